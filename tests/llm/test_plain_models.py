"""The fitted operators (5, 7, 9) against plain recomputations: posteriors in Python, rates by trying every
active set, n-grams counted one by one, one gradient step in loops."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakebars.llm import lang_id, mixing, quality


# ---------------------------------------------------------------- 5 quality

def plain_strength(sites):
    """Beta-binomial precision by moments over ``(n, share, parent)``."""
    spread = sum(n * (s - p) ** 2 for n, s, p in sites)
    noise = sum(p * (1 - p) for _, _, p in sites)
    typical, weight = sum(n * p * (1 - p) for n, _, p in sites), sum(n for n, _, _ in sites)
    if not weight or not noise:
        return 1e6
    between = (spread - noise) / weight
    return min(1e6, max(1.0, typical / weight / between - 1)) if between > 0 else 1e6


def plain_posteriors(rows):
    """``(host prior, path prior, posterior)`` of ``(host, path, bad)`` rows, a row's own part taken out."""
    hosts, paths = defaultdict(list), defaultdict(list)
    for host, path, bad in rows:
        hosts[host].append(bad)
        paths[host, path].append(bad)
    overall = (sum(b for *_, b in rows) + 0.5) / (len(rows) + 1.0)
    k = plain_strength([(len(v), sum(v) / len(v), overall) for v in hosts.values()])
    share = {h: (sum(v) + k * overall) / (len(v) + k) for h, v in hosts.items()}
    k_path = plain_strength([(len(v), sum(v) / len(v), share[h]) for (h, _), v in paths.items()])
    logit = lambda p: math.log(min(1 - 1e-4, max(1e-4, p)) / (1 - min(1 - 1e-4, max(1e-4, p))))
    out = []
    for host, path, bad in rows:
        own = hosts[host]
        prior = (sum(own) - bad + k * overall) / (len(own) - 1 + k)
        here = paths[host, path]
        at = (sum(here) - bad + k_path * prior) / (len(here) - 1 + k_path)
        out.append((prior, at, 1 / (1 + math.exp(-(logit(bad) - logit(overall) + logit(at))))))
    return out


@pytest.mark.parametrize("spread", [0.02, 0.4])
def test_site_posteriors_against_a_plain_version(spark, spread):
    """A third of all documents on one host, single ones on others; alike sites and very different ones."""
    rng = random.Random(3)
    base = {f"h{k}": min(0.95, max(0.02, 0.3 + rng.uniform(-spread, spread))) for k in range(12)}
    sources = ["hot.org/a"] * 60 + ["hot.org/b"] * 40 + [f"h{rng.randint(0, 11)}/{rng.choice('pq')}" for _ in range(150)]
    sources += [f"single{k}" for k in range(20)] + [None] * 5 + ["https://h1/p?x", "HTTP://h2/q#y"]
    rows = []
    for k, s in enumerate(sources):
        bare = (s or "").split("://")[-1]
        host, path = bare.split("/")[0], "/".join(bare.split("?")[0].split("#")[0].split("/")[:2])
        rows.append((k, s, min(0.999, max(0.001, rng.gauss(base.get(host, 0.3), 0.1))), host, path))
    scored = spark.createDataFrame([r[:3] for r in rows], "id long, source string, classifier double")
    sites, overall = quality.site_posteriors(scored, "source", "classifier")
    got = {r["id"]: (r["host_prior"], r["path_prior"], r["posterior"])
           for r in quality.judge(scored, sites, overall, quality.NAMES, "source", "classifier").collect()}
    for (k, *_), want in zip(rows, plain_posteriors([(h, p, b) for _, _, b, h, p in rows])):
        assert np.allclose(got[k], want, rtol=1e-9, atol=1e-12), (k, got[k], want)


def test_posteriors_of_the_whole_operator(spark):
    """From documents to posteriors: what ``assess`` returns follows from its own classifier scores."""
    from tests.llm.test_operators import frame, judged

    docs, labels = judged(300)
    rows = quality.assess(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    parts = []
    for r in rows:
        bare = (r["source"] or "").split("://")[-1]
        parts.append((bare.split("/")[0], "/".join(bare.split("?")[0].split("#")[0].split("/")[:2]), r["classifier"]))
    for r, want in zip(rows, plain_posteriors(parts)):
        good = 1.0
        for c in ("low_odds", "toxic_odds"):
            good *= 1 - 1 / (1 + math.exp(-r[c]))
        assert abs(r["classifier"] - (1 - good)) < 1e-12
        assert np.allclose((r["host_prior"], r["path_prior"], r["posterior"]), want, rtol=1e-7, atol=1e-10)
        assert r["kept"] == (r["posterior"] < quality.THRESHOLD)


# ---------------------------------------------------------------- 7 mixing

def least_change(words, chances, goal):
    """Rates >= 0 that meet the goals and change least (by words), found by trying every set of zero rates."""
    n, k = chances.shape
    for zeros in itertools.chain.from_iterable(itertools.combinations(range(n), m) for m in range(n)):
        free = np.setdiff1d(np.arange(n), zeros)
        p, w = chances[free], words[free]
        pulls, *_ = np.linalg.lstsq((p * w[:, None]).T @ p, (p * w[:, None]).sum(0) - goal, rcond=None)
        rates = 1 - chances @ pulls
        if (rates[free] >= -1e-9).all() and (rates[list(zeros)] <= 1e-9).all() and np.allclose(
                (chances[free] * w[:, None]).T @ rates[free], goal, rtol=1e-6, atol=1e-6 * words.sum()):
            return np.maximum(0, rates)
    return None


@pytest.mark.parametrize("k, weights", [(2, [0.8, 0.2]), (2, [0.5, 0.5]), (3, [0.6, 0.3, 0.1]), (3, [0.05, 0.05, 0.9])])
def test_rates_against_every_active_set(spark, k, weights):
    rng = np.random.default_rng(k)
    found = 0
    for trial in range(3):
        n = rng.integers(1, 50, 10)
        p = rng.dirichlet([0.4] * k, 10)
        want = least_change(n.astype(float), p, np.array(weights) * n.sum())
        if want is None:
            continue
        found += 1
        rows = [(i, int(n[i]), 1, *map(float, p[i])) for i in range(10)]
        members = spark.createDataFrame(rows, "id long, n long, rows long, " + ", ".join(f"p{j} double" for j in range(k))).cache()
        rated, told = mixing.fit_rates(members, k, weights)
        got = np.array([r["rate"] for r in rated.orderBy("id").collect()])
        assert told["gap"] <= 10 * mixing.TOLERANCE       # the ridge holds extreme targets back a little
        assert np.allclose(got, want, atol=2e-3), (trial, got, want)
    assert found


# ---------------------------------------------------------------- 9 languages

def plain_features(text):
    words = "".join(c if ord(c) >= 0x80 or c.isalpha() else " " for c in text.lower()).split(" ")
    data = (" " + " ".join(w for w in words if w) + " ").encode()
    counts = Counter()
    for n in lang_id.ORDERS:
        for lo in range(len(data) - n + 1):
            h = n
            for byte in data[lo:lo + n]:
                h = (h * 0x01000193 + byte) & 0xFFFFFFFF
            h ^= h >> 15
            h = (h * 0x2C1B3C6D) & 0xFFFFFFFF
            counts[h >> 19] += 1
    total = max(1, sum(counts.values()))
    return {b: c / total for b, c in counts.items()}


@pytest.mark.parametrize("text", ["", "a", "Hello, World 42!", "éÀ ñandú straße", "x" * 300, "日本語 テスト", "a1b2c3"])
def test_features_against_a_plain_version(text):
    got = lang_id.features(text)
    want = plain_features(text)
    assert {int(b) for b in np.flatnonzero(got)} == set(want)
    assert all(abs(got[b] - share) < 1e-12 for b, share in want.items())


def test_one_step_of_training_against_loops():
    """One batch of five rows: hidden averages, softmax, and both gradients written out."""
    rng = np.random.default_rng(2)
    rows = [(np.sort(rng.choice(lang_id.BUCKETS, 6, replace=False)), rng.dirichlet([1.0] * 6)) for _ in range(5)]
    labels, classes = np.array([0, 2, 1, 2, 0]), 3
    embed, weights = lang_id.train(rows, labels, classes, seed=4, epochs=1)
    again = np.random.default_rng(4)
    e0, w0 = again.normal(0, 0.1, (lang_id.BUCKETS, lang_id.DIM)), again.normal(0, 0.1, (lang_id.DIM, classes))
    w1, e1 = w0.copy(), e0.copy()
    for (at, share), label in zip(rows, labels):
        hidden = [lang_id.SCALE * sum(s * e0[b, d] for b, s in zip(at, share)) for d in range(lang_id.DIM)]
        z = [sum(hidden[d] * w0[d, c] for d in range(lang_id.DIM)) for c in range(classes)]
        total = sum(math.exp(x) for x in z)
        error = [math.exp(z[c]) / total - (c == label) for c in range(classes)]
        for d in range(lang_id.DIM):
            for c in range(classes):
                w1[d, c] -= lang_id.RATE * hidden[d] * error[c] / len(rows)
            back = lang_id.SCALE * sum(error[c] * w0[d, c] for c in range(classes)) / len(rows)
            for b, s in zip(at, share):
                e1[b, d] -= lang_id.RATE * s * back
    assert np.allclose(embed, e1, atol=1e-10) and np.allclose(weights, w1, atol=1e-10)
