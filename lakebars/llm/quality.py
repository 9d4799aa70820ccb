"""Document quality by hierarchical empirical Bayes over hosts and paths.

Two logistic classifiers give each document evidence: that its quality is
low, and that it is toxic.  They see statistics of the whole text and the
strongest evidence of any word (by itself and by its beginnings), so a long
text does not hide a few bad words.  They are fitted on a bounded sample of
the labelled documents; the weights of each half are fitted on the word
evidence that the other half taught.

The share of bad documents differs by site.  Each host's share is the mean
of its documents' posteriors, shrunk toward the global share; each path's is
shrunk toward its host's.  The strength of the shrinkage is estimated from
the spread between sites (beta-binomial moments), so sparse sites follow
their parents and large ones speak for themselves.  A document's posterior
joins its own evidence with its path's share, its own part taken out.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakebars.llm.common import WORD_TABLE, fresh, materialize, prepare

SAMPLE = 20_000          # labelled documents fitted on at most, in expectation
LEARNED = 40_000         # word features kept for each class at most
LEAST_DOCS = 4           # documents of the class that must have a word feature
LEAST_LOGODDS = 2.0      # smallest evidence of a word feature that is kept
STARTS = (4, 5, 6)       # beginnings of words that are features too
THRESHOLD = 0.5          # documents with a posterior of being bad at or over it are rejected
BROADCAST_SITES = 100_000
SLICE = 1 << 20          # bytes of a text taken at a time
CLASSES = ("low", "toxic")
COUNTED = (*[f"n_{c}" for c in CLASSES], *CLASSES)

_SPACE = re.compile(rb"[ \t-\r]")
_SYMBOLS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-()?")
_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = bytes(range(0x30, 0x3A))


def _slices(data: bytes):
    lo = 0
    while lo < len(data):
        cut = _SPACE.search(data, lo + SLICE)
        hi = cut.start() if cut else len(data)
        yield data[lo:hi]
        lo = hi


def word_features(words: set[bytes]) -> set[bytes]:
    """The words and their beginnings (marked, so that they differ from whole words)."""
    return words.union(*({w[:n] + b"*" for w in words if len(w) > n} for n in STARTS))


def text_features(data: bytes, evidence: dict[str, tuple]) -> list[float]:
    """Statistics of a whole text, then for each class its strongest words' evidence."""
    n_bytes, n_words, repeats, symbols, upper, digits = len(data), 0, 0, 0, 0, 0
    last, vocabulary = None, set()
    for part in _slices(data):
        words = part.split()
        repeats += sum(map(bytes.__eq__, words[1:], words[:-1])) + (bool(words) and words[0] == last)
        last = words[-1] if words else last
        n_words += len(words)
        symbols += n_bytes_of(part, _SYMBOLS)
        upper += n_bytes_of(part, _UPPER)
        digits += n_bytes_of(part, _DIGITS)
        vocabulary.update(part.translate(WORD_TABLE).split())
    own, strong = word_features(vocabulary), []
    for names, odds in evidence.values():
        top = sorted((odds[f] for f in own & names), reverse=True)[:8]
        strong += [top[0] if top else 0.0, sum(top)]
    share = lambda n, of: math.log(n / max(1, of) + 1e-3)
    return [share(symbols, n_bytes), share(upper, n_bytes), share(digits, n_bytes), share(repeats, n_words),
            share(len(vocabulary), n_words), n_bytes / max(1, n_words), math.log1p(n_words),
            float(n_words == 0), *strong]


def n_bytes_of(data: bytes, wanted: bytes) -> int:
    return len(data) - len(data.translate(None, wanted))


def _lookup(features: dict[str, dict]) -> dict[str, tuple]:
    return {c: (frozenset(f), f) for c, f in features.items()}


def _logit(p):
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> dict:
    """Ridge logistic regression by Newton's method on standardised columns."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    prior = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = _logit(prior)
    penalty = np.full(len(w), ridge * len(y) / 100 + 1e-3)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return {"mean": mean, "scale": scale, "w": w, "prior": float(prior)}


def log_odds(model: dict, x: np.ndarray) -> np.ndarray:
    return np.clip(np.column_stack([(x - model["mean"]) / model["scale"], np.ones(len(x))]) @ model["w"], -12, 12)


def _count_words(sample: DataFrame) -> DataFrame:
    """By word feature and half of the sample: documents that have it, for each class all with its label and bad ones."""
    def run(batches):
        for batch in batches:
            counts: dict[tuple, Counter] = {}
            for half, low, toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = word_features(set(
                    (text or "").encode("utf-8", "surrogatepass").translate(WORD_TABLE).split()))
                for name, has in (("n_low", low is not None), ("n_toxic", toxic is not None), ("low", low),
                                  ("toxic", toxic)):
                    if has:
                        counts.setdefault((half, name), Counter()).update(own)
            for half in sorted({h for h, _ in counts}):
                mine = [counts.get((half, name), Counter()) for name in COUNTED]
                names = list(mine[0].keys() | mine[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array(np.full(len(names), half), pa.int64()),
                     *(pa.array([c[f] for f in names], pa.int64()) for c in mine)], ["f", "half", *COUNTED])

    return sample.mapInArrow(run, "f binary, half long, " + ", ".join(f"{c} long" for c in COUNTED)).groupBy(
        "f", "half").agg(*[F.sum(c).alias(c) for c in COUNTED])


def _word_evidence(counts: DataFrame, sizes: dict[str, int]) -> dict[str, dict]:
    """By class: the log odds of the word features that are telling enough, at most ``LEARNED``."""
    both = counts.groupBy("f").agg(*[F.sum(c).alias(c) for c in COUNTED])
    features = {}
    for c in CLASSES:
        inside = F.log((F.col(c) + 0.5) / (sizes[c] + 1.0))
        outside = F.log((F.col(f"n_{c}") - F.col(c) + 0.5) / (sizes[f"n_{c}"] - sizes[c] + 1.0))
        best = (both.where(F.col(c) >= LEAST_DOCS).withColumn("e", inside - outside)
                .where(F.col("e") >= LEAST_LOGODDS).orderBy(F.desc(F.col("e") * F.sqrt(c)), "f").limit(LEARNED))
        features[c] = {bytes(r["f"]): r["e"] for r in best.select("f", "e").collect()}
    return features


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE, seed: int = 11) -> dict:
    """Both classifiers, from about ``sample`` labelled documents chosen by a hash of the id.

    The weights are fitted on word evidence that the other half of the
    sample taught, the evidence that the model keeps is that of both halves.
    Each classifier learns from the rows that have its label, whatever the
    other is; an id labelled several times counts as bad if any of its labels
    does.  Without labels the model has no evidence.
    """
    clean = labels.where(F.col(id_col).isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    clean = clean.groupBy(id_col).agg((F.min("quality") == 0).alias("low"), (F.max("toxic") == 1).alias("toxic"))
    total = clean.count()
    place = F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(1 << 30)) / float(1 << 30)
    chosen = clean.where(place < min(1.0, sample / max(1, total))).withColumn(
        "half", F.pmod(F.xxhash64(F.lit(seed + 1), id_col), F.lit(2)))
    # bounded by ``sample`` rows, so it may be broadcast
    rows = materialize(docs.select(id_col, F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(chosen), id_col).select("half", "low", "toxic", "text"), "quality-sample")
    sizes = {r["half"]: r for r in rows.groupBy("half").agg(
        *[F.count(c).alias(f"n_{c}") for c in CLASSES], *[F.count_if(c).alias(c) for c in CLASSES]).collect()}
    count = lambda halves: {c: sum(sizes[h][c] for h in halves if h in sizes) for c in COUNTED}
    counts = materialize(_count_words(rows), "quality-words")
    parts = []
    for half in (0, 1):
        taught = _word_evidence(counts.where(F.col("half") == 1 - half), count([1 - half]))
        parts.append(_measure(rows.where(F.col("half") == half).select("low", "toxic", "text"), taught,
                              ["low", "toxic"]).toArrow())
    got = pa.concat_tables(parts)
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(len(got), -1 if len(got) else 1)
    order = np.lexsort(x.T)   # the fit does not depend on how the tasks were dealt out
    model = {"features": _word_evidence(counts, count([0, 1])), "models": {}}
    for c in CLASSES:
        y = np.array(got.column(c).to_pylist(), np.float64)   # NULL is NaN
        own = order[~np.isnan(y[order])]
        if len(own) and 0 < y[own].sum() < len(own):
            model["models"][c] = fit_logistic(x[own], y[own])
    return model


def _measure(rows: DataFrame, features: dict, keep: list[str]) -> DataFrame:
    """Text features of every row; the text is the column after ``keep``."""
    shared = rows.sparkSession.sparkContext.broadcast(features)
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        evidence = _lookup(shared.value)
        for batch in batches:
            x = [text_features((t or "").encode("utf-8", "surrogatepass"), evidence)
                 for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), pa.array(x, pa.list_(pa.float64()))], [*keep, "x"])

    return rows.mapInArrow(run, f"{fields}, x array<double>")


def with_evidence(docs: DataFrame, model: dict, text_col: str, names: dict[str, str], keep: list[str]) -> DataFrame:
    """``keep`` columns with each classifier's log odds (``names`` by class), the whole text measured."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = fresh("measured_text", docs.columns)
    frame = docs.select(*keep, F.col(text_col).cast("string").alias(text))
    schema = StructType([*(frame.schema[c] for c in keep), *(StructField(names[c], DoubleType()) for c in CLASSES)])
    never = -12.0

    def run(batches):
        own = shared.value
        evidence = _lookup(own["features"])
        for batch in batches:
            x = [text_features((t or "").encode("utf-8", "surrogatepass"), evidence)
                 for t in batch.column(len(keep)).to_pylist()]
            odds = [log_odds(own["models"][c], np.array(x)) if c in own["models"] and x else np.full(len(x), never)
                    for c in CLASSES]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), *(pa.array(o, pa.float64()) for o in odds)],
                [*keep, *names.values()])

    return frame.mapInArrow(run, schema)


def host_of(source: Column) -> Column:
    """The host of a source: without scheme, up to the first slash; NULL becomes the empty host."""
    bare = F.regexp_replace(F.coalesce(source.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.substring_index(bare, "/", 1)


def path_of(source: Column) -> Column:
    """The host and the first segment of the path, if there is one."""
    bare = F.regexp_replace(F.coalesce(source.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.substring_index(F.regexp_replace(bare, r"[?#].*$", ""), "/", 2)


def _sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _bounded_logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), p))
    return F.log(p / (1 - p))


def _strength(sites: DataFrame, share: Column, parent: Column) -> float:
    """Documents that a parent's share is worth: the beta-binomial precision by moments."""
    n, gap = F.col("n"), share - parent
    spread, noise, typical, weight = sites.agg(
        F.sum(n * gap * gap), F.sum(parent * (1 - parent)), F.sum(n * parent * (1 - parent)), F.sum(n)).first()
    if not weight or not noise:
        return 1e6
    between = (float(spread) - float(noise)) / float(weight)   # variance beyond that of sampling
    return float(np.clip(float(typical) / float(weight) / between - 1 if between > 0 else 1e6, 1.0, 1e6))


def site_posteriors(scored: DataFrame, source_col: str, bad: str) -> tuple[DataFrame, float]:
    """By path: documents, bad ones expected, and the shrunken shares of host and path; the global share.

    One grouped aggregation over all documents; hosts are summed from it.
    """
    paths = materialize(scored.groupBy(host_of(F.col(source_col)).alias("host"), path_of(F.col(source_col)).alias(
        "path")).agg(F.count(F.lit(1)).alias("n"), F.sum(bad).alias("bad")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total, expected = hosts.agg(F.sum("n"), F.sum("bad")).first()
    overall = (float(expected or 0) + 0.5) / (float(total or 0) + 1.0)
    k = _strength(hosts, F.col("bad") / F.col("n"), F.lit(overall))
    hosts = hosts.select("host", F.col("n").alias("host_n"), F.col("bad").alias("host_bad"),
                         ((F.col("bad") + k * overall) / (F.col("n") + k)).alias("host_share"))
    both = paths.join(hosts, "host")
    k_path = _strength(both, F.col("bad") / F.col("n"), F.col("host_share"))
    return both.select("host", "path", "n", F.col("bad").alias("path_bad"), "host_n", "host_bad",
                       F.lit(k).alias("host_k"), F.lit(k_path).alias("path_k")), overall


def judge(scored: DataFrame, sites: DataFrame, overall: float, names: dict[str, str], source_col: str,
          bad: str) -> DataFrame:
    """Adds ``host_prior``, ``path_prior`` and ``posterior`` (of being bad), a document's own part taken out."""
    small = sites.count() <= BROADCAST_SITES
    taken = [*scored.columns, *sites.columns]
    h, p = fresh("own_host", taken), fresh("own_path", taken)
    joined = scored.withColumn(h, host_of(F.col(source_col))).withColumn(p, path_of(F.col(source_col)))
    other = sites.select(*[F.col(c).alias(fresh(f"site_{c}", scored.columns)) for c in sites.columns])
    s = dict(zip(sites.columns, other.columns))
    joined = joined.join(F.broadcast(other) if small else other,
                         (F.col(h) == F.col(s["host"])) & (F.col(p) == F.col(s["path"])), "left")
    host = ((F.col(s["host_bad"]) - F.col(bad) + F.col(s["host_k"]) * overall)
            / (F.col(s["host_n"]) - 1 + F.col(s["host_k"])))
    joined = joined.withColumn(names["host_prior"], host)
    path = ((F.col(s["path_bad"]) - F.col(bad) + F.col(s["path_k"]) * F.col(names["host_prior"]))
            / (F.col(s["n"]) - 1 + F.col(s["path_k"])))
    joined = joined.withColumn(names["path_prior"], path)
    # the classifiers' odds already hold the global share; the path's takes its place
    moved = _bounded_logit(F.col(bad)) - _bounded_logit(F.lit(overall)) + _bounded_logit(F.col(names["path_prior"]))
    return joined.withColumn(names["posterior"], _sigmoid(moved)).drop(h, p, *other.columns)


def bad_share(names: dict[str, str]) -> Column:
    """The chance that either classifier is right, from their log odds."""
    good = F.lit(1.0)
    for c in CLASSES:
        good = good * (1 - _sigmoid(F.col(names[c])))
    return 1 - good


NAMES = {"low": "low_odds", "toxic": "toxic_odds", "bad": "classifier", "host_prior": "host_prior",
         "path_prior": "path_prior", "posterior": "posterior"}


def assess(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: the id, the source, the odds and priors named in ``NAMES``, and ``kept``.

    A document is kept when its posterior of being bad is under
    ``threshold``.  NULL and empty texts are measured as texts without words;
    NULL sources are one site.  Without labels every document is kept.  No
    rows give no rows.
    """
    prepare(docs.sparkSession)
    model = fit(docs, labels, id_col, text_col, sample)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                         F.col(text_col).alias("text"))
    scored = with_evidence(narrow, model, "text", {c: NAMES[c] for c in CLASSES}, ["id", "source"])
    scored = materialize(scored.withColumn(NAMES["bad"], bad_share(NAMES)), "quality-scores")
    sites, overall = site_posteriors(scored, "source", NAMES["bad"])
    out = judge(scored, sites, overall, NAMES, "source", NAMES["bad"])
    return out.withColumn("kept", F.col("posterior") < threshold).withColumnsRenamed(
        {"id": id_col, "source": source_col})


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The documents (all columns) that :func:`assess` keeps.

    The texts are measured a second time instead of being shuffled to their
    scores.
    """
    prepare(docs.sparkSession)
    model = fit(docs, labels, id_col, text_col, sample)
    names = {k: fresh(v, docs.columns) for k, v in NAMES.items()}
    odds = {c: names[c] for c in CLASSES}
    sites, overall = site_posteriors(
        with_evidence(docs, model, text_col, odds, [source_col]).withColumn(names["bad"], bad_share(names)),
        source_col, names["bad"])
    scored = with_evidence(docs, model, text_col, odds, docs.columns).withColumn(names["bad"], bad_share(names))
    out = judge(scored, sites, overall, names, source_col, names["bad"])
    return out.where(F.col(names["posterior"]) < threshold).select(*docs.columns)
