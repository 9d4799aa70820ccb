"""Plain single-process versions of the operators, to test against."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = " \t\n\x0b\x0c\r"


def low(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def spaced(text: str | None) -> list[str]:
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def components(ids: list, linked) -> dict:
    """Smallest id reachable; ``linked(i, j)`` over positions."""
    label = list(range(len(ids)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                if a != b:
                    small, large = sorted((a, b), key=lambda k: ids[k])
                    label[large] = small
    return {k: ids[root(k)] for k in range(len(ids))}


def simhash(text: str | None) -> int:
    words = spaced(low(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows: list[tuple]) -> list[tuple]:
    fps = [simhash(t) for _, t in rows]
    named = [k for k, r in enumerate(rows) if r[0] is not None]
    group = components([rows[k][0] for k in named], lambda i, j: (fps[named[i]] ^ fps[named[j]]).bit_count() <= 3)
    of = {k: group[n] for n, k in enumerate(named)}
    by_fp = {fps[k]: of[k] for k in named}
    return [(r[0], format(fps[k], "016x"), of.get(k, by_fp.get(fps[k]))) for k, r in enumerate(rows)]


def line_dedup(rows: list[tuple]) -> list[tuple]:
    """(id, lines, dropped, text left); NULL ids are one document after all others."""
    place = lambda i: (i is None, i or 0)
    key = lambda line: low(line.strip(SPACE))
    first = {}
    for i, text in sorted(rows, key=lambda r: place(r[0])):
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                first.setdefault(key(line), i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def lm_scores_of_order(rows: list[tuple], order: int, backoff: float = 0.4) -> list[tuple]:
    words = [spaced(low(t or "")) for _, t in rows]
    grams = lambda w: Counter(tuple(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    every = sum(map(grams, words), Counter())
    total, out = sum(map(len, words)), []
    for (i, _), w in zip(rows, words):
        own, score, seen = grams(w), 0.0, 0
        others = lambda g: every[g] - own[g]

        def chance(g):
            if len(g) == 1:
                return (others(g) or 0.5) / max(1, total - len(w))
            return others(g) / others(g[:-1]) if others(g) > 0 else backoff * chance(g[1:])

        for k in range(len(w)):
            g = tuple(w[max(0, k + 1 - order):k + 1])
            score += math.log(chance(g))
            seen += len(g) == order and others(g) > 0
        out.append((i, len(w), seen, score))
    return out


def contamination(rows: list[tuple], items: list[tuple]) -> list[tuple]:
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall(low(text or ""))
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i:i + n])].add(item)
    out = []
    for doc, text in rows:
        w = word.findall(low(text or ""))
        hit, found = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i:i + n]))
                if own is not None:
                    found |= own
                    hit[i:i + n] = [True] * n
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), sum(hit), names, sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


def substrings(rows: list[tuple], width: int = 50) -> list[tuple]:
    first: dict = {}
    for i, text in rows:
        if i is not None:
            w = spaced(text)
            for k in range(len(w) - width + 1):
                gram = tuple(w[k:k + width])
                first[gram] = min(first.get(gram, i), i)
    out = []
    for i, text in rows:
        w = spaced(text)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k:k + width])] < i:
                gone[k:k + width] = [True] * width
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def longest_level(rows: list[tuple], width: int = 50) -> dict:
    """By id: the longest doubling of ``width`` at which another id shares a window."""
    out: dict = {}
    size = width
    while True:
        holders = defaultdict(set)
        for i, text in rows:
            w = spaced(text)
            for k in range(len(w) - size + 1):
                holders[tuple(w[k:k + size])].add(i)
        shared = [h for h in holders.values() if len(h) > 1]
        if not shared:
            return out
        for h in shared:
            for i in h:
                out[i] = size
        size *= 2


def cosine_groups(rows: list[tuple], least: float = 0.9) -> list[tuple]:
    def unit(v):
        if v is None or not len(v) or any(x is None for x in v):
            return None
        v = np.asarray(v, np.float64)
        if not np.isfinite(v).all() or not v.any():
            return None
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)

    named = [k for k, r in enumerate(rows) if r[0] is not None]
    units = [unit(rows[k][1]) for k in named]
    links = lambda i, j: (units[i] is not None and units[j] is not None and len(units[i]) == len(units[j])
                          and float(units[i] @ units[j]) >= least)
    group = components([rows[k][0] for k in named], links)
    of = {k: (sum(links(n, m) for m in range(len(named)) if m != n), group[n]) for n, k in enumerate(named)}
    return [(r[0], of[k][0], of[k][1], of[k][1] == r[0]) if k in of else (None, 0, None, True)
            for k, r in enumerate(rows)]


def lm_scores(rows: list[tuple], backoff: float = 0.4) -> list[tuple]:
    words = [spaced(low(t or "")) for _, t in rows]
    one, two = Counter(), Counter()
    for w in words:
        one.update(w)
        two.update(zip(w, w[1:]))
    total, out = sum(one.values()), []
    for (i, _), w in zip(rows, words):
        own1, own2, score, seen = Counter(w), Counter(zip(w, w[1:])), 0.0, 0
        for k, x in enumerate(w):
            alone = (one[x] - own1[x] or 0.5) / max(1, total - len(w))
            if k == 0:
                score += math.log(alone)
                continue
            n = two[w[k - 1], x] - own2[w[k - 1], x]
            seen += n > 0
            score += math.log(n / (one[w[k - 1]] - own1[w[k - 1]])) if n > 0 else math.log(backoff * alone)
        out.append((i, len(w), seen, score))
    return out
