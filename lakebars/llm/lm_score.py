"""Stupid-backoff scores of documents, every document scored by the counts of all the others.

The corpus is dealt into groups of documents by a hash of the row.  A group
lists its distinct n-grams of each order, as 64-bit hashes in ascending
order with their counts, cut into stretches by hash range.  All stretches of
a range meet in one task, which adds up the counts: that is the range's
part of the n-gram table.  It answers each stretch with the corpus counts in
the order they were asked in, and each group joins the answers to the
n-grams of its documents and sums the scores.

An n-gram travels once per group that has it, packed; a frequent one is
combined in its group first, so no range is hot.  Counts, like the table,
cover every document and grow with the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebars.llm.common import LOWER_TABLE, materialize, prepare, shuffle_width

ORDER = 2
BACKOFF = 0.4
CACHE = 1 << 18
GROUPS_EACH = 2          # groups of documents for each shuffle partition at least
GROUP_BYTES = 16 << 20   # UTF-8 bytes of text of a group, in expectation at most
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xFF51AFD7ED558CCD)


class _Hashes(dict):
    """XXH64 of words; forgets everything when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """White-space separated words, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER_TABLE).split()


def _grams(words: np.ndarray, sizes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places (of the last word) of all n-grams of ``order`` words inside documents."""
    with np.errstate(over="ignore"):
        h = words[:len(words) - order + 1].copy() if len(words) >= order else words[:0]
        for k in range(1, order):
            h = (h ^ (h >> np.uint64(31))) * MULTIPLIER + words[k:k + len(h)]
        h = (h ^ (h >> np.uint64(33))) * MIX
        h ^= h >> np.uint64(29)
    of = np.repeat(np.arange(len(sizes)), sizes)
    first, last = of[:len(h)], of[order - 1:order - 1 + len(h)]
    inside = first == last
    return h[inside], np.flatnonzero(inside) + order - 1


def _read_group(texts: list, known: _Hashes, order: int):
    """Words of a group's documents and, for each order, distinct n-grams, which each is, and where."""
    parts = [np.fromiter(map(known.__getitem__, words_of(t)), np.uint64) for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    out = []
    for n in range(1, order + 1):
        h, at = _grams(words, sizes, n)
        distinct, which, counts = np.unique(h, return_inverse=True, return_counts=True)
        out.append((distinct, which, counts, at))
    return sizes, out


def _cuts(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where the hash ranges begin and end in an ascending list of hashes."""
    bounds = (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(np.uint64)
    return np.r_[0, np.searchsorted(hashes, bounds), len(hashes)]


def pack(numbers: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as differences, byte planes apart, so that high zero bytes cost little."""
    steps = np.diff(numbers, prepend=np.uint64(0)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack_counts(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<i8").ravel()


def _ask(order: int, ranges: int):
    """A group's documents to its packed n-grams, one row for each order and hash range."""
    def run(key, frame):
        known = _Hashes()
        _, grams = _read_group(frame.column("text").to_pylist(), known, order)
        out = []
        for n, (distinct, _, counts, _) in enumerate(grams, 1):
            cuts = _cuts(distinct, ranges)
            for r in range(ranges):
                lo, hi = cuts[r], cuts[r + 1]
                if hi > lo:
                    out.append((n, r, key[0].as_py(), int(hi - lo),
                                int(counts[lo:hi].sum()), pack(distinct[lo:hi]), _pack_counts(counts[lo:hi])))
        columns = list(zip(*out)) if out else [()] * 7
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, ASK_TYPES)], names=ASK)

    return run


ASK = ["n", "range", "grp", "size", "words", "grams", "counts"]
ASK_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
ANSWER_SCHEMA = "n int, range int, grp int, size long, words long, counts binary"
ASK_SCHEMA = "n int, range int, grp int, size long, words long, grams binary, counts binary"


def _answer(key, frame):
    """One order's hash range: corpus counts for every stretch, in the order asked; its own words go along."""
    sizes = frame.column("size").to_pylist()
    hashes = [unpack(g.as_py(), n) for g, n in zip(frame.column("grams"), sizes)]
    counts = [_unpack_counts(c.as_py(), n) for c, n in zip(frame.column("counts"), sizes)]
    distinct, which = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, which, np.concatenate(counts))
    ends = np.cumsum(sizes)
    answers = [_pack_counts(total[which[hi - n:hi]]) for n, hi in zip(sizes, ends)]
    return pa.Table.from_arrays(
        [*(frame.column(c) for c in ("n", "range", "grp", "size", "words")), pa.array(answers, pa.binary())],
        names=["n", "range", "grp", "size", "words", "counts"])


def backoff_scores(corpus: list[np.ndarray], own: list[np.ndarray], totals: np.ndarray, vocabulary_floor: float,
                   backoff: float = BACKOFF) -> np.ndarray:
    """Natural logarithms of the scores of n-grams that end at the same words.

    ``corpus[k]`` and ``own[k]`` are the counts of the (k+1)-word n-gram that
    ends at each word, in the corpus and in the document itself (-1 where
    the document begins later), and ``totals`` the words the other documents have.
    """
    left = [c - o for c, o in zip(corpus, own)]
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(left[0] > 0, left[0], vocabulary_floor) / np.maximum(totals, 1)
        for k in range(1, len(left)):
            # the n-gram's context is the shorter n-gram that ends one word earlier
            before = np.r_[0, left[k - 1][:-1]]
            seen = (own[k] >= 0) & (left[k] > 0)
            lower = np.where(own[k] >= 0, backoff * score, score)
            score = np.where(seen, left[k] / np.maximum(before, 1), lower)
    return np.log(score)


def _score(order: int, backoff: float):
    """A group's documents and the answers to its n-grams: a row of scores for each document."""
    def run(key, docs, answers):
        texts = docs.column("text").to_pylist()
        sizes, grams = _read_group(texts, _Hashes(), order)
        rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("n", "range", "size", "counts", "words"))),
                      key=lambda r: r[:2])
        everything = rows[0][4] if rows else 0
        of = np.repeat(np.arange(len(sizes)), sizes)
        corpus, own = [], []
        for n, (distinct, which, _, at) in enumerate(grams, 1):
            stretches = [_unpack_counts(r[3], r[2]) for r in rows if r[0] == n]
            table = np.concatenate(stretches) if stretches else np.zeros(0, np.int64)
            pair, inverse, count = np.unique(of[at] * max(1, len(distinct)) + which, return_inverse=True,
                                             return_counts=True)
            everywhere, here = np.full(len(of), -1, np.int64), np.full(len(of), -1, np.int64)
            everywhere[at], here[at] = table[which], count[inverse]
            corpus.append(everywhere)
            own.append(here)
        scores = backoff_scores(corpus, own, (everything - sizes)[of], 0.5, backoff)
        total = np.zeros(len(sizes))
        np.add.at(total, of, scores)
        seen = np.zeros(len(sizes), np.int64)
        np.add.at(seen, of, (corpus[-1] > own[-1]).astype(np.int64))
        mean = [float(t / n) if n else None for t, n in zip(total, sizes)]
        return pa.Table.from_arrays([docs.column("id"), pa.array(sizes), pa.array(seen), pa.array(total),
                                     pa.array(mean, pa.float64())],
                                    names=["id", "n_words", "n_seen", "log_score", "mean_log_score"])

    return run


def groups_and_ranges(rows: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Groups of documents and hash ranges, by bytes of text; at least as many as the shuffle partitions give."""
    size = rows.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    width = shuffle_width(rows.sparkSession)
    groups = max(GROUPS_EACH * width, -(-size // GROUP_BYTES))
    return groups, max(width, groups // GROUPS_EACH)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                    backoff: float = BACKOFF) -> DataFrame:
    """One row per input row: the id, ``n_words``, ``n_seen``, ``log_score``, ``mean_log_score``.

    The score of a word after its context is the share of the context's
    occurrences that the word follows, both counted in all other rows; when
    the n-gram occurs nowhere else, ``backoff`` times the score after a
    context one word shorter; a word seen nowhere else counts as half an
    occurrence.  ``log_score`` is the sum of natural logarithms over the words,
    ``n_seen`` the words whose longest n-gram is known.  NULL and empty texts
    have no words, score 0 and a NULL mean.  Repeated rows are rows of their
    own and know each other's words.  No rows give no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    groups, ranges = groups_and_ranges(rows)
    group = F.pmod(F.xxhash64("id", "text"), F.lit(groups)).cast("int")
    dealt = rows.select(group.alias("grp"), "id", "text").repartition(ranges, "grp")
    asked = dealt.groupBy("grp").applyInArrow(_ask(order, ranges), ASK_SCHEMA)
    answers = materialize(asked.groupBy("n", "range").applyInArrow(_answer, ANSWER_SCHEMA), "lm-answers")
    words = int(answers.where("n = 1").agg(F.sum("words")).first()[0] or 0)
    answers = answers.withColumn("words", F.lit(words).cast("long"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = dealt.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(
        _score(order, backoff), f"id {kind}, n_words long, n_seen long, log_score double, mean_log_score double")
    return out.withColumnRenamed("id", id_col)
