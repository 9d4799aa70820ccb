"""Substring deduplication by level-wise doubling of repeated word windows.

Level 0 is half of the shortest repeat that counts.  Of every window of
``min_words`` words one window of half its length is taken, the one with the
smallest hash; equal windows have equal ones, so a window can only be
repeated if its chosen half is.  Halves found in two documents
are extended to twice their length, repeats among these again to twice
that, and so on until no candidate survives (or ``max_words`` is reached).

Copies of a whole document are one candidate: the one with the smallest id
stands for all, and the others lose every word.  Only hashes are shuffled
between the levels; whole texts are shuffled once, and again only for the
documents that hold candidates.
"""

from __future__ import annotations

import hashlib
from functools import reduce
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebars.llm.common import materialize, prepare

MIN_WORDS = 50
FINAL = ["id", "n_words", "n_removed", "kept_sha256", "longest_repeat"]
FINAL_SCHEMA = "id long, n_words long, n_removed long, kept_sha256 string, longest_repeat long"
CACHE_WORDS = 1 << 18    # word hashes remembered by a task
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
MIX = np.uint64(0xFF51AFD7ED558CCD)


class WordHashes(dict):
    """XXH64 of words; forgets everything when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def split_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, unchanged."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of every window of ``length`` words, built by doubling.

    Polynomials over the word hashes, finished with a mix of the high bits.
    """
    if len(words) < length:
        return np.zeros(0, np.uint64)
    base = BASES[which]
    power, have, step = words * MIX if which else words, None, 1
    have_len, factor = 0, base   # factor: base to the power of step
    n = length
    with np.errstate(over="ignore"):
        scale = np.uint64(1)
        while n:
            if n & 1:
                if have is None:
                    have, scale = power, factor
                else:
                    size = len(words) - have_len - step + 1
                    have = have[:size] * factor + power[have_len:have_len + size]
                    scale = scale * factor
                have_len += step
            n >>= 1
            if n:
                power = power[:-step] * factor + power[step:]
                factor = factor * factor
                step *= 2
        have = have ^ (have >> np.uint64(32))
        have = have * MIX
        return have ^ (have >> np.uint64(29))


def least_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive hashes, by doubling."""
    size, step, out = len(hashes) - width + 1, 1, hashes
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    return np.minimum(out[:size], out[width - step:width - step + size])


def _sequence(words: list[bytes]) -> list[int]:
    """A 128-bit hash of a whole word sequence, as two longs."""
    return np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), "<i8").tolist()


def _lists(values: list) -> pa.Array:
    return pa.array(values, pa.list_(pa.int64()))


def _scan(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per document: its word count, sequence hash and chosen halves."""
    half, width = min_words // 2, min_words - min_words // 2 + 1

    def run(batches):
        known = WordHashes()
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                words, halves = split_words(text), np.zeros(0, np.uint64)
                if len(words) >= min_words:
                    h = window_hashes(word_hashes(words, known), half)
                    halves = np.unique(least_of(h, width))
                rows.append((len(words), *_sequence(words), halves.view(np.int64)))
            n, s1, s2, halves = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 _lists(list(halves))], ["id", "n", "s1", "s2", "halves"])

    return docs.mapInArrow(run, "id long, n long, s1 long, s2 long, halves array<long>")


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _distinct(words: np.ndarray, length: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of the distinct windows of ``length`` words among those at ``places``."""
    h1, h2 = (window_hashes(words, length, k)[places].view(np.int64) for k in (0, 1))
    first = np.unique(np.rec.fromarrays([h1, h2]), return_index=True)[1]
    return h1[first], h2[first]


def _with_chosen(h: np.ndarray, wanted: list[int], width: int) -> np.ndarray:
    """Places of the windows whose chosen half is among ``wanted``."""
    return np.flatnonzero(np.isin(least_of(h, width), np.array(wanted, np.int64).view(np.uint64)))


def _first_level(joined: DataFrame, min_words: int) -> DataFrame:
    """The final row of documents without candidates; text and distinct candidate windows of the others."""
    half, width = min_words // 2, min_words - min_words // 2 + 1

    def run(batches):
        known = WordHashes()
        for batch in batches:
            rows = []
            for text, copied, halves in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                words, found = split_words(text), ()
                copy = bool(copied) and len(words) >= min_words and _sequence(words)[0] in copied
                if halves and not copy and len(words) >= min_words:
                    w = word_hashes(words, known)
                    found = _with_chosen(window_hashes(w, half), halves, width)
                if len(found):
                    rows.append((len(words), 0, None, None, text, *_distinct(w, min_words, found)))
                elif copy:
                    rows.append((len(words), len(words), _digest([]), len(words), None, None, None))
                else:
                    rows.append((len(words), 0, _digest(words), None, None, None, None))
            n, gone, digest, longest, text, h1, h2 = zip(*rows) if rows else ((),) * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string()),
                 pa.array(longest, pa.int64()), pa.array(text, pa.string()), _lists(list(h1)), _lists(list(h2))],
                [*FINAL, "text", "h1", "h2"])

    return joined.select("id", "text", "copied", "halves").mapInArrow(
        run, f"{FINAL_SCHEMA}, text string, h1 array<long>, h2 array<long>")


def _next_level(held: DataFrame, length: int) -> DataFrame:
    """Documents with windows of twice ``length`` words whose two halves are both in ``repeated``."""
    def run(batches):
        known = WordHashes()
        for batch in batches:
            keep, out1, out2 = [], [], []
            for i, (text, repeated) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2)))):
                w = word_hashes(split_words(text), known)
                again = np.isin(window_hashes(w, length), np.array(repeated, np.int64).view(np.uint64))
                places = np.flatnonzero(again[:-length] & again[length:])
                if len(places):
                    h1, h2 = _distinct(w, 2 * length, places)
                    keep.append(i)
                    out1.append(h1)
                    out2.append(h2)
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), _lists(out1), _lists(out2)],
                                             ["id", "text", "h1", "h2"])

    return held.select("id", "text", "repeated").mapInArrow(
        run, "id long, text string, h1 array<long>, h2 array<long>")


def _repeats(level: DataFrame) -> DataFrame:
    """By id: its windows that two documents hold, and those of them that a smaller id holds."""
    windows = level.select("id", F.explode(F.arrays_zip("h1", "h2")).alias("w")).select(
        "id", F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2"))
    firsts = windows.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    shared = firsts.where(F.col("first") < F.col("last")).select("h1", "h2", "first")
    return (windows.join(shared, ["h1", "h2"]).groupBy("id")
            .agg(F.collect_list("h1").alias("repeated"),
                 F.collect_list(F.when(F.col("id") > F.col("first"), F.col("h1"))).alias("later")))


def _remove(texts: DataFrame, min_words: int) -> DataFrame:
    """The final row of documents with candidates: words under windows listed in ``later`` go."""
    def run(batches):
        known = WordHashes()
        for batch in batches:
            n_words, n_removed, digest = [], [], []
            for text, later in zip(*(batch.column(c).to_pylist() for c in (1, 2))):
                words = split_words(text)
                gone = np.zeros(len(words) + 1, np.int64)
                if later:
                    h = window_hashes(word_hashes(words, known), min_words)
                    at = np.flatnonzero(np.isin(h, np.array(later, np.int64).view(np.uint64)))
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + min_words, -1)
                out = (np.cumsum(gone[:-1]) > 0).tolist()
                n_words.append(len(words))
                n_removed.append(sum(out))
                digest.append(_digest([x for x, o in zip(words, out) if not o]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(digest, pa.string()), batch.column(3)], FINAL)

    return texts.select("id", "text", "later", "longest_repeat").mapInArrow(run, FINAL_SCHEMA)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                     max_words: int | None = None) -> DataFrame:
    """One row per input row: ``id_col``, ``n_words``, ``n_removed``, ``kept_sha256``, ``longest_repeat``.

    A word is removed if a window of ``min_words`` words that covers it also
    starts in a document with a smaller id; windows are judged on the input.
    ``longest_repeat`` is the longest level (``min_words`` times a power of
    two) at which the document shares a window with another one, NULL if
    none; for a later copy of a whole document it is the word count.  Levels
    beyond ``max_words`` are not tried; they cannot change what is removed.
    NULL and empty texts have no words.  Rows with a NULL id remove nothing
    and lose nothing; rows that repeat an id are one document with respect to
    each other.  No rows give no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    named = rows.where(F.col("id").isNotNull())
    seen = materialize(_scan(named, min_words).where(F.col("n") >= min_words), "substring-scan")

    # one document stands for all with its word sequence: the one with the smallest id
    firsts = seen.groupBy("s1", "s2").agg(F.min("id").alias("first"))
    status = seen.join(firsts, ["s1", "s2"]).select(
        "id", "s1", (F.col("id") > F.col("first")).alias("copy"), "halves")
    status = materialize(status.withColumn("halves", F.when(~F.col("copy"), F.col("halves"))), "substring-status")
    halves = status.select("id", F.explode("halves").alias("h"))
    shared = halves.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("h")
    marks = (halves.join(shared, "h").select("id", "h", F.lit(None).cast("long").alias("s1"))
             .unionByName(status.where("copy").select("id", F.lit(None).cast("long").alias("h"), "s1"))
             .groupBy("id").agg(F.collect_set("s1").alias("copied"), F.collect_set("h").alias("halves")))

    joined = rows.join(marks.hint("shuffle_hash"), "id", "left")
    first = materialize(_first_level(joined, min_words), "substring-level")
    done = first.where(F.col("text").isNull()).select(*FINAL)
    texts = first.where(F.col("text").isNotNull()).select("id", "text")
    level, length, reached = first.where(F.col("text").isNotNull()), min_words, []
    base = None
    while True:
        repeated, found = materialize(_repeats(level), "substring-repeats", [F.count(F.lit(1)).alias("n")])
        base = repeated if base is None else base
        if not found["n"]:
            break
        reached.append(repeated.select("id", F.lit(length).cast("long").alias("length")))
        if max_words is not None and 2 * length > max_words:
            break
        held = level.select("id", "text").join(repeated.select("id", "repeated").hint("shuffle_hash"), "id")
        level, left = materialize(_next_level(held, length), "substring-level", [F.count(F.lit(1)).alias("n")])
        if not left["n"]:
            break
        length *= 2
    later = base.select("id", "later")
    if reached:
        longest = reduce(DataFrame.unionByName, reached).groupBy("id").agg(F.max("length").alias("longest_repeat"))
    else:
        longest = later.select("id", F.lit(None).cast("long").alias("longest_repeat"))
    facts = later.join(longest, "id", "left")
    return done.unionByName(_remove(texts.join(facts.hint("shuffle_hash"), "id", "left"), min_words)).select(
        F.col("id").alias(id_col), *FINAL[1:])
