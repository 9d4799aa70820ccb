"""Line deduplication over levelled sorted runs of line hashes.

The index is a set of runs: sorted Parquet tables of 128-bit line keys, no
key in two runs.  Documents are taken in batches in the order of their ids.
A batch reduces its lines to one row per key, merge-anti-joins all runs,
and becomes a new run of level 0 itself; ``FANOUT`` runs of a level are
compacted to one run of the next, so a batch meets few runs however many
came before it.  Everything here is DataFrame functions.

Only hashes are shuffled for the decisions.  Texts are shuffled once, to
meet the positions of their dropped lines.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars.llm.common import ASCII_SPACE, fresh, lower_ascii, new_run_dir, prepare, text_key

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2
KEY = ["ha", "hb"]
ROW = ["id", "ka", "kb"]


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(ASCII_SPACE)))


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line whose key has ``min_chars`` code points: row identity, position, key hashes.

    The row identity is the id and a 128-bit hash of the text, so rows that
    repeat an id with other text are told apart.
    """
    key = text_key(F.col("text"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    lines = rows.select("id", key["a"].alias("ka"), key["b"].alias("kb"),
                        F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.select(*ROW, "pos", line_key(F.col("line")).alias("line"))
    lines = lines.where(F.char_length("line") >= min_chars)
    return lines.select(*ROW, "pos", F.xxhash64("line").alias("ha"), F.xxhash64(F.lit(7), "line").alias("hb"))


class LineIndex:
    """The runs of all lines added so far, in the shared work folder (or ``root``)."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, root: str | None = None):
        self.spark, self.fanout = spark, fanout
        self.root = root or new_run_dir(spark, "line-index")
        self.levels: list[list[str]] = [[]]
        self._made = 0

    def _write(self, run: DataFrame) -> str:
        path = os.path.join(self.root, f"run-{self._made}")
        self._made += 1
        run.sortWithinPartitions(*KEY).write.parquet(path)
        return path

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def known(self) -> DataFrame | None:
        """The keys of all runs, or None before the first batch."""
        runs = [self._read(p).where(~F.col("known")).select(*KEY) for level in self.levels for p in level]
        return reduce(DataFrame.unionByName, runs) if runs else None

    def add(self, lines: DataFrame, last: bool = False) -> DataFrame:
        """Add a batch of keyed lines; returns the rows of it that are repeats, as ``ROW`` and ``pos``.

        A line is a repeat if a run holds its key, or if a smaller id of the
        batch does.  Lines of NULL ids come after all others.  ``last`` skips
        the compaction that only later batches would use.
        """
        firsts = lines.groupBy(*KEY).agg(F.min("id").alias("first"), F.max("id").alias("last"),
                                         F.bool_or(F.col("id").isNull()).alias("unnamed"))
        firsts = firsts.select(*KEY, "first", (F.col("last").isNotNull() & (
            F.col("unnamed") | (F.col("first") != F.col("last")))).alias("shared"))
        runs = self.known()
        if runs is None:
            state = firsts.withColumn("known", F.lit(False))
        else:
            state = firsts.join(runs.withColumn("hit", F.lit(True)).hint("merge"), KEY, "left")
            state = state.withColumn("known", F.col("hit").isNotNull()).drop("hit")
        path = self._write(state)
        self.levels[0].append(path)
        decided = self._read(path).where(F.col("known") | F.col("shared"))
        if not last:
            self._compact()
        repeats = lines.join(decided, KEY)
        return repeats.where(F.col("known") | ~F.col("id").eqNullSafe(F.col("first"))).select(*ROW, "pos")

    def _compact(self) -> None:
        for depth in range(len(self.levels)):
            if len(self.levels[depth]) < self.fanout:
                return
            keys = reduce(DataFrame.unionByName,
                          [self._read(p).where(~F.col("known")).select(*KEY) for p in self.levels[depth]])
            merged = self._write(keys.repartition(*KEY).withColumn("known", F.lit(False)))
            self.levels[depth] = []
            if depth + 1 == len(self.levels):
                self.levels.append([])
            self.levels[depth + 1].append(merged)


def _without(lines: Column, dropped: Column) -> Column:
    """``lines`` without the ascending zero-based positions ``dropped``: the stretches between them.

    Both are bound once (a lambda would compute them for every stretch), so
    the work is proportional to the lines.
    """
    def stretches(s: Column) -> Column:
        def stretch(i: Column) -> Column:
            lo = F.coalesce(F.get(s["dropped"], i - 1), F.lit(-1)) + 1
            return F.slice(s["lines"], lo + 1, F.coalesce(F.get(s["dropped"], i), F.size(s["lines"])) - lo)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(s["dropped"])), stretch))

    bound = F.array(F.struct(lines.alias("lines"), dropped.alias("dropped")))
    return F.get(F.transform(bound, stretches), F.lit(0))


def count_lines(text: Column) -> Column:
    """Newlines and one."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                batches: int = BATCHES, fanout: int = FANOUT, n_lines: str = "n_lines",
                n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` (all columns, all rows) without the lines that a document with a smaller id holds too.

    Adds ``n_lines`` (before dropping) and ``n_dropped``; the text becomes
    the lines left, joined by newlines.  Lines with keys under ``min_chars``
    code points always stay, and every repeat inside the first document.
    A NULL text counts as one empty line and stays NULL.  Documents with
    NULL ids come last, as one document.  No rows give no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    lines = keyed_lines(docs, id_col, text_col, min_chars)
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx(id_col, shares, 1000).alias("c")).first()["c"] if shares else []
    number = sum([F.when(F.col("id") > F.lit(c), 1).otherwise(0) for c in cuts or []], F.lit(0))
    number = F.when(F.col("id").isNull(), batches - 1).otherwise(number)
    path = os.path.join(new_run_dir(spark, "lines"), "lines")
    dealt = lines.withColumn("batch", number)
    dealt.write.partitionBy("batch").parquet(path)
    stored = spark.read.schema(dealt.schema).parquet(path)
    index = LineIndex(spark, fanout)
    repeats = [index.add(stored.where(F.col("batch") == b).drop("batch"), last=b == batches - 1)
               for b in range(batches)]
    drops = reduce(DataFrame.unionByName, repeats).groupBy(*ROW).agg(
        F.sort_array(F.collect_set("pos")).alias("dropped"))

    key = text_key(F.col(text_col).cast("string"))
    gone = fresh("dropped", docs.columns)
    drops = drops.select(*[F.col(c).alias(fresh(f"drop_{c}", docs.columns)) for c in ROW],
                         F.col("dropped").alias(gone))
    r_id, r_ka, r_kb = drops.columns[:3]
    joined = docs.join(drops.hint("shuffle_hash"),
                       docs[id_col].eqNullSafe(F.col(r_id)) & (key["a"] == F.col(r_ka)) & (key["b"] == F.col(r_kb)),
                       "left")
    split = F.split(F.col(text_col).cast("string"), "\n", -1)
    kept = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.array_join(_without(split, F.col(gone)), "\n"))
    return joined.select(
        *[kept.alias(c) if c == text_col else F.col(c) for c in docs.columns],
        F.coalesce(count_lines(F.col(text_col).cast("string")), F.lit(1)).cast("long").alias(n_lines),
        F.coalesce(F.when(F.col(gone).isNotNull(), F.size(F.col(gone))), F.lit(0)).cast("long").alias(n_dropped))
