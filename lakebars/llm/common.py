"""Shared helpers: text normalisation, row keys, bounded Arrow batches, side tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars import session
from lakebars.session import delete_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_SPACE = " \t\n\x0b\x0c\r"

#: bytes table: A-Z to a-z, everything else unchanged
LOWER_TABLE = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
#: bytes table: A-Z to a-z; ASCII bytes that are no letter and no digit become a space
WORD_TABLE = bytes(
    (c + 32) if 0x41 <= c <= 0x5A else c if (0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80) else 0x20
    for c in range(256))

#: Session settings of the operators, all changeable at run time: small Arrow
#: batches (documents may be very long), and shuffle files that go when the job
#: that wrote them ends (results between jobs are Parquet in the shared folder).
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def prepare(spark: SparkSession) -> None:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


_MADE: list[list[str]] = []     # folders made since each open ``finished``


def materialize(df: DataFrame, name: str = "side", observe: list | None = None):
    """:func:`lakebars.session.materialize`, remembered by an open :func:`finished`."""
    out = session.materialize(df, name, observe)
    if _MADE:
        _MADE[-1].append((out[0] if observe else out).side_path)
    return out


def new_run_dir(spark: SparkSession, name: str) -> str:
    """:func:`lakebars.session.new_run_dir`, remembered by an open :func:`finished`."""
    path = session.new_run_dir(spark, name)
    if _MADE:
        _MADE[-1].append(path)
    return path


def finished(spark: SparkSession, make, name: str) -> DataFrame:
    """What ``make()`` returns, written once; the side tables made on the way are deleted, also after an error."""
    _MADE.append([])
    try:
        return session.materialize(make(), name)
    finally:
        for path in _MADE.pop():
            delete_folder(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions: the cluster sizes it to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(col: Column) -> Column:
    """A-Z lower-cased, every other character unchanged.

    Pure ASCII strings take the fast byte path of ``lower``; others are
    translated, because ``lower`` would also change letters such as É.
    """
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, UPPER.lower()))


def text_key(col: Column) -> Column:
    """128-bit identity of a text as a struct of two longs (NULL counts as a value of its own)."""
    missing = F.when(col.isNull(), 1).otherwise(0)
    return F.struct(F.xxhash64(col, missing).alias("a"), F.xxhash64(F.lit(7), missing, col).alias("b"))


def draw(rows: DataFrame, of: str, keys: list[str], sample: int, seed: int) -> DataFrame:
    """At most ``sample`` rows of each value of ``of``, distinct by ``keys``: those with the smallest hashes of them.

    The driver gets hashes only, little more than ``sample`` for each value.
    """
    place = fresh("place", rows.columns)
    placed = rows.withColumn(place, F.xxhash64(F.lit(seed), *keys))
    about = placed.groupBy(of).agg(F.approx_count_distinct(place, 0.02).alias("n")).collect()
    enough = 1.1 * (sample + 6 * sample ** 0.5)
    first = {r[of]: min((1 << 63) - 1, int(enough / max(1, r["n"]) * (1 << 64)) - (1 << 63)) for r in about}

    def below(limits: dict) -> DataFrame:
        by_value = F.create_map(*[x for value, most in limits.items() for x in (F.lit(value), F.lit(most).cast("long"))])
        return placed.where(F.col(place) <= by_value[F.col(of)])

    if not first:
        return rows.limit(0)
    heads: dict = {}
    for value, at in below(first).select(of, place).distinct().collect():
        heads.setdefault(value, []).append(at)
    last = {value: sorted(at)[:sample][-1] for value, at in heads.items()}
    return below(last).dropDuplicates([of, place]).drop(place)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that clashes with none of ``taken``."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name


def worker_state(key, make):
    """What ``make()`` returned for ``key`` in this Python worker, which serves many tasks.

    Only the newest key of each kind ``key[1]`` is held.
    """
    import pyspark

    held = pyspark.__dict__.setdefault("_lakebars_worker_state", {})
    if held.get(key[1], (None,))[0] != key:
        held[key[1]] = (key, make())
    return held[key[1]][1]
