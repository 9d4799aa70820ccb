"""Upsert and insert-if-absent as frames.

The frame functions compute the new content of the affected slice; the
publishers in :mod:`lakebars.plans.tables` write it back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakebars.functions.params import ts_lit
from lakebars.operators.bars import dedupe_latest


def _null_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _spread(df: DataFrame, keys: list[str]) -> Column:
    """A second join key: 0, or a hash of the whole row where a key is NULL.

    NULL keys match nothing, and with it they are spread over the tasks
    instead of piling up in one.
    """
    return F.when(_null_key(keys), F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("bigint"))


def prepare_source(source: DataFrame, keys: list[str], on_duplicate: str = "error",
                   latest_first: list[Column] | None = None) -> DataFrame:
    """The source with unique non-NULL keys, ``_spread`` and ``_in_s``; nothing runs yet.

    ``error``: the query fails when it meets a repeated key (a second write
    of one row in a single statement is an error in SQL upserts).
    ``latest``: keep the first row by ``latest_first`` (newest first).
    ``checked``: the caller has verified uniqueness.  NULL keys are never
    conflicts; they pass.
    """
    if on_duplicate == "latest":
        if not latest_first:
            raise ValueError("on_duplicate='latest' needs an ordering")
        keyed = dedupe_latest(source.where(~_null_key(keys)), keys, latest_first)
        source = keyed.unionByName(source.where(_null_key(keys)))
    elif on_duplicate not in ("checked", "error"):
        raise ValueError(f"unknown on_duplicate={on_duplicate!r}")
    source = source.withColumn("_spread", _spread(source, keys))
    if on_duplicate != "error":
        return source.withColumn("_in_s", F.lit(True))
    # numbered in the order the join needs anyway: no exchange or sort of its own
    place = F.row_number().over(Window.partitionBy(*keys, "_spread").orderBy("_spread"))
    repeated = (F.col("_place") > 1) & ~_null_key(keys)
    refused = F.raise_error(F.lit(f"source has a repeated key on {keys}")).cast("boolean")
    return (source.withColumn("_place", place)
            .withColumn("_in_s", F.when(repeated, refused).otherwise(F.lit(True))).drop("_place"))


def upsert_frame(target: DataFrame, source: DataFrame, keys: list[str], value_cols: list[str],
                 run_ts, stamp_col: str | None = "load_dt", on_duplicate: str = "error",
                 latest_first: list[Column] | None = None) -> DataFrame:
    """New content of ``target`` after ``INSERT .. ON CONFLICT (keys) DO UPDATE``.

    * key in both: value columns from source, ``stamp_col = run_ts``;
    * only in source: inserted, ``stamp_col = run_ts``;
    * only in target: kept as is;
    * NULL keys never match: target rows kept, source rows inserted.

    One scan of each side and one full outer join.  Output columns follow
    ``target``.
    """
    source = prepare_source(source, keys, on_duplicate, latest_first)
    out_cols = target.columns
    stamp = ts_lit(run_ts)
    # Non-key columns the source also carries but does not update: taken from
    # the source only when the row is new (e.g. a partition column).
    carried = [c for c in out_cols if c not in keys and c not in value_cols and c != stamp_col
               and c in source.columns]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in out_cols if c not in keys],
                      _spread(target, keys).alias("_spread"), F.lit(True).alias("_in_t"))
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in value_cols + carried], "_spread", "_in_s")
    joined = t.join(s, [*keys, "_spread"], "full_outer")
    from_source = F.col("_in_s").isNotNull()
    new_row = from_source & F.col("_in_t").isNull()

    def pick(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c == stamp_col:
            return F.when(from_source, stamp).otherwise(F.col(f"_t_{c}")).alias(c)
        if c in value_cols:
            return F.when(from_source, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c)
        if c in carried:
            return F.when(new_row, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c)
        return F.col(f"_t_{c}").alias(c)  # column the source lacks

    return joined.select(*[pick(c) for c in out_cols])


def insert_if_absent_frame(target: DataFrame, source: DataFrame, keys: list[str],
                           first_by: list[Column] | None = None) -> DataFrame:
    """The rows of ``source`` whose key is not yet in ``target``.

    Within the source, the first row of a key wins (``ON CONFLICT DO
    NOTHING`` semantics); ``first_by`` makes "first" deterministic.
    """
    keyed = source.where(~_null_key(keys))
    if first_by:
        keyed = dedupe_latest(keyed, keys, first_by)
    else:
        keyed = keyed.dropDuplicates(keys)
    new = keyed.join(target.select(*keys).where(~_null_key(keys)), keys, "left_anti")
    return new.select(*target.columns)
