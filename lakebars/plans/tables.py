"""Table maintenance as dataflow (D1-D8) on Parquet catalog tables.

Parquet tables have no MERGE and Spark refuses to overwrite a table the
same query reads; the publishers therefore compute the new content of the
affected partitions, write it once to a side table in the shared folder
named by ``spark.checkpoint.dir`` (:func:`lakebars.session.materialize`,
which cuts the lineage), overwrite exactly those partitions from it, and
delete the side table.

Which overwrite when:
* one day that may end up empty (D1, D4, D6) -> static
  ``INSERT OVERWRITE ... PARTITION (trade_date = D)``; it empties the day and
  leaves the others alone in either mode;
* a set of days that cannot end up empty (D2) -> one dynamic overwrite, in a
  session of its own (the writer option is ignored by ``insertInto``, and
  the caller's session keeps its mode).
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakebars.functions.params import END_OF_TIME, as_date, as_datetime, ts_lit
from lakebars.operators.bar_state import BAR_STATE, merge_states
from lakebars.operators.merge import insert_if_absent_frame, upsert_frame
from lakebars.operators.quality import DataQualityError
from lakebars.operators.scd2 import DIM_COLUMNS, SOURCE_ROWS, TOUCHED, scd2_frames, strict_merge
from lakebars.schemas import ddl
from lakebars.session import bucket_session, delete_folder, discard, dynamic_session, materialize, work_root

OPEN_END_DATE = END_OF_TIME.date()


def create_table(spark: SparkSession, name: str, schema: StructType, location: str | None = None,
                 partition_by: tuple[str, ...] = (), bucket_by: tuple[str, int] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` a Parquet table, with ``bucket_by=(column, n)`` in buckets.

    Without ``location`` the table is managed and lives in its database's
    folder.  Partition columns must be the last fields of ``schema``
    (inserts match columns by position).
    """
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    buckets = f" CLUSTERED BY ({bucket_by[0]}) SORTED BY ({bucket_by[0]}) INTO {bucket_by[1]} BUCKETS" if bucket_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING parquet{parts}{buckets}{loc}")


def bucket_spec(spark: SparkSession, name: str) -> tuple[str, int] | None:
    """``(column, n)`` of a table in buckets of one column, from the catalog."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    columns = told.get("Bucket Columns", "").strip("[]").replace("`", "").split(",")
    return (columns[0].strip(), int(told["Num Buckets"])) if "Num Buckets" in told and len(columns) == 1 else None


def upsert_plan(spark: SparkSession, table: str, source: DataFrame, keys: list[str], value_cols: list[str], run_ts, dates,
                buckets: tuple[str, int] | None, partition_col: str = "trade_date", **options) -> DataFrame:
    """The new content of the touched partitions.

    A target in buckets of a key column is read bucket by bucket and joined
    where it lies: only the source moves, to the tasks of its buckets.
    """
    reader = bucket_session(spark) if buckets and buckets[0] in keys else spark
    target = reader.table(table).where(F.col(partition_col).isin(dates))
    return upsert_frame(target, source, keys, value_cols, run_ts, **options)


def _bucketed_side(spark: SparkSession, table: str, frame: DataFrame, buckets: tuple[str, int], observe: list[Column]):
    """A side table in the buckets of ``table``: one file a bucket, which the overwrite copies task by task."""
    name = f"{table.rsplit('.', 1)[0]}.side_{uuid.uuid4().hex[:12]}" if "." in table else f"side_{uuid.uuid4().hex[:12]}"
    path = os.path.join(work_root(spark), "_side", name.replace(".", "-"))
    seen = Observation(f"upsert-{uuid.uuid4().hex[:8]}")
    (frame.observe(seen, *observe).write.format("parquet").bucketBy(buckets[1], buckets[0]).sortBy(buckets[0])
     .option("path", path).saveAsTable(name))
    return name, path, seen.get


def table_columns(spark: SparkSession, name: str) -> list[str]:
    return spark.table(name).columns


def _view(df: DataFrame) -> str:
    name = f"_lb_src_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    return name


def replace_day(spark: SparkSession, table: str, day, rows: DataFrame | None,
                partition_col: str = "trade_date") -> None:
    """The rows of ``day`` become exactly those of ``rows`` for that day
    (``None`` or an empty frame clears the day = D1)."""
    d = as_date(day)
    cols = [c for c in table_columns(spark, table) if c != partition_col]
    if rows is None:
        rows = spark.createDataFrame([], spark.table(table).schema)
    view = _view(rows)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({partition_col} = DATE'{d}') "
                  f"SELECT {', '.join(f'`{c}`' for c in cols)} FROM {view} "
                  f"WHERE {partition_col} = DATE'{d}'")
    finally:
        spark.catalog.dropTempView(view)


def clear_day(spark: SparkSession, table: str, day, partition_col: str = "trade_date") -> None:
    """``DELETE FROM table WHERE trade_date = D``."""
    replace_day(spark, table, day, None, partition_col)


def overwrite_partitions(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Replace the partitions present in ``rows``; all others stay.

    The rows go through a side table, which the overwriting session reads.
    """
    side = materialize(rows.select(*table_columns(spark, table)), "partitions")
    _overwrite_from(spark, table, side)
    discard(side)


def _overwrite_from(spark: SparkSession, table: str, side: DataFrame) -> None:
    other = dynamic_session(spark)
    other.read.schema(side.schema).parquet(side.side_path).select(
        *table_columns(spark, table)).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def replace_days(spark: SparkSession, table: str, rows: DataFrame, days,
                 partition_col: str = "trade_date") -> list[dt.date]:
    """D4 over several days: one dynamic overwrite for the days with rows,
    then a static clear for each requested day that ended up empty.

    Returns the days with rows, which are observed while they are written.
    """
    wanted = sorted({as_date(d) for d in days})
    rows = rows.where(F.col(partition_col).isin(wanted)).select(*table_columns(spark, table))
    side, found = materialize(rows, "days", observe=[F.collect_set(partition_col).alias("days")])
    present = set(found["days"] or [])
    if present:
        _overwrite_from(spark, table, side)
    discard(side)
    for d in wanted:
        if d not in present:
            clear_day(spark, table, d, partition_col)
    return sorted(present)


def truncate(spark: SparkSession, table: str) -> None:
    """``TRUNCATE TABLE``; external tables (refused by Spark) get a static
    overwrite with no rows, which drops every partition."""
    if (spark.catalog.getTable(table).tableType or "").upper() == "EXTERNAL":
        spark.createDataFrame([], spark.table(table).schema).write.insertInto(table, overwrite=True)
    else:
        spark.sql(f"TRUNCATE TABLE {table}")


def replace_partition_from(spark: SparkSession, target: str, buffer: str, day,
                           partition_col: str = "trade_date") -> None:
    """The day's partition of ``target`` becomes the buffer's rows of that day."""
    d = as_date(day)
    cols = [c for c in table_columns(spark, target) if c != partition_col]
    spark.sql(f"INSERT OVERWRITE TABLE {target} PARTITION ({partition_col} = DATE'{d}') "
              f"SELECT {', '.join(f'`{c}`' for c in cols)} FROM {buffer} "
              f"WHERE {partition_col} = DATE'{d}'")


def upsert_into(spark: SparkSession, table: str, source: DataFrame, keys: list[str],
                value_cols: list[str], run_ts, partition_col: str = "trade_date",
                stamp_col: str = "load_dt", on_duplicate: str = "error",
                latest_first: list[Column] | None = None, observe: list[Column] | None = None,
                rows_by_date: dict | None = None):
    """D2 publisher: merge ``source`` into the partitions it touches.

    The touched dates (one row per date) are the only data that reaches the
    driver; they become a literal partition filter, so only those
    partitions of the target are read and rewritten.  ``observe``
    aggregates are computed over the new content of those partitions while
    it is written; with it the result is ``(dates, metrics)``.  The number
    of source rows of each date is put in ``rows_by_date``.
    """
    work_root(spark)
    source = source.where(F.col(partition_col).isNotNull())
    if partition_col in keys and on_duplicate == "error":
        # One aggregate answers both questions: which dates, and is any key
        # repeated.  NULL keys never conflict, so they count as unique.
        any_null = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
        per_date = (source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_n", F.col("_rows"))
                    .withColumn("_n", F.when(any_null, F.lit(1)).otherwise(F.col("_n")))
                    .groupBy(partition_col).agg(F.max("_n").alias("_max"), F.sum("_rows").alias("_rows")).collect())
        repeated = [r[partition_col] for r in per_date if r["_max"] > 1]
        if repeated:
            raise DataQualityError(f"source repeats a key on {keys} (dates {repeated[:5]})")
        checked = True
    else:
        per_date = source.groupBy(partition_col).agg(F.count(F.lit(1)).alias("_rows")).collect()
        checked = False
    dates = sorted(r[partition_col] for r in per_date)
    if rows_by_date is not None:
        rows_by_date.update({r[partition_col]: r["_rows"] for r in per_date})
    if not dates:
        return ([], {}) if observe else []
    buckets = bucket_spec(spark, table)
    merged = upsert_plan(spark, table, source, keys, value_cols, run_ts, dates, buckets, partition_col, stamp_col=stamp_col,
                         on_duplicate="checked" if checked else on_duplicate, latest_first=latest_first)
    observe_ = observe or [F.count(F.lit(1)).alias("rows")]
    if buckets and buckets[0] in keys:
        name, path, metrics = _bucketed_side(spark, table, merged, buckets, observe_)
        writer = bucket_session(spark, dynamic=True)
        writer.table(name).select(*table_columns(spark, table)).write.insertInto(table, overwrite=True)
        spark.catalog.refreshTable(table)
        spark.sql(f"DROP TABLE {name}")
        delete_folder(spark, path)
    else:
        side, metrics = materialize(merged, "upsert", observe=observe_)
        _overwrite_from(spark, table, side)
        discard(side)
    return (dates, dict(metrics)) if observe else dates


def store_states(spark: SparkSession, table: str, new: DataFrame) -> list[dt.date]:
    """A4 publisher by state: loads join a table of :data:`BAR_STATE` partitioned by day; gives the days touched.

    Reads and rewrites the states of the days that ``new`` brings (a row for
    each ticker and load), never their candles.  A load stored again, after a
    crash or corrected, replaces what it said.
    """
    fresh, seen = materialize(new.select(*BAR_STATE.fieldNames()), "states", observe=[F.collect_set("trade_date").alias("days")])
    days = sorted(seen["days"] or [])
    if days:
        held = spark.table(table).where(F.col("trade_date").isin(days))
        overwrite_partitions(spark, table, merge_states(held, fresh))
    discard(fresh)
    return days


def insert_if_absent_into(spark: SparkSession, table: str, source: DataFrame, keys: list[str],
                          first_by: list[Column] | None = None) -> None:
    """D7 publisher: append the source rows whose key the table lacks."""
    new = materialize(insert_if_absent_frame(spark.table(table), source, keys, first_by), "absent")
    new.write.insertInto(table)
    discard(new)


NEW_TICKERS_BROADCAST = 100_000   # tickers of one snapshot that may be broadcast to the history


def _with_earlier_versions(spark: SparkSession, history: DataFrame, snapshot: DataFrame,
                           versions: DataFrame) -> DataFrame | None:
    """The snapshot's tickers that have no version in ``versions`` but some in ``history``.

    On most runs there is no such candidate, and the history is not read.
    """
    unknown = materialize(snapshot.select("ticker").where(F.col("ticker").isNotNull()).distinct().join(
        versions.select("ticker"), "ticker", "left_anti"), "unknown")
    n = unknown.count()
    if n == 0:
        discard(unknown)
        return None
    side = F.broadcast(unknown) if n <= NEW_TICKERS_BROADCAST else unknown
    found = materialize(history.select("ticker").join(side, "ticker", "left_semi").distinct(), "earlier")
    discard(unknown)
    return found


def scd2_publish(spark: SparkSession, table: str, snapshot: DataFrame, run_ts,
                 strict: bool = True, end_col: str = "version_end",
                 before_swap: Callable[[dict, DataFrame], None] | None = None) -> dict:
    """D3 publisher for a dimension partitioned by the date its versions end.

    Current versions live in the 9999-12-31 partition; a version that ends
    lands in the partition of that date.  A run reads the partitions from its
    own date on (normally its own and the current one), merges them in one
    pass and rewrites those in which a version changed, from one side table.
    An older run that comes late thus finds the versions of its own time.

    The partition of the run's date, which receives the versions that the
    run ends, is written first and the current one last: after a crash
    in between, a rerun finds the ended versions already there (an
    identical version is kept once) and completes the rest.  A plain rerun
    changes nothing.

    ``before_swap(stats, changes)`` is called when the merge is written to
    its side table and the dimension is still as it was: with what this
    function returns, and the change feed ``(ticker, from_date, to_date)`` of
    the attributes that change, which is there until this function ends.
    """
    work_root(spark)
    run_day = as_datetime(run_ts).date()
    dim = spark.table(table)
    held = dim.where(F.col(end_col) >= F.lit(run_day))
    earlier = None
    if strict:
        # Key check deferred to the side-table write below: no pass of its own.
        earlier = _with_earlier_versions(spark, dim.where(F.col(end_col) < F.lit(run_day)), snapshot, held)
        merged = strict_merge(held.select(*DIM_COLUMNS), snapshot, run_ts, earlier, defer_key_check=True)
    else:
        current = held.where(F.col("is_current")).select(*DIM_COLUMNS)
        frames = scd2_frames(current, snapshot, run_ts, strict=False)
        closed = (frames.closed.withColumn(TOUCHED, F.lit(True))
                  .unionByName(held.where(~F.col("is_current")).select(*DIM_COLUMNS, F.lit(False).alias(TOUCHED)))
                  .groupBy(*DIM_COLUMNS).agg(F.max(TOUCHED).alias(TOUCHED)))   # once, also after a crash
        merged = (closed.unionByName(frames.opened.withColumn(TOUCHED, F.lit(True)))
                  .unionByName(frames.kept.withColumn(TOUCHED, F.lit(False))).withColumn(SOURCE_ROWS, F.lit(1)))
    merged = merged.withColumn(end_col, F.to_date("valid_to"))
    side, seen = materialize(merged, "scd2", observe=[
        F.count_if(F.col(end_col) == F.lit(OPEN_END_DATE)).alias("current"),
        F.count_if(F.col(end_col) == F.lit(run_day)).alias("closed_on_run_day"),
        F.collect_set(F.when(F.col(TOUCHED), F.col(end_col))).alias("ends"),
        F.max(SOURCE_ROWS).alias("max_source_rows"),
        F.count_if(F.col("ticker").isNull()).alias("null_tickers")])
    seen = dict(seen)
    if strict and ((seen["max_source_rows"] or 0) > 1 or seen["null_tickers"]):
        raise DataQualityError(f"issuer snapshot: duplicate or NULL tickers ({seen}); nothing published")
    rows = side.drop(SOURCE_ROWS, TOUCHED)
    ends = sorted(set(seen["ends"] or []), key=lambda d: (d != run_day, d))
    late = [e for e in ends if e not in (run_day, OPEN_END_DATE)]
    stats = {"current": seen["current"], "closed_on_run_day": seen["closed_on_run_day"],
             "changed_until": max(late) if late else None}
    if before_swap is not None:
        before_swap(stats, change_feed(side, run_ts))
    for end in ends:
        replace_day(spark, table, end, rows, partition_col=end_col)
    for frame in (side, earlier):
        if frame is not None:
            discard(frame)
    return stats


def change_feed(merged: DataFrame, run_ts) -> DataFrame:
    """``(ticker, from_date, to_date)``: from when on, and until when, a merge gave a ticker other attributes.

    Versions that the merge made or replaced, from the run's day on (a
    version that it only ended says of its own days what it said before).
    """
    run = ts_lit(run_ts)
    made = merged.where(F.col(TOUCHED) & (F.col("valid_to") > run))
    return made.select("ticker", F.to_date(F.greatest("valid_from", run)).alias("from_date"),
                       F.to_date("valid_to").alias("to_date"))


def merge_into_days(spark: SparkSession, table: str, pairs: DataFrame, rows: DataFrame, days,
                    keys: tuple[str, ...] = ("ticker", "trade_date"), partition_col: str = "trade_date") -> list[dt.date]:
    """The rows of ``table`` with a key in ``pairs`` become ``rows``; all others of ``days`` are copied as they are.

    ``rows`` may lack a key of ``pairs`` (the row goes) but holds no other.
    Gives the days that still have rows.
    """
    days = sorted({as_date(d) for d in days})
    held = spark.table(table).where(F.col(partition_col).isin(days))
    left = held.join(pairs.select(*keys).distinct(), list(keys), "left_anti").select(*held.columns)
    return replace_days(spark, table, left.unionByName(rows.select(*held.columns)), days, partition_col)
