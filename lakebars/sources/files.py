"""File scans of the landing zone (S1-S3, S7; S8 is ``spark.table``).

Layout written by :mod:`lakebars.plans.jobs`:

    {root}/candles/load_date=<D>/bucket=<k>/part-*  raw candles, JSONL; a ticker is in one bucket
    {root}/candle_loads/load_date=<D>/part-*        the manifest: tickers of the load, their rows and buckets
    {root}/issuers/load_date=<D>/part-*.parquet     reference snapshots

A load date has as many folders as its size needs, whatever the number of
tickers (one file per ticker and day would flood the store
with small files).  Each line is the API record with the requesting ticker
added.  Which load of a ticker counts is found in the manifest, before any
candle is read; one scan then reads the chosen loads of all tickers, and
only the folders that hold them are listed: of an older load date, the
buckets of the tickers that fall back to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from lakebars.functions.params import previous_dates
from lakebars.operators.quality import MissingSnapshotError
from lakebars.schemas import ISSUER, RAW_CANDLE
from lakebars.session import child_names, delete_folder, discard, materialize

RAW_CANDLE_FILES = StructType([StructField("ticker", StringType())] + RAW_CANDLE.fields
                              + [StructField("load_date", DateType())])
ISSUER_FILES = StructType(ISSUER.fields + [StructField("load_date", DateType())])


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist (a metadata call per path on the driver)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            out.append(p)
    return out


def read_raw_candles(spark: SparkSession, root: str, load_dates=None) -> DataFrame:
    """Landed candles as text fields + (ticker, load_date).

    The read schema declares every measure as string: number tokens keep
    their exact text and are cast later with ``try_cast``.  Unknown fields
    in the files are ignored; an empty file is an empty table.  With
    ``load_dates`` only those folders are listed; a missing folder is simply
    absent (the only error that means "no data").
    """
    reader = (spark.read.schema(RAW_CANDLE_FILES)
              .option("basePath", root).option("mode", "PERMISSIVE"))
    if load_dates is None:
        return reader.json(root).drop("bucket")
    paths = existing_paths(spark, [f"{root}/load_date={d}" for d in load_dates])
    if not paths:
        return spark.createDataFrame([], RAW_CANDLE_FILES)
    return reader.json(paths).drop("bucket")


BUCKET_ROWS = 2_000_000      # candles of a bucket, about; a load date has as many buckets as its rows need
MOST_BUCKETS = 256
LOAD = StructType([StructField("ticker", StringType()), StructField("bucket", IntegerType()), StructField("rows", LongType()),
                   StructField("load_date", DateType())])


def write_candle_loads(lines: DataFrame, root: str, manifest: str, bucket_rows: int = BUCKET_ROWS) -> int:
    """``(ticker, load_date, line)`` -> JSONL by load date and bucket, then the manifest; gives the number of lines.

    The load dates present are replaced, others stay; no lines replace
    nothing.  The lines are computed once.  The manifest names each ticker's
    bucket and is written last: a load counts when its manifest does, and
    what an earlier load of the date left in other buckets is not in it (and
    is deleted at the end).  Full buckets are split, small ones written by
    one task, whatever the number of tasks that made the lines.
    """
    spark = lines.sparkSession
    side, seen = materialize(lines, "loads", observe=[F.count(F.lit(1)).alias("rows"), F.collect_set("load_date").alias("days")])
    days, rows = sorted(seen["days"] or []), int(seen["rows"] or 0)
    if days:
        buckets = max(1, min(MOST_BUCKETS, rows // (len(days) * bucket_rows)))
        side_b = side.withColumn("bucket", F.pmod(F.xxhash64("ticker"), F.lit(buckets)).cast("int"))
        before = {d: [n for n in child_names(spark, f"{root}/load_date={d}") if n.startswith("bucket=")] for d in days}
        (side_b.select("line", "load_date", "bucket").hint("rebalance", F.col("load_date"), F.col("bucket"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_date", "bucket").text(root))
        (side_b.groupBy("ticker", "bucket", "load_date").agg(F.count(F.lit(1)).alias("rows")).select(*LOAD.fieldNames())
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_date").parquet(manifest))
        if any(before.values()):
            held = {(r[0], f"bucket={r[1]}") for r in read_manifest(spark, manifest, days).select("load_date", "bucket").distinct().collect()}
            for d, names in before.items():
                for name in names:
                    if (d, name) not in held:
                        delete_folder(spark, f"{root}/load_date={d}/{name}")
    discard(side)
    return rows


def read_manifest(spark: SparkSession, manifest: str, load_dates) -> DataFrame | None:
    """The manifest of these load dates; ``None`` if one of them has none."""
    paths = [f"{manifest}/load_date={d}" for d in load_dates]
    if len(existing_paths(spark, paths)) < len(paths):
        return None
    if not paths:
        return spark.createDataFrame([], LOAD)
    return spark.read.schema(LOAD).option("basePath", manifest).parquet(*paths)


def latest_loads(spark: SparkSession, root: str, manifest: str, process_date, lookback_days: int = 1) -> DataFrame | None:
    """S2 from the manifest alone: ``(ticker, load_date, bucket)``, the newest load of each ticker in the window.

    ``None`` if a load date of the window was landed without a manifest.
    """
    landed = [d for d in previous_dates(process_date, lookback_days) if existing_paths(spark, [f"{root}/load_date={d}"])]
    loads = read_manifest(spark, manifest, landed)
    if loads is None:
        return None
    newest = loads.groupBy("ticker").agg(F.max(F.struct("load_date", "bucket")).alias("l"))
    return newest.select("ticker", "l.load_date", "l.bucket")


def read_loads(spark: SparkSession, root: str, loads: DataFrame) -> DataFrame:
    """S1 of chosen ``loads(ticker, load_date, bucket)``: only the folders that hold one of them are listed and read."""
    folders = [r for r in loads.select("load_date", "bucket").distinct().collect()]     # load dates x buckets at most
    paths = existing_paths(spark, [f"{root}/load_date={r['load_date']}/bucket={r['bucket']}" for r in folders])
    if not paths:
        return spark.createDataFrame([], RAW_CANDLE_FILES)
    raw = spark.read.schema(RAW_CANDLE_FILES).option("basePath", root).option("mode", "PERMISSIVE").json(paths)
    return raw.drop("bucket").join(loads.select("ticker", "load_date"), ["ticker", "load_date"], "left_semi").select(
        *RAW_CANDLE_FILES.fieldNames())


def latest_available(df: DataFrame, process_date, lookback_days: int = 1,
                     key: str | None = "ticker", load_col: str = "load_date") -> DataFrame:
    """Per key, the rows of the newest load date in [D-k, D] that exists.

    The window filter prunes partitions; the per-key max is a partial
    aggregate over partition values; the semi join keeps only the chosen
    load.  A key with no load in the window is absent.
    """
    window = previous_dates(process_date, lookback_days)
    cand = df.where(F.col(load_col).isin(window))
    keys = [key] if key else []
    latest = cand.groupBy(*keys).agg(F.max(load_col).alias(load_col))
    return cand.join(latest, keys + [load_col], "left_semi")


def read_snapshot(spark: SparkSession, root: str, process_date, lookback_days: int = 1,
                  schema: StructType = ISSUER_FILES) -> tuple[DataFrame, object]:
    """S3 + Q3: the newest snapshot among [D, ..., D-k]; raise when none exists.

    Resolution is per snapshot (not per key); a missing folder is the only
    reason to fall back.
    """
    window = previous_dates(process_date, lookback_days)
    # Only the window's folders are probed (newest first); the first that
    # exists wins, so the listing does not grow with the history kept.
    for d in window:
        paths = existing_paths(spark, [f"{root}/load_date={d}"])
        if paths:
            df = spark.read.schema(schema).option("basePath", root).parquet(*paths)
            return df.drop("load_date"), d
    raise MissingSnapshotError(f"no snapshot under {root} for any of {[str(d) for d in window]}")


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet object/folder read as a table."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
