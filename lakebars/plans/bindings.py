"""How the shared test tables stand in for market data (see FIXTURES.md §2).

* candles: one ``events`` row is one minute candle; ticker = ``event_type``
  (5 busy tickers) or ``user_id`` (many small ones); every price = ``value``;
  volume = ``props.$.k``; begin = ``ts``.
* issuer snapshots: one ``customer`` row is one issuer; ticker = ``c_custkey``.
  Snapshot v1 and v2 differ by rule (keys dropped/added, sector and flag
  changed) so that an SCD2 merge has every kind of change to apply.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars.functions.casts import to_long
from lakebars.operators.candles import typed_candles
from lakebars.operators.scd2 import empty_dimension, scd2_merge

PROCESS_DATE = dt.date(2024, 1, 15)
EARLY_RUN_TS = dt.datetime(2024, 1, 1, 0, 0, 0)    # load of snapshot v1
RUN_TS = dt.datetime(2024, 1, 15, 0, 0, 0)         # merge of snapshot v2
LATE_RUN_TS = dt.datetime(2024, 1, 8, 0, 0, 0)      # snapshot v2 for an earlier date, come late
BASE_LOAD_TS = dt.datetime(2024, 1, 1, 0, 0, 0)    # load_dt of rows already in a target
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
PAGE_SIZE = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def span(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    """First and last day of the events (their row groups' statistics would do; one column is read)."""
    first, last = table(spark, sf_dir, "events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    return (first, last) if first else (PROCESS_DATE, PROCESS_DATE)


def raw_candles(events: DataFrame, by: str = "type") -> DataFrame:
    """events -> raw text candles (ticker, begin, open, close, high, low, volume)."""
    ticker = F.col("event_type") if by == "type" else F.col("user_id").cast("string")
    price = F.col("value").cast("string")
    return events.select(
        ticker.alias("ticker"),
        F.col("ts").cast("string").alias("begin"),
        price.alias("open"), price.alias("close"), price.alias("high"), price.alias("low"),
        F.get_json_object("props", "$.k").alias("volume"),
    )


def candles(spark: SparkSession, sf_dir: str, by: str = "type", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed candles straight from the typed columns: filters on ``ts`` reach
    the Parquet scan and only the four used columns are read."""
    e = table(spark, sf_dir, "events")
    ticker = F.col("event_type") if by == "type" else F.col("user_id").cast("string")
    return e.select(
        ticker.alias("ticker"), F.col("ts").alias("begin_ts"),
        *[F.col("value").alias(c) for c in ("open", "close", "high", "low")],
        to_long(F.get_json_object("props", "$.k")).alias("volume"),
        F.to_date("ts").alias("trade_date"), *keep,
    )


def candles_from_text(spark: SparkSession, sf_dir: str, by: str = "type") -> DataFrame:
    """The same candles through the raw-text path (render, then lenient casts)."""
    return typed_candles(raw_candles(table(spark, sf_dir, "events"), by))


def _issuer(customer: DataFrame, sector, flag) -> DataFrame:
    return customer.select(
        F.col("c_custkey").cast("string").alias("ticker"),
        F.col("c_name").alias("company_name"),
        sector.alias("sector"),
        flag.alias("dividend_policy_active"),
    )


def snapshot_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 13 != 0)
    return _issuer(c, F.col("c_mktsegment"), F.col("c_acctbal") > 0)


def snapshot_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 17 != 0)
    sector = F.when(F.col("c_custkey") % 7 == 0, F.lit("RESEGMENTED")).otherwise(F.col("c_mktsegment"))
    paying = F.col("c_acctbal") > 0
    flag = F.when(F.col("c_custkey") % 11 == 0, ~paying).otherwise(paying)
    return _issuer(c, sector, flag)


def dimension_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_merge(empty_dimension(spark), snapshot_v1(spark, sf_dir), EARLY_RUN_TS)


def dimension_v2(spark: SparkSession, sf_dir: str, run_ts=RUN_TS) -> DataFrame:
    return scd2_merge(dimension_v1(spark, sf_dir), snapshot_v2(spark, sf_dir), run_ts)


EMPTY_PAGE = '{"candles":{"metadata":{},"data":[]}}'
BLOCK_PAGES = 32     # pages of a chain in one folder of the store


def page_key(ticker: str, day) -> str:
    """Folder of a (ticker, day): any name of a ticker becomes a plain folder name."""
    return hashlib.md5(f"{ticker}|{day}".encode()).hexdigest()


def write_page_store(pages: DataFrame, root: str, page_size: int = PAGE_SIZE, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """Pages keyed by (ticker, day, start), as a server holds them; returns the requests for all of their chains.

    A folder holds ``block_pages`` pages of a chain at most, so answering a
    request opens one small file however long the chain is.
    """
    key = F.md5(F.concat_ws("|", "ticker", F.col("trade_date").cast("string")))
    (pages.select(key.alias("key"), F.floor(F.col("start") / (page_size * block_pages)).alias("block"), "start", "page")
     .repartition("key", "block").sortWithinPartitions("key", "block", "start")
     .write.mode("error").partitionBy("key", "block").parquet(root))
    return pages.groupBy("ticker", F.col("trade_date").alias("load_date")).agg(F.count(F.lit(1)).alias("pages")).drop("pages")


def page_server(root_uri: str, page_size: int = PAGE_SIZE, block_pages: int = BLOCK_PAGES):
    """Stands in for the HTTP API: the page of the store at the request's offset, an empty one after the last."""
    def fetch(params: dict) -> str:
        import pyarrow.parquet as pq
        from pyarrow import fs

        start = int(params.get("start") or 0)
        store, root = fs.FileSystem.from_uri(root_uri)
        folder = f"{root}/key={page_key(params['ticker'], params['date'])}/block={start // (page_size * block_pages)}"
        files = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        for f in files:
            if f.path.endswith(".parquet"):
                found = pq.read_table(f.path, filesystem=store, columns=["page"], filters=[("start", "=", start)])
                if found.num_rows:
                    return found.column("page")[0].as_py()
        return EMPTY_PAGE

    cloudpickle.register_pickle_by_value(sys.modules[__name__])     # workers need no copy of the package
    return fetch
