"""The query catalogue: one callable per operator group, ``(spark, sf_dir) -> DataFrame``.

Every query reads whole driver tables (or data Spark derives from them);
queries that exercise table writes do so in a fresh folder under the
shared work root and return a scan of what they wrote.  Decimal outputs
are presented as double so that results compare across engines.
"""

from __future__ import annotations

import datetime as dt
import os
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars.functions.hashing import row_hash
from lakebars.functions.params import date_lit, ts_lit
from lakebars.operators.asof import asof_join, mart_frame
from lakebars.operators.bar_state import BAR_STATE, bar_states, bars_from_states
from lakebars.operators.bars import (daily_hlv, daily_ohlcv, daily_ohlcv_latest_load, dedupe_latest,
                                     distinct_candles, recombined_ohlcv, union_frames)
from lakebars.operators.candles import on_day, typed_candles
from lakebars.operators.merge import insert_if_absent_frame, upsert_frame
from lakebars.operators.pages import decode_pages, encode_pages, next_page_start
from lakebars.operators.quality import dq_summary, dq_violations, key_duplicates
from lakebars.operators.ranking import candle_rank, rank_within
from lakebars.operators.scd2 import scd2_frames, scd2_merge
from lakebars.plans import bindings as B
from lakebars.plans import jobs, sinks, tables
from lakebars.plans.publication import Publication
from lakebars.schemas import ISSUER_ATTRIBUTES, MART, ODS_BAR, PRICE
from lakebars.session import apply_conf, new_run_dir, scratch_database
from lakebars.sources.files import (latest_available, latest_loads, read_loads, read_parquet, read_raw_candles,
                                    read_snapshot)
from lakebars.sources.paged import read_pages, uri
from lakebars.sources.seed import universe_frame

Query = Callable[[SparkSession, str], DataFrame]
CANDLE_OUT = ["ticker", "begin_ts", "open", "close", "high", "low", "volume", "trade_date"]
LINEITEM_VALUES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                   "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINEITEM_ORDER = ["l_shipdate"] + [c for c in LINEITEM_VALUES if c != "l_shipdate"]


def _latest_first():
    """Newest ship date first, then every other value column: a total order."""
    return [F.col(c).desc() for c in LINEITEM_ORDER]
ORDER_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _as_double(df: DataFrame) -> DataFrame:
    """Present decimal columns as double."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal"
                       else F.col(f.name) for f in df.schema.fields])


def _bars_by_user(spark, sf_dir) -> DataFrame:
    return daily_ohlcv(B.candles(spark, sf_dir, "user"))


def _ods_bars(spark, sf_dir) -> DataFrame:
    bars = _bars_by_user(spark, sf_dir)
    return bars.select("ticker", "trade_date", "volume",
                       *[F.col(c).cast(PRICE).alias(c) for c in ("open_price", "close_price", "high_price", "low_price")])


# ------------------------------------------------------------ silver operators

def q_candles_typed(spark, sf_dir):
    return B.candles_from_text(spark, sf_dir).select(*CANDLE_OUT)


def q_day_filter(spark, sf_dir):
    return on_day(B.candles(spark, sf_dir), B.PROCESS_DATE).select(*CANDLE_OUT)


def q_daily_hlv(spark, sf_dir):
    return daily_hlv(B.candles(spark, sf_dir, "user"))


def q_candle_rank(spark, sf_dir):
    return candle_rank(B.candles(spark, sf_dir))


def q_rank_by_text(spark, sf_dir):
    """Positions by two text columns, the first downwards; one group holds a third of all orders."""
    o = B.table(spark, sf_dir, "orders")
    held = F.when(F.col("o_orderkey") % 3 == 0, F.lit("HOT")).otherwise(F.col("o_orderstatus"))
    rows = o.select(held.alias("held"), "o_orderpriority", F.col("o_orderkey").cast("string").alias("order_text"))
    return rank_within(rows, ["held"], ["o_orderpriority desc", "order_text"], descending_col="rn_last")


def q_daily_ohlcv(spark, sf_dir):
    return daily_ohlcv(B.candles(spark, sf_dir))


def q_daily_ohlcv_by_user(spark, sf_dir):
    return _bars_by_user(spark, sf_dir)


def q_recombined_ohlcv(spark, sf_dir):
    return recombined_ohlcv(B.candles(spark, sf_dir))


def q_dedupe_latest(spark, sf_dir):
    return dedupe_latest(B.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
                         _latest_first())


def q_latest_available_load(spark, sf_dir):
    c = B.candles(spark, sf_dir, "user").withColumn("load_date", F.col("trade_date"))
    return latest_available(c, B.PROCESS_DATE, lookback_days=1).select(*CANDLE_OUT, "load_date")


def q_latest_load_by_manifest(spark, sf_dir):
    """The same from landed files: loads are chosen in the manifest, then only their folders are read."""
    root = new_run_dir(spark, "loads")
    lh = jobs.Lakehouse(root)
    raw = B.raw_candles(B.table(spark, sf_dir, "events"), by="user")
    jobs.land_candle_records(lh, raw.select("ticker", F.to_date(F.col("begin").try_cast("timestamp_ntz")).alias("load_date"), F.to_json(
        F.struct("begin", "open", "close", "high", "low", "volume")).alias("record")))
    loads = latest_loads(spark, lh.bronze_candles, lh.bronze_loads, B.PROCESS_DATE)
    return typed_candles(read_loads(spark, lh.bronze_candles, loads), keep=("ticker", "load_date")).select(*CANDLE_OUT, "load_date")


def _pages(spark, sf_dir) -> DataFrame:
    return encode_pages(B.candles(spark, sf_dir), B.PAGE_SIZE)


def q_page_decode(spark, sf_dir):
    rows = decode_pages(_pages(spark, sf_dir), keep=("ticker",))
    return typed_candles(rows).select(*CANDLE_OUT)


def q_next_page_offset(spark, sf_dir):
    return next_page_start(_pages(spark, sf_dir), keep=("ticker", "trade_date"))


def q_universe_filter(spark, sf_dir):
    universe = universe_frame(spark, "click,purchase,view")
    return B.candles(spark, sf_dir).join(universe, "ticker", "left_semi").select(*CANDLE_OUT)


def q_union_frames(spark, sf_dir):
    """Two frames of different tickers: busy ones (by event type) and small ones (by user)."""
    return union_frames([B.candles(spark, sf_dir, by).select(*CANDLE_OUT) for by in ("type", "user")])


def q_silver_deduped(spark, sf_dir):
    """Daily bars of loads that repeat every third candle: repeats count once."""
    c = B.candles(spark, sf_dir, "user", keep=("event_id",)).withColumn("load_date", F.col("trade_date"))
    repeated = c.unionByName(c.where(F.col("event_id") % 3 == 0))
    # every day is a load of its own: the day takes the part of the ticker's newest load
    by_day = repeated.withColumn("ticker", F.concat_ws("|", "ticker", "trade_date"))
    bars = daily_ohlcv_latest_load(distinct_candles(by_day))
    return bars.withColumn("ticker", F.substring_index("ticker", "|", 1))


def q_bars_from_late_loads(spark, sf_dir):
    """The candles of every day in four loads; three are stored, the last one comes late, one is stored twice.

    Each load touches the stored states of its days only; the bars equal those of a full rebuild.
    """
    root, db = scratch_database(spark, "states")
    t = f"{db}.bar_states"
    tables.create_table(spark, t, BAR_STATE, None, ("trade_date",))
    c = B.candles(spark, sf_dir, "user", keep=("event_id",)).withColumn("load_id", F.col("event_id") % 4)
    tables.store_states(spark, t, bar_states(c.where("load_id < 3")))
    # a load that was cut short is stored again, then the late one
    tables.store_states(spark, t, bar_states(c.where("load_id = 2 AND event_id % 8 = 2")))
    tables.store_states(spark, t, bar_states(c.where("load_id = 2")))
    tables.store_states(spark, t, bar_states(c.where("load_id = 3")))
    return bars_from_states(spark.table(t))


# ------------------------------------------------------------ quality

def _bars_with_anomalies(spark, sf_dir) -> DataFrame:
    """Daily user bars with rule-breaking values injected by a rule on the volume."""
    b = _bars_by_user(spark, sf_dir)
    v = F.col("volume")
    return b.select(
        "ticker", "trade_date",
        F.when(v % 13 == 0, F.lit(0.0)).otherwise(F.col("open_price")).alias("open_price"),
        F.when(v % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("close_price")).alias("close_price"),
        F.when(v % 7 == 0, F.col("low_price") - 1).otherwise(F.col("high_price")).alias("high_price"),
        "low_price",
        F.when(v % 11 == 0, -v).otherwise(v).alias("volume"),
    )


def q_dq_violations(spark, sf_dir):
    return dq_violations(_bars_with_anomalies(spark, sf_dir))


def q_dq_gate(spark, sf_dir):
    return dq_summary(_bars_with_anomalies(spark, sf_dir))


def q_key_duplicates(spark, sf_dir):
    return key_duplicates(B.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------ merges

def q_upsert_orders(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders")
    target = orders.where(F.col("o_orderkey") % 3 < 2).withColumn("load_dt", ts_lit(B.BASE_LOAD_TS))
    source = (orders.where(F.col("o_orderkey") % 3 > 0)
              .withColumn("o_totalprice", F.col("o_totalprice") * F.lit(1.1)))
    return upsert_frame(target, source, ["o_orderkey"], ORDER_VALUES, B.RUN_TS)


def q_upsert_keeps_latest(spark, sf_dir):
    li = B.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    target = (dedupe_latest(li.where(F.col("l_linestatus") == "F"), keys, _latest_first())
              .withColumn("load_dt", ts_lit(B.BASE_LOAD_TS)))
    source = li.where(F.col("l_linestatus") == "O")
    return upsert_frame(target, source, keys, LINEITEM_VALUES, B.RUN_TS,
                        on_duplicate="latest", latest_first=_latest_first())


def q_upsert_in_buckets(spark, sf_dir):
    """Bars of every day upserted into an operational table in buckets of the ticker: only the batch moves."""
    root, db = scratch_database(spark, "buckets")
    t, names = f"{db}.ods_bars", [f.name for f in ODS_BAR.fields]
    tables.create_table(spark, t, ODS_BAR, None, ("trade_date",), ("ticker", 8))
    bars = _ods_bars(spark, sf_dir).withColumn("load_dt", F.lit(None).cast("timestamp_ntz")).select(*names)
    key, values = ["ticker", "trade_date"], [n for n in names if n.endswith("_price") or n == "volume"]
    of = F.col("ticker").cast("bigint") % 3
    tables.upsert_into(spark, t, bars.where(of < 2), key, values, B.BASE_LOAD_TS)
    tables.upsert_into(spark, t, bars.where(of > 0).withColumn("volume", F.col("volume") + 1), key, values, B.RUN_TS)
    return _as_double(spark.table(t))


def q_insert_if_absent(spark, sf_dir):
    """The whole table, every row twice, into a target that holds a part of it."""
    cust = B.table(spark, sf_dir, "customer")
    target = cust.where(F.col("c_nationkey") < 10)
    source = cust.unionByName(cust)
    return target.unionByName(insert_if_absent_frame(target, source, ["c_custkey"]))


def q_row_hash(spark, sf_dir):
    cust = B.table(spark, sf_dir, "customer")
    issuers = B._issuer(cust, F.col("c_mktsegment"), F.col("c_acctbal") > 0)
    return issuers.select("ticker", row_hash(*ISSUER_ATTRIBUTES).alias("row_hash"))


def _v2_frames(spark, sf_dir):
    return scd2_frames(B.dimension_v1(spark, sf_dir), B.snapshot_v2(spark, sf_dir), B.RUN_TS)


def q_scd2_changed(spark, sf_dir):
    return _v2_frames(spark, sf_dir).changed


def q_scd2_new(spark, sf_dir):
    return _v2_frames(spark, sf_dir).new


def q_scd2_merge(spark, sf_dir):
    return B.dimension_v2(spark, sf_dir).drop("emitent_id")


def q_scd2_rerun_older_date(spark, sf_dir):
    """v1, v2, then v1's date again and v2's snapshot for a date between them, which comes late."""
    dim = B.dimension_v2(spark, sf_dir)
    again = scd2_merge(dim, B.snapshot_v1(spark, sf_dir), B.EARLY_RUN_TS)
    return scd2_merge(again, B.snapshot_v2(spark, sf_dir), B.LATE_RUN_TS).drop("emitent_id")


def q_scd2_asof_join(spark, sf_dir):
    joined = asof_join(_bars_by_user(spark, sf_dir), B.dimension_v2(spark, sf_dir), between=B.span(spark, sf_dir))
    return joined.select("ticker", "trade_date", *ISSUER_ATTRIBUTES, "valid_from", "valid_to")


def _mart(spark, sf_dir, dimension=None) -> DataFrame:
    dim = dimension if dimension is not None else B.dimension_v2(spark, sf_dir)
    return mart_frame(_ods_bars(spark, sf_dir), dim)


def q_mart_daily(spark, sf_dir):
    return _as_double(_mart(spark, sf_dir))


# ------------------------------------------------------------ table maintenance

def _loaded_mart(spark, sf_dir, name: str) -> tuple[str, DataFrame]:
    root, db = scratch_database(spark, name)
    t = f"{db}.mart_daily"
    tables.create_table(spark, t, MART, None, ("trade_date",))
    mart = _mart(spark, sf_dir)
    tables.overwrite_partitions(spark, t, mart)
    return t, mart


def q_day_rebuild(spark, sf_dir):
    t, mart = _loaded_mart(spark, sf_dir, "day_rebuild")
    tables.replace_day(spark, t, B.PROCESS_DATE, mart.where(F.col("trade_date") == date_lit(B.PROCESS_DATE)))
    return _as_double(spark.table(t))


def q_day_rebuild_empty(spark, sf_dir):
    t, mart = _loaded_mart(spark, sf_dir, "day_rebuild_empty")
    empty = mart.where(F.col("trade_date") == date_lit(B.PROCESS_DATE)).where(F.lit(False))
    tables.replace_day(spark, t, B.PROCESS_DATE, empty)
    return _as_double(spark.table(t))


def q_partition_replace(spark, sf_dir):
    root, db = scratch_database(spark, "partition_replace")
    serving, buffer = f"{db}.serving", f"{db}.serving_buffer"
    tables.create_table(spark, serving, MART, None, ("trade_date",))
    tables.create_table(spark, buffer, MART, None, ("trade_date",))
    # Serving starts with every day built against the old dimension.
    old = _mart(spark, sf_dir, B.dimension_v1(spark, sf_dir))
    tables.overwrite_partitions(spark, serving, old)
    sinks.insert_by_position(old.where(F.col("trade_date") == date_lit(B.PROCESS_DATE)).select(
        *[f.name for f in MART.fields]), buffer)
    # Publish one day of the new mart: export -> truncate buffer -> load -> swap.
    day = _mart(spark, sf_dir).where(F.col("trade_date") == date_lit(B.PROCESS_DATE)).drop("trade_date")
    path = os.path.join(root, "export", str(B.PROCESS_DATE))
    sinks.write_parquet(day, path)
    tables.truncate(spark, buffer)
    exported = read_parquet(spark, path).withColumn("trade_date", date_lit(B.PROCESS_DATE))
    sinks.insert_by_position(exported.select(*[f.name for f in MART.fields]), buffer)
    tables.replace_partition_from(spark, serving, buffer, B.PROCESS_DATE)
    return _as_double(spark.table(serving))


def q_seed_reference(spark, sf_dir):
    root, db = scratch_database(spark, "seed_reference")
    nation = B.table(spark, sf_dir, "nation")
    t = f"{db}.nation_ref"
    tables.create_table(spark, t, nation.schema)
    tables.create_table(spark, t, nation.schema)  # already there: no-op
    for _ in range(2):  # second load inserts nothing
        tables.insert_if_absent_into(spark, t, nation, ["n_nationkey"])
    return spark.table(t)


# ------------------------------------------------------------ sources and sinks

def q_jsonl_round_trip(spark, sf_dir):
    root = new_run_dir(spark, "jsonl")
    raw = B.raw_candles(B.table(spark, sf_dir, "events"))
    landed = raw.withColumn("load_date", F.to_date(F.col("begin").try_cast("timestamp_ntz")).cast("string"))
    sinks.write_jsonl(landed, root, partition_by=["load_date"])
    back = typed_candles(read_raw_candles(spark, root), keep=("ticker", "load_date"))
    return back.select(*CANDLE_OUT, "load_date")


def q_parquet_round_trip(spark, sf_dir):
    root = new_run_dir(spark, "snapshots")
    prev = B.PROCESS_DATE - dt.timedelta(days=1)
    later = B.PROCESS_DATE + dt.timedelta(days=1)
    sinks.write_parquet(B.snapshot_v1(spark, sf_dir), os.path.join(root, f"load_date={prev}"))
    sinks.write_parquet(B.snapshot_v2(spark, sf_dir), os.path.join(root, f"load_date={later}"))
    snapshot, _ = read_snapshot(spark, root, B.PROCESS_DATE, lookback_days=1)
    return snapshot


def _page_api(spark, sf_dir, root):
    """A page store of all events under ``root``: its requests, and the fetch that answers them page by page."""
    folder = os.path.join(root, "store")
    requests = B.write_page_store(_pages(spark, sf_dir), folder)
    return requests, B.page_server(uri(spark, folder))


def q_paged_source(spark, sf_dir):
    """Every page chain of the events fetched page by page, then decoded."""
    root = new_run_dir(spark, "pages")
    requests, fetch = _page_api(spark, sf_dir, root)
    rows = decode_pages(read_pages(requests, fetch, path=os.path.join(root, "requests")), keep=("ticker",))
    return typed_candles(rows).select(*CANDLE_OUT)


def q_bronze_daily(spark, sf_dir):
    """L1 over all events: every page chain landed as JSONL and read back."""
    root, db = scratch_database(spark, "bronze")
    lh = jobs.Lakehouse(root, db=db)
    requests, fetch = _page_api(spark, sf_dir, root)
    jobs.ingest_requests(spark, requests, lh, fetch)
    landed = typed_candles(read_raw_candles(spark, lh.bronze_candles), keep=("ticker", "load_date"))
    return landed.select(*CANDLE_OUT, "load_date")


def q_skip_if_empty(spark, sf_dir):
    root = new_run_dir(spark, "skip")
    c = B.candles(spark, sf_dir)
    rows = []
    for day in (dt.date(2023, 12, 31), B.PROCESS_DATE):
        path = os.path.join(root, str(day))
        res = sinks.skip_if_empty(on_day(c, day), path)
        rows.append((day, res.status, res.rows))
    return spark.createDataFrame(rows, "process_date date, status string, row_count bigint")


def _three_runs(spark, sf_dir) -> jobs.Lakehouse:
    """L1 landing of every candle, then L2-L4 for D-1, D and D+1.

    The D-1 candles of every fifth ticker arrive only after the run of D-1:
    that run takes their D-2 load, and the run of D promotes their D-1 bars
    (and serves that day again) if they have no load of D.  The second
    snapshot comes with D and is valid from D+1 on.  A run whose bars break a
    rule of the gate is stopped and the next one goes on.
    """
    root, db = scratch_database(spark, "lakehouse")
    lh = jobs.Lakehouse(root, db=db).ensure(spark)
    prev, following = B.PROCESS_DATE - dt.timedelta(days=1), B.PROCESS_DATE + dt.timedelta(days=1)
    raw = B.raw_candles(B.table(spark, sf_dir, "events"), by="user")
    landed = raw.withColumn("load_date", F.to_date(F.col("begin").try_cast("timestamp_ntz")))
    records = landed.select("ticker", "load_date", F.to_json(F.struct("begin", "open", "close", "high", "low", "volume")).alias("record"))
    late = (F.col("load_date") == date_lit(prev)) & (F.col("ticker").cast("bigint") % 5 == 0)
    jobs.land_candle_records(lh, records.where(~late))
    jobs.land_snapshot(lh, B.snapshot_v1(spark, sf_dir), prev)
    jobs.daily_run(spark, lh, prev, jobs.default_run_ts(prev))
    jobs.land_candle_records(lh, records.where(F.col("load_date") == date_lit(prev)))
    jobs.land_snapshot(lh, B.snapshot_v2(spark, sf_dir), B.PROCESS_DATE)
    for day in (B.PROCESS_DATE, following):
        jobs.daily_run(spark, lh, day, jobs.default_run_ts(day))
    return lh


def q_daily_run_end_to_end(spark, sf_dir):
    """The whole serving table after the three runs of :func:`_three_runs`."""
    return _as_double(spark.table(_three_runs(spark, sf_dir).t("serving")))


def q_run_ledger(spark, sf_dir):
    """The ledger after the same three runs: every day that each of them touched, and its outcome."""
    return _three_runs(spark, sf_dir).ledger(spark).frame()


def q_publish_many_days(spark, sf_dir):
    """Every day published with the first dimension, then all days from D on again, with the second, in one swap."""
    root, db = scratch_database(spark, "publication")
    served = Publication(spark, os.path.join(root, "publication"), MART, view=f"{db}.serving",
                         versions=f"{db}.serving_versions").ensure()
    old, new = _mart(spark, sf_dir, B.dimension_v1(spark, sf_dir)), _mart(spark, sf_dir)
    first, last = B.span(spark, sf_dir)
    days = [first + dt.timedelta(days=k) for k in range((last - first).days + 1)]
    served.publish(old, days)
    served.publish(new, [d for d in days if d >= B.PROCESS_DATE])
    return _as_double(spark.table(f"{db}.serving"))


QUERIES: dict[str, Query] = {
    "candles_typed": q_candles_typed,
    "day_filter": q_day_filter,
    "daily_hlv": q_daily_hlv,
    "candle_rank": q_candle_rank,
    "rank_by_text": q_rank_by_text,
    "daily_ohlcv": q_daily_ohlcv,
    "daily_ohlcv_by_user": q_daily_ohlcv_by_user,
    "recombined_ohlcv": q_recombined_ohlcv,
    "dedupe_latest": q_dedupe_latest,
    "latest_available_load": q_latest_available_load,
    "latest_load_by_manifest": q_latest_load_by_manifest,
    "page_decode": q_page_decode,
    "next_page_offset": q_next_page_offset,
    "universe_filter": q_universe_filter,
    "union_frames": q_union_frames,
    "silver_deduped": q_silver_deduped,
    "bars_from_late_loads": q_bars_from_late_loads,
    "dq_violations": q_dq_violations,
    "dq_gate": q_dq_gate,
    "key_duplicates": q_key_duplicates,
    "upsert_orders": q_upsert_orders,
    "upsert_keeps_latest": q_upsert_keeps_latest,
    "upsert_in_buckets": q_upsert_in_buckets,
    "insert_if_absent": q_insert_if_absent,
    "row_hash": q_row_hash,
    "scd2_changed": q_scd2_changed,
    "scd2_new": q_scd2_new,
    "scd2_merge": q_scd2_merge,
    "scd2_rerun_older_date": q_scd2_rerun_older_date,
    "scd2_asof_join": q_scd2_asof_join,
    "mart_daily": q_mart_daily,
    "day_rebuild": q_day_rebuild,
    "day_rebuild_empty": q_day_rebuild_empty,
    "partition_replace": q_partition_replace,
    "seed_reference": q_seed_reference,
    "jsonl_round_trip": q_jsonl_round_trip,
    "parquet_round_trip": q_parquet_round_trip,
    "paged_source": q_paged_source,
    "bronze_daily": q_bronze_daily,
    "skip_if_empty": q_skip_if_empty,
    "daily_run_end_to_end": q_daily_run_end_to_end,
    "run_ledger": q_run_ledger,
    "publish_many_days": q_publish_many_days,
}


def with_conf(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_conf(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: with_conf(fn) for name, fn in QUERIES.items()}
