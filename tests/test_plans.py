"""Physical-plan properties the design relies on (read from the planned query)."""

import pytest

from lakebars.plans import registry as R

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_partial_hash_aggregate(spark):
    p = plan(R.q_daily_ohlcv_by_user(spark, SF))
    assert "partial_min_by" in p and "partial_max_by" in p and "partial_sum" in p
    assert "SortAggregate" not in p and "Window" not in p
    assert p.count("Exchange hashpartitioning") == 1


def test_day_filter_reaches_parquet(spark):
    p = plan(R.q_day_filter(spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-15T00:00), LessThan(ts,2024-01-16T00:00)]" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in p


def test_dedupe_limits_before_shuffle(spark):
    p = plan(R.q_dedupe_latest(spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_upsert_one_join_and_one_scan_of_each_side(spark):
    p = plan(R.q_upsert_orders(spark, SF))
    assert p.count("FullOuter") == 1 and p.count("FileScan parquet") == 2
    assert p.count("Exchange hashpartitioning") == 2       # the key check needs none of its own


def test_scd2_one_join_for_each_merge(spark):
    p = plan(R.q_scd2_merge(spark, SF))                    # two merges, as registered
    assert p.count("FullOuter") == 2 and p.count("FileScan parquet") == 2
    assert "LeftSemi" not in p and "LeftAnti" not in p
    assert plan(R.q_mart_daily(spark, SF)).count("FullOuter") == 2


@pytest.mark.parametrize("name", ["upsert_orders", "scd2_merge", "scd2_changed", "mart_daily", "candle_rank"])
def test_building_a_frame_runs_nothing(spark, name):
    spark.sparkContext.setJobGroup(f"build-{name}", "")
    R.queries()[name](spark, SF)
    ran = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
    spark.sparkContext.setJobGroup("default", "")
    assert len(ran) <= FOOTERS[name]                       # jobs that read Parquet footers for a schema


FOOTERS = {"upsert_orders": 1, "scd2_merge": 2, "scd2_changed": 2, "mart_daily": 3, "candle_rank": 1}


def test_candle_rank_splits_groups_into_pieces(spark):
    p = plan(R.q_candle_rank(spark, SF))
    assert "_piece" in p and "Window [row_number()" in p
    assert "WriteFiles" not in p  # nothing materialised


def test_asof_join_is_equi_join_with_range_residual(spark):
    p = plan(R.q_scd2_asof_join(spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert ("SortMergeJoin [ticker" in p or "BroadcastHashJoin [ticker" in p
            or "ShuffledHashJoin [ticker" in p)
    assert "_from_date" in p and "_to_date" in p


def test_silver_reads_window_only(spark, lakehouse):
    import datetime as dt

    from pyspark.sql import functions as F

    from lakebars.plans import jobs
    from lakebars.session import delete_folder

    days = [dt.date(2024, 1, d) for d in range(1, 8)]
    df = spark.createDataFrame([("A", d, f"{d} 10:00:00") for d in days], "ticker string, load_date date, begin string")
    rec = F.to_json(F.struct(F.col("begin"), F.lit("1").alias("open"), F.lit("1").alias("close"),
                             F.lit("1").alias("high"), F.lit("1").alias("low"), F.lit("1").alias("volume")))
    jobs.land_candle_records(lakehouse, df.select("ticker", "load_date", rec.alias("record")))
    bars = jobs.silver_bars(spark, lakehouse, dt.date(2024, 1, 5))
    p = plan(bars)
    assert "partial_min_by" in p and "WindowGroupLimit" in p   # repeated candles go before the shuffle
    read = [f for f in bars.inputFiles() if "/candles/" in f]  # the chosen load alone, its predecessor is not listed
    assert read and all("load_date=2024-01-05" in f for f in read)
    loads = [f for f in bars.inputFiles() if "/candle_loads/" in f]
    assert loads and all("load_date=2024-01-05" in f or "load_date=2024-01-04" in f for f in loads)
    delete_folder(spark, lakehouse.bronze_loads)               # without a manifest: the window's folders
    p = plan(jobs.silver_bars(spark, lakehouse, dt.date(2024, 1, 5)))
    assert "InMemoryFileIndex(2 paths)" in p and "PartitionFilters: [load_date" in p
    assert p.count("Exchange hashpartitioning") <= 3 and "partial_min_by" in p and "WindowGroupLimit" in p
    from lakebars.sources.files import read_raw_candles
    files = read_raw_candles(spark, lakehouse.bronze_candles, [dt.date(2024, 1, 5), dt.date(2024, 1, 4)]).inputFiles()
    assert files and all("load_date=2024-01-05" in f or "load_date=2024-01-04" in f for f in files)


def test_gold_reads_only_versions_that_can_cover(spark, lakehouse):
    from pyspark.sql import functions as F

    dim = spark.table(lakehouse.t("dim_issuers")).where(F.col("version_end") > F.lit("2024-01-02").cast("date"))
    assert "PartitionFilters: [isnotnull(version_end" in plan(dim)


def test_upsert_in_buckets_moves_the_source_only(spark, lakehouse):
    """The target's side has no exchange: a bucketed scan feeds the join; the side table and the result keep the buckets."""
    import datetime as dt
    import re

    from lakebars.plans import tables
    from lakebars.schemas import ODS_BAR

    t = f"{lakehouse.db}.ods_in_buckets"
    tables.create_table(spark, t, ODS_BAR, None, ("trade_date",), ("ticker", 4))
    assert tables.bucket_spec(spark, t) == ("ticker", 4) and tables.bucket_spec(spark, lakehouse.t("ods_bars")) is None
    days = [dt.date(2024, 1, d) for d in (2, 3, 4)]
    rows = spark.range(300).selectExpr(
        "IF(id % 50 = 0, NULL, concat('T', id % 60)) AS ticker", *[f"CAST(id AS DECIMAL(18,6)) AS {c}_price" for c in ("open", "close", "high", "low")],
        "id AS volume", "CAST(NULL AS TIMESTAMP_NTZ) AS load_dt", "date_add(DATE'2024-01-02', CAST(id % 3 AS INT)) AS trade_date").dropDuplicates(
        ["ticker", "trade_date"])
    rows = rows.where("ticker IS NOT NULL")
    values = ["open_price", "close_price", "high_price", "low_price", "volume"]
    options = (["ticker", "trade_date"], values)
    tables.upsert_into(spark, t, rows, *options, dt.datetime(2024, 1, 5))
    source = rows.where("volume % 2 = 0 AND trade_date < DATE'2024-01-04'").withColumn("volume", rows["volume"] + 1000)
    merged = tables.upsert_plan(spark, t, source, *options, dt.datetime(2024, 1, 6), days[:2], ("ticker", 4), on_duplicate="checked")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    p = plan(merged)
    assert "SelectedBucketsCount: 4 out of 4" in p
    join = p.index("SortMergeJoin")
    target, moved = p[join:].split("FileScan parquet")[0], p[join:]
    assert "Exchange" not in target and moved.count("Exchange hashpartitioning") >= 1
    assert not re.search(r"Exchange[^\n]*\n[^\n]*(Project|Filter|ColumnarToRow)[^\n]*\n[^\n]*FileScan parquet[^\n]*ods_in_buckets", p)
    plain = lakehouse.t("ods_bars")
    for run, part in ((dt.datetime(2024, 1, 5), rows), (dt.datetime(2024, 1, 6), source), (dt.datetime(2024, 1, 6), source)):
        tables.upsert_into(spark, plain, part, *options, run)
        if part is source:
            tables.upsert_into(spark, t, part, *options, run)
    assert sorted(map(str, spark.table(t).collect())) == sorted(map(str, spark.table(plain).collect()))
    files = {}
    for f in spark.table(t).inputFiles():
        files.setdefault(re.search(r"trade_date=([^/]+)", f)[1], []).append(re.search(r"_(\d{5})\.", f)[1])
    assert all(len(own) == len(set(own)) <= 4 for own in files.values()) and len(files) == 3
    assert not [r for r in spark.sql(f"SHOW TABLES IN {lakehouse.db}").collect() if r["tableName"].startswith("side_")]
