"""Silver operators on hand-written adversarial rows (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from lakebars.operators.bars import daily_ohlcv_latest_load, daily_ohlcv, dedupe_latest
from lakebars.operators.candles import on_day, typed_candles
from lakebars.operators.ranking import rank_within
from lakebars.schemas import RAW_CANDLE
from lakebars.sources.files import latest_available

D = dt.date(2024, 1, 2)
RAW = "ticker string, begin string, open string, close string, high string, low string, volume string"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_lenient_casts(spark):
    rows = [("A", "2024-01-02 10:00:00", "abc", "1.50", "2", "1", "1e3"),
            ("A", "2024-01-02 10:01:00", "1", "1", "1", "1", "9007199254740993"),
            ("A", "bad", "1", "1", "1", "1", "1")]
    out = typed_candles(raw(spark, rows)).orderBy("begin_ts").collect()
    assert out[0]["begin_ts"] is None and out[0]["open"] == 1.0  # "bad" begin: NULL, row kept
    by_vol = {r["volume"] for r in out}
    assert 1000 in by_vol and 9007199254740993 in by_vol
    kept = on_day(typed_candles(raw(spark, rows)), D).collect()
    assert len(kept) == 2  # the row with an unparsable begin is dropped by the day filter
    first = [r for r in kept if r["volume"] == 1000][0]
    assert first["open"] is None and first["close"] == 1.5


def test_next_day_candle_dropped(spark):
    rows = [("A", "2024-01-02 23:59:00", "1", "1", "1", "1", "1"),
            ("A", "2024-01-03 00:00:00", "2", "2", "2", "2", "2")]
    df = typed_candles(raw(spark, rows)).withColumn("load_date", F.lit(D))
    (bar,) = daily_ohlcv_latest_load(df).collect()
    assert (bar["trade_date"], bar["close_price"], bar["volume"]) == (D, 1.0, 1)


def test_ohlcv_semantics(spark):
    rows = [("A", "2024-01-02 10:00:00", None, "5", None, "1", "10"),
            ("A", "2024-01-02 10:01:00", "7", "6", None, "2", "20"),
            ("B", "2024-01-02 11:00:00", "3", "4", "5", "2", None)]
    bars = {r["ticker"]: r for r in daily_ohlcv(typed_candles(raw(spark, rows))).collect()}
    a, b = bars["A"], bars["B"]
    assert a["open_price"] is None          # first candle's open is NULL: stays NULL
    assert a["close_price"] == 6.0
    assert a["high_price"] is None          # all-NULL high
    assert a["low_price"] == 1.0 and a["volume"] == 30
    assert (b["open_price"], b["close_price"], b["high_price"], b["low_price"]) == (3.0, 4.0, 5.0, 2.0)
    assert b["volume"] is None


def test_dedupe_latest_load_wins(spark):
    df = spark.createDataFrame(
        [("A", "2024-01-02 10:00:00", "5", dt.date(2024, 1, 2)),
         ("A", "2024-01-02 10:00:00", "7", dt.date(2024, 1, 3)),
         ("A", "2024-01-02 10:01:00", "1", dt.date(2024, 1, 2))],
        "ticker string, begin string, volume string, load_date date")
    out = dedupe_latest(df, ["ticker", "begin"], [F.col("load_date").desc()])
    vols = sorted(r["volume"] for r in out.collect())
    assert vols == ["1", "7"]


def test_latest_available_per_ticker(spark):
    d0, d1 = D, D - dt.timedelta(days=1)
    df = spark.createDataFrame(
        [("A", d0, 1), ("A", d1, 2), ("B", d1, 3), ("C", D - dt.timedelta(days=5), 4)],
        "ticker string, load_date date, x int")
    out = {r["ticker"]: r["load_date"] for r in latest_available(df, D, 1).collect()}
    assert out == {"A": d0, "B": d1}


def test_rank_within_hot_group(spark):
    # one key holds most rows: positions must still be exact 1..n in order
    rows = [("hot", i) for i in range(3000)] + [("cold", i) for i in range(5)] + [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "k string, t int").repartition(7)
    out = rank_within(df, ["k"], ["t"], rank_col="rn", size_col="n", descending_col="rd").collect()
    for r in out:
        if r["k"] is not None:
            assert r["rn"] == r["t"] + 1
        assert r["rn"] + r["rd"] - 1 == r["n"]
    hot = sorted((r["t"], r["rn"]) for r in out if r["k"] == "hot")
    assert [rn for _, rn in hot] == list(range(1, 3001))
    nulls = sorted((r["t"], r["rn"]) for r in out if r["k"] is None)
    assert nulls == [(1, 1), (2, 2)]


def test_raw_schema_is_text():
    assert all(f.dataType.simpleString() == "string" for f in RAW_CANDLE.fields)


def test_fused_latest_load_bars(spark):
    from lakebars.operators.bars import daily_ohlcv_latest_load

    d0, d1 = D, D - dt.timedelta(days=1)
    rows = [("A", "2024-01-02 10:00:00", "5", "5", "5", "5", "1", d0),   # A: D and D-1 -> D
            ("A", "2024-01-01 10:00:00", "4", "4", "4", "4", "1", d1),
            ("B", "2024-01-01 10:00:00", "3", "3", "3", "3", "2", d1),   # B: only D-1 -> D-1
            ("C", "2024-01-03 00:00:00", "9", "9", "9", "9", "9", d0),   # C: file of D holds only D+1
            ("C", "2024-01-01 09:00:00", "1", "1", "1", "1", "1", d1)]
    df = spark.createDataFrame(rows, RAW + ", load_date date")
    out = {r["ticker"]: r for r in daily_ohlcv_latest_load(typed_candles(df, keep=("ticker", "load_date"))).collect()}
    assert set(out) == {"A", "B"}                      # C's newest file exists but has no candle of its day
    assert (out["A"]["trade_date"], out["A"]["open_price"]) == (d0, 5.0)
    assert (out["B"]["trade_date"], out["B"]["volume"]) == (d1, 2)


def test_rank_within_local_timestamps(spark):
    base = dt.datetime(2024, 3, 31, 1, 59, 59, 999999)   # around a DST change in many zones
    rows = [("k", base + dt.timedelta(microseconds=i * 7919)) for i in range(500)] + [("k", None)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz").repartition(5)
    out = sorted((r["t"] is not None, r["t"] or dt.datetime.min, r["rn"])
                 for r in rank_within(df, ["k"], ["t"], width=0.5).collect())
    assert [r[2] for r in out] == list(range(1, 502))     # NULL first, then strictly by time


def test_hot_key_spreads_over_pieces(spark):
    from lakebars.operators.ranking import assign_pieces

    df = spark.range(30000).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 997)) AS k", "id AS t")
    sizes = assign_pieces(df, "t", 100).where("k = 'hot'").groupBy("_piece").count().collect()
    assert len(sizes) == 300 and max(r["count"] for r in sizes) <= 34      # pieces grow with the group
    nulls = spark.createDataFrame([("a", None), ("a", 2.5), ("a", float("inf")), ("a", None)], "k string, t double")
    ranks = sorted(r["rn"] for r in rank_within(nulls, ["k"], ["t"]).collect())
    assert ranks == [1, 2, 3, 4]
    words = spark.createDataFrame([("a", "y"), ("a", "x")], "k string, t string")
    assert {r["t"]: r["rn"] for r in rank_within(words, ["k"], ["t"]).collect()} == {"x": 1, "y": 2}


def test_value_where_and_recombined(spark):
    """A2 over a caller's predicate; J1 equals the single aggregate, NULL tickers included."""
    from lakebars.operators.bars import recombined_ohlcv, value_where

    rows = [("A", "2024-01-02 10:00:00", "7", "5", "8", "1", "10"), ("A", "2024-01-02 10:01:00", "6", "6", "9", "2", "20"),
            (None, "2024-01-02 11:00:00", "3", "4", "5", "2", "1"), (None, "2024-01-02 11:05:00", "4", "3", "5", "2", "1")]
    candles = typed_candles(raw(spark, rows))
    first = candles.groupBy("ticker").agg(value_where(F.minute("begin_ts") == 0, "open").alias("x"))
    assert {r["ticker"]: r["x"] for r in first.collect()} == {"A": 7.0, None: 3.0}
    key = lambda r: (r["ticker"] or "", r["trade_date"])
    assert sorted(recombined_ohlcv(candles).collect(), key=key) == sorted(daily_ohlcv(candles).collect(), key=key)
