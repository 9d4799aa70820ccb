"""Row numbers by sampled splitters, and bars as sums of stored states."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakebars.operators.bar_state import BAR_STATE, bar_states, bars_from_states, merge_states
from lakebars.operators.bars import daily_ohlcv
from lakebars.operators.ranking import By, assign_sampled_pieces, rank_within
from lakebars.plans import tables


def texts(n=900, seed=3):
    rng = random.Random(seed)
    words = ["", "a", "aa", "ab", "é", "Z", None]
    return [(rng.choice(["HOT", f"G{k % 9}", None]) if k % 3 else "HOT", rng.choice(words), rng.choice([None, rng.randint(0, 9)]), f"id{k:05d}")
            for k in range(n)]


def plain_rank(rows, order):
    """Positions by (column, descending) pairs; NULLs first upwards, last downwards."""
    out, groups = {}, {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    for key, own in groups.items():
        for column, descending in reversed(order):
            own.sort(key=lambda r: (r[column] is not None, r[column] if r[column] is not None else type(r[column])() if r[column] else 0)
                     if not isinstance(r[column], str) else (True, r[column].encode()), reverse=descending)
        out.update({r[3]: (k + 1, len(own)) for k, r in enumerate(own)})
    return out


@pytest.mark.parametrize("piece_rows", [10**6, 40, 3])
@pytest.mark.parametrize("order, spec", [
    (["t", "id"], [(1, False), (3, False)]),
    (["t desc", "id"], [(1, True), (3, False)]),
    (["t", "n desc", "id desc"], [(1, False), (2, True), (3, True)]),
    (["id"], [(3, False)]),
])
def test_rank_by_several_columns(spark, order, spec, piece_rows):
    rows = texts()
    df = spark.createDataFrame(rows, "g string, t string, n int, id string")
    out = rank_within(df, ["g"], order, descending_col="last", piece_rows=piece_rows)
    assert out.columns == ["g", "t", "n", "id", "rn", "group_rows", "last"]
    got = {r["id"]: (r["rn"], r["group_rows"]) for r in out.collect()}
    assert got == plain_rank(rows, spec)
    assert all(r["last"] == r["group_rows"] - r["rn"] + 1 for r in out.collect())


def test_large_groups_are_cut_small_ones_are_not(spark):
    rows = spark.range(30_000).selectExpr("IF(id % 3 = 0, 'HOT', concat('G', id % 5000)) AS g", "sha2(CAST(id AS STRING), 256) AS t")
    pieces = assign_sampled_pieces(rows, ["g"], [By("t")], piece_rows=300).groupBy("g", "_piece").count()
    hot = sorted(r["count"] for r in pieces.where("g = 'HOT'").collect())
    assert 20 <= len(hot) <= 50 and hot[-1] <= 900
    assert pieces.where("g <> 'HOT'").count() == pieces.where("g <> 'HOT'").select("g").distinct().count()
    assert assign_sampled_pieces(rows.limit(0), ["g"], [By("t")], piece_rows=1).count() == 0


def test_rank_without_keys(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "t string")
    assert {r["t"]: r["rn"] for r in rank_within(df, [], ["t desc"], size_col=None, piece_rows=1).collect()} == {"c": 1, "b": 2, "a": 3, None: 4}


def candles(spark, seed=5, n=400):
    rng = random.Random(seed)
    price = lambda: rng.choice([None, round(rng.random() * 50, 2)])
    start = dt.datetime(2024, 1, 2)
    rows = [(f"T{rng.randint(0, 6)}", start + dt.timedelta(minutes=rng.randint(0, 4000), microseconds=k), price(), price(), price(), price(),
             rng.choice([None, rng.randint(0, 9)]), rng.randint(0, 5)) for k in range(n)]
    df = spark.createDataFrame(rows, "ticker string, begin_ts timestamp_ntz, open double, close double, high double, low double, "
                                     "volume bigint, load_id bigint")
    return df.withColumn("trade_date", F.to_date("begin_ts"))


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_states_in_any_order_equal_a_full_rebuild(spark):
    c = candles(spark)
    want = rows_of(daily_ohlcv(c))
    assert rows_of(bars_from_states(bar_states(c))) == want
    held = spark.createDataFrame([], BAR_STATE)
    for load in (3, 0, 5, 2, 4, 1, 3):              # the last one again
        held = merge_states(held, bar_states(c.where(F.col("load_id") == load)))
    assert rows_of(bars_from_states(held)) == want
    assert rows_of(held) == rows_of(bar_states(c))


def test_stored_states(spark, lakehouse, monkeypatch):
    """Only the days that a load brings are read and rewritten; a load that was cut short is replaced."""
    c, t = candles(spark, 8), f"{lakehouse.db}.states"
    tables.create_table(spark, t, BAR_STATE, None, ("trade_date",))
    days = sorted(r[0] for r in c.select("trade_date").distinct().collect())
    assert tables.store_states(spark, t, bar_states(c.where("load_id <> 1"))) == days
    first = F.col("trade_date") == F.lit(days[0])
    tables.store_states(spark, t, bar_states(c.where((F.col("load_id") == 1) & first).limit(1)))
    others = {f for f in spark.table(t).where(~first).inputFiles()}
    assert tables.store_states(spark, t, bar_states(c.where((F.col("load_id") == 1) & first))) == [days[0]]
    assert {f for f in spark.table(t).where(~first).inputFiles()} == others
    assert rows_of(bars_from_states(spark.table(t))) == rows_of(daily_ohlcv(c.where((F.col("load_id") != 1) | first)))
    assert tables.store_states(spark, t, bar_states(c.where("false"))) == []


def test_candles_at_the_same_time_the_newest_load_counts_last(spark):
    at = dt.datetime(2024, 1, 2, 10)
    c = spark.createDataFrame([("A", at, 1.0, 1.0, 1, 7), ("A", at, 2.0, 2.0, 1, 9)],
                              "ticker string, begin_ts timestamp_ntz, open double, close double, volume bigint, load_id bigint")
    c = c.withColumns({"high": F.col("open"), "low": F.col("open"), "trade_date": F.to_date("begin_ts")})
    (bar,) = bars_from_states(bar_states(c)).collect()
    assert (bar["open_price"], bar["close_price"], bar["volume"]) == (2.0, 2.0, 2)
