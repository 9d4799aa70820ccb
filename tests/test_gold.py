"""Gold operators: quality gate, upsert, SCD2, as-of join, daily return."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakebars.functions.returns import daily_return_pct
from lakebars.operators.asof import asof_join
from lakebars.operators.merge import upsert_frame
from lakebars.operators.quality import DataQualityError, dq_gate, dq_summary, dq_violations
from lakebars.operators.scd2 import DIM_COLUMNS, empty_dimension, scd2_merge
from lakebars.schemas import ISSUER

D = dt.date(2024, 1, 2)
RUN = dt.datetime(2024, 1, 10, 12, 0, 0)
BARS = "ticker string, trade_date date, open_price double, close_price double, high_price double, low_price double, volume bigint"


def test_quality_rules(spark):
    rows = [("hl", D, 1.0, 1.0, 1.0, 2.0, 1), ("vol", D, 1.0, 1.0, 2.0, 1.0, -1),
            ("open0", D, 0.0, 1.0, 2.0, 1.0, 1), ("nulls", D, None, None, None, None, None),
            ("ok", D, 1.0, 1.0, 2.0, 1.0, 1)]
    bars = spark.createDataFrame(rows, BARS)
    bad = {r["ticker"]: r["failed_rules"] for r in dq_violations(bars).collect()}
    assert bad == {"hl": "high_below_low", "vol": "negative_volume", "open0": "non_positive_open"}
    with pytest.raises(DataQualityError):
        dq_gate(bars)
    assert dq_gate(bars.where(F.col("ticker").isin("nulls", "ok")))["passed"]
    assert dq_gate(bars.where(F.lit(False)))["passed"]  # empty day passes
    summary = dq_summary(bars).first()
    assert summary["violations"] == 3 and not summary["passed"]


TARGET = "k bigint, v string, load_dt timestamp_ntz"


def test_upsert_cases(spark):
    t0 = dt.datetime(2024, 1, 1)
    target = spark.createDataFrame([(1, "old", t0), (2, "keep", t0), (None, "tnull", t0)], TARGET)
    source = spark.createDataFrame([(1, "new"), (3, "ins"), (None, "snull")], "k bigint, v string")
    out = sorted((r["k"] if r["k"] is not None else -1, r["v"], r["load_dt"])
                 for r in upsert_frame(target, source, ["k"], ["v"], RUN).collect())
    assert out == [(-1, "snull", RUN), (-1, "tnull", t0), (1, "new", RUN), (2, "keep", t0), (3, "ins", RUN)]
    twice = source.where("k is null").unionByName(source)      # NULL keys never conflict, not even repeated rows
    assert upsert_frame(target, twice, ["k"], ["v"], RUN).where("k is null").count() == 3


def test_upsert_duplicate_source_key(spark):
    target = spark.createDataFrame([], TARGET)
    source = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k bigint, v string, seq int")
    with pytest.raises(PySparkException, match="repeated key"):
        upsert_frame(target, source, ["k"], ["v"], RUN).collect()
    out = upsert_frame(target, source, ["k"], ["v"], RUN, on_duplicate="latest",
                       latest_first=[F.col("seq").desc()]).collect()
    assert [(r["k"], r["v"]) for r in out] == [(1, "b")]


def issuers(spark, rows):
    return spark.createDataFrame(rows, ISSUER)


def dim_rows(df):
    return sorted((r["ticker"] or "", r["sector"] or "", r["valid_from"], r["valid_to"], r["is_current"])
                  for r in df.select(*DIM_COLUMNS).collect())


def test_scd2_cases(spark):
    start, end = dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59)
    v1 = issuers(spark, [("SAME", "n", "s", True), ("CHG", "n", "s", True), ("GONE", "n", "s", True),
                         ("MOVE", "a", None, True)])
    dim1 = scd2_merge(empty_dimension(spark), v1, dt.datetime(2024, 1, 1))
    v2 = issuers(spark, [("SAME", "n", "s", True), ("CHG", "n", "t", True), ("NEW", "n", "s", False),
                         ("MOVE", None, "a", True)])
    dim2 = scd2_merge(dim1, v2, RUN)
    got = dim_rows(dim2)
    assert ("CHG", "s", start, RUN, False) in got and ("CHG", "t", RUN, end, True) in got
    assert ("SAME", "s", start, end, True) in got
    assert ("GONE", "s", start, end, True) in got          # no delete detection
    assert ("NEW", "s", start, end, True) in got            # new ticker starts in 1900
    assert ("MOVE", "", start, end, True) in got            # NULL moved between attributes: not seen
    assert len(got) == 6
    # the same snapshot again changes nothing
    assert dim_rows(scd2_merge(dim2, v2, RUN + dt.timedelta(days=1))) == got


def test_scd2_history_only_restarts_at_run(spark):
    start, end = dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59)
    hist = spark.createDataFrame([(1, "X", "n", "s", True, start, dt.datetime(2024, 1, 5), False)],
                                 "emitent_id bigint, ticker string, company_name string, sector string, "
                                 "dividend_policy_active boolean, valid_from timestamp_ntz, valid_to timestamp_ntz, "
                                 "is_current boolean")
    got = dim_rows(scd2_merge(hist, issuers(spark, [("X", "n", "t", True)]), RUN))
    assert ("X", "t", RUN, end, True) in got


def test_scd2_strict_rejects_duplicates(spark):
    snap = issuers(spark, [("A", "n", "s", True), ("A", "n", "t", True)])
    with pytest.raises(PySparkException, match="duplicate or NULL tickers"):
        scd2_merge(empty_dimension(spark), snap, RUN).collect()
    loose = dim_rows(scd2_merge(empty_dimension(spark), snap, RUN, strict=False))
    assert len(loose) == 2  # both inserted as current, like the original SQL


def test_asof_join_date_grain(spark):
    t = lambda *a: dt.datetime(*a)
    dim = spark.createDataFrame([
        ("A", "old", t(1900, 1, 1), t(2024, 1, 3, 9)),
        ("A", "new", t(2024, 1, 3, 9), t(9999, 12, 31, 23, 59, 59)),
        ("B", "blip", t(2024, 1, 2, 1), t(2024, 1, 2, 5)),
    ], "ticker string, sector string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = spark.createDataFrame([("A", dt.date(2024, 1, 2)), ("A", dt.date(2024, 1, 3)),
                                   ("B", dt.date(2024, 1, 2)), ("Z", dt.date(2024, 1, 2))],
                                  "ticker string, trade_date date")
    got = sorted((r["ticker"], r["trade_date"].day, r["sector"]) for r in asof_join(facts, dim).collect())
    assert got == [("A", 2, "old"), ("A", 3, "new")]


def test_daily_return_rounding(spark):
    df = spark.createDataFrame([(Decimal("8.00"), Decimal("8.01")), (Decimal("8.00"), Decimal("7.99")),
                                (Decimal("0"), Decimal("1"))], "o decimal(18,6), c decimal(18,6)")
    got = [r[0] for r in df.select(daily_return_pct("o", "c")).collect()]
    assert got == [Decimal("0.13"), Decimal("-0.13"), None]


def test_scd2_loose_null_and_duplicate_tickers(spark):
    start = dt.datetime(1900, 1, 1)
    dim = scd2_merge(empty_dimension(spark), issuers(spark, [("A", "n", "s", True)]), dt.datetime(2024, 1, 1))
    snap = spark.createDataFrame([("A", "n", "s", True), ("A", "n", "t", True), (None, "x", "y", True)],
                                 "ticker string, company_name string, sector string, dividend_policy_active boolean")
    once = dim_rows(scd2_merge(dim, snap, RUN, strict=False))
    # A changed through one of its two rows: the old version closes once, both rows open
    assert ("A", "s", start, RUN, False) in once
    assert sum(1 for r in once if r[0] == "A" and r[4]) == 2
    # a NULL ticker never matches: inserted from 1900 on every run
    assert sum(1 for r in once if r[0] == "") == 1
    twice = dim_rows(scd2_merge(scd2_merge(dim, snap, RUN, strict=False), snap, RUN, strict=False))
    assert sum(1 for r in twice if r[0] == "") == 2
    for bad in (snap.where("ticker is null"), snap.where("ticker = 'A'")):
        with pytest.raises(PySparkException, match="duplicate or NULL tickers"):
            scd2_merge(dim, bad, RUN).collect()  # strict rejects both problems


def test_insert_if_absent_first_wins(spark):
    from lakebars.operators.merge import insert_if_absent_frame

    target = spark.createDataFrame([(1, "t")], "k bigint, v string")
    source = spark.createDataFrame([(1, "s", 0), (2, "first", 0), (2, "second", 1), (None, "n", 0)],
                                   "k bigint, v string, seq int")
    new = insert_if_absent_frame(target, source, ["k"], first_by=[F.col("seq")]).collect()
    assert [(r["k"], r["v"]) for r in new] == [(2, "first")]


def test_upsert_carries_source_only_columns_on_insert(spark):
    t0 = dt.datetime(2024, 1, 1)
    target = spark.createDataFrame([(1, "old", t0, D)], "k bigint, v string, load_dt timestamp_ntz, d date")
    source = spark.createDataFrame([(1, "new", dt.date(2030, 1, 1)), (2, "ins", D)], "k bigint, v string, d date")
    out = {r["k"]: r for r in upsert_frame(target, source, ["k"], ["v"], RUN).collect()}
    assert (out[1]["v"], out[1]["d"]) == ("new", D)   # matched: only value columns change
    assert (out[2]["v"], out[2]["d"]) == ("ins", D)   # inserted: every column from the source
