"""Property tests: Spark operators against brute-force Python models on random rows."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from lakebars.operators.bars import daily_ohlcv
from lakebars.operators.merge import upsert_frame
from lakebars.operators.scd2 import DIM_COLUMNS, empty_dimension, scd2_merge

SETTINGS = settings(max_examples=8, deadline=None)
BASE = dt.datetime(2024, 1, 1)
RUN = dt.datetime(2024, 2, 1, 3, 0)

candle = st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 3 * 24 * 60 - 1),
                   st.one_of(st.none(), st.integers(1, 500)), st.one_of(st.none(), st.integers(0, 50)))


@SETTINGS
@given(st.lists(candle, max_size=40, unique_by=lambda c: (c[0], c[1])))
def test_ohlcv_matches_model(spark, rows):
    data = [(t, BASE + dt.timedelta(minutes=m), None if p is None else p / 100, None if p is None else p / 100,
             None if p is None else p / 100, None if p is None else p / 100, v,
             (BASE + dt.timedelta(minutes=m)).date()) for t, m, p, v in rows]
    df = spark.createDataFrame(data, "ticker string, begin_ts timestamp_ntz, open double, close double, "
                                     "high double, low double, volume bigint, trade_date date")
    got = {(r["ticker"], r["trade_date"]): tuple(r[c] for c in ("open_price", "close_price", "high_price",
                                                                "low_price", "volume"))
           for r in daily_ohlcv(df).collect()}
    model = {}
    for key in {(d[0], d[7]) for d in data}:
        group = sorted((d for d in data if (d[0], d[7]) == key), key=lambda d: d[1])
        prices = [d[2] for d in group if d[2] is not None]
        vols = [d[6] for d in group if d[6] is not None]
        model[key] = (group[0][2], group[-1][3], max(prices) if prices else None,
                      min(prices) if prices else None, sum(vols) if vols else None)
    assert got == model


@SETTINGS
@given(st.dictionaries(st.integers(0, 30), st.text("ab", max_size=2), max_size=15),
       st.dictionaries(st.integers(0, 30), st.text("xy", max_size=2), max_size=15))
def test_upsert_matches_model(spark, target, source):
    t0 = BASE
    tdf = spark.createDataFrame([(k, v, t0) for k, v in target.items()], "k bigint, v string, load_dt timestamp_ntz")
    sdf = spark.createDataFrame([(k, v) for k, v in source.items()], "k bigint, v string")
    got = {r["k"]: (r["v"], r["load_dt"]) for r in upsert_frame(tdf, sdf, ["k"], ["v"], RUN).collect()}
    model = {k: (v, t0) for k, v in target.items()}
    model.update({k: (v, RUN) for k, v in source.items()})
    assert got == model


issuer = st.tuples(st.sampled_from(["s1", "s2", None]), st.sampled_from([True, False, None]))


def scd2_model(snapshots):
    """Apply snapshots in order with the merge rules; versions as tuples."""
    start, end = dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59)
    dim = []  # [ticker, sector, flag, valid_from, valid_to, is_current]

    def h(sector, flag):
        return "||".join(x for x in ("n", sector, None if flag is None else str(flag).lower()) if x is not None)

    for run_ts, snap in snapshots:
        current = {v[0]: v for v in dim if v[5]}
        history = {v[0] for v in dim if not v[5]}
        for ticker, (sector, flag) in snap.items():
            cur = current.get(ticker)
            if cur is None:
                dim.append([ticker, sector, flag, run_ts if ticker in history else start, end, True])
            elif h(cur[1], cur[2]) != h(sector, flag):
                cur[4], cur[5] = run_ts, False
                dim.append([ticker, sector, flag, run_ts, end, True])
    return sorted((tuple(v) for v in dim), key=_order)


def _order(row):
    return tuple((x is None, "" if x is None else str(x)) for x in row)


@SETTINGS
@given(st.lists(st.dictionaries(st.sampled_from(["A", "B", "C", "D"]), issuer, max_size=4), min_size=1, max_size=3))
def test_scd2_strict_matches_model(spark, snaps):
    runs = [(RUN + dt.timedelta(days=i), s) for i, s in enumerate(snaps)]
    dim = empty_dimension(spark)
    for run_ts, snap in runs:
        sdf = spark.createDataFrame([(t, "n", s, f) for t, (s, f) in snap.items()],
                                    "ticker string, company_name string, sector string, dividend_policy_active boolean")
        dim = spark.createDataFrame(scd2_merge(dim, sdf, run_ts).collect(), dim.schema)
    got = sorted(((r["ticker"], r["sector"], r["dividend_policy_active"], r["valid_from"], r["valid_to"],
                   r["is_current"]) for r in dim.select(*DIM_COLUMNS).collect()), key=_order)
    assert got == scd2_model(runs)


def timeline_model(loads):
    """What each ticker's attributes are over time after loads in any order, repeats included."""
    start, end = dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59)
    h = lambda a: "||".join(x for x in ("n", a[0], None if a[1] is None else str(a[1]).lower()) if x is not None)
    lines = {}
    for run_ts, snap in loads:
        for ticker, attrs in snap.items():
            line = lines.setdefault(ticker, [])
            cover = next((v for v in line if v[0] <= run_ts < v[1]), None)
            if cover is None:
                line.append([start, end, attrs])
            elif h(cover[2]) != h(attrs):
                line.remove(cover)
                if cover[0] < run_ts:
                    line.append([cover[0], run_ts, cover[2]])
                line.append([run_ts, cover[1], attrs])
    return {(t, *v[2], v[0], v[1]) for t, line in lines.items() for v in line}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.dictionaries(st.sampled_from(["A", "B", "C"]), issuer, max_size=3)),
                min_size=2, max_size=5))
def test_scd2_in_any_order_of_dates(spark, loads):
    runs = [(RUN + dt.timedelta(days=day), snap) for day, snap in loads]
    dim = empty_dimension(spark)
    for run_ts, snap in runs:
        sdf = spark.createDataFrame([(t, "n", s, f) for t, (s, f) in snap.items()],
                                    "ticker string, company_name string, sector string, dividend_policy_active boolean")
        dim = spark.createDataFrame(scd2_merge(dim, sdf, run_ts).collect(), dim.schema)
    rows = dim.collect()
    assert {(r["ticker"], r["sector"], r["dividend_policy_active"], r["valid_from"], r["valid_to"])
            for r in rows} == timeline_model(runs) and len(rows) == len(timeline_model(runs))
    for ticker in {r["ticker"] for r in rows}:
        line = sorted((r["valid_from"], r["valid_to"], r["is_current"]) for r in rows if r["ticker"] == ticker)
        assert all(lo < hi for lo, hi, _ in line)                               # none inverted or empty
        assert all(a[1] == b[0] for a, b in zip(line, line[1:]))                # no overlap, no gap
        assert [c for _, _, c in line] == [False] * (len(line) - 1) + [True]


from lakebars.operators.bars import daily_ohlcv_latest_load  # noqa: E402
from lakebars.operators.candles import typed_candles  # noqa: E402

D = dt.date(2024, 1, 2)
raw_candle = st.tuples(st.sampled_from(["A", "B", "C"]), st.sampled_from([0, 1]),      # load D-1 / D
                       st.sampled_from([0, 1]), st.integers(0, 1439),                  # own day / next day
                       st.integers(1, 99), st.integers(0, 9))


@SETTINGS
@given(st.lists(raw_candle, max_size=25, unique_by=lambda c: (c[0], c[1], c[2], c[3])))
def test_fused_silver_matches_model(spark, rows):
    data = []
    for t, load_back, next_day, minute, price, vol in rows:
        load = D - dt.timedelta(days=1 - load_back)
        begin = dt.datetime.combine(load, dt.time()) + dt.timedelta(days=next_day, minutes=minute)
        data.append((t, str(begin), str(price), str(price), str(price), str(price), str(vol), load))
    df = spark.createDataFrame(data, "ticker string, begin string, open string, close string, high string, "
                                     "low string, volume string, load_date date")
    got = {r["ticker"]: (r["trade_date"], r["open_price"], r["close_price"], r["volume"])
           for r in daily_ohlcv_latest_load(typed_candles(df, keep=("ticker", "load_date"))).collect()}
    model = {}
    for t in {d[0] for d in data}:
        newest = max(d[7] for d in data if d[0] == t)
        own = sorted((d for d in data if d[0] == t and d[7] == newest and d[1][:10] == str(newest)),
                     key=lambda d: d[1])
        if own:
            model[t] = (newest, float(own[0][2]), float(own[-1][3]), sum(int(d[6]) for d in own))
    assert got == model
