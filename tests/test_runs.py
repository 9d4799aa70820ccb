"""Run ledger, gate stops, resumed runs, publication by manifest, repaired marts, joins by bins."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakebars.operators import asof
from lakebars.operators.asof import asof_join, bin_width, versions_by_bin
from lakebars.plans import jobs, smallfiles, tables
from lakebars.plans.jobs import Lakehouse
from lakebars.plans.publication import Publication
from lakebars.schemas import MART
from lakebars.session import child_names, new_run_dir
from tests.test_jobs import D1, D2, land, mart_rows, row, snapshot

D3 = D2 + dt.timedelta(days=1)
DAYS = (D1, D2, D3)


def content(spark, lh, name):
    return sorted((tuple(r) for r in spark.table(lh.t(name)).collect()), key=str)


def states(spark, lh):
    return {(r["process_date"], r["trade_date"]): r["state"] for r in lh.ledger(spark).frame().collect()}


def candle(ticker, day, price="10"):
    return (ticker, day, f"{day} 10:00:00", price, "5")


def prepare(spark, lh, bad=None):
    """Three days of two tickers; the bars of ``bad`` hold a zero price."""
    land(spark, lh, [candle(t, d, "0" if (t, d) == ("B", bad) else "10") for d in DAYS for t in "AB"])
    for d, sector in zip(DAYS, ("one", "two", "three")):
        jobs.land_snapshot(lh, snapshot(spark, [("A", "a", sector, True), ("B", "b", sector, True)]), d)


@pytest.mark.parametrize("bad", DAYS)
def test_a_stopped_run_stops_alone(spark, lakehouse, bad):
    lh = lakehouse
    prepare(spark, lh, bad)
    for d in DAYS:
        before = [content(spark, lh, t) for t in ("dim_issuers", "mart_daily", "serving")]
        out = jobs.daily_run(spark, lh, d, jobs.default_run_ts(d))
        if d == bad:
            assert out["state"] == "STOPPED" and out["gold"]["gate"]["non_positive_close"] == 1
            assert [content(spark, lh, t) for t in ("dim_issuers", "mart_daily", "serving")] == before
        else:
            assert out["state"] == "PUBLISHED" and out["gold"]["gate"]["passed"]
    assert {r["trade_date"] for r in spark.table(lh.t("serving")).collect()} == set(DAYS) - {bad}
    assert spark.table(lh.t("ods_bars")).where("close_price = 0").count() == 1      # visible, not published
    assert states(spark, lh) == {(d, d): "STOPPED" if d == bad else "PUBLISHED" for d in DAYS}
    (stop,) = lh.ledger(spark).frame().where("state = 'STOPPED'").collect()
    assert (stop["staged_rows"], stop["violations"], stop["failed_rules"]) == (2, 2, "non_positive_open,non_positive_close")
    assert lh.ledger(spark).unfinished() == [bad]

    # nothing has changed: it stops again; with the load corrected it is finished, the other days stay as they are
    assert {d: x["state"] for d, x in jobs.resume(spark, lh).items()} == {bad: "STOPPED"}
    served = spark.table(lh.t("serving")).where(F.col("trade_date") != F.lit(bad)).count()
    land(spark, lh, [candle(t, bad) for t in "AB"])
    assert {d: x["state"] for d, x in jobs.resume(spark, lh).items()} == {bad: "PUBLISHED"}
    assert lh.ledger(spark).unfinished() == [] and jobs.resume(spark, lh) == {}
    assert spark.table(lh.t("serving")).count() == 6 and served == 4
    if bad != D2:
        return
    clean = Lakehouse(new_run_dir(spark, "clean"), db=lh.db + "c").ensure(spark)
    prepare(spark, clean)
    for d in [x for x in DAYS if x != bad] + [bad]:
        jobs.daily_run(spark, clean, d, jobs.default_run_ts(d))
    for name in ("mart_daily", "serving"):
        assert content(spark, lh, name) == content(spark, clean, name)


def test_rows_that_fall_back_to_a_stopped_day(spark, lakehouse):
    """B has no load of D2, so its bad D1 bar is staged, and found, by both runs."""
    lh = lakehouse
    land(spark, lh, [candle("A", D1), candle("A", D2), candle("B", D1, "0")])
    jobs.land_snapshot(lh, snapshot(spark, [("A", "a", "s", True), ("B", "b", "s", True)]), D1)
    for d in (D1, D2):
        assert jobs.daily_run(spark, lh, d, jobs.default_run_ts(d))["state"] == "STOPPED"
    found = {(r["process_date"], r["trade_date"]): (r["staged_rows"], r["violations"]) for r in lh.ledger(spark).frame().collect()}
    assert found == {(D1, D1): (2, 2), (D2, D1): (1, 2), (D2, D2): (1, 0)}
    assert spark.table(lh.t("serving")).count() == 0
    out = jobs.daily_run(spark, lh, D2, jobs.default_run_ts(D2), gate_scope="process_date")
    assert out["state"] == "PUBLISHED" and set(out["served"]) == {D1, D2}


@pytest.mark.parametrize("step", ["replace_day", "replace_days", "swap"])
def test_an_interrupted_run_is_finished(spark, lakehouse, monkeypatch, step):
    """The driver is lost while the dimension, the mart or the served days change; late changes are not forgotten."""
    lh = lakehouse
    prepare(spark, lh)
    for d in DAYS:
        jobs.daily_run(spark, lh, d, jobs.default_run_ts(d))
    # a corrected snapshot of D1 changes A from D2 to the version of the run of D2
    jobs.land_snapshot(lh, snapshot(spark, [("A", "a", "fixed", True), ("B", "b", "one", True)]), D1)
    place = Publication if step == "swap" else tables
    real, calls = getattr(place, step), []

    def lost(*args, **kwargs):
        calls.append(args)
        if step == "replace_day" and len(calls) < 2:     # the dimension is half swapped
            return real(*args, **kwargs)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(place, step, lost)
    before = content(spark, lh, "serving")
    with pytest.raises(RuntimeError, match="driver lost"):
        jobs.daily_run(spark, lh, D1, jobs.default_run_ts(D1))
    monkeypatch.setattr(place, step, real)
    assert content(spark, lh, "serving") == before         # readers see nothing of it
    assert lh.ledger(spark).unfinished() == [D1]
    out = jobs.resume(spark, lh)[D1]
    assert out["state"] == "PUBLISHED" and set(out["served"]) == {D1, D2}
    sectors = {(r["ticker"], r["trade_date"]): r["sector"] for r in spark.table(lh.t("serving")).collect()}
    assert sectors == {("A", D1): "one", ("B", D1): "one", ("A", D2): "fixed", ("B", D2): "one", ("A", D3): "two", ("B", D3): "two"}
    assert content(spark, lh, "serving") == content(spark, lh, "mart_daily")
    assert lh.ledger(spark).unfinished() == []


def test_late_changes_repair_their_rows_only(spark, lakehouse, monkeypatch):
    """Six days and four tickers served; one ticker's attributes change on three days: three rows are made anew."""
    lh = lakehouse
    days = [D1 + dt.timedelta(days=k) for k in range(6)]
    names = "ABCD"
    land(spark, lh, [candle(t, d) for d in days for t in names])
    issuers = lambda **own: snapshot(spark, [(t, t, own.get(t, "s"), True) for t in names])
    for k, d in enumerate(days):
        jobs.land_snapshot(lh, issuers(**({"C": "later"} if k >= 4 else {})), d)
        jobs.daily_run(spark, lh, d, jobs.default_run_ts(d))
    jobs.land_snapshot(lh, issuers(C="fixed"), days[1])
    seen, real = {}, tables.merge_into_days

    def watched(spark, table, pairs, rows, days, **kwargs):
        seen["pairs"] = sorted((r["ticker"], r["trade_date"]) for r in pairs.collect())
        return real(spark, table, pairs, rows, days, **kwargs)

    monkeypatch.setattr(tables, "merge_into_days", watched)
    out = jobs.daily_run(spark, lh, days[1], jobs.default_run_ts(days[1]))
    assert seen["pairs"] == [("C", d) for d in days[2:5]] and out["gold"]["repaired"] == days[2:5]
    sectors = {r["trade_date"]: r["sector"] for r in spark.table(lh.t("serving")).where("ticker = 'C'").collect()}
    assert [sectors[d] for d in days] == ["s"] * 2 + ["fixed"] * 3 + ["later"]
    assert spark.table(lh.t("serving")).where("ticker <> 'C' and sector <> 's'").count() == 0
    assert content(spark, lh, "serving") == content(spark, lh, "mart_daily") and spark.table(lh.t("serving")).count() == 24


def test_open_ended_late_change(spark, lakehouse):
    """No later change follows: the corrected version is the current one, and the days after it follow too."""
    lh = lakehouse
    land(spark, lh, [candle("A", d) for d in DAYS])
    for d in DAYS:
        jobs.land_snapshot(lh, snapshot(spark, [("A", "a", "s", True)]), d)
        jobs.daily_run(spark, lh, d, jobs.default_run_ts(d))
    jobs.land_snapshot(lh, snapshot(spark, [("A", "a", "t", True)]), D1)
    out = jobs.daily_run(spark, lh, D1, jobs.default_run_ts(D1))
    assert out["gold"]["rebuilt"] == [D1, D2, D3]
    assert [r["sector"] for r in spark.table(lh.t("serving")).orderBy("trade_date").collect()] == ["s", "t", "t"]


def test_cli_stop_ledger_resume_vacuum(spark, lakehouse, capsys):
    import json

    from lakebars.__main__ import main

    at = ["--root", lakehouse.root, "--db", lakehouse.db, "--profile", "local"]
    told = lambda: [json.loads(x) for x in capsys.readouterr().out.strip().splitlines() if x.startswith("{")]
    land(spark, lakehouse, [candle("A", D2, "0")])
    jobs.land_snapshot(lakehouse, snapshot(spark, [("A", "a", "s", True)]), D2)
    with pytest.raises(SystemExit) as stop:
        main(["daily", str(D2), "A", *at])
    assert stop.value.code == 3 and told()[-1]["state"] == "STOPPED"
    main(["ledger", *at])
    (line,) = told()
    assert (line["process_date"], line["state"], line["violations"]) == (str(D2), "STOPPED", 2)
    land(spark, lakehouse, [candle("A", D2)])
    main(["resume", *at])
    assert told()[-1][str(D2)]["state"] == "PUBLISHED"
    assert spark.table(lakehouse.t("serving")).count() == 1
    main(["vacuum", *at])
    assert told()[-1] == {"deleted": []}


# ------------------------------------------------------------ publication

def jobs_of(spark, call):
    """Number of Spark jobs that ``call`` starts."""
    sc, group = spark.sparkContext, f"count-{os.urandom(4).hex()}"
    sc.setJobGroup(group, "")
    try:
        call()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def served(spark, publication):
    shown = sorted((r["ticker"], r["trade_date"]) for r in publication.read().collect())
    if publication.view:
        assert shown == sorted((r["ticker"], r["trade_date"]) for r in spark.table(publication.view).collect())
    return shown


def test_publication_of_many_days(spark, lakehouse):
    lh = lakehouse
    many = [D1 + dt.timedelta(days=k) for k in range(90)]
    counted = []
    for days in (many[:40], many):              # beyond 32 folders Spark lists them in jobs of its own
        tables.overwrite_partitions(spark, lh.t("mart_daily"), mart_rows(spark, [row("A", d) for d in days]))
        counted.append(jobs_of(spark, lambda days=days: jobs.serve_days(spark, lh, days)))
    assert counted[0] == counted[1] <= 8
    publication = lh.publication(spark)
    assert served(spark, publication) == [("A", d) for d in many]
    assert len({*publication.manifest().values()}) == 1 and len(publication.history()) == 2
    shown = spark.table(lh.t("serving")).inputFiles()          # neither the older version nor other days
    assert shown and all(f"version={publication.current()}" in f for f in shown)
    one = spark.table(lh.t("serving")).where(F.col("trade_date") == F.lit(D2)).inputFiles()
    assert one and all(f"trade_date={D2}" in f for f in one)


@pytest.mark.parametrize("catalog", [True, False])
def test_publication_versions(spark, lakehouse, monkeypatch, catalog):
    names = {"view": f"{lakehouse.db}.pub", "versions": f"{lakehouse.db}.pub_versions"} if catalog else {}
    publication = Publication(spark, os.path.join(lakehouse.root, "pub"), MART, **names).ensure()
    assert served(spark, publication) == [] and publication.publish(mart_rows(spark, []), DAYS) == []
    assert publication.current() is None
    assert publication.publish(mart_rows(spark, [row("A", d) for d in DAYS] + [row("Z", D3 + dt.timedelta(days=1))]), DAYS) == list(DAYS)
    first = publication.current()
    # one day changes, one is withdrawn, one stays; a day without rows may be left alone
    publication.publish(mart_rows(spark, [row("B", D2)]), [D2, D3])
    assert served(spark, publication) == [("A", D1), ("B", D2)]
    publication.publish(mart_rows(spark, [row("C", D2)]), [D1, D2], clear=False)
    assert served(spark, publication) == [("A", D1), ("C", D2)]
    last = publication.current()
    # a writer lost before the swap: readers see the old days, a reader of the new version none of it
    monkeypatch.setattr(smallfiles, "write_json", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        publication.publish(mart_rows(spark, [row("X", D1), row("X", D2)]), [D1, D2])
    monkeypatch.undo()
    assert publication.current() == last and served(spark, publication) == [("A", D1), ("C", D2)]
    # back to an earlier manifest and forth again
    publication.swap(first)
    assert served(spark, publication) == [("A", d) for d in DAYS]
    publication.swap(last)
    gone = publication.vacuum(keep=1)
    assert {d for _, d in gone} == {str(D1), str(D2), str(D3)} and publication.history() == [last]
    assert served(spark, publication) == [("A", D1), ("C", D2)]
    if catalog:                                                # the catalog forgets: the files know
        spark.sql(f"DROP VIEW {publication.view}")
        spark.sql(f"DROP TABLE {publication.versions}")
        assert served(spark, publication.ensure()) == [("A", D1), ("C", D2)]


def test_small_files(spark):
    root = new_run_dir(spark, "small")
    path = os.path.join(root, "a", "b", "x.json")
    assert smallfiles.read_json(spark, path) is None and child_names(spark, root) == []
    for value in ({"é": [1, 2]}, {}, {"k": "x" * 100_000}):
        smallfiles.write_json(spark, path, value)
        assert smallfiles.read_json(spark, path) == value
    assert child_names(spark, os.path.dirname(path)) == ["x.json"]


# ------------------------------------------------------------ joins by bins

def versions(spark, rows):
    return spark.createDataFrame(rows, "ticker string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")


def test_join_by_bins_equals_the_plain_join(spark):
    import random

    rng = random.Random(4)
    first = dt.date(2023, 12, 20)
    at = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(hours=k)
    rows = [("A", "always", dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59)), (None, "n", at(0), at(500))]
    for k in range(150):
        lo = rng.randint(-400, 3000)
        rows.append((rng.choice("ABC"), f"v{k}", at(lo), at(lo + rng.choice([0, 5, 24, 30, 300, 2000]))))
    facts = spark.createDataFrame([(rng.choice(["A", "B", "C", "D", None]), first + dt.timedelta(days=rng.randint(0, 150)), k)
                                   for k in range(400)], "ticker string, trade_date date, n int")
    key = lambda df: sorted(map(tuple, df.select("n", "name").collect()))
    want = key(asof_join(facts, versions(spark, rows)))
    assert len(want) > 400
    for bins in (256, 40, 7, 1):
        got = asof_join(facts, versions(spark, rows), between=(first, first + dt.timedelta(days=150)), bins=bins)
        assert got.columns == asof_join(facts, versions(spark, rows)).columns and key(got) == want


def test_join_by_bins_meets_few_versions(spark):
    """One ticker with a version a day for four years: a fact meets the versions of its bin, not all 1,461."""
    start = dt.date(2020, 1, 1)
    days = 1461
    dim = spark.range(days).selectExpr(
        "'HOT' AS ticker", "concat('v', id) AS name", f"timestamp_ntz'{start}' + make_dt_interval(CAST(id AS INT)) AS valid_from",
        f"timestamp_ntz'{start}' + make_dt_interval(CAST(id + 1 AS INT)) AS valid_to")
    facts = spark.range(days).selectExpr("'HOT' AS ticker", f"date_add(DATE'{start}', CAST(id AS INT)) AS trade_date")
    between = (start, start + dt.timedelta(days=days - 1))
    width = bin_width(*between)
    assert width == 6
    binned = versions_by_bin(dim, between)
    met = facts.withColumn("_b", F.floor(F.datediff("trade_date", F.lit(start)) / width)).join(
        binned, (F.col("ticker") == F.col("_dim_key")) & (F.col("_b") == F.col("_bin")))
    out = asof_join(facts, dim, between=between)
    assert out.count() == days and met.count() <= width * days          # all pairs: 1,461 times as many
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_bin" in plan
    # two days of a daily run: nothing but the versions of those days
    assert versions_by_bin(dim, (start, start + dt.timedelta(days=1))).count() == 2
    assert asof.bin_width(start, start) == 1


# ------------------------------------------------------------ loads and their manifest

def loaded(spark, lh, process_date=D2, lookback=1):
    from lakebars.sources.files import latest_loads, read_loads

    loads = latest_loads(spark, lh.bronze_candles, lh.bronze_loads, process_date, lookback)
    return loads, read_loads(spark, lh.bronze_candles, loads)


def test_manifest_chooses_loads_before_the_scan(spark, lakehouse, monkeypatch):
    """Of the older date only the bucket of the ticker that falls back is read, of a date without any none."""
    from lakebars.sources import files

    monkeypatch.setattr(files.write_candle_loads, "__defaults__", (2,))        # two rows a bucket
    lh, names = lakehouse, [f"T{k}" for k in range(12)]
    land(spark, lh, [candle(t, d) for d in (D1, D2) for t in names if not (t == "T3" and d == D2)])
    loads, raw = loaded(spark, lh)
    assert {(r["ticker"], r["load_date"]) for r in loads.collect()} == {(t, D1 if t == "T3" else D2) for t in names}
    of = {r["ticker"]: r["bucket"] for r in files.read_manifest(spark, lh.bronze_loads, [D1]).collect()}
    read = [f for f in raw.inputFiles() if "/candles/" in f]
    assert len({f.rsplit("/", 2)[-2] for f in read if f"load_date={D2}" in f}) > 2
    assert {f.rsplit("/", 2)[-2] for f in read if f"load_date={D1}" in f} == {f"bucket={of['T3']}"}
    assert sorted((r["ticker"], r["load_date"]) for r in raw.collect()) == sorted((t, D1 if t == "T3" else D2) for t in names)
    land(spark, lh, [candle(t, D2) for t in names])             # complete now: the older date is not touched
    assert not any("/candles/" in f and f"load_date={D1}" in f for f in loaded(spark, lh)[1].inputFiles())
    # landed again with two tickers: nothing of the earlier load is left, in the manifest or in the folders
    land(spark, lh, [candle(t, D2, "20") for t in names[:2]])
    assert len(child_names(spark, f"{lh.bronze_candles}/load_date={D2}")) <= 2
    raw = loaded(spark, lh)[1]
    assert {r["open"] for r in raw.where(F.col("load_date") == F.lit(D2)).collect()} == {"20"} and raw.count() == 12
    assert loaded(spark, lh, D3, 0)[1].count() == 0             # no load in the window


def test_silver_with_and_without_a_manifest(spark, lakehouse):
    from lakebars.session import delete_folder

    lh = lakehouse
    land(spark, lh, [candle("A", D2), candle("A", D2), candle("A", D1, "9"), candle("B", D1, "20"),
                     ("B", D1, f"{D2} 00:00:00", "99", "9"), ("C", D2, f"{D1} 10:00:00", "7", "1"), candle("C", D1, "6")])
    bars = lambda tickers=None: sorted(map(tuple, jobs.silver_bars(spark, lh, D2, tickers).collect()))
    want, some = bars(), bars("A,C")
    assert [(r[0], r[-1], r[5]) for r in want] == [(D1, "B", 5), (D2, "A", 5)]     # C's newest load has no candle of its day
    assert [r[-1] for r in some] == ["A"]
    delete_folder(spark, lh.bronze_loads)
    assert (bars(), bars("A,C")) == (want, some)


def test_landing_nothing_replaces_nothing(spark, lakehouse):
    land(spark, lakehouse, [candle("A", D1)])
    empty = spark.createDataFrame([], "ticker string, load_date date, record string")
    assert jobs.land_candle_records(lakehouse, empty).status == "SKIPPED"
    assert loaded(spark, lakehouse)[1].count() == 1


# ------------------------------------------------------------ the page source

def test_page_source_of_a_long_chain(spark):
    """A chain of 700 pages beside short ones: every page is one row, no answer opens more than a block."""
    from lakebars.plans import bindings as B
    from lakebars.sources.paged import read_pages, uri

    rows = [("HOT", D1, 2 * k, '{"candles":{"data":[[1],[2]]}}') for k in range(700)]
    rows += [(f"T/{k} é", D1, 0, '{"candles":{"data":[[1],[2]]}}') for k in range(5)]
    root = new_run_dir(spark, "store")
    pages = spark.createDataFrame(rows, "ticker string, trade_date date, start long, page string")
    requests = B.write_page_store(pages, root, page_size=2)
    fetch = B.page_server(uri(spark, root), page_size=2)
    got = read_pages(requests, fetch, parallelism=3)
    assert got.count() == 705 and got.where("ticker = 'HOT'").select("request_start").distinct().count() == 700
    folder = os.path.join(root, f"key={B.page_key('HOT', D1)}")
    assert len([n for n in child_names(spark, folder) if n.startswith("block=")]) == -(-700 // B.BLOCK_PAGES)
    assert fetch({"ticker": "HOT", "date": str(D1), "start": 1398}) == rows[699][3] and fetch({"ticker": "HOT", "date": str(D1), "start": 1400}) == B.EMPTY_PAGE
    assert fetch({"ticker": "NONE", "date": str(D1)}) == B.EMPTY_PAGE
    assert read_pages(requests.where("false"), fetch).count() == 0


def test_page_source_by_options_and_pushed_filters(spark):
    """Requests as an option; with the session's leave, filters leave out requests before they are made."""
    import json

    from lakebars.sources.paged import register_page_source

    requests = json.dumps([{"ticker": t, "load_date": str(d), "params": {"n": 1}} for t in "ABC" for d in (D1, D2)])

    def source():
        log = new_run_dir(spark, "log")
        os.makedirs(log)

        def fetch(params):
            open(os.path.join(log, f"{params['ticker']}-{params['date']}-{params.get('n')}"), "a").close()
            return {"candles": {"data": [] if params.get("start") else [[1]]}}

        name = register_page_source(spark, "test_pages", fetch)
        return spark.read.format(name).option("requests", requests).option("partitions", 2).load(), log

    pages, log = source()
    assert pages.rdd.getNumPartitions() == 2 and pages.count() == 6 and len(os.listdir(log)) == 6
    key = "spark.sql.python.filterPushdown.enabled"
    spark.conf.set(key, "true")
    try:
        pages, log = source()
        found = pages.where(F.col("ticker").isin("A", "B") & (F.col("load_date") == F.lit(D2)))
        assert sorted(r["ticker"] for r in found.collect()) == ["A", "B"]
        assert sorted(os.listdir(log)) == [f"A-{D2}-1", f"B-{D2}-1"]
        assert pages.where("page IS NULL AND ticker = 'C'").count() == 0
    finally:
        spark.conf.unset(key)
