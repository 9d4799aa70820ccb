"""The four daily jobs (L1-L4), each re-runnable for any process date.

Everything lives under one root folder (on a cluster: a shared store):

    bronze/candles/load_date=/bucket=   raw JSONL           (L1 writes, L2 reads)
    bronze/candle_loads/load_date=      manifest of the loads (L1 writes, L2 chooses by it)
    bronze/issuers/load_date=           issuer snapshots    (L1 writes, L2 reads)
    tables/<db>/...                     staging, ODS, dimension, mart, buffer
    export/mart/trade_date=             one Parquet folder per published day
    publication/                        the served days by version, their manifests, the pointer (view ``serving``)
    ledger/process_date=                the state of every run
"""

from __future__ import annotations

import datetime as dt
import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from lakebars.functions.params import as_date, as_datetime, parse_ticker_list, previous_dates
from lakebars.operators.asof import mart_frame
from lakebars.operators.bars import daily_ohlcv, daily_ohlcv_latest_load, distinct_candles
from lakebars.operators.candles import typed_candles
from lakebars.operators.pages import page_records
from lakebars.operators.quality import (BAR_RULES, LOST_PRICES, GateStopped, combine_counts, dq_summary, gate_metrics,
                                        gate_verdict)
from lakebars.plans import ledger as runs
from lakebars.plans import sinks, tables
from lakebars.plans.ledger import Entry, RunLedger
from lakebars.plans.publication import Publication
from lakebars.schemas import DIMENSION, ISSUER, MART, ODS_BAR, PRICE, STAGED_BAR
from lakebars.session import delete_folder, discard, materialize, new_run_dir
from lakebars.sources.files import (latest_loads, read_loads, read_parquet, read_raw_candles, read_snapshot,
                                    write_candle_loads)
from lakebars.sources.paged import read_pages
from lakebars.sources.seed import universe_frame

STAGED_TABLE = StructType([f for f in STAGED_BAR.fields if f.name != "trade_date"]
                          + [StructField("trade_date", DateType())])
DIM_TABLE = StructType(DIMENSION.fields + [StructField("version_end", DateType())])


@dataclass
class Lakehouse:
    """Paths and table names of one deployment (``db`` namespaces the tables).

    With ``ods_buckets`` the operational table is made in that many buckets
    of the ticker; its upserts then move the batch only (for days too large
    to shuffle; a day has a file for each bucket).
    """
    root: str
    db: str = "lakebars"
    ods_buckets: int | None = None
    created: bool = field(default=False, repr=False)

    @property
    def bronze_candles(self) -> str:
        return os.path.join(self.root, "bronze", "candles")

    @property
    def bronze_loads(self) -> str:
        return os.path.join(self.root, "bronze", "candle_loads")

    @property
    def bronze_issuers(self) -> str:
        return os.path.join(self.root, "bronze", "issuers")

    @property
    def export_root(self) -> str:
        return os.path.join(self.root, "export", "mart")

    def export_path(self, day) -> str:
        return os.path.join(self.export_root, f"trade_date={as_date(day)}")

    def t(self, name: str) -> str:
        return f"{self.db}.{name}"

    def ledger(self, spark: SparkSession) -> RunLedger:
        return RunLedger(spark, os.path.join(self.root, "ledger"))

    def publication(self, spark: SparkSession) -> Publication:
        """The served days; the view ``serving`` shows those in force."""
        return Publication(spark, os.path.join(self.root, "publication"), MART, view=self.t("serving"),
                           versions=self.t("serving_versions"))

    def ensure(self, spark: SparkSession) -> "Lakehouse":
        """D8 for every table; idempotent."""
        if self.created:
            return self
        base = os.path.join(self.root, "tables")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.db} LOCATION '{base}'")
        specs = [
            ("stg_bars", STAGED_TABLE, ("trade_date",)),
            ("stg_issuers", ISSUER, ()),
            ("ods_bars", ODS_BAR, ("trade_date",)),
            ("dim_issuers", DIM_TABLE, ("version_end",)),
            ("mart_daily", MART, ("trade_date",)),
            ("serving_buffer", MART, ("trade_date",)),
        ]
        for name, schema, parts in specs:
            buckets = ("ticker", self.ods_buckets) if self.ods_buckets and name == "ods_bars" else None
            tables.create_table(spark, self.t(name), schema, None, parts, buckets)
        self.publication(spark).ensure()
        self.created = True
        return self


# ---------------------------------------------------------------- L1 bronze

def land_snapshot(lh: Lakehouse, snapshot: DataFrame, load_date) -> sinks.WriteResult:
    """Reference snapshot -> Parquet under load_date=D (skipped when empty)."""
    path = os.path.join(lh.bronze_issuers, f"load_date={as_date(load_date)}")
    return sinks.skip_if_empty(snapshot.select(*[f.name for f in ISSUER.fields]), path)


def tagged_record(ticker="ticker", record="record"):
    """The API record text with the requesting ticker spliced in as its first
    field; the record's own text (number tokens included) is kept verbatim."""
    name = F.regexp_extract(F.to_json(F.array(F.col(ticker))), r"^\[(.*)\]$", 1)
    rest = F.when(F.trim(F.col(record)) == "{}", F.lit("}")).otherwise(
        F.concat(F.lit(","), F.expr(f"substring(ltrim({record}), 2)")))
    return F.concat(F.lit('{"ticker":'), name, rest)


def land_candle_records(lh: Lakehouse, records: DataFrame) -> sinks.WriteResult:
    """(ticker, load_date, record JSON text) -> JSONL and the manifest of its loads.

    The load dates present in ``records`` are replaced whole, so no records
    replace nothing; the records are computed once.
    """
    out = records.select("ticker", F.col("load_date").cast("date").alias("load_date"), tagged_record().alias("line"))
    rows = write_candle_loads(out, lh.bronze_candles, lh.bronze_loads)
    return sinks.WriteResult("WRITTEN" if rows else "SKIPPED", rows, lh.bronze_candles)


def ingest_requests(spark: SparkSession, requests: DataFrame, lh: Lakehouse, fetch, advance=None,
                    **options) -> sinks.WriteResult:
    """Every request's page chain -> JSONL; each page is fetched once."""
    folder = new_run_dir(spark, "requests")
    pages = read_pages(requests, fetch, advance, path=folder, **options)
    result = land_candle_records(lh, page_records(pages, keep=("ticker", "load_date")))
    delete_folder(spark, folder)
    return result


def bronze_ingest(spark: SparkSession, lh: Lakehouse, load_date, tickers, fetch, advance=None,
                  snapshot: DataFrame | None = None, params: dict[str, dict] | None = None,
                  common: dict | None = None) -> dict:
    """L1: snapshot -> Parquet, then every ticker's page chain -> JSONL.

    ``common`` are request parameters for all tickers, ``params`` for single
    ones; a day's request covers that day (``from`` and ``till``) unless
    they say otherwise.  Wrap ``fetch`` in ``paged.with_retry`` for a real API.
    """
    result = {}
    if snapshot is not None:
        result["issuers"] = land_snapshot(lh, snapshot, load_date)
    day = as_date(load_date)
    rows = [(t, day, json.dumps({"from": str(day), "till": str(day), **(common or {}), **(params or {}).get(t, {})}))
            for t in parse_ticker_list(tickers)]
    requests = spark.createDataFrame(rows, "ticker string, load_date date, params string")
    result["candles"] = ingest_requests(spark, requests, lh, fetch, advance)
    return result


# ---------------------------------------------------------------- L2 silver

def silver_bars(spark: SparkSession, lh: Lakehouse, process_date, tickers=None,
                lookback_days: int = 1) -> DataFrame:
    """S1 + S2 + P1/P2 + A5 + F1 + A4: the staged bars of one run.

    The manifest names each ticker's newest load of the window; all tickers
    are read in one scan of the folders that hold those.  Repeated candles of
    a load count once.
    """
    names = parse_ticker_list(tickers)
    universe = universe_frame(spark, names) if names else None
    loads = latest_loads(spark, lh.bronze_candles, lh.bronze_loads, process_date, lookback_days)
    if loads is not None:
        if universe is not None:
            loads = loads.join(universe, "ticker", "left_semi")
        chosen = typed_candles(read_loads(spark, lh.bronze_candles, loads), keep=("ticker", "load_date"))
        return daily_ohlcv(distinct_candles(chosen.where(F.col("trade_date") == F.col("load_date"))))
    # loads without a manifest: the newest is found among the candles themselves
    window = previous_dates(process_date, lookback_days)
    raw = read_raw_candles(spark, lh.bronze_candles, window)
    if universe is not None:
        raw = raw.join(universe, "ticker", "left_semi")
    raw = raw.where(F.col("load_date").isin(window))
    return daily_ohlcv_latest_load(distinct_candles(typed_candles(raw, keep=("ticker", "load_date"))))


def silver(spark: SparkSession, lh: Lakehouse, process_date, tickers=None,
           lookback_days: int = 1) -> dict:
    """L2: snapshot -> stg_issuers (replaced); bars -> stg_bars (replaced per batch).

    The staging table holds exactly the batch of this run, so gold promotes
    every trade date the batch contains (fallback dates included).
    """
    lh.ensure(spark)
    snapshot, snap_date = read_snapshot(spark, lh.bronze_issuers, process_date, lookback_days)
    snapshot.write.insertInto(lh.t("stg_issuers"), overwrite=True)
    bars = silver_bars(spark, lh, process_date, tickers, lookback_days)
    # The staging table holds exactly this batch: an empty batch empties it
    # (like the day clear that precedes every load) and reports SKIPPED.
    obs = Observation("staged")
    rows_of = bars.select(*[f.name for f in STAGED_TABLE.fields]).observe(
        obs, F.count(F.lit(1)).alias("rows"), F.collect_set("trade_date").alias("days"))
    rows_of.write.insertInto(lh.t("stg_bars"), overwrite=True)
    rows = int(obs.get["rows"])
    status = sinks.WriteResult("WRITTEN" if rows else "SKIPPED", rows, lh.t("stg_bars"))
    return {"snapshot_date": snap_date, "bars": status, "days": sorted(obs.get["days"] or [])}


# ---------------------------------------------------------------- L3 gold

def _found_by_day(ods: DataFrame, staged: DataFrame, lost, days) -> dict:
    """``{day: (violations, rules)}`` of the days that the gate looked at; asked only when it stops a run."""
    found: dict = {}
    for r in dq_summary(ods.where(F.col("trade_date").isin(days))).collect():
        found[r["trade_date"]] = {name: r[name] for name in BAR_RULES}
    for r in staged.where(F.col("trade_date").isin(days)).groupBy("trade_date").agg(lost).collect():
        found.setdefault(r["trade_date"], {})[LOST_PRICES] = r[LOST_PRICES]
    return {day: (sum(n.values()), ",".join(name for name, k in n.items() if k)) for day, n in found.items()}


def gold(spark: SparkSession, lh: Lakehouse, process_date, run_ts, strict: bool = True,
         gate_scope: str = "touched", ledger: RunLedger | None = None) -> dict:
    """L3: upsert ODS (D2) -> quality gate (Q1) -> SCD2 dimension (D3) -> mart days.

    ``gate_scope="touched"`` checks every ODS day the run wrote (the process
    date and any fallback day); ``"process_date"`` checks the process date
    only, as the original flow does.  A gate that fails raises
    :class:`GateStopped`: the upsert stays, dimension and mart are untouched.

    The mart days of the run are rebuilt whole.  A run whose snapshot changes
    attributes of days that later runs have built already changes the mart
    rows of those tickers and days, and no others.  ``ledger`` is told of
    every step; days that an interrupted attempt left in it are rebuilt too.
    """
    if gate_scope not in ("touched", "process_date"):
        raise ValueError(f"unknown gate_scope={gate_scope!r}")
    lh.ensure(spark)
    d = as_date(process_date)
    pending = ledger.pending(d) if ledger else []
    staged = spark.table(lh.t("stg_bars"))
    priced = {c: F.col(c).try_cast(PRICE) for c in ("open_price", "close_price", "high_price", "low_price")}
    source = staged.select("ticker", *[x.alias(c) for c, x in priced.items()], "volume",
                           F.lit(None).cast("timestamp_ntz").alias("load_dt"), "trade_date")
    # The gate runs after the upsert, over every day it touched (plus D): its
    # counts are observed while the merged partitions are written, so only an
    # untouched process date needs a query of its own.
    scope = None if gate_scope == "touched" else F.col("trade_date") == F.lit(d)
    lost = [F.col(c).isNotNull() & x.isNull() for c, x in priced.items()]
    lost = F.count_if(lost[0] | lost[1] | lost[2] | lost[3]).alias(LOST_PRICES)
    lost_counts = staged.where(scope if scope is not None else F.lit(True)).agg(lost).first().asDict()
    staged_rows: dict = {}
    dates, counts = tables.upsert_into(
        spark, lh.t("ods_bars"), source, ["ticker", "trade_date"],
        ["open_price", "close_price", "high_price", "low_price", "volume"], run_ts,
        observe=gate_metrics(where=scope), rows_by_date=staged_rows)
    own = sorted(set(dates) | {d})

    def note(state: str, days, found: dict | None = None, left=()) -> None:
        if ledger:
            entries = [Entry(x, state, staged_rows.get(x, 0), *(found or {}).get(x, (0, ""))) for x in days]
            ledger.record(d, run_ts, entries + [Entry(x, runs.MERGING) for x in left if x not in days])

    ods = spark.table(lh.t("ods_bars"))
    if d not in dates:
        counts = combine_counts(counts, ods.where(F.col("trade_date") == F.lit(d))
                                .agg(*gate_metrics()).first().asDict())
    try:
        gate = gate_verdict(combine_counts(counts, lost_counts))
    except GateStopped:
        if ledger:
            note(runs.STOPPED, own, _found_by_day(ods, staged, lost, own if scope is None else [d]), pending)
        raise
    note(runs.UPSERTED, own, left=pending)
    whole = sorted({*own, *pending})
    repair: dict = {"days": [], "pairs": None}

    def before_swap(_, changes: DataFrame) -> None:
        # facts of later days whose attributes change; there are none unless later runs came first
        later = ods.where((F.col("trade_date") >= F.to_date(F.lit(as_datetime(run_ts)))) & ~F.col("trade_date").isin(whole))
        if later.inputFiles():                 # from the listing of partitions, no job
            hit = later.join(changes, "ticker").where((F.col("trade_date") >= F.col("from_date"))
                                                      & (F.col("trade_date") < F.col("to_date")))
            repair["pairs"], seen = materialize(hit.select(*ods.columns).dropDuplicates(["ticker", "trade_date"]), "repair",
                                                observe=[F.collect_set("trade_date").alias("days")])
            repair["days"] = sorted(seen["days"] or [])
        note(runs.MERGING, sorted({*whole, *repair["days"]}))

    dim_stats = tables.scd2_publish(spark, lh.t("dim_issuers"), spark.table(lh.t("stg_issuers")),
                                    run_ts, strict=strict, before_swap=before_swap)
    days = sorted({*whole, *repair["days"]})
    # only versions that end after the first day can cover one of the days
    dim = spark.table(lh.t("dim_issuers")).where(F.col("version_end") > F.lit(days[0])).drop("version_end")
    between = (days[0], days[-1])
    built = tables.replace_days(spark, lh.t("mart_daily"), mart_frame(
        ods.where(F.col("trade_date").isin(whole)), dim, between), whole)
    if repair["pairs"] is not None:
        if repair["days"]:
            built = sorted({*built, *tables.merge_into_days(
                spark, lh.t("mart_daily"), repair["pairs"], mart_frame(repair["pairs"], dim, between), repair["days"])})
        discard(repair["pairs"])
    note(runs.BUILT, days)
    return {"ods_dates": dates, "gate": gate, "dimension": dim_stats, "mart_days": built, "rebuilt": days,
            "repaired": repair["days"], "staged_rows": staged_rows}


# ---------------------------------------------------------------- L4 serving

FEW_DAYS = 32     # days whose rows are counted while they are exported; more are counted by a job of their own


def serve_days(spark: SparkSession, lh: Lakehouse, days, clear=()) -> dict:
    """L4 for any number of days: mart -> Parquet export -> buffer -> one swap; ``{day: WriteResult}``.

    The number of Spark jobs does not depend on the number of days, and
    readers of ``serving`` see all of the days change or none.  A day without
    mart rows is skipped: its served rows stay, unless it is one of
    ``clear`` (days that were rebuilt); then it is withdrawn in the same swap.
    """
    lh.ensure(spark)
    days, clear = sorted({as_date(d) for d in days}), {as_date(d) for d in clear}
    seen = Observation("exported")
    few = days if len(days) <= FEW_DAYS else []
    rows = spark.table(lh.t("mart_daily")).where(F.col("trade_date").isin(days)).observe(
        seen, F.collect_set("trade_date").alias("days"), *[F.count_if(F.col("trade_date") == F.lit(d)).alias(str(d)) for d in few])
    sinks.write_parquet(rows, lh.export_root, partition_by=["trade_date"], dynamic=True)
    present = sorted(seen.get["days"] or [])
    counts = {d: seen.get[str(d)] for d in few if d in present}
    tables.truncate(spark, lh.t("serving_buffer"))
    if present:
        exported = read_parquet(spark, lh.export_root, MART).where(F.col("trade_date").isin(present))
        if not few:
            counts = {r["trade_date"]: r["count"] for r in exported.groupBy("trade_date").count().collect()}
        sinks.insert_by_position(exported.select(*[f.name for f in MART.fields]), lh.t("serving_buffer"))
    withdrawn = [d for d in days if d not in present and d in clear]
    if present or withdrawn:
        lh.publication(spark).publish(spark.table(lh.t("serving_buffer")), present + withdrawn)
    return {d: sinks.WriteResult("WRITTEN" if d in counts else "SKIPPED", counts.get(d, 0), lh.export_path(d)) for d in days}


def serving(spark: SparkSession, lh: Lakehouse, process_date, clear_empty: bool = False) -> sinks.WriteResult:
    """L4 for one day; an empty day is skipped, or with ``clear_empty`` withdrawn."""
    d = as_date(process_date)
    return serve_days(spark, lh, [d], [d] if clear_empty else [])[d]


def _publish_run(spark: SparkSession, lh: Lakehouse, ledger: RunLedger, d, run_ts, days, clear, staged_rows: dict) -> dict:
    served = serve_days(spark, lh, days, clear)
    ledger.record(d, run_ts, [Entry(x, runs.PUBLISHED if r.status == "WRITTEN" else runs.EMPTY, staged_rows.get(x, 0))
                              for x, r in served.items()])
    return served


def daily_run(spark: SparkSession, lh: Lakehouse, process_date, run_ts, tickers=None,
              lookback_days: int = 1, strict: bool = True, gate_scope: str = "touched") -> dict:
    """L2 -> L3 -> L4 for one process date; every day that gold rebuilt is served, in one swap.

    ``serving`` is the process date's result, ``served`` that of every day,
    ``state`` the run's outcome.  A run that the quality gate stops ends
    there (``STOPPED``, with the gate's counts): dimension, mart and serving
    stay as they were, and other runs are not affected.  The ledger has every
    step; the same call again starts over and finishes what is left.
    """
    lh.ensure(spark)
    d, ledger = as_date(process_date), lh.ledger(spark)
    pending = ledger.pending(d)
    out: dict = {"silver": silver(spark, lh, d, tickers, lookback_days)}
    staged = sorted({d, *out["silver"]["days"]})
    ledger.record(d, run_ts, [Entry(x, runs.MERGING if x in pending else runs.STAGED) for x in sorted({*staged, *pending})])
    try:
        out["gold"] = gold(spark, lh, d, run_ts, strict, gate_scope, ledger)
    except GateStopped as stop:
        out |= {"gold": {"gate": {**stop.counts, "passed": False}}, "served": {}, "state": runs.STOPPED,
                "serving": sinks.WriteResult(runs.STOPPED, 0, lh.export_path(d))}
        return out
    # a process date without a batch leaves what is served alone, as an empty export does
    clear = [x for x in out["gold"]["rebuilt"] if x != d or d in out["gold"]["ods_dates"]]
    out["served"] = _publish_run(spark, lh, ledger, d, run_ts, out["gold"]["rebuilt"], clear, out["gold"]["staged_rows"])
    out["serving"], out["state"] = out["served"][d], runs.PUBLISHED
    return out


def resume(spark: SparkSession, lh: Lakehouse, **params) -> dict:
    """Finish every unfinished run of the ledger, oldest first: ``{process date: result}``.

    A run whose mart is built is only served.  Any other starts over with its
    own run time: an interrupted one finds what it had done, a stopped one
    looks at the data that are there now.
    """
    lh.ensure(spark)
    ledger, out = lh.ledger(spark), {}
    for d in ledger.unfinished():
        entries, run_ts = ledger.entries(d), ledger.run_ts(d)
        if all(e.state in (runs.BUILT, runs.PUBLISHED, runs.EMPTY) for e in entries):
            rows = {e.trade_date: e.staged_rows for e in entries}
            clear = [x for x, n in rows.items() if x != d or n]
            served = _publish_run(spark, lh, ledger, d, run_ts, list(rows), clear, rows)
            out[d] = {"served": served, "serving": served.get(d), "state": runs.PUBLISHED}
        else:
            out[d] = daily_run(spark, lh, d, run_ts, **params)
    return out


def default_run_ts(process_date) -> dt.datetime:
    """The reference stamps versions with the wall clock of a run that starts
    the day after the process date; explicit and reproducible here."""
    return as_datetime(as_date(process_date) + dt.timedelta(days=1))
