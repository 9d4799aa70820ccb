"""Command line for the daily jobs.

    python -m lakebars bronze  <process_date> <tickers> --root R --fetch module:callable [--params JSON]
                               [--issuers parquet path]
    python -m lakebars silver  <process_date> [tickers] --root R [--lookback 1]
    python -m lakebars gold    <process_date> --root R [--run-ts TS]
    python -m lakebars serving <process_date> --root R
    python -m lakebars daily   <process_date> [tickers] --root R [--run-ts TS]
    python -m lakebars resume  --root R           every unfinished run of the ledger
    python -m lakebars ledger  --root R           the state of every run, one JSON line a day
    python -m lakebars vacuum  --root R [--keep 2]  served versions that no kept manifest names

A run that the quality gate stops ends with exit code 3.
``--fetch`` names a callable that takes the request parameters and returns a
page; it is tried again after failures that may pass.  ``--params`` is a
JSON object of request parameters for all tickers.

``tickers`` is a comma list ("A,B,C"); empty means every landed ticker.
The shared work folder is taken from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import importlib
import json

from lakebars.functions.params import as_datetime
from lakebars.plans import jobs
from lakebars.session import build_session
from lakebars.sources.paged import with_retry


STOPPED_CODE = 3


def _plain(value):
    """The value with text keys, for JSON."""
    return {str(k): _plain(v) for k, v in value.items()} if isinstance(value, dict) else value


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="lakebars")
    p.add_argument("step", choices=["bronze", "silver", "gold", "serving", "daily", "resume", "ledger", "vacuum"])
    p.add_argument("process_date", nargs="?")
    p.add_argument("tickers", nargs="?", default="")
    p.add_argument("--root", required=True)
    p.add_argument("--db", default="lakebars")
    p.add_argument("--lookback", type=int, default=1)
    p.add_argument("--run-ts", default=None)
    p.add_argument("--loose", action="store_true", help="SCD2 without key checks")
    p.add_argument("--profile", default="cluster", choices=["cluster", "local"])
    p.add_argument("--gate-scope", default="touched", choices=["touched", "process_date"])
    p.add_argument("--fetch", help="module:callable of the API client (bronze)")
    p.add_argument("--params", default="{}", help="request parameters as a JSON object (bronze)")
    p.add_argument("--issuers", help="Parquet path of the issuer snapshot (bronze)")
    p.add_argument("--ods-buckets", type=int, help="make a new operational table in so many buckets of the ticker")
    p.add_argument("--keep", type=int, default=2, help="newest manifests that stay readable (vacuum)")
    a = p.parse_args(argv)
    if a.step not in ("resume", "ledger", "vacuum") and not a.process_date:
        p.error(f"{a.step} needs a process date")
    if a.step == "bronze" and not a.fetch:
        p.error("bronze needs --fetch module:callable")
    spark = build_session(app_name=f"lakebars-{a.step}", profile=a.profile)
    lh = jobs.Lakehouse(a.root, db=a.db, ods_buckets=a.ods_buckets)
    run_ts = as_datetime(a.run_ts) if a.run_ts else a.process_date and jobs.default_run_ts(a.process_date)
    if a.step == "bronze":
        module, _, name = a.fetch.partition(":")
        fetch = with_retry(getattr(importlib.import_module(module), name))
        snapshot = spark.read.parquet(a.issuers) if a.issuers else None
        out = jobs.bronze_ingest(spark, lh, a.process_date, a.tickers, fetch, snapshot=snapshot,
                                 common=json.loads(a.params))
    elif a.step == "silver":
        out = jobs.silver(spark, lh, a.process_date, a.tickers or None, a.lookback)
    elif a.step == "gold":
        out = jobs.gold(spark, lh, a.process_date, run_ts, strict=not a.loose, gate_scope=a.gate_scope)
    elif a.step == "serving":
        out = jobs.serving(spark, lh, a.process_date)
    elif a.step == "resume":
        out = jobs.resume(spark, lh, lookback_days=a.lookback, strict=not a.loose, gate_scope=a.gate_scope)
    elif a.step == "ledger":
        for line in lh.ledger(spark).frame().orderBy("process_date", "trade_date").toJSON().toLocalIterator():
            print(line)
        return
    elif a.step == "vacuum":
        out = {"deleted": lh.ensure(spark).publication(spark).vacuum(a.keep)}
    else:
        out = jobs.daily_run(spark, lh, a.process_date, run_ts, a.tickers or None, a.lookback,
                             strict=not a.loose, gate_scope=a.gate_scope)
    print(json.dumps(_plain(out), default=str))
    if out.get("state") == "STOPPED" or any(isinstance(x, dict) and x.get("state") == "STOPPED" for x in out.values()):
        raise SystemExit(STOPPED_CODE)


if __name__ == "__main__":
    main()
