"""The run ledger: how far each run got, and with what outcome, for every day it touched (L2-L4, Q1).

One small file per run (process date), one JSON line per trade date.  A
run's file is replaced whole at each step, after the step it names is done,
except ``MERGING``: that is written before the dimension changes, with all
days whose marts follow from the change, since the change is not found
again once it is made.

    STAGED -> UPSERTED -> MERGING -> BUILT -> PUBLISHED | EMPTY
                       -> STOPPED (by the quality gate)

A stopped run leaves dimension, mart and serving as they were; other runs go
on.  :func:`unfinished` lists what is left to do, oldest run first.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from lakebars.functions.params import as_date, as_datetime
from lakebars.plans import smallfiles
from lakebars.session import child_names

STAGED, UPSERTED, MERGING, BUILT, PUBLISHED, EMPTY, STOPPED = (
    "STAGED", "UPSERTED", "MERGING", "BUILT", "PUBLISHED", "EMPTY", "STOPPED")
FINAL = frozenset({PUBLISHED, EMPTY})
FILE = "run.json"

LEDGER_SCHEMA = ("trade_date date, run_ts timestamp_ntz, state string, staged_rows bigint, violations bigint, "
                 "failed_rules string, process_date date")


@dataclass
class Entry:
    """One day of a run.  ``violations`` and ``failed_rules`` say what the gate found in that day."""
    trade_date: dt.date
    state: str
    staged_rows: int = 0
    violations: int = 0
    failed_rules: str = ""


class RunLedger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _file(self, process_date) -> str:
        return os.path.join(self.root, f"process_date={as_date(process_date)}", FILE)

    def record(self, process_date, run_ts, entries: list[Entry]) -> None:
        """The run's state becomes ``entries`` (one day each; a batch and its gate touch few days)."""
        lines = [json.dumps({**asdict(e), "trade_date": str(e.trade_date), "run_ts": as_datetime(run_ts).isoformat(sep=" ")},
                            sort_keys=True) for e in sorted(entries, key=lambda e: e.trade_date)]
        smallfiles.write_text(self.spark, self._file(process_date), "\n".join(lines) + "\n")

    def entries(self, process_date) -> list[Entry]:
        """The run's days as last recorded; empty if it never started."""
        text = smallfiles.read_text(self.spark, self._file(process_date)) or ""
        found = [json.loads(line) for line in text.splitlines() if line]
        return [Entry(as_date(r["trade_date"]), r["state"], r["staged_rows"], r["violations"], r["failed_rules"])
                for r in found]

    def run_ts(self, process_date) -> dt.datetime | None:
        text = smallfiles.read_text(self.spark, self._file(process_date)) or ""
        return as_datetime(json.loads(text.splitlines()[0])["run_ts"]) if text.strip() else None

    def pending(self, process_date) -> list[dt.date]:
        """Days that an interrupted attempt of this run has still to build or to publish."""
        return [e.trade_date for e in self.entries(process_date) if e.state in (MERGING, BUILT)]

    def unfinished(self) -> list[dt.date]:
        """Process dates, oldest first, of runs with a day that is neither published nor found empty."""
        dates = [as_date(n.split("=", 1)[1]) for n in child_names(self.spark, self.root) if n.startswith("process_date=")]
        return [d for d in sorted(dates) if any(e.state not in FINAL for e in self.entries(d))]

    def frame(self) -> DataFrame:
        """All runs and days as a table; without runs an empty one."""
        if not child_names(self.spark, self.root):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return (self.spark.read.schema(LEDGER_SCHEMA).option("basePath", self.root).json(self.root)
                .select("process_date", "trade_date", "run_ts", "state", "staged_rows", "violations", "failed_rules"))
