"""Published days by version: many days change with one swap of a pointer.

Rows are appended under ``version=<v>/trade_date=<D>`` and never changed.  A
manifest names for every published day the version that holds it; the file
``CURRENT`` names the manifest in force.  Publishing N days is one write, one
manifest and one replacement of ``CURRENT``, however large N is: a reader
sees all of the days or none, and a run that dies before the swap leaves
files that no manifest names.

Readers go through :meth:`Publication.read`, or through a catalog view that
each swap redefines in one step; both prune to the folders in force.  One
writer at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakebars.functions.params import as_date
from lakebars.plans import smallfiles, tables
from lakebars.session import child_names, delete_folder

POINTER = "CURRENT"


class Publication:
    """The published days of a table whose last column is ``day_col``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, day_col: str = "trade_date",
                 view: str | None = None, versions: str | None = None):
        self.spark, self.root, self.schema, self.day_col, self.view, self.versions = spark, root, schema, day_col, view, versions
        self.data = os.path.join(root, "data")
        fields = [f for f in schema.fields if f.name != day_col]
        self.stored = StructType([*fields, StructField("version", StringType()), schema[day_col]])

    def ensure(self) -> "Publication":
        """The catalog's table of versions and its view, made again from the files if the catalog lost them."""
        if self.view:
            known = self.spark.catalog.tableExists(self.versions)
            tables.create_table(self.spark, self.versions, self.stored, self.data, ("version", self.day_col))
            if not known and child_names(self.spark, self.data):
                self.spark.catalog.recoverPartitions(self.versions)
            self._show(self.manifest())
        return self

    # ------------------------------------------------------------ manifests

    def _manifest_file(self, name: str) -> str:
        return os.path.join(self.root, "manifests", f"{name}.json")

    def current(self) -> str | None:
        """Name of the manifest in force."""
        return smallfiles.read_text(self.spark, os.path.join(self.root, POINTER))

    def manifest(self, name: str | None = None) -> dict[str, str]:
        """Day -> version that holds it, of the manifest in force or a named one."""
        name = name or self.current()
        return (smallfiles.read_json(self.spark, self._manifest_file(name)) or {})["days"] if name else {}

    def history(self) -> list[str]:
        """Names of the manifests kept, oldest first."""
        return [n.removesuffix(".json") for n in child_names(self.spark, os.path.join(self.root, "manifests"))
                if n.endswith(".json") and not n.startswith("_")]

    def swap(self, name: str) -> None:
        """Put a manifest in force: the new one, or an earlier one to go back to."""
        days = self.manifest(name)
        smallfiles.write_text(self.spark, os.path.join(self.root, POINTER), name)
        self._show(days)

    def _in_force(self, days: dict[str, str]) -> Column:
        """Selects each day from its version: partition columns only, so other folders are never read."""
        by_version: dict[str, list] = {}
        for day, version in days.items():
            by_version.setdefault(version, []).append(as_date(day))
        found = F.lit(False)
        for version, own in sorted(by_version.items()):
            found = found | ((F.col("version") == version) & F.col(self.day_col).isin(sorted(own)))
        return found

    def _show(self, days: dict[str, str]) -> None:
        if not self.view:
            return
        by_version: dict[str, list] = {}
        for day, version in days.items():
            by_version.setdefault(version, []).append(day)
        parts = [f"(version = '{v}' AND {self.day_col} IN ({', '.join(f"DATE'{d}'" for d in sorted(own))}))"
                 for v, own in sorted(by_version.items())]
        columns = ", ".join(f"`{f.name}`" for f in self.schema.fields)
        self.spark.catalog.refreshTable(self.versions)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view} AS SELECT {columns} FROM {self.versions} "
                       f"WHERE {' OR '.join(parts) or 'FALSE'}")

    # ------------------------------------------------------------ reading and writing

    def read(self, name: str | None = None) -> DataFrame:
        """The published rows of the manifest in force (or of a named one)."""
        days = self.manifest(name)
        columns = [f.name for f in self.schema.fields]
        if not days:
            return self.spark.createDataFrame([], self.schema)
        frame = self.spark.read.schema(self.stored).option("basePath", self.data).parquet(self.data)
        return frame.where(self._in_force(days)).select(*columns)

    def publish(self, rows: DataFrame, days, clear: bool = True) -> list[dt.date]:
        """The published rows of ``days`` become those of ``rows``, all at once; gives the days that have rows.

        A day without rows is withdrawn, or with ``clear=False`` left as it
        was.  Rows of other days are ignored.  If nothing changes, nothing
        is swapped.
        """
        wanted = sorted({as_date(d) for d in days})
        held = self.manifest()
        number = int((self.current() or "0").split("-")[0]) + 1
        version = f"{number:010d}-{uuid.uuid4().hex[:8]}"
        rows = rows.where(F.col(self.day_col).isin(wanted)).select(*[f.name for f in self.schema.fields])
        found = _observed_days(rows, self.day_col)
        out = found.frame.withColumn("version", F.lit(version)).select(*[f.name for f in self.stored.fields])
        if self.view:
            out.write.insertInto(self.versions)
        else:
            out.write.mode("append").partitionBy("version", self.day_col).parquet(self.data)
        present = found.days()
        new = {d: v for d, v in held.items() if as_date(d) not in wanted or (not clear and as_date(d) not in present)}
        new |= {str(d): version for d in present}
        if new != held:
            smallfiles.write_json(self.spark, self._manifest_file(version), {"days": new})
            self.swap(version)
        return present

    def vacuum(self, keep: int = 2) -> list[tuple[str, str]]:
        """Delete the folders that none of the newest ``keep`` manifests names, and older manifests.

        Run it when no reader of an older manifest is left, and never beside a writer.
        """
        names = self.history()
        kept = {*names[-keep:], self.current()} if keep > 0 else {self.current()}
        used = {(v, d) for n in kept if n for d, v in self.manifest(n).items()}
        gone = []
        for folder in child_names(self.spark, self.data):
            version = folder.removeprefix("version=")
            if version == folder:
                continue
            for day in child_names(self.spark, os.path.join(self.data, folder)):
                if (version, day.split("=", 1)[-1]) not in used:
                    delete_folder(self.spark, os.path.join(self.data, folder, day))
                    gone.append((version, day.split("=", 1)[-1]))
            if not any(v == version for v, _ in used):
                delete_folder(self.spark, os.path.join(self.data, folder))
        for n in names:
            if n not in kept:
                delete_folder(self.spark, self._manifest_file(n))
        if self.view and gone:
            listed = ", ".join(f"PARTITION (version = '{v}', {self.day_col} = DATE'{d}')" for v, d in gone)
            self.spark.sql(f"ALTER TABLE {self.versions} DROP IF EXISTS {listed}")
        return gone


class _observed_days:
    """A frame whose distinct days are known once it is written, without a job of their own."""

    def __init__(self, rows: DataFrame, day_col: str):
        from pyspark.sql import Observation

        self._seen = Observation(f"days-{uuid.uuid4().hex[:8]}")
        self.frame = rows.observe(self._seen, F.collect_set(day_col).alias("days"))

    def days(self) -> list[dt.date]:
        return sorted(self._seen.get["days"] or [])
