"""Writes (K1-K6, A6) returning a :class:`WriteResult`."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakebars.session import delete_folder, hadoop_path

JDBC_BATCH_SIZE = 50_000


@dataclass
class WriteResult:
    status: str          # WRITTEN or SKIPPED
    rows: int
    target: str


def observed(df: DataFrame, name: str = "written") -> tuple[DataFrame, Observation]:
    """Count the rows as a side effect of the write job (no extra scan)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def skip_if_empty(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] | None = None) -> WriteResult:
    """K6 + O2: the folder at ``path`` becomes ``df``, or stays as it is when ``df`` has no row.

    ``df`` is computed once: it is written beside the folder while its rows
    are counted, and takes the folder's place only if there are any.
    ``write(df, folder)`` is a Parquet write by default.
    """
    spark = df.sparkSession
    parent, name = os.path.split(path.rstrip("/"))
    beside = os.path.join(parent, f"_{name}-{uuid.uuid4().hex[:12]}")   # hidden from scans of the parent
    counted, obs = observed(df)
    (write or write_parquet)(counted, beside)
    rows = int(obs.get["rows"])
    if not rows:
        delete_folder(spark, beside)
        return WriteResult("SKIPPED", 0, path)
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)
    if not fs.rename(hadoop_path(spark, beside)[1], target):
        raise OSError(f"cannot move {beside} to {path}")
    return WriteResult("WRITTEN", rows, path)


def write_jsonl(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """K1: JSON lines, UTF-8 unescaped, replacing what is at ``path``."""
    writer = df.write.mode(mode).option("compression", "none").option("ignoreNullFields", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", dynamic: bool = False) -> None:
    """K2: Parquet; ``dynamic`` replaces only the partitions present in ``df``."""
    writer = df.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, batch_size: int = JDBC_BATCH_SIZE) -> None:
    """K3 (append) / K4 (overwrite: drop and recreate from the frame's schema)."""
    props = {"batchsize": str(batch_size), **(properties or {})}
    df.write.jdbc(url, table, mode=mode, properties=props)


def insert_by_position(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """K5: ``INSERT INTO table SELECT * ...`` (columns matched by position)."""
    df.write.insertInto(table, overwrite=overwrite)
