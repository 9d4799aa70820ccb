"""Small driver-side metadata files (pointers, manifests, ledger entries) on any store Spark knows.

A file is written beside its place and renamed over it, so a reader finds
the old content or the new one, never a part.  Local disks and HDFS rename
in one step; a store that copies on rename still never shows a part.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _context(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p = p.getFileSystem(conf).makeQualified(p)
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """The file at ``path`` becomes ``text``."""
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    files, target = _context(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}.{uuid.uuid4().hex[:8]}")
    flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE)
    parents = gateway.new_array(jvm.org.apache.hadoop.fs.Options.CreateOpts, 1)
    parents[0] = jvm.org.apache.hadoop.fs.Options.CreateOpts.createParent()
    out = files.create(beside, flags, parents)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    over = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(beside, target, over)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of the file, ``None`` if there is none."""
    files, target = _context(spark, path)
    if not files.util().exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value) -> None:
    write_text(spark, path, json.dumps(value, sort_keys=True))


def read_json(spark: SparkSession, path: str):
    text = read_text(spark, path)
    return None if text is None else json.loads(text)
