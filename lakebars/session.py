"""Session construction and the shared work folder.

Every job relies on a few settings being explicit rather than defaulted:
UTC session time, ANSI mode, STATIC partition overwrite (the dynamic mode
only in :func:`dynamic_session`), AQE with skew handling.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "STATIC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


# Static settings: only effective when the session is built here (they
# cannot change on a running session).  A daily run compiles many distinct
# plans; a larger generated-code cache avoids recompiling them on every run.
STATIC_CONF = {
    "spark.sql.codegen.cache.maxEntries": "2000",
}

# Sizing for a large cluster (e.g. 1000 executors, ~100 TB of candles): many
# initial shuffle partitions that AQE coalesces to ~128 MB each, splits of
# skewed partitions above 256 MB / 5x the median, 128 MB input splits, and a
# runtime broadcast only for sides measured below 64 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
    # size-first coalescing: fewer, fuller tasks on a shared cluster
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.files.openCostInBytes": "8m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def build_session(master: str | None = None, app_name: str = "lakebars",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  profile: str = "local") -> SparkSession:
    """Create (or reuse) a session with the settings every job assumes.

    ``profile="cluster"`` adds :data:`CLUSTER_CONF`.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if profile == "cluster":
        for key, value in CLUSTER_CONF.items():
            builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **SESSION_CONF}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Pin the SQL settings on an existing session (e.g. one the driver built)."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)


_LOCAL_ROOTS: dict[str, str] = {}


class NoSharedFolder(RuntimeError):
    """A cluster session names no folder that all its executors reach."""


def work_root(spark: SparkSession) -> str:
    """The shared folder for side tables and intermediate outputs.

    ``spark.checkpoint.dir`` names a folder every executor can reach; it is
    only read here (a checkpoint folder set on the context counts too).  When
    neither exists, a session on one machine (master ``local`` or
    ``local[...]``: tests, development) gets a temporary folder, once per
    application; any other raises, because rows written to each executor's
    own disk would be missing from what is read back.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - not readable on some session types
            root = None
    if not root:
        root = _LOCAL_ROOTS.get(sc.applicationId)
    if not root:
        ckpt = sc._jsc.sc().getCheckpointDir()
        root = ckpt.get() if ckpt.isDefined() else None
    if not root:
        if not is_one_machine(sc.master):
            raise NoSharedFolder(f"master {sc.master}: set spark.checkpoint.dir to a folder shared by all executors")
        app = sc.applicationId
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="lakebars-")
            sc.setCheckpointDir(os.path.join(_LOCAL_ROOTS[app], "checkpoints"))
        root = _LOCAL_ROOTS[app]
    return root


def is_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the shared work folder for one run."""
    return os.path.join(work_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str = "side", observe: list | None = None):
    """Write ``df`` once as a Parquet side table in the shared folder and read it back.

    Cuts the lineage (a later overwrite may then replace the files ``df``
    was read from) in a single pass; ``checkpoint()`` would compute the plan
    twice.  The files survive the loss of any executor.  ``observe`` takes
    aggregate columns computed during that same write; with it the result is
    ``(frame, metrics dict)``.
    """
    from pyspark.sql import Observation

    spark = df.sparkSession
    path = os.path.join(work_root(spark), "_side", f"{name}-{uuid.uuid4().hex[:12]}")
    obs = None
    if observe:
        obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        df = df.observe(obs, *observe)
    df.write.mode("error").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.side_path = path
    return (out, obs.get) if observe else out


def discard(frame) -> None:
    """Delete the side table that :func:`materialize` returned, once nothing reads it any more."""
    delete_folder(frame.sparkSession, frame.side_path)


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` of a folder on any store Spark knows."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, sorted; none if it does not exist."""
    fs, p = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def scratch_database(spark: SparkSession, name: str) -> tuple[str, str]:
    """A database in a run folder of its own: ``(folder, database)``; see :func:`drop_scratch`."""
    root = new_run_dir(spark, name)
    db = "lb_" + os.path.basename(root).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}'")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append((db, root))
    return root, db


_SCRATCH: dict[str, list[tuple[str, str]]] = {}


def drop_scratch(spark: SparkSession) -> int:
    """Drop all scratch databases of this application with their folders; returns how many."""
    found = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for db, root in found:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
        delete_folder(spark, root)
    return len(found)


def dynamic_session(spark: SparkSession) -> SparkSession:
    """A session on the same context and catalog in which overwrites replace only the partitions written.

    The writer option is ignored by ``insertInto``, and the mode of the
    caller's session is left alone: other jobs in it may rely on it.
    """
    other = spark.newSession()
    apply_conf(other)
    other.conf.set("spark.sql.sources.partitionOverwriteMode", "DYNAMIC")
    return other


def bucket_session(spark: SparkSession, dynamic: bool = False) -> SparkSession:
    """A session in which a table in buckets is read a bucket a task, and joined on more columns than its bucket
    column without being moved; with ``dynamic`` also :func:`dynamic_session`."""
    other = dynamic_session(spark) if dynamic else spark.newSession()
    if not dynamic:
        apply_conf(other)
    other.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    other.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return other
