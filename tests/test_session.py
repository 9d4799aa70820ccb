"""The shared work folder when the session names none (a separate JVM without defaults)."""

import os
import subprocess
import sys
import tempfile

import pytest

from lakebars.session import (NoSharedFolder, discard, drop_scratch, dynamic_session, materialize, scratch_database,
                              work_root)

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SNIPPET = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert s.sparkContext.getConf().get("spark.checkpoint.dir", None) is None
from lakebars.session import materialize, work_root
a, b = work_root(s), work_root(s)
assert a == b, (a, b)
assert materialize(s.range(7)).count() == 7
print("OK", a)
"""


def test_work_root_without_checkpoint_dir():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="empty-conf-"))
    out = subprocess.run([sys.executable, "-c", SNIPPET.format(repo=REPO)], env=env, cwd=tempfile.gettempdir(),
                         capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "OK " in out.stdout


class _Context:
    """Enough of a context to ask for its work folder."""
    applicationId = "app-without-folder"

    def __init__(self, master):
        self.master = master

    def getConf(self):  # noqa: N802 - Spark's name
        return {}

    @property
    def _jsc(self):
        class Nothing:
            def sc(self):
                return self

            def getCheckpointDir(self):  # noqa: N802 - Spark's name
                return self

            def isDefined(self):  # noqa: N802 - Spark's name
                return False
        return Nothing()


@pytest.mark.parametrize("master", ["yarn", "k8s://host", "spark://host:7077", "local-cluster[3,2,1024]"])
def test_cluster_without_shared_folder_is_refused(master):
    class Session:
        sparkContext = _Context(master)  # noqa: N815 - Spark's name

        class conf:  # noqa: N801 - Spark's name
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(NoSharedFolder):
        work_root(Session())


def test_scratch_databases_and_side_tables_go(spark):
    root, db = scratch_database(spark, "scratch-test")
    spark.sql(f"CREATE TABLE {db}.t USING parquet AS SELECT 1 AS x")
    side = materialize(spark.range(3), "gone")
    assert os.path.isdir(side.side_path.removeprefix("file:")) and os.path.isdir(root)
    discard(side)
    assert drop_scratch(spark) >= 1
    assert not os.path.isdir(side.side_path.removeprefix("file:")) and not os.path.isdir(root)
    assert not spark.catalog.databaseExists(db)


def test_dynamic_session_leaves_the_callers_mode(spark):
    other = dynamic_session(spark)
    key = "spark.sql.sources.partitionOverwriteMode"
    assert other.conf.get(key) == "DYNAMIC" and spark.conf.get(key) == "STATIC"
