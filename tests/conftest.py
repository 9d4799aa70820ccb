import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lakebars.session import build_session

    work = tempfile.mkdtemp(prefix="lakebars-tests-")
    s = build_session("local[4]", app_name="lakebars-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": work, "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def lakehouse(spark):
    import uuid

    from lakebars.plans.jobs import Lakehouse
    from lakebars.session import new_run_dir

    root = new_run_dir(spark, "lh")
    return Lakehouse(root, db=f"t_{uuid.uuid4().hex[:10]}").ensure(spark)
