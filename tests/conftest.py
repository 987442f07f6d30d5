import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

# Tests that count what Spark ran need every execution of the session; by default 1,000 are kept.
os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--conf spark.sql.ui.retainedExecutions=20000 pyspark-shell")

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from adlift.session import local_session

    s = local_session(4, shuffle_partitions=8, app="adlift-tests")
    yield s
    s.stop()
