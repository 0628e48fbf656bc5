import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierlake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark import SparkConf

    conf = {"spark.sql.shuffle.partitions": "8"}
    # Tests set their own shared folder only when the environment names none.
    if not SparkConf().get("spark.checkpoint.dir", None):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = build_session("tierlake-tests", master="local[8]", conf=conf)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def workdir():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
