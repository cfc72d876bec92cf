import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from tillstream.session import configure
    s = (SparkSession.builder.master("local[*]")
         .appName("tillstream-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s


@pytest.fixture
def scratch(spark):
    """A fresh folder for one test (below /tmp; tests only)."""
    return tempfile.mkdtemp(prefix="tillstream-test-")


@pytest.fixture(scope="session")
def spark_hyp(spark):
    """The session fixture under a name hypothesis tests can share."""
    return spark
