import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from reelrank.session import PLAN_CONF
    builder = (SparkSession.builder.master("local[4]").appName("reelrank-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for k, v in PLAN_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reelrank-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def R(spark):
    """FIXTURES ratings: u1{a:5,b:3} u2{a:4,b:2,c:5} u3{a:1,c:4}; a,b,c = 1,2,3."""
    return spark.createDataFrame(
        [(1, 1, 5.0), (1, 2, 3.0), (2, 1, 4.0), (2, 2, 2.0), (2, 3, 5.0), (3, 1, 1.0), (3, 3, 4.0)],
        "userId long, itemId long, rating double")


SF_SMALL = "/root/testdata/sf0.001"
