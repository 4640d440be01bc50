import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from pitchmetrics.session import configure
    s = (SparkSession.builder.master("local[4]").appName("pitchmetrics-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call sites for every column
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pm-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="pm-test-")
