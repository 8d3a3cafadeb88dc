import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from pumpline.session import SESSION_SETTINGS
    b = (SparkSession.builder.master("local[4]").appName("pumpline-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8"))
    for k, v in SESSION_SETTINGS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pumpline-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
