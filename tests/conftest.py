import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from shelfwise.session import BASE_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.master("local[4]").appName("shelfwise-tests").config("spark.sql.shuffle.partitions", "4")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-test-ckpt-", dir="/tmp"))
    ensure_checkpoint_dir(s)
    yield s
