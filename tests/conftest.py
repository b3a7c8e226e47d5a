import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from panelspark.session import LOCAL_CONF
    b = SparkSession.builder.master("local[4]").appName("panelspark-tests")
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "4").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder only where the session has none
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelspark-test-ckpt-"))
    yield s
