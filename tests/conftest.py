import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("TALLYSPARK_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from tallyspark.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.master("local[*]").appName("tallyspark-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "8")
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallyspark-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
