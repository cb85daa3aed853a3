import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from carelake.session import apply_conf

    ckpt = tempfile.mkdtemp(prefix="carelake-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("carelake-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_conf(s)
    yield s


@pytest.fixture(scope="session")
def sample(spark):
    from carelake.sources.fixtures import hospital_from_rows
    from sample_rows import AS_OF, SAMPLE
    return hospital_from_rows(spark, SAMPLE, AS_OF)
