import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from skein.session import configure
    s = (SparkSession.builder.master("local[4]").appName("skein-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="skein-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="skein-test-")


def one_col(spark, values, name="c", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")
