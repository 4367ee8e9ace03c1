import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from standlens.session import SCALE_CONF
    b = (SparkSession.builder.master("local[4]").appName("standlens-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="standlens-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def ctx(spark):
    from standlens.config import FIXTURE_PARAMS
    from standlens.plans.context import Context
    return Context.from_tpch(spark, SF_SMALL, FIXTURE_PARAMS)
