"""A compartment key holding a third of the records: AQE splits the hot
partition of the records-to-compartments join, and the answer is the same
as without the split."""

from pyspark.sql import functions as F

from standlens.config import FIXTURE_PARAMS
from standlens.plans.context import Context
from standlens.sources.fixture import Inputs, tpch_inputs

SF = "/root/testdata/sf0.01"
TEST_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",            # force the sort-merge path
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",   # test-sized thresholds
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
}


def _department(spark):
    inp = tpch_inputs(spark, SF)
    # several map tasks (at scale there are thousands), one third of the records on one key
    hot = inp.stands.repartition(16).withColumn(
        "fc_key", F.when(F.col("fcskey") % 3 == 0, F.lit(4)).otherwise(F.col("fc_key")))
    ctx = Context(spark, Inputs(spark, hot, inp.compartments, inp.domains, inp.created_dates, inp.domain_rows),
                  FIXTURE_PARAMS)
    return ctx.department.select("fcskey", "tb1", "fc_key", "authority_key", "unit_key")


def test_hot_compartment_key_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in [*TEST_CONF, "spark.sql.adaptive.skewJoin.enabled"]}
    try:
        for k, v in TEST_CONF.items():
            spark.conf.set(k, v)
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        df = _department(spark)
        split_rows = sorted(map(tuple, df.collect()), key=lambda t: tuple(str(x) for x in t))
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        plain = sorted(map(tuple, _department(spark).collect()), key=lambda t: tuple(str(x) for x in t))
        assert split_rows == plain and len(plain) == 60000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
