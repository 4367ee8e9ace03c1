"""Published sets: a rewrite that fails leaves the last good version, readers follow the manifest."""

import os

import pytest
from pyspark.sql import functions as F

from standlens.sources.publish import current, prune, publish
from standlens.sources.sinks import read_prepared


def _set(spark, n, bad=None):
    df = spark.range(n).select("id", (F.col("id") % 3).cast("string").alias("authority_key")).repartition(4)
    if bad is not None:
        fail = F.raise_error(F.lit("broken record")).cast("long")
        df = df.withColumn("id", F.when(F.col("id") == bad, fail).otherwise(F.col("id")))
    return lambda to: df.write.partitionBy("authority_key").parquet(to)


def test_a_write_that_fails_leaves_the_last_version(spark, tmp_path):
    root = f"{tmp_path}/set"
    with pytest.raises(Exception, match="broken record"):
        publish(spark, root, _set(spark, 90, bad=70))
    assert current(spark, root) == root
    first = publish(spark, root, _set(spark, 30))
    reader = read_prepared(spark, root)
    with pytest.raises(Exception, match="broken record"):
        publish(spark, root, _set(spark, 90, bad=70))
    assert current(spark, root) == first and reader.count() == read_prepared(spark, root).count() == 30
    second = publish(spark, root, _set(spark, 60))
    assert current(spark, root) == second != first
    # a reader that began before goes on; new ones see the new version, and pruned reads still prune
    assert reader.count() == 30 and read_prepared(spark, root).count() == read_prepared(spark, second).count() == 60
    plan = read_prepared(spark, root).where("authority_key = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(authority_key" in plan


def test_prune_keeps_what_is_read_and_what_is_being_written(spark, tmp_path):
    root = f"{tmp_path}/set"
    paths = [publish(spark, root, _set(spark, n)) for n in (3, 4, 5)]
    _set(spark, 2)(f"{root}/v-unfinished")
    assert prune(spark, root, keep=2) == [os.path.basename(paths[0])]
    assert not os.path.exists(paths[0]) and os.path.exists(paths[1]) and os.path.exists(f"{root}/v-unfinished")
    assert read_prepared(spark, root).count() == 5


def test_hand_offs_are_rewritten_in_place(spark, ctx, tmp_path):
    from standlens.sources.sinks import prepared_context, write_department, write_snapshots
    root = f"{tmp_path}/department"
    a, b = write_department(ctx, root), write_department(ctx, root)
    assert a != b and current(spark, root) == b
    n = ctx.department.count()
    assert prepared_context(ctx, root).department.count() == spark.read.parquet(a).count() == n
    snaps = write_snapshots(ctx, f"{tmp_path}/snaps")
    assert spark.read.parquet(snaps["snapshot_latest"]).count() == read_prepared(spark, f"{tmp_path}/snaps/snapshot_latest").count()
