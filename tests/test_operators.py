"""Operators on hand-made frames: null-safe lookups, null-aware counts,
zero sums, first-row dedup, top-k with ties, distributed ranking and the
interval snapshot against the naive per-year form."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from standlens.operators.dedup import first_per_key
from standlens.operators.lookup import Lookup, lookup_join
from standlens.operators.shares import count_if, distinct_with_null, ratio, sum_if, zero_sum
from naive import naive_annual_snapshots
from standlens.operators.snapshots import explode_validity
from standlens.operators.topk import distributed_rank, top_k
from standlens.plans.profile import global_top_k_ties


def test_lookup_join_null_safe_and_unmatched(spark):
    left = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, code int")
    lk = spark.createDataFrame([(10, "ten"), (None, "missing")], "code int, label string")
    for bound in (2, None):   # broadcast and shuffle paths agree
        got = sorted(lookup_join(left, Lookup(lk, "code", bound)).select("id", "label").collect())
        assert [tuple(r) for r in got] == [(1, "ten"), (2, "missing"), (3, None)]


def test_null_aware_counts_and_zero_sums(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, None), (2, None)], "k int, a double")
    r = df.agg(distinct_with_null("k").alias("d"), zero_sum("a").alias("s"),
               count_if(F.col("k") == 1).alias("c"), sum_if(F.col("k") == 1, "a").alias("si"),
               ratio(F.lit(1), F.lit(0)).alias("r")).first()
    assert (r.d, r.s, r.c, r.si, r.r) == (3, 0.0, 2, 0.0, None)
    empty = spark.createDataFrame([], "k int, a double")
    assert empty.agg(zero_sum("a")).first()[0] == 0.0


def test_first_per_key_tie_break(spark):
    df = spark.createDataFrame([(1, "2000-01-01", 2, "b"), (1, "2000-01-01", 1, "a"), (1, "1999-01-01", 0, "c"),
                                (2, None, 5, "n"), (2, "1990-01-01", 9, "m")], "k int, d string, tb int, v string")
    got = first_per_key(df, ["k"], [F.col("d").desc_nulls_last(), F.col("tb").asc()]).orderBy("k")
    assert [r.v for r in got.collect()] == ["a", "m"]


def test_top_k_ties(spark):
    df = spark.createDataFrame([("g", "u1", 5.0), ("g", "u2", 5.0), ("g", "u3", 4.0), ("g", "u4", 3.0)],
                               "g string, u string, a double")
    with_ties = top_k(df, ["g"], [F.desc("a")], 1, ties=True)
    assert sorted(r.u for r in with_ties.collect()) == ["u1", "u2"]
    no_ties = top_k(df, ["g"], [F.desc("a"), F.asc("u")], 1, ties=False)
    assert [r.u for r in no_ties.collect()] == ["u1"]
    glob = global_top_k_ties(df, "a", 2)
    assert sorted(r.u for r in glob.collect()) == ["u1", "u2"]
    glob3 = global_top_k_ties(df, "a", 3)
    assert sorted(r.u for r in glob3.collect()) == ["u1", "u2", "u3"]


def test_distributed_rank_matches_window(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["A", "B", None]), f"u{i:04d}", float(rng.randint(0, 30))) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, u string, a double").repartition(7)
    order = [F.desc("a"), F.asc("u")]
    got = distributed_rank(df, ["g"], "a", order, "rk", running="a", running_col="cum")
    w = Window.partitionBy("g").orderBy(*order)
    exp = (df.withColumn("rk", F.row_number().over(w))
             .withColumn("cum", F.sum("a").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    key = lambda r: (r.g or "", r.u)
    assert sorted([(r.g, r.u, r.rk, r.cum) for r in got.collect()], key=lambda t: (t[0] or "", t[1])) == \
        sorted([(r.g, r.u, r.rk, r.cum) for r in exp.collect()], key=lambda t: (t[0] or "", t[1]))
    g2 = distributed_rank(df, [], "a", order, "rk")
    assert sorted(r.rk for r in g2.collect()) == list(range(1, 501))
    del key


def test_interval_snapshot_equals_naive(spark):
    rng = random.Random(11)
    rows = []
    for stand in range(60):
        years = rng.sample(range(1990, 2002), rng.randint(1, 6))
        for y in years:
            rows.append((stand, y, max(y, 1997), f"{y}-06-01", rng.choice(["Water", "Land", "Crop"]),
                         float(rng.randint(0, 9))))
    # stands with only pre-baseline years and one moving water -> land -> water
    rows += [(900, 1991, 1997, "1991-01-01", "Land", 1.0), (900, 1993, 1997, "1993-01-01", "Water", 2.0),
             (901, 1998, 1998, "1998-01-01", "Water", 1.0), (901, 1999, 1999, "1999-01-01", "Land", 1.0),
             (901, 2001, 2001, "2001-01-01", "Water", 1.0)]
    df = spark.createDataFrame(rows, "fcskey int, inventory_year_raw int, inventory_year int, date string, "
                                     "cover string, acres double").withColumn("date", F.to_timestamp("date"))
    years = list(range(1997, 2002))
    fast = explode_validity(df).groupBy("inventory_year", "cover").agg(F.count("*").alias("n"), F.sum("acres").alias("a"))
    slow = naive_annual_snapshots(df, years).groupBy("inventory_year", "cover").agg(
        F.count("*").alias("n"), F.sum("acres").alias("a"))
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
    # water removed after the interval step: stand 901 is land only in 1999-2000
    land = explode_validity(df).filter("fcskey = 901 AND cover <> 'Water'")
    assert sorted(r.inventory_year for r in land.collect()) == [1999, 2000]


def test_equal_numbers_are_ranked_in_more_than_one_task(spark):
    n = 100_000
    df = spark.range(n).select(F.lit("g").alias("g"), F.lit(2.5).alias("a"),
                               F.when(F.col("id") == 5, None).otherwise(F.format_string("u%06d", (F.col("id") * 7919) % n)).alias("u"))
    df = df.unionByName(spark.createDataFrame([("g", 9.0, "top"), ("g", None, "last"), ("h", 2.5, "alone")], "g string, a double, u string"))
    order = [F.desc_nulls_last("a"), F.asc_nulls_last("u")]
    then = [F.col("u").isNull(), F.col("u")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # so little data would be put into one task again
    try:
        out = distributed_rank(df, ["g"], "a", order, "rk", running="a", running_col="cum", then=then)
        rows = out.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = {(r.g, r.u): (r.rk, r.cum) for r in rows}
    want = sorted((r.u for r in rows if r.a == 2.5 and r.g == "g"), key=lambda u: (u is None, u or ""))
    assert [got["g", u] for u in want] == [(i, 9.0 + 2.5 * (i - 1)) for i in range(2, n + 2)]
    assert got["g", "top"] == (1, 9.0) and got["h", "alone"] == (1, 2.5) and got["g", "last"][0] == n + 2
    per_task = {}
    for r in rows:
        per_task[r.task] = per_task.get(r.task, 0) + 1
    assert len(per_task) > 3 and max(per_task.values()) < n // 2
    plain = {(r.g, r.u): r.rk for r in distributed_rank(df, ["g"], "a", order, "rk").collect()}
    assert plain == {k: v[0] for k, v in got.items()}
