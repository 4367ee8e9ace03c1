"""Distributed exact quantiles equal Spark's ``percentile``."""

import random

from pyspark.sql import functions as F

from standlens.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


def test_matches_percentile_grouped_and_global(spark):
    rng = random.Random(3)
    rows = []
    for g, n in (("big", 700), ("small", 1), ("two", 2), ("ties", 40)):
        for _ in range(n):
            v = rng.choice([1.0, 2.0, 2.0, 3.5]) if g == "ties" else round(rng.uniform(0, 175) * 2) / 2
            rows.append((g, v))
    rows += [("big", None), (None, 5.0), (None, 7.5), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, a double").repartition(5)
    got = {r.g: r for r in exact_quantiles(df, ["g"], "a", PROBS).collect()}
    exp = {r.g: r for r in df.groupBy("g").agg(F.percentile("a", PROBS).alias("p")).collect()}
    assert set(got) == set(exp)
    for g, r in got.items():
        for i, p in enumerate(PROBS):
            if exp[g].p is None:
                assert r[f"q_{str(p).replace('.', '_')}"] is None
                continue
            assert abs(r[f"q_{str(p).replace('.', '_')}"] - exp[g].p[i]) < 1e-9, (g, p)
    one = exact_quantiles(df, [], "a", [0.5]).first()
    assert abs(one.q_0_5 - df.agg(F.percentile("a", 0.5)).first()[0]) < 1e-9


def test_quantile_methods_agree(spark):
    from standlens.operators.stats import quantile_frame
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.choice(["x", "y"]), float(rng.randint(0, 400)) / 2) for _ in range(500)],
                               "g string, a double")
    frames = {m: {r.g: r for r in quantile_frame(df, ["g"], "a", [0.25, 0.5], m).collect()}
              for m in ("distributed", "local", "approx")}
    bounds = {r.g: r for r in quantile_frame(df, ["g"], "a", [0.23, 0.27, 0.48, 0.52], "local").collect()}
    for g in ("x", "y"):
        for c, lo, hi in (("q_0_25", "q_0_23", "q_0_27"), ("q_0_5", "q_0_48", "q_0_52")):
            assert abs(frames["distributed"][g][c] - frames["local"][g][c]) < 1e-9
            # the sketch returns a data value whose rank is close to the target
            assert bounds[g][lo] <= frames["approx"][g][c] <= bounds[g][hi]


def test_large_groups_are_bracketed(spark):
    df = spark.range(90_000).select((F.col("id") % 2).alias("g"), (F.hash("id") % 1_000_003 / 7.0).alias("a")).unionByName(
        spark.range(30_000).select(F.lit(5).cast("long").alias("g"), (F.col("id") % 3).cast("double").alias("a")))
    got = {r.g: r for r in exact_quantiles(df, ["g"], "a", [0.0, 0.25, 0.5, 0.9, 1.0], [F.max("a").alias("top")]).collect()}
    exp = {r.g: r for r in df.groupBy("g").agg(F.percentile("a", [0.0, 0.25, 0.5, 0.9, 1.0]).alias("p"), F.max("a").alias("top")).collect()}
    for g, e in exp.items():
        assert [round(got[g][f"q_{x}"], 6) for x in ("0_0", "0_25", "0_5", "0_9", "1_0")] == [round(x, 6) for x in e.p] and got[g].top == e.top
    assert abs(exact_quantiles(df, [], "a", [0.3]).first().q_0_3 - df.agg(F.percentile("a", 0.3)).first()[0]) < 1e-6


def _values(spark):
    rng = random.Random(11)
    rows = [("wide", rng.lognormvariate(0, 4)) for _ in range(1500)] + [("flat", 7.0)] * 900 + [("few", x) for x in (-1.5, 0.0, 2.0)]
    rows += [("neg", -float(i % 97)) for i in range(800)] + [(None, float(i)) for i in range(50)] + [("none", None)]
    return spark.createDataFrame(rows, "g string, a double").repartition(6)


def _same(spark, df, by, **kw):
    from standlens.operators.quantiles import narrowed_quantiles
    got = {tuple(r[c] for c in by): r for r in narrowed_quantiles(df, by, "a", PROBS, [F.count(F.lit(1)).alias("rows")], **kw).collect()}
    exp = {tuple(r[c] for c in by): r for r in df.groupBy(*by).agg(F.percentile("a", PROBS).alias("p"), F.count(F.lit(1)).alias("rows")).collect()}
    assert {k: r.rows for k, r in got.items()} == {k: r.rows for k, r in exp.items()}
    for k, e in exp.items():
        values = [got[k][f"q_{str(x).replace('.', '_')}"] for x in PROBS]
        assert values == [None] * 5 if e.p is None else all(abs(a - b) <= 1e-9 * max(1, abs(b)) for a, b in zip(values, e.p)), (k, values, e.p)


def test_a_missed_bracket_is_noticed_and_moves(spark, monkeypatch):
    import pytest

    from standlens.operators import quantiles
    monkeypatch.setattr(quantiles, "SMALL", 0)
    monkeypatch.setattr(quantiles, "MARGIN", 0)       # brackets of one value, far from the right ones
    monkeypatch.setattr(quantiles, "ACCURACY", 25)
    df = _values(spark)
    _same(spark, df, ["g"], bound=300)
    with pytest.raises(Exception, match="bracket of a quantile missed"):
        exact_quantiles(df, ["g"], "a", PROBS).collect()


def test_a_crowded_bracket_narrows(spark, monkeypatch):
    import pytest

    from standlens.operators import quantiles
    df = _values(spark)
    _same(spark, df, ["g"], bound=20)
    _same(spark, df, [], bound=30)
    _same(spark, df.limit(0), ["g"])
    _same(spark, df.where("g = 'none'"), [])
    monkeypatch.setattr(quantiles, "BOUND", 3)
    with pytest.raises(Exception, match="holds too much"):
        exact_quantiles(df, ["g"], "a", PROBS).collect()


def test_any_wrong_bracket_ends_in_the_right_one():
    from standlens.operators.quantiles import CELLS, _Target
    rng = random.Random(4)
    for trial in range(300):
        values = sorted(rng.choice([rng.lognormvariate(0, 9), float(rng.randint(-3, 3)), -1e-300 * rng.random(), 1e308]) for _ in range(rng.randint(1, 60)))
        rank = rng.randrange(len(values))
        lo, hi = sorted(rng.choice([*values, -1e9, 0.5]) for _ in range(2))
        t, scans = _Target(0, rank, values[0], values[-1], lo, hi), 0
        while not t.done:
            lo, hi = t.bracket
            inside = [x for x in values if lo <= x <= hi]
            # any quantiles of what is inside will do, be they ever so coarse
            grid = sorted([min(inside), max(inside), *rng.choices(inside, k=CELLS - 1)]) if inside else None
            t.judge(sum(x < lo for x in values), len(inside), min(inside, default=None), max(inside, default=None), grid, 2)
            scans += 1
            assert scans < 4000
        lo, hi = t.bracket
        assert lo <= values[rank] <= hi and t.below == sum(x < lo for x in values)
