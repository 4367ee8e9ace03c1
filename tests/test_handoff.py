"""The prepared department set: records move with their codes, and labels are joined to them when they stay."""

import pytest
from pyspark.sql import functions as F

from dataclasses import replace

from standlens.plans.context import Context


@pytest.fixture(scope="module")
def odd(ctx):
    """Records without a stand or a compartment, a compartment that is not known, and a stand with two dates."""
    s = ctx.inputs.stands.limit(400).withColumn("fcskey", F.when(F.col("tb1") != 3, F.col("fcskey")))
    s = s.withColumn("fc_key", F.when(F.col("tb1") == 2, F.lit(-7)).when(F.col("tb1") != 4, F.col("fc_key"))).localCheckpoint()
    dates = ctx.inputs.created_dates
    twice = dates.unionByName(dates.filter("fcskey % 2 = 0")).unionByName(dates.limit(1).withColumn("fcskey", F.lit(None).cast("long")))
    return Context(ctx.spark, replace(ctx.inputs, stands=s, created_dates=twice.localCheckpoint()), ctx.p)


@pytest.mark.parametrize("scope", ["department", "division"])
def test_dates_joined_first_give_the_same_records(odd, scope):
    a, b = getattr(odd, f"{scope}_dated"), odd.with_created_date(getattr(odd, scope))
    assert a.columns == b.columns and dict(a.dtypes) == dict(b.dtypes)
    assert a.count() > 0 and a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_a_record_moves_before_its_labels_are_joined(ctx):
    plan = ctx.department_dated._jdf.queryExecution().executedPlan().toString().splitlines()
    joins = [x for x in plan if "Join " in x]
    labels = [i for i, x in enumerate(joins) if any(f"__lk_{k}" in x for k in (
        "canopy_closure", "l4covertype_full", "managed_site", "l3covertype"))]
    moves = [i for i, x in enumerate(joins) if "fcskey" in x or "__fc#" in x]
    assert len(labels) == 4 and len(moves) == 2
    assert max(labels) < min(moves)                                         # a plan shows the last join first
    assert not any("Broadcast" in joins[i] for i in moves)                  # no table that grows is broadcast


def test_the_reports_share_stored_records(ctx, monkeypatch):
    from standlens.plans import blocks
    from standlens.sources import sinks
    real, plans = sinks.write_reports, {}

    def spied(own, out):
        frames = {"department": own.department, "division": own.division, "dedup": own.dept.dedup, "latest": own.div.latest,
                  "terrestrial": own.dept.terrestrial}
        plans.update({n: f._jdf.queryExecution().executedPlan().toString() for n, f in frames.items()})
        assert own.dept.latest.count() == ctx.dept.latest.count()
        return real(own, out)

    monkeypatch.setattr(sinks, "write_reports", spied)
    tables = {t.name for t in ctx.spark.catalog.listTables()}
    assert blocks.reports_written(ctx).select("report").distinct().count() == len(blocks.REPORTS)
    assert len(plans) == 5 and not [n for n, p in plans.items() if "lineitem" in p or "Exchange" in p]
    assert {t.name for t in ctx.spark.catalog.listTables()} == tables
