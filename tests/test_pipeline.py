"""Invariants the workflow checks by eye, as assertions."""

import os
import tempfile

from pyspark.sql import functions as F

from standlens.plans import analysis as A
from standlens.plans import prepare as P
from standlens.plans.context import DEPARTMENT, DIVISION


def test_lookups_unique(ctx):
    for df, key in ((ctx.canopy_lookup, "canopy_closure"), (ctx.l4_lookup, "l4covertype_full"),
                    (ctx.management_lookup, "managed_site"), (ctx.authority_lookup, "management_type"),
                    (ctx.unit_lookup, "unit_name"), (ctx.l3_lookup, "l3covertype"),
                    (ctx.compartment_attributes, "fc_key")):
        assert df.groupBy(key).count().filter("count > 1").count() == 0, key


def test_joins_keep_row_count(ctx):
    n = ctx.inputs.stands.count()
    assert ctx.stands_labelled.count() == n
    assert ctx.department.count() == n


def test_only_null_and_zero_unlabelled_after_crosswalk(ctx):
    rows = P.l3_missing_descriptions(ctx).filter(F.col("stage") == P.STAGE_CROSSWALK).collect()
    assert {r.l3covertype for r in rows} <= {None, 0}


def test_funnel_never_increases(ctx):
    rows = A.department_retention(ctx).collect()
    for a, b in zip(rows, rows[1:]):
        assert b.rows_or_stands <= a.rows_or_stands and b.acres <= a.acres + 1e-9


def test_no_duplicate_stand_years(ctx):
    for s in (DIVISION, DEPARTMENT):
        assert A.stand_record_summary(ctx, s).first().duplicate_stand_year_rows == 0


def test_last_annual_total_equals_latest_snapshot(ctx):
    last = A.annual_total_summary(ctx, DIVISION).orderBy(F.desc("inventory_year")).first()
    latest = A.latest_totals(ctx).first()
    assert last.total_stands_all_cover == latest.latest_snapshot_stands
    assert abs(last.total_acres_all_cover - latest.latest_snapshot_acres) < 1e-6


def test_categories_sum_to_100(ctx):
    for r in A.authority_comparison_check(ctx).collect():
        assert abs(r.total_percent - 100.0) < 1e-6


def test_consistency_counts_add_up(ctx):
    v = {r.check: r.value for r in A.consistency_summary(ctx).collect()}
    assert v["WLD workflow terrestrial stands"] - v["Stands only in WLD workflow"] == \
        v["Department workflow Wildlife terrestrial stands"] - v["Stands only in Department workflow"]


def test_distributed_rank_is_a_permutation(ctx):
    ranks = [r[0] for r in A.management_area_full(ctx).select("management_area_rank_by_project_cover_acres").collect()]
    assert sorted(ranks) == list(range(1, len(ranks) + 1))


def test_sinks_round_trip(spark, ctx):
    from standlens.sources.sinks import (prepared_context, read_prepared, write_compartments, write_department,
                                         write_reports, write_snapshots)
    out = tempfile.mkdtemp(prefix="standlens-sinks-")
    path = write_department(ctx, os.path.join(out, "department"))
    back = read_prepared(spark, path)
    assert back.count() == ctx.department.count()
    pctx = prepared_context(ctx, path)
    plan = pctx.division.select("fcskey")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Wildlife" in plan
    assert pctx.division.count() == ctx.division.count()
    snaps = write_snapshots(ctx, os.path.join(out, "snapshots"))
    assert spark.read.parquet(snaps["snapshot_latest"]).count() == ctx.div.latest.count()
    reports = write_reports(ctx, os.path.join(out, "reports"))
    app = spark.read.option("header", True).csv(reports["appendix_eda_qc_summary_table"])
    assert app.count() == 22
    comp = write_compartments(ctx, os.path.join(out, "compartments"))
    assert spark.read.parquet(comp["compartments"]).count() == ctx.compartments_unique.count()


def test_materialized_scopes_give_same_answers(spark, ctx):
    from standlens.sources.sinks import prepared_context, write_department
    out = tempfile.mkdtemp(prefix="standlens-mat-")
    pctx = prepared_context(ctx, write_department(ctx, os.path.join(out, "dept")))
    before = {s: A.annual_cover_summary(pctx, s).collect() for s in (DIVISION, DEPARTMENT)}
    rep_before = A.report_summary(pctx).collect()
    pctx.div.materialize(os.path.join(out, "snap"))
    pctx.dept.materialize(os.path.join(out, "snap"))
    def key(t):
        return tuple((x is None, str(x)) for x in t)

    def rows(r):
        return sorted(map(tuple, r), key=key)

    for s in (DIVISION, DEPARTMENT):
        assert rows(A.annual_cover_summary(pctx, s).collect()) == rows(before[s])
    assert rows(A.report_summary(pctx).collect()) == rows(rep_before)
