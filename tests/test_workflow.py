"""The end-to-end workflow writes every output and they read back."""

import tempfile

from standlens.workflow import run_workflow


def test_run_workflow(spark, ctx):
    out = tempfile.mkdtemp(prefix="standlens-wf-")
    outputs = run_workflow(ctx, out)
    expected = {"department", "division", "compartments", "authority_lookup", "unit_lookup",
                "appendix_eda_qc_summary_table", "step3_report_summary", "department_authority_terrestrial_context",
                "department_retention_summary", "department_project_cover_authority_context", "stand_size_summary",
                "management_area_top15_report_table", "wld_management_area_full_summary", "snapshot_latest",
                "snapshot_terrestrial"}
    assert expected <= set(outputs)
    n = ctx.department.count()
    assert spark.read.parquet(outputs["department"]).count() == n
    assert spark.read.parquet(outputs["division"]).count() == ctx.division.count()
    rep = spark.read.option("header", True).csv(outputs["step3_report_summary"])
    assert rep.count() == 2 and "top_20_percent" in rep.columns
    assert spark.read.parquet(outputs["snapshot_latest"]).count() == ctx.div.latest.count()
