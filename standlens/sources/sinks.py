"""Sinks and hand-offs (SRC-04..08).

The prepared department set is written once, partitioned by authority, so
later steps read it back and the division filter becomes partition pruning
(``PartitionFilters`` in the scan). Hand-offs, snapshots and the compartment layer are published in versions
(``sources.publish``): the functions return the path of the new version, and readers given the folder follow its manifest. Report tables bounded by a domain (one
row per class or authority) are written as a single headed CSV each;
tables that grow with the data keep their partitioning.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from standlens.plans.context import Context
from standlens.sources.publish import current, publish

PREPARED_PARTITION = "authority_key"
#: What the report tables read of the department's records, and of the snapshots.
REPORT_COLUMNS = ("fcskey", "fc_key", "l3covertype", "l3cover_key", "l4covertype_full", "canopy_key", "canopy_closure", "management_key",
                  "sub_canopy_cover", "acres", "date", "last_edited_date", "created_date", "authority_key", "unit_key", "tb1", "tb2", "tb3")
REPORT_SNAPSHOT_COLUMNS = ("l3covertype", "l3cover_key", "project_cover_class", "authority_key", "unit_key", "acres")


def write_department(ctx: Context, path: str) -> str:
    """SRC-05: every authority, geometry dropped, created_date attached."""
    df = ctx.department_dated
    if "geometry" in df.columns:
        df = df.drop("geometry")
    return publish(ctx.spark, path, lambda to: df.write.partitionBy(PREPARED_PARTITION).parquet(to))


def write_division(ctx: Context, path: str) -> str:
    """SRC-04: the division working set."""
    return publish(ctx.spark, path, ctx.division_dated.write.parquet)


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    """Read back a prepared set, the version published last (partition column restored from the layout); ``path`` may also be
    that of one version."""
    path = current(spark, path)
    return spark.read.option("basePath", path).parquet(path)


def prepared_context(ctx: Context, path: str) -> Context:
    """A Context whose department set is the written hand-off."""
    return Context(ctx.spark, ctx.inputs, ctx.p, prepared=read_prepared(ctx.spark, path))


def write_snapshots(ctx: Context, out_dir: str) -> dict[str, str]:
    """SRC-06: latest and latest-terrestrial snapshots of the division."""
    paths = {"snapshot_latest": os.path.join(out_dir, "snapshot_latest"),
             "snapshot_terrestrial": os.path.join(out_dir, "snapshot_terrestrial")}
    frames = {"snapshot_latest": ctx.div.latest, "snapshot_terrestrial": ctx.div.terrestrial}
    return {k: publish(ctx.spark, path, frames[k].write.parquet) for k, path in paths.items()}


def write_csv(df: DataFrame, path: str, single_file: bool) -> str:
    if single_file:
        df = df.coalesce(1)      # keeps a prior sort order: partitions are concatenated
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def report_context(ctx: Context, path: str) -> Context:
    """What the report tables share, computed and written once: the department's records, partitioned by authority so that the
    division is a pruned read of them, and the stand-year table and latest snapshot of both scopes. created_date is left to the one
    report that reads it, for the division's records alone. ``forget`` both scopes when the reports are written."""
    rows = ctx.department
    rows = rows.select(*[c for c in rows.columns if c in REPORT_COLUMNS])
    rows.write.partitionBy(PREPARED_PARTITION).parquet(f"{path}/records")
    own = Context(ctx.spark, ctx.inputs, ctx.p, prepared=ctx.spark.read.schema(rows.schema).parquet(f"{path}/records"))
    for scope in (own.div, own.dept):
        scope.materialize(f"{path}/snapshots", columns=REPORT_SNAPSHOT_COLUMNS)
    return own


def write_reports(ctx: Context, out_dir: str) -> dict[str, str]:
    """SRC-07: the appendix and the seven step-3 report tables."""
    from standlens.plans import analysis as A
    from standlens.plans.appendix import appendix_table
    bounded = {
        "appendix_eda_qc_summary_table": appendix_table(ctx),
        "step3_report_summary": A.report_summary(ctx),
        "department_authority_terrestrial_context": A.department_authority_context(ctx),
        "department_retention_summary": A.department_retention(ctx),
        "department_project_cover_authority_context": A.department_class_authority_context(ctx),
        "stand_size_summary": A.stand_size_summary(ctx),
        "management_area_top15_report_table": A.management_area_report(ctx),
    }
    out = {k: write_csv(v, os.path.join(out_dir, k), True) for k, v in bounded.items()}
    # one row per management unit: grows with the data, so no single file
    out["wld_management_area_full_summary"] = write_csv(
        A.management_area_full(ctx), os.path.join(out_dir, "wld_management_area_full_summary"), False)
    return out


def write_compartments(ctx: Context, out_dir: str) -> dict[str, str]:
    """SRC-08: reusable compartment layer (parquet) and two lookups (CSV)."""
    paths = {"compartments": os.path.join(out_dir, "compartments_prepared"),
             "authority_lookup": os.path.join(out_dir, "authority_lookup"),
             "unit_lookup": os.path.join(out_dir, "unit_name_lookup")}
    paths["compartments"] = publish(ctx.spark, paths["compartments"], ctx.compartments_unique.write.parquet)
    write_csv(ctx.authority_lookup.orderBy(F.asc_nulls_last("management_type")), paths["authority_lookup"], True)
    write_csv(ctx.unit_lookup, paths["unit_lookup"], False)
    return paths
