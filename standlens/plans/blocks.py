"""Building blocks whose output is a table (PRJ, FLT, JN, SET, WIN rows of
SURVEY section 2), each applied to the whole data so it can be checked on
its own. Value -> class mappings are reported as grouped counts, which pin
the mapping down on every value present."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from standlens.functions.classes import (SIZE_LABELS_ANALYSIS, SIZE_LABELS_PROFILE, age_class, clamp_year, size_class,
                                         year_label)
from standlens.functions.formatting import format_acres, format_count, format_percent_value, percent_label
from standlens.functions.labels import CANOPY_KEY_ORDER, canopy_class, factor, level_order, missing_as
from standlens.operators.shares import ratio, scalar_total, with_share_within, zero_sum
from standlens.operators.topk import distributed_rank, top_k
from standlens.plans import analysis as A
from standlens.plans import profile as E
from standlens.plans.context import Context, add_project_class
from standlens.session import checkpoint_dir
from standlens.sources.readers import clean_names, read_compartments, read_domains, read_stands

# ---- fixed values: raw layer column names as delivered (mixed case) ----
RAW_COMPARTMENT_NAMES = {"fc_key": "FC_Key", "management_type": "Management Type", "unit_name": "UnitName", "acres": "Acres"}
RAW_STAND_NAMES = {"fcskey": "FCSKEY", "fc_key": "FC_Key", "l4covertype": "L4COVERTYPE",
                   "canopy_closure": "Canopy Closure", "managed_site": "ManagedSite",
                   "sub_canopy_cover": "Sub_Canopy_Cover", "acres": "Acres", "date": "Date",
                   "last_edited_date": "LastEditedDate"}
OTHER_COMPARTMENT_NAMES = {"fc_key": "fc key", "management_type": "management_type", "unit_name": "Unit Name", "acres": "ACRES"}
OTHER_STAND_NAMES = {"fcskey": "fcskey", "fc_key": "fc key", "l4covertype": "l4covertype", "canopy_closure": "CanopyClosure",
                     "managed_site": "managed site", "sub_canopy_cover": "SubCanopyCover", "acres": "acres", "date": "DATE",
                     "last_edited_date": "last edited date"}
# ---- end of fixed values ----


def _n():
    return F.count(F.lit(1))


def _folder(ctx: Context, name: str) -> str:
    return f"{checkpoint_dir(ctx.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _raw(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(n) for c, n in names.items()])


def clean_names_stands(ctx: Context) -> DataFrame:
    """PRJ-01 on a stand layer as it is delivered: written with mixed-case names, read back, names cleaned."""
    path = _folder(ctx, "raw-stands")
    _raw(ctx.inputs.stands, RAW_STAND_NAMES).write.parquet(path)
    return clean_names(ctx.spark.read.parquet(path))


def stands_through_reader(ctx: Context) -> DataFrame:
    """SRC-01: the same layer through ``read_stands``."""
    path = _folder(ctx, "raw-stands")
    _raw(ctx.inputs.stands, RAW_STAND_NAMES).write.parquet(path)
    return read_stands(ctx.spark, path).drop("created_date")


def compartments_through_reader(ctx: Context) -> DataFrame:
    """SRC-02: the compartment layer, delivered with mixed-case names."""
    path = _folder(ctx, "raw-compartments")
    _raw(ctx.inputs.compartments, RAW_COMPARTMENT_NAMES).write.parquet(path)
    return read_compartments(ctx.spark, path)


def _in_two_spellings(df: DataFrame, key: str, names: dict[str, str], other: dict[str, str], path: str) -> None:
    """Write a layer as two deliveries into one folder: names, column order and types differ between them."""
    _raw(df.filter(F.col(key) % 2 == 0), names).write.parquet(path)
    rest = df.filter(F.col(key) % 2 != 0).select(*[F.col(c).cast("long" if t == "int" else t).alias(other[c])
                                                    for c, t in reversed(df.dtypes) if c in other])
    rest.write.mode("append").parquet(path)


def stands_in_two_spellings(ctx: Context) -> DataFrame:
    """SRC-01: a stand layer delivered as files with differing headers."""
    path = _folder(ctx, "raw-stands")
    _in_two_spellings(ctx.inputs.stands, "fcskey", RAW_STAND_NAMES, OTHER_STAND_NAMES, path)
    return read_stands(ctx.spark, path).drop("created_date")


def compartments_in_two_spellings(ctx: Context) -> DataFrame:
    """SRC-02: a compartment layer delivered as files with differing headers."""
    path = _folder(ctx, "raw-compartments")
    _in_two_spellings(ctx.inputs.compartments, "fc_key", RAW_COMPARTMENT_NAMES, OTHER_COMPARTMENT_NAMES, path)
    return read_compartments(ctx.spark, path)


def domains_through_reader(ctx: Context) -> DataFrame:
    """SRC-03: every domain as a CSV file with the columns the other way round; one table of (domain, code, label)."""
    paths = {}
    for name, df in ctx.inputs.domains.items():
        label = next(c for c in df.columns if c != "code")
        paths[name] = _folder(ctx, f"domain-{name}")
        df.select(F.col(label).alias("Label"), F.col("code").alias("Code")).write.option("header", True).csv(paths[name])
    out = None
    for name, df in read_domains(ctx.spark, paths).items():
        label = next(c for c in df.columns if c not in ("code", "input_order"))
        part = df.select(F.lit(name).alias("domain"), "code", F.col(label).alias("label"))
        out = part if out is None else out.unionByName(part)
    return out


HANDED_ON = ["fcskey", "fc_key", "tb1", "tb2", "tb3", "acres", "date", "l3covertype", "l3cover_key", "l4cover_key", "canopy_key",
             "management_key", "authority_key", "unit_key", "created_date"]


def division_handoff(ctx: Context) -> DataFrame:
    """SRC-04: the division set, written and read back."""
    return ctx.spark.read.parquet(sinks().write_division(ctx, _folder(ctx, "division"))).select(*HANDED_ON)


def department_handoff(ctx: Context) -> DataFrame:
    """SRC-05: the department set, written (partitioned by authority) and read back."""
    path = sinks().write_department(ctx, _folder(ctx, "department"))
    return sinks().read_prepared(ctx.spark, path).select(*HANDED_ON)


def snapshots_written(ctx: Context) -> DataFrame:
    """SRC-06: both snapshots of the division, written and read back."""
    paths = sinks().write_snapshots(ctx, _folder(ctx, "snapshots"))
    parts = [ctx.spark.read.parquet(p).select(F.lit(name).alias("snapshot"), "fcskey", "inventory_year_raw", "date", "acres", "l3cover_key",
                                              "project_cover_class", "unit_key") for name, p in sorted(paths.items())]
    return parts[0].unionByName(parts[1])


def report_written(ctx: Context) -> DataFrame:
    """SRC-07: the management-area table, written as CSV with a header and read back by name."""
    table = A.management_area_full(ctx)
    path = sinks().write_csv(table, _folder(ctx, "report"), False)
    back = ctx.spark.read.option("header", True).csv(path)
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])


#: The eight report tables: the query that each one holds, and the columns that tell its rows apart.
REPORTS = {
    "appendix_eda_qc_summary_table": ("eda_32_appendix_summary", ["metric"]),
    "step3_report_summary": ("snp_34_report_summary", ["project_cover_class"]),
    "department_authority_terrestrial_context": ("snp_35_department_authority_context", ["authority_key"]),
    "department_retention_summary": ("snp_13_department_retention", ["step"]),
    "department_project_cover_authority_context": ("snp_36_class_authority_context", ["project_cover_class", "authority_key"]),
    "stand_size_summary": ("snp_24_stand_size_summary", ["project_cover_class"]),
    "management_area_top15_report_table": ("snp_29_management_area_report", ["management_area_rank_by_project_cover_acres"]),
    "wld_management_area_full_summary": ("snp_28_management_area_full", ["management_area_rank_by_project_cover_acres"]),
}


def reports_written(ctx: Context) -> DataFrame:
    """SRC-07: all eight report tables, written by ``write_reports`` and read back: a row for each table, row and field that
    is not null. What reads as a number is one; the rest is text. As in the workflow, the tables are computed from stored records and
    snapshots, so the lookups, the compartment join and the snapshots run once and not for each table."""
    folder = _folder(ctx, "reports")
    stored = sinks().report_context(ctx, f"{folder}/work")
    try:
        paths = sinks().write_reports(stored, folder)
    finally:
        stored.div.forget()
        stored.dept.forget()
    out = None
    for name, (_, keys) in REPORTS.items():
        back = ctx.spark.read.option("header", True).csv(paths[name])
        part = back.select(F.lit(name).alias("report"), F.concat_ws("|", *keys).alias("key"), *back.columns)
        part = part.unpivot(["report", "key"], back.columns, "field", "raw")
        out = part if out is None else out.unionByName(part)
    number = F.expr("try_cast(raw AS double)")
    return out.filter("raw IS NOT NULL").select("report", "key", "field", number.alias("number"), F.when(number.isNull(), F.col("raw")).alias("text"))


def compartments_written(ctx: Context) -> DataFrame:
    """SRC-08: the reusable compartment layer with a geometry, written and read back."""
    shaped = ctx.inputs.compartments.withColumn("geometry", F.encode(F.concat(F.lit("POINT "), F.col("fc_key")), "UTF-8"))
    own = Context(ctx.spark, replace(ctx.inputs, compartments=shaped), ctx.p)
    back = ctx.spark.read.parquet(sinks().write_compartments(own, _folder(ctx, "layer"))["compartments"])
    return back.withColumn("geometry", F.hex("geometry"))


def column_order(ctx: Context) -> DataFrame:
    """PRJ-08: the first seven columns of the labelled stands, by their position, and how often their values occur."""
    s = ctx.stands_labelled
    front = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in s.columns[:7]]
    return s.groupBy(F.concat_ws("|", *front).alias("front")).agg(_n().alias("n"))


def geometry_dropped(ctx: Context) -> DataFrame:
    """PRJ-09: records with a geometry, after the department hand-off."""
    shaped = ctx.inputs.stands.withColumn("geometry", F.encode(F.col("fcskey").cast("string"), "UTF-8"))
    own = Context(ctx.spark, replace(ctx.inputs, stands=shaped), ctx.p)
    back = sinks().read_prepared(ctx.spark, sinks().write_department(own, _folder(ctx, "department")))
    return back.select("fcskey", "tb1", "tb2", "tb3", "authority_key", F.lit("geometry" in back.columns).alias("has_geometry"))


def sinks():
    from standlens.sources import sinks as module     # it imports the plans
    return module


def labels_in_use(codes: DataFrame, code: str, lookup: DataFrame, key: str, labels: list[str]) -> DataFrame:
    """A lookup against the codes that occur: records per code, codes without a label and labels without a record included."""
    n = codes.groupBy(F.col(code).cast("int").alias("__c")).agg(_n().alias("n"))
    j = n.join(lookup, n["__c"].eqNullSafe(lookup[key]), "full")
    return j.select(F.coalesce("__c", key).alias(key), *labels, F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def canopy_labels(ctx: Context) -> DataFrame:
    """PRJ-02."""
    return labels_in_use(ctx.inputs.stands, "canopy_closure", ctx.canopy_lookup, "canopy_closure", ["canopy_key"])


def l4_labels(ctx: Context) -> DataFrame:
    """PRJ-03."""
    return labels_in_use(ctx.inputs.stands, "l4covertype", ctx.l4_lookup, "l4covertype_full", ["l4cover_key"])


def management_labels(ctx: Context) -> DataFrame:
    """PRJ-04."""
    return labels_in_use(ctx.inputs.stands, "managed_site", ctx.management_lookup, "managed_site", ["management_key"])


def authority_labels(ctx: Context) -> DataFrame:
    """PRJ-05."""
    return labels_in_use(ctx.inputs.compartments, "management_type", ctx.authority_lookup, "management_type", ["authority_key"])


def l3_labels(ctx: Context) -> DataFrame:
    """SET-01."""
    return labels_in_use(ctx.stands_coded, "l3covertype", ctx.l3_lookup, "l3covertype", ["l3cover_key", "l3_key_source"])


def project_class_mapping(ctx: Context) -> DataFrame:
    """PRJ-10 over every department record (null codes included)."""
    d = add_project_class(ctx.department, ctx.p)
    return d.groupBy("cover_code_chr", "l3cover_key", "project_cover_class").agg(_n().alias("n"))


def canopy_class_mapping(ctx: Context) -> DataFrame:
    """PRJ-11."""
    return ctx.department.groupBy("canopy_key", canopy_class("canopy_key").alias("canopy_class")).agg(_n().alias("n"))


def missing_label_mapping(ctx: Context) -> DataFrame:
    """PRJ-12 for the five label columns (long form)."""
    cols = ["canopy_key", "management_key", "l3cover_key", "authority_key", "l4cover_key"]
    d = ctx.department.select(*[missing_as(c).alias(c) for c in cols])
    return (d.unpivot([], cols, "label_column", "label").groupBy("label_column", "label").agg(_n().alias("n")))


def size_class_mapping(ctx: Context) -> DataFrame:
    """PRJ-13: both label sets, with the acre range each class receives."""
    d = ctx.department
    return (d.groupBy(size_class("acres", ctx.p, SIZE_LABELS_PROFILE).alias("size_class_profile"),
                      size_class("acres", ctx.p, SIZE_LABELS_ANALYSIS).alias("size_class_analysis"))
            .agg(_n().alias("n"), F.min("acres").alias("min_acres"), F.max("acres").alias("max_acres")))


def age_class_mapping(ctx: Context) -> DataFrame:
    """PRJ-14."""
    a = E.stand_inventory_age(ctx)
    return a.groupBy("inventory_age", age_class("inventory_age", ctx.p).alias("age_class")).agg(_n().alias("n"))


def inventory_year_mapping(ctx: Context) -> DataFrame:
    """PRJ-15 before the valid-year filter (null, 1899 and all years)."""
    y = F.year("date")
    return ctx.department.groupBy(y.alias("inventory_year_raw"), clamp_year(y, ctx.p).alias("inventory_year")) \
        .agg(_n().alias("n"))


def year_label_mapping(ctx: Context) -> DataFrame:
    """PRJ-16 over the department's analysis years."""
    return A.analysis_years(ctx, "department").select("inventory_year",
                                                       year_label("inventory_year", ctx.p).alias("year_label"))


def ordered_canopy_keys(ctx: Context) -> DataFrame:
    """PRJ-17: label, its factor value and level position."""
    k = missing_as("canopy_key")
    return ctx.department.groupBy(k.alias("canopy_key"), factor(k, CANOPY_KEY_ORDER).alias("canopy_level"),
                                  level_order(k, CANOPY_KEY_ORDER).alias("canopy_level_order")).agg(_n().alias("n"))


def department_cover_shares(ctx: Context) -> DataFrame:
    """PRJ-18: department records per L3 with shares of the department total and their percent labels."""
    g = ctx.department.groupBy("l3covertype", "l3cover_key").agg(_n().alias("stands"), zero_sum("acres").alias("acres"))
    g = (g.withColumn("percent_stands", ratio("stands", scalar_total(g, F.sum("stands"))))
          .withColumn("percent_acres", ratio("acres", scalar_total(g, F.sum("acres")))))
    return (g.withColumn("percent_stands_label", percent_label("percent_stands"))
             .withColumn("percent_acres_label", percent_label("percent_acres")))


def authority_shares(ctx: Context) -> DataFrame:
    """WIN-01: records and acres per authority as shares of all."""
    g = ctx.department.groupBy("authority_key").agg(_n().alias("stands"), zero_sum("acres").alias("acres"))
    return (g.withColumn("share_stands", ratio("stands", scalar_total(g, F.sum("stands"))))
             .withColumn("share_acres", ratio("acres", scalar_total(g, F.sum("acres")))))


def canopy_against_totals(ctx: Context) -> DataFrame:
    """JN-10: canopy classes next to the totals of the department."""
    g = ctx.department.groupBy("canopy_key").agg(_n().alias("stands"), zero_sum("acres").alias("acres"))
    return (g.withColumn("total_stands", scalar_total(g, F.sum("stands"))).withColumn("total_acres", scalar_total(g, F.sum("acres")))
             .withColumn("other_acres", F.col("total_acres") - F.col("acres")))


def report_formats(ctx: Context) -> DataFrame:
    """PRJ-19 on the class summary."""
    s = A.project_cover_summary(ctx, ordered=False)
    return s.select("project_cover_class", format_acres("acres").alias("acres"),
                    format_count("stands").alias("stands"),
                    format_percent_value("percent_terrestrial_acres").alias("percent_terrestrial_acres"))


def suffixed_compare(ctx: Context) -> DataFrame:
    """PRJ-20."""
    return A._suffixed(A.wld_compare(ctx), "_wld")


def agriculture_branch(ctx: Context) -> DataFrame:
    """FLT-03 on the department: records per L3 code in the branch."""
    from standlens.functions.codes import int_code_has_prefix
    return (ctx.department.filter(int_code_has_prefix("l3covertype", ctx.p.agriculture_prefix))
            .groupBy("l3covertype").agg(_n().alias("n")))


def valid_year_window(ctx: Context) -> DataFrame:
    """FLT-04 on the department's screened records."""
    return ctx.dept.timed.groupBy("inventory_year_raw").agg(_n().alias("n"))


def canopy_subsets(ctx: Context) -> DataFrame:
    """FLT-06: forested and open subsets of the department."""
    d = ctx.department
    forested = F.col("canopy_key").isNotNull() & (F.col("canopy_key") != "0-25")
    open_ = F.col("canopy_key") == "0-25"
    return (d.filter(forested | open_)
            .groupBy(F.when(open_, F.lit("open")).otherwise(F.lit("forested")).alias("subset"), "canopy_key")
            .agg(_n().alias("n"), zero_sum("acres").alias("acres")))


def positive_acres(ctx: Context) -> DataFrame:
    """FLT-07."""
    d = ctx.department.filter(F.col("acres").isNotNull() & (F.col("acres") > 0))
    return d.agg(_n().alias("records"), zero_sum("acres").alias("acres"), F.min("acres").alias("min_acres"))


def project_class_records(ctx: Context) -> DataFrame:
    """FLT-08 on the division terrestrial snapshot."""
    return A._classed(ctx).select("fcskey", "project_cover_class", "acres", "unit_key")


def matching_stands(ctx: Context) -> DataFrame:
    """JN-07: the inner join with suffixed columns only."""
    a = A._suffixed(A.wld_compare(ctx), "_wld")
    b = A._suffixed(A.department_wld_compare(ctx), "_department")
    return a.join(b, "fcskey", "inner")


def landbase_join(ctx: Context) -> DataFrame:
    """JN-09 before rounding: class x authority with the authority land base."""
    g = A.class_authority(ctx).select("authority_key", "project_cover_class", "acres", "total_authority_terrestrial_acres")
    return g.withColumn("percent_authority_terrestrial_landbase",
                        ratio(100 * F.col("acres"), "total_authority_terrestrial_acres"))


def scope_summaries(ctx: Context) -> DataFrame:
    """SET-02: the two scope summaries stacked."""
    a = E.scope_summary(ctx.division, "value").withColumn("scope", F.lit("division"))
    b = E.scope_summary(ctx.department, "value").withColumn("scope", F.lit("department"))
    return a.unionByName(b)


def cover_shares_long(ctx: Context) -> DataFrame:
    """SET-04: department cover shares in long form."""
    s = department_cover_shares(ctx).select("l3cover_key", F.col("percent_stands").alias("Stands"),
                                            F.col("percent_acres").alias("Acres"))
    return s.unpivot(["l3cover_key"], ["Stands", "Acres"], "metric", "percent")


def share_within_authority(ctx: Context) -> DataFrame:
    """WIN-02: department L3 stands as a share of each authority's stands."""
    g = ctx.department.groupBy("authority_key", "l3cover_key").agg(_n().alias("stands"))
    return with_share_within(g, ["authority_key"], "stands", "percent_within_authority")


def unit_rank_running_total(ctx: Context) -> DataFrame:
    """WIN-03: units ranked by acres within authority, with running acres."""
    u = ctx.department.groupBy("authority_key", "unit_key").agg(zero_sum("acres").alias("acres"))
    return distributed_rank(u, ["authority_key"], "acres", [F.desc("acres"), F.asc_nulls_last("unit_key")], "rank",
                            running="acres", running_col="cumulative_acres", then=[F.col("unit_key").isNull(), F.col("unit_key")])


def top_covers_per_authority(ctx: Context) -> DataFrame:
    """WIN-04: three largest L3 types per authority (no ties)."""
    g = ctx.department.groupBy("authority_key", "l3cover_key").agg(zero_sum("acres").alias("acres"))
    return top_k(g, ["authority_key"], [F.desc("acres"), F.asc_nulls_last("l3cover_key")], 3, ties=False)
