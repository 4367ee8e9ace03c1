"""E1 checks on the prepared data (AGG-01..11, JN-05, SET-03).

Every function takes a ``Context`` and returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from standlens.functions.codes import code_digits
from standlens.operators.shares import count_if, distinct_with_null, zero_sum
from standlens.plans.context import Context

# ---- fixed values: dataset and stage names of the workflow ----
DATASET_COMPARTMENTS = "Wildlife compartments"
DATASET_WORKING = "Prepared working stand dataset"
STAGE_DOMAIN = "Cover type domain"
STAGE_CROSSWALK = "Domain plus manual crosswalk"
# ---- end of fixed values ----


def cover_level_counts(ctx: Context) -> DataFrame:
    """AGG-01: rows per code length; a null code is "Level NA"."""
    d = code_digits("l4covertype_full")
    return (ctx.stands_coded
            .groupBy(F.concat(F.lit("Level "), F.coalesce(d.cast("string"), F.lit("NA"))).alias("cover_level"),
                     d.alias("cover_code_digits"))
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n")))


def cover_code_counts(ctx: Context) -> DataFrame:
    """AGG-02."""
    return (ctx.stands_coded.groupBy("l4covertype_full", "l4cover_key")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")))


def cover_hierarchy_summary(ctx: Context) -> DataFrame:
    """AGG-03: per L3 code, records and distinct full codes (null counted)."""
    return (ctx.stands_coded.groupBy("l3covertype")
            .agg(F.count(F.lit(1)).alias("stand_records"),
                 distinct_with_null("l4covertype_full").alias("unique_full_cover_codes"))
            .orderBy(F.desc("stand_records")))


def _l3_codes(ctx: Context) -> DataFrame:
    return ctx.stands_coded.select("l3covertype").distinct()


def l3_lookup_check(ctx: Context, with_crosswalk: bool, ordered: bool = True) -> DataFrame:
    """JN-05: distinct L3 codes with the label found for them (or null)."""
    if with_crosswalk:
        lk = ctx.l3_lookup.select("l3covertype", F.col("l3cover_key").alias("l3cover_key_check"))
    else:
        lk = ctx.l4_lookup.select(F.col("l4covertype_full").alias("l3covertype"),
                                  F.col("l4cover_key").alias("l3cover_key_check"))
    codes = _l3_codes(ctx)
    lk = lk.withColumnRenamed("l3covertype", "__c")
    out = codes.join(lk, codes["l3covertype"].eqNullSafe(lk["__c"]), "left").drop("__c")
    return out.orderBy(F.asc_nulls_last("l3covertype")) if ordered else out


def l3_lookup_coverage(ctx: Context) -> DataFrame:
    """AGG-04: labelled / unlabelled L3 codes before and after the crosswalk."""
    out = None
    for stage, xw in ((STAGE_DOMAIN, False), (STAGE_CROSSWALK, True)):
        chk = l3_lookup_check(ctx, xw, ordered=False)
        row = chk.agg(F.lit(stage).alias("stage"),
                      F.count(F.lit(1)).alias("total_l3_codes"),
                      F.count("l3cover_key_check").alias("l3_codes_with_description"),
                      count_if(F.col("l3cover_key_check").isNull()).alias("l3_codes_missing_description"))
        out = row if out is None else out.unionByName(row)
    return out


def l3_missing_descriptions(ctx: Context) -> DataFrame:
    """AGG-05: the L3 codes left without a label, per stage."""
    out = None
    for stage, xw in ((STAGE_DOMAIN, False), (STAGE_CROSSWALK, True)):
        rows = (l3_lookup_check(ctx, xw, ordered=False).filter(F.col("l3cover_key_check").isNull())
                .select(F.lit(stage).alias("stage"), "l3covertype"))
        out = rows if out is None else out.unionByName(rows)
    return out


def l3_label_counts(ctx: Context) -> DataFrame:
    """AGG-06."""
    return (ctx.stands_labelled.groupBy("l3covertype", "l3cover_key")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")))


def records_per_authority(ctx: Context) -> DataFrame:
    """AGG-07."""
    return ctx.department.groupBy("authority_key").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


def unit_key_check(ctx: Context) -> DataFrame:
    """SET-03: distinct authority x unit pairs."""
    return (ctx.department.select("authority_key", "unit_key").distinct()
            .orderBy(F.asc_nulls_last("authority_key"), F.asc_nulls_last("unit_key")))


def compartment_acres_summary(ctx: Context) -> DataFrame:
    """AGG-08: division compartments (all rows, repeats included)."""
    c = ctx.compartments_labelled.filter(F.col("authority_key").isin(*ctx.p.division))
    return c.agg(F.lit(DATASET_COMPARTMENTS).alias("dataset"),
                 F.count(F.lit(1)).alias("compartments"),
                 distinct_with_null("fc_key").alias("unique_compartments"),
                 F.lit(None).cast("long").alias("stands"),
                 F.lit(None).cast("long").alias("unique_stands"),
                 zero_sum("acres").alias("acres"))


def working_set_summary(ctx: Context) -> DataFrame:
    """AGG-09 (one row)."""
    w = ctx.division
    return w.agg(F.lit(DATASET_WORKING).alias("dataset"),
                 distinct_with_null("fc_key").alias("compartments"),
                 distinct_with_null("fc_key").alias("unique_compartments"),
                 F.count(F.lit(1)).alias("stands"),
                 distinct_with_null("fcskey").alias("unique_stands"),
                 zero_sum("acres").alias("acres"))


def inventory_base_summary(ctx: Context) -> DataFrame:
    """AGG-09 stacked under AGG-08 (SET-02)."""
    return compartment_acres_summary(ctx).unionByName(working_set_summary(ctx))


def inventory_base_difference(ctx: Context) -> DataFrame:
    """AGG-10: compartment vs stand acres of the division."""
    sa = working_set_summary(ctx).select("acres").scalar()
    ca = F.col("acres")
    return compartment_acres_summary(ctx).select(ca.alias("compartment_acres"), sa.alias("stand_acres"),
                      (ca - sa).alias("acre_difference"),
                      F.try_divide(100 * (ca - sa), ca).alias("percent_difference"),
                      F.try_divide(100 * sa, ca).alias("percent_accounted_for"))


def compartments_reusable_check(ctx: Context) -> DataFrame:
    """AGG-11: one row per compartment; authorities and areas skip nulls."""
    c = ctx.compartments_unique
    return c.agg(F.count(F.lit(1)).alias("records"),
                 distinct_with_null("fc_key").alias("unique_compartments"),
                 F.count_distinct("authority_key").alias("management_authorities"),
                 F.count_distinct("unit_key").alias("management_areas"))
