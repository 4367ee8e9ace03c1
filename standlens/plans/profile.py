"""E2: exploration and quality-control summaries (EDA-01..32).

All inputs are the division working set unless a function takes a scope.
Shares of a grand total use scalar subqueries; shares within a group use a
partitioned window over the (small) grouped result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from standlens.functions.classes import (AGE_LABELS, SIZE_LABELS_PROFILE, age_class, labels_for, size_class,
                                         valid_year)
from standlens.functions.codes import int_code_has_prefix
from standlens.functions.formatting import percent_label
from standlens.functions.labels import (CANOPY_CLASS_ORDER, CANOPY_KEY_ORDER, canopy_class, factor, level_order,
                                        missing_as)
from standlens.operators.shares import (count_if, distinct_with_null, ratio, scalar_total, sum_if,
                                        with_share_within, zero_sum)
from standlens.plans.context import Context

# ---- fixed values: metric, variable and status names of the workflow ----
SCOPE_METRICS = ("Compartments", "Stands", "Acres")
MISSING_VARIABLES = (("L3 Cover Type", "l3covertype"), ("L4 Cover Type", "l4covertype_full"),
                     ("Canopy Closure", "canopy_closure"), ("Management Status", "managed_site"),
                     ("Acres", "acres"))
NO_DATA = "Missing / No data"
AVAILABLE = "Available"
METRIC_STANDS, METRIC_ACRES = "Stands", "Acres"
METRIC_PCT_STANDS, METRIC_PCT_ACRES = "Percent of Stands", "Percent of Acres"
DATE_FIELDS = ("date", "created_date", "last_edited_date")
UNSPECIFIED_MANAGEMENT = ("Unspecified", "Missing / NA")
# ---- end of fixed values ----


def _n() -> Column:
    return F.count(F.lit(1))


def _stands_acres() -> list[Column]:
    return [_n().alias("stands"), zero_sum("acres").alias("acres")]


def scope_summary(df: DataFrame, value_name: str) -> DataFrame:
    """EDA-01: compartments, rows and acres as metric rows."""
    one = df.agg(distinct_with_null("fc_key").cast("double").alias(SCOPE_METRICS[0]),
                 _n().cast("double").alias(SCOPE_METRICS[1]),
                 zero_sum("acres").alias(SCOPE_METRICS[2]))
    return one.unpivot([], list(SCOPE_METRICS), "metric", value_name)


def working_summary(ctx: Context) -> DataFrame:
    return scope_summary(ctx.division, "working")


def department_summary(ctx: Context) -> DataFrame:
    return scope_summary(ctx.department, "department")


def missing_summary(ctx: Context) -> DataFrame:
    """EDA-02: null and zero counts per variable, one pass, then stacked."""
    w = ctx.division
    aggs = [_n().alias("total_rows")]
    for i, (_, c) in enumerate(MISSING_VARIABLES):
        aggs += [count_if(F.col(c).isNull()).alias(f"m{i}"), count_if(F.col(c) == 0).alias(f"z{i}")]
    one = w.agg(*aggs)
    parts = ", ".join(f"'{label}', m{i}, z{i}" for i, (label, _) in enumerate(MISSING_VARIABLES))
    long = one.selectExpr(f"stack({len(MISSING_VARIABLES)}, {parts}) AS (variable, missing_values, zero_values)",
                          "total_rows")
    return (long.withColumn("percent_missing", ratio(100 * F.col("missing_values"), "total_rows"))
                .withColumn("percent_zero", ratio(100 * F.col("zero_values"), "total_rows")))


def _share(df: DataFrame, value: str, out: str, scale: float = 1.0) -> DataFrame:
    tot = scalar_total(df, F.sum(value))
    return df.withColumn(out, ratio(F.col(value) * scale if scale != 1.0 else F.col(value), tot))


def authority_summary(ctx: Context) -> DataFrame:
    """EDA-03."""
    g = ctx.division.groupBy("authority_key").agg(_n().alias("n"))
    g = _share(g, "n", "percent")
    return g.withColumn("percent_label", percent_label("percent")).orderBy(F.desc("n"))


def unique_units(ctx: Context) -> DataFrame:
    """EDA-04."""
    return ctx.division.agg(distinct_with_null("unit_key").alias("unique_units"))


def unit_summary(ctx: Context, ordered: bool = True) -> DataFrame:
    """EDA-05."""
    g = ctx.division.groupBy("unit_key").agg(*_stands_acres())
    g = _share(g, "stands", "percent_stands")
    g = _share(g, "acres", "percent_acres")
    return g.orderBy(F.desc("acres")) if ordered else g


def global_top_k_ties(df: DataFrame, col: str, k: int) -> DataFrame:
    """Rows whose ``col`` is at least the k-th largest value: exactly the rows
    with ``rank() <= k`` over ``col`` descending (ties kept), without moving
    the table into one partition. The k-th value comes from a bounded
    take-ordered top-k run as a scalar subquery."""
    kth = scalar_total(df.orderBy(F.desc_nulls_last(col)).limit(k), F.min(col))
    # nulls rank after every value (rank = non-null count + 1): kept only when that is <= k
    non_null = scalar_total(df, F.count(col))
    c = F.col(col)
    return df.filter((c >= kth) | (c.isNull() & (non_null < k)))


def unit_top(ctx: Context) -> DataFrame:
    """EDA-05 top 10 units by acres, ties kept."""
    return global_top_k_ties(unit_summary(ctx, ordered=False), "acres", ctx.p.unit_top_k).orderBy(F.desc("acres"))


def _agri(df: DataFrame, ctx: Context) -> DataFrame:
    return df.filter(int_code_has_prefix("l3covertype", ctx.p.agriculture_prefix))


def cover_200_summary(ctx: Context) -> DataFrame:
    """EDA-06: agriculture branch per L3, shares of branch and of all."""
    every = ctx.division.groupBy("l3covertype", "l3cover_key").agg(*_stands_acres(), F.max("l3covertype").alias("__code"))
    branch = int_code_has_prefix("__code", ctx.p.agriculture_prefix)      # on an aggregate: stays above the shared shuffle
    g = every.filter(branch)
    for c in ("stands", "acres"):
        g = (g.withColumn(f"percent_200_{c}", ratio(c, scalar_total(every, F.sum(F.when(branch, F.col(c))))))
              .withColumn(f"percent_total_{c}", ratio(c, scalar_total(every, F.sum(c)))))
    for c in ("percent_200_stands", "percent_200_acres", "percent_total_stands", "percent_total_acres"):
        g = g.withColumn(f"{c}_label", percent_label(c))
    return g.drop("__code").orderBy(F.desc("acres"))


def cover_200_by_unit_summary(ctx: Context) -> DataFrame:
    """EDA-07: the same per unit, shares within the unit."""
    g = _agri(ctx.division, ctx).groupBy("unit_key", "l3covertype", "l3cover_key").agg(*_stands_acres())
    g = with_share_within(g, ["unit_key"], "stands", "percent_unit_200_stands", total_col="total_unit_200_stands")
    g = with_share_within(g, ["unit_key"], "acres", "percent_unit_200_acres", total_col="total_unit_200_acres")
    g = (g.withColumn("percent_unit_200_stands_label", percent_label("percent_unit_200_stands"))
          .withColumn("percent_unit_200_acres_label", percent_label("percent_unit_200_acres")))
    return g.orderBy(F.asc_nulls_last("unit_key"), F.desc("acres"))


def cover_summary(ctx: Context, ordered: bool = True) -> DataFrame:
    """EDA-08."""
    g = ctx.division.groupBy("l3covertype", "l3cover_key").agg(*_stands_acres())
    g = _share(g, "stands", "percent_stands")
    g = _share(g, "acres", "percent_acres")
    g = (g.withColumn("percent_stands_label", percent_label("percent_stands"))
          .withColumn("percent_acres_label", percent_label("percent_acres")))
    return g.orderBy(F.desc("acres")) if ordered else g


def _compare_long(df: DataFrame, key: str, stands_name: str = METRIC_STANDS,
                  acres_name: str = METRIC_ACRES) -> DataFrame:
    """SET-04: percent_stands / percent_acres to (metric, percent) rows."""
    return (df.select(key, F.col("percent_stands").alias(stands_name), F.col("percent_acres").alias(acres_name))
              .unpivot([key], [stands_name, acres_name], "metric", "percent"))


def cover_compare(ctx: Context) -> DataFrame:
    """EDA-08: top 10 cover types by acres (ties kept), long form."""
    top = global_top_k_ties(cover_summary(ctx, ordered=False), "acres", ctx.p.cover_top_k)
    return _compare_long(top, "l3cover_key")


def cover_acres_per_stand(ctx: Context) -> DataFrame:
    """EDA-09."""
    return (cover_summary(ctx, ordered=False).select("l3cover_key", "stands", "acres",
                                      ratio("acres", "stands").alias("acres_per_stand"))
            .orderBy("acres_per_stand"))


def canopy_summary(ctx: Context, ordered: bool = True) -> DataFrame:
    """EDA-10: per canopy class in class order (100-scaled shares)."""
    g = (ctx.division.withColumn("canopy_key", canopy_class("canopy_key"))
         .groupBy("canopy_key").agg(*_stands_acres()))
    g = _share(g, "stands", "percent_stands", 100.0)
    g = _share(g, "acres", "percent_acres", 100.0)
    return g.orderBy(F.asc_nulls_last(level_order("canopy_key", CANOPY_CLASS_ORDER))) if ordered else g


def canopy_compare(ctx: Context) -> DataFrame:
    """EDA-10 long form."""
    return _compare_long(canopy_summary(ctx, ordered=False), "canopy_key")


def _forested(ctx: Context) -> DataFrame:
    """FLT-06: non-null canopy other than "0-25" ("Unspecified" counts)."""
    return ctx.division.filter(F.col("canopy_key").isNotNull() & (F.col("canopy_key") != "0-25"))


def _records_stands_acres() -> list[Column]:
    return [_n().alias("records"), F.count_distinct("fcskey").alias("unique_stands"),
            zero_sum("acres").alias("acres")]


def sub_canopy_availability(ctx: Context, ordered: bool = True) -> DataFrame:
    """EDA-11."""
    sc = F.col("sub_canopy_cover")
    status = F.when(sc.isNull() | (sc == 0), F.lit(NO_DATA)).otherwise(F.lit(AVAILABLE))
    g = _forested(ctx).groupBy(status.alias("sub_canopy_data_status")).agg(*_records_stands_acres())
    g = _share(g, "records", "percent_records", 100.0)
    g = _share(g, "unique_stands", "percent_unique_stands", 100.0)
    g = _share(g, "acres", "percent_acres", 100.0)
    return g.orderBy(F.desc("records")) if ordered else g


def sub_canopy_no_data(ctx: Context) -> DataFrame:
    """EDA-11: the no-data row."""
    return sub_canopy_availability(ctx, ordered=False).filter(F.col("sub_canopy_data_status") == NO_DATA)


def sub_canopy_composition(ctx: Context) -> DataFrame:
    """EDA-12."""
    sc = F.col("sub_canopy_cover")
    g = (_forested(ctx).filter(sc.isNotNull() & (sc != 0))
         .groupBy(sc.cast("string").alias("sub_canopy_cover")).agg(*_records_stands_acres()))
    g = _share(g, "records", "percent_available_records", 100.0)
    g = _share(g, "unique_stands", "percent_available_unique_stands", 100.0)
    g = _share(g, "acres", "percent_available_acres", 100.0)
    return g.orderBy(F.desc("acres"))


def canopy_by_cover(ctx: Context) -> DataFrame:
    """EDA-13: canopy x L3, share of stands within the canopy class."""
    ck = factor(missing_as("canopy_key"), CANOPY_KEY_ORDER)
    g = ctx.division.groupBy(ck.alias("canopy_key"), "l3cover_key").agg(*_stands_acres())
    g = with_share_within(g, ["canopy_key"], "stands", "percent_within_canopy")
    return g.orderBy(F.asc_nulls_last(level_order("canopy_key", CANOPY_KEY_ORDER)), F.desc("stands"))


def _management(df: DataFrame, ordered: bool = True) -> DataFrame:
    g = (df.groupBy("managed_site", missing_as("management_key").alias("management_key"))
           .agg(*_stands_acres()))
    g = _share(g, "stands", "percent_stands")
    g = _share(g, "acres", "percent_acres")
    return g.orderBy(F.desc("acres")) if ordered else g


def management_summary(ctx: Context, ordered: bool = True) -> DataFrame:
    """EDA-14."""
    return _management(ctx.division, ordered)


def management_compare(ctx: Context) -> DataFrame:
    return _compare_long(management_summary(ctx, ordered=False), "management_key")


def open_canopy_management(ctx: Context, ordered: bool = True) -> DataFrame:
    """EDA-15: EDA-14 inside the open-canopy subset."""
    return _management(ctx.division.filter(F.col("canopy_key") == "0-25"), ordered)


def open_canopy_management_compare(ctx: Context) -> DataFrame:
    return _compare_long(open_canopy_management(ctx, ordered=False), "management_key", METRIC_PCT_STANDS,
                         METRIC_PCT_ACRES)


def duplicate_stands(ctx: Context) -> DataFrame:
    """EDA-16."""
    return ctx.division.groupBy("fcskey").agg(_n().alias("n")).filter("n > 1").orderBy(F.desc("n"))


def _positive_acres(ctx: Context) -> DataFrame:
    """FLT-07."""
    return ctx.division.filter(F.col("acres").isNotNull() & (F.col("acres") > 0))


def acre_size(ctx: Context) -> DataFrame:
    """EDA-17."""
    g = (_positive_acres(ctx).groupBy(size_class("acres", ctx.p).alias("size_class")).agg(_n().alias("n")))
    g = _share(g, "n", "percent")
    return g.orderBy(level_order("size_class", labels_for(ctx.p.size_breaks, SIZE_LABELS_PROFILE, "acres")))


def log_acre_histogram(ctx: Context) -> DataFrame:
    """EDA-18: counts in equal-width bins of log10(acres) from min to max."""
    pos = _positive_acres(ctx).select(F.log10("acres").alias("x"))
    bins = ctx.p.histogram_bins
    b = pos.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    lo, hi = b.select("lo").scalar(), b.select("hi").scalar()
    width = (hi - lo) / bins
    raw = F.floor(F.try_divide(F.col("x") - lo, hi - lo) * bins) + 1
    bin_ = F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")
    g = pos.groupBy(bin_.alias("bin")).agg(_n().alias("n"))
    return (g.withColumn("log10_lower", lo + (F.col("bin") - 1) * width)
             .withColumn("log10_upper", lo + F.col("bin") * width)
             .orderBy("bin"))


def acre_summary(ctx: Context) -> DataFrame:
    """EDA-19."""
    from standlens.operators.stats import quantile_frame
    w = ctx.division
    one = quantile_frame(w, [], "acres", [0.25, 0.5, 0.75], ctx.p.quantile_method, ctx.p.quantile_accuracy, [
        F.min("acres").alias("min_acres"), F.avg("acres").alias("mean_acres"), F.max("acres").alias("max_acres"),
        F.stddev_samp("acres").alias("sd_acres")])
    one = one.select("min_acres", F.col("q_0_25").alias("q1_acres"), F.col("q_0_5").alias("median_acres"), "mean_acres",
                     F.col("q_0_75").alias("q3_acres"), "max_acres", "sd_acres")
    return one.withColumn("cv_percent", ratio(100 * F.col("sd_acres"), "mean_acres"))


def _input_order(df: DataFrame) -> list[Column]:
    return [F.col(c).asc() for c in ("tb1", "tb2", "tb3", "fcskey") if c in df.columns]


def largest_stands(ctx: Context) -> DataFrame:
    """EDA-20: ten largest records (TakeOrderedAndProject)."""
    w = ctx.division
    return (w.orderBy(F.desc_nulls_last("acres"), *_input_order(w)).limit(10)
            .select("acres", "l3covertype", "l3cover_key", "l4covertype_full", "l4cover_key", "fc_key", "unit_key"))


def _dated(ctx: Context) -> DataFrame:
    return ctx.with_created_date(ctx.division)


def date_summary(ctx: Context) -> DataFrame:
    """EDA-21."""
    aggs = []
    for c in DATE_FIELDS:
        stem = "" if c == "date" else c.replace("_date", "") + "_"
        aggs += [F.min(c).alias(f"min_{stem}date"), F.max(c).alias(f"max_{stem}date")]
    return _dated(ctx).agg(*aggs)


def _date_long(ctx: Context) -> DataFrame:
    d = _dated(ctx).select(*DATE_FIELDS)
    return (d.unpivot([], list(DATE_FIELDS), "date_field", "date_value")
             .withColumn("year", F.year("date_value")))


def date_year_counts(ctx: Context, ordered: bool = True) -> DataFrame:
    """EDA-22: rows per (date field, year), null year included."""
    g = _date_long(ctx).groupBy("date_field", "year").agg(_n().alias("n"))
    return g.orderBy(F.desc("n")) if ordered else g


def pre1950_summary(ctx: Context) -> DataFrame:
    """EDA-23."""
    return date_year_counts(ctx, ordered=False).filter(F.col("year") < ctx.p.min_year)


def date_year_summary(ctx: Context) -> DataFrame:
    """EDA-24: rows per (date field, valid year)."""
    return (_date_long(ctx).filter(valid_year("year", ctx.p))
            .groupBy("date_field", "year").agg(_n().alias("n")).orderBy("date_field", "year"))


def inventory_year_summary(ctx: Context) -> DataFrame:
    """EDA-25."""
    y = F.year("date")
    return (ctx.division.filter(valid_year(y, ctx.p)).groupBy(y.alias("inventory_year"))
            .agg(_n().alias("n")).orderBy("inventory_year"))


def stand_inventory_age(ctx: Context) -> DataFrame:
    """EDA-26: newest valid year per stand and its age."""
    y = F.year("date")
    g = (ctx.division.filter(valid_year(y, ctx.p)).groupBy("fcskey")
         .agg(F.max(y).alias("most_recent_inventory_year")))
    return g.withColumn("inventory_age", F.lit(ctx.p.current_year) - F.col("most_recent_inventory_year"))


def stand_inventory_age_summary(ctx: Context) -> DataFrame:
    """EDA-27."""
    from standlens.operators.stats import quantiles
    a = stand_inventory_age(ctx)
    # ages are whole years inside the valid-year window: a bounded domain, so
    # the per-group map of distinct values is small and percentile is safe
    q = quantiles("inventory_age", [0.25, 0.5, 0.75], ctx.p.quantile_method != "approx", ctx.p.quantile_accuracy)
    return a.agg(_n().alias("unique_stands"), F.min("inventory_age").alias("min_age"), q[0].alias("q1_age"),
                 q[1].alias("median_age"), F.avg("inventory_age").alias("mean_age"), q[2].alias("q3_age"),
                 F.max("inventory_age").alias("max_age"), F.stddev_samp("inventory_age").alias("sd_age"))


def age_by_year(ctx: Context) -> DataFrame:
    """EDA-28."""
    g = stand_inventory_age(ctx).groupBy("inventory_age").agg(_n().alias("n"))
    return _share(g, "n", "percent").orderBy("inventory_age")


def age_by_class(ctx: Context) -> DataFrame:
    """EDA-29."""
    g = stand_inventory_age(ctx).groupBy(age_class("inventory_age", ctx.p).alias("age_class")).agg(_n().alias("n"))
    return _share(g, "n", "percent").orderBy(level_order("age_class", labels_for(ctx.p.age_breaks, AGE_LABELS, "years")))


def _is_water(ctx: Context) -> Column:
    return F.col("l3cover_key") == ctx.p.water_label


def water_summary(ctx: Context) -> DataFrame:
    """EDA-30."""
    one = ctx.division.agg(count_if(_is_water(ctx)).alias("water_stands"),
                           sum_if(_is_water(ctx), "acres").alias("water_acres"),
                           _n().alias("total_stands"), zero_sum("acres").alias("total_acres"))
    return (one.withColumn("percent_total_stands", ratio(100 * F.col("water_stands"), "total_stands"))
               .withColumn("percent_total_acres", ratio(100 * F.col("water_acres"), "total_acres")))


def water_by_unit(ctx: Context, ordered: bool = True) -> DataFrame:
    """EDA-31: water acres and percent per unit, units with > 1 water acre."""
    g = ctx.division.groupBy("unit_key").agg(zero_sum("acres").alias("total_acres"),
                                             sum_if(_is_water(ctx), "acres").alias("water_acres"))
    g = g.withColumn("percent_water", ratio(100 * F.col("water_acres"), "total_acres"))
    g = g.filter(F.col("water_acres") > ctx.p.water_min_acres)
    return g.orderBy(F.desc("percent_water")) if ordered else g


def water_by_unit_top_acres(ctx: Context) -> DataFrame:
    return global_top_k_ties(water_by_unit(ctx, ordered=False), "water_acres", ctx.p.unit_top_k).orderBy("water_acres")


def water_by_unit_top_percent(ctx: Context) -> DataFrame:
    return global_top_k_ties(water_by_unit(ctx, ordered=False), "percent_water", ctx.p.unit_top_k).orderBy("percent_water")
