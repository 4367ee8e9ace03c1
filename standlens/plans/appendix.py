"""EDA-32: the appendix table of 22 metric / value / interpretation rows.

Counts and sums come from one aggregate pass over the working set; the few
values that need their own grouping are scalar subqueries. Values are
formatted and stacked into rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from standlens.functions.formatting import comma, number, percent_label
from standlens.functions.labels import missing_as
from standlens.operators.shares import count_if, distinct_with_null, one_shuffle, sum_if, zero_sum
from standlens.plans import profile as E
from standlens.plans.context import Context

# ---- fixed values: appendix metric names and interpretation texts ----
APPENDIX = (
    ("Stand records", "Total prepared stand records in the Wildlife Division working dataset."),
    ("Unique stands", "Unique stand identifiers after accounting for repeated fcskey records."),
    ("Compartments", "Number of compartments represented in the working dataset."),
    ("Management areas", "Number of Wildlife Division management areas represented."),
    ("Total mapped acres", "Total mapped acres associated with the working dataset."),
    ("Missing L3 cover records", "Cover-type completeness was high, supporting downstream cover analyses."),
    ("Missing canopy closure records", "Canopy closure was mostly complete but should still be filtered by analysis."),
    ("Management status unspecified or missing",
     "Management status should be interpreted cautiously due to high unspecified/missing values."),
    ("Median stand size", "Median is more representative than mean because stand sizes are right-skewed."),
    ("Mean stand size", "Mean is inflated by a small number of very large polygons."),
    ("Maximum stand size", "Largest records should be reviewed because they can strongly influence acreage summaries."),
    ("Stands <20 acres", "Most stands are relatively small polygons."),
    ("Water stands", "Water is a small share of stand records."),
    ("Water acres", "Water is a large share of mapped acreage."),
    ("Water percent of total acres", "Water should be considered separately in terrestrial vegetation summaries."),
    ("Mean stand inventory age", "Average recency of the most recent inventory record per stand."),
    ("Median stand inventory age", "Median recency of the most recent inventory record per stand."),
    ("Stands inventoried <5 years ago", "Share of stands with relatively recent inventory information."),
    ("Stands inventoried 15+ years ago", "Share of stands with older inventory information."),
    ("Pre-1950 temporal records", "Likely legacy, placeholder, or migration-related dates."),
    ("Largest cover type by acres", "Dominant Level-3 cover type by mapped acreage."),
    ("Forested records missing sub-canopy cover",
     "Sub-canopy cover was not carried forward because nearly all forested records were missing or coded as "
     "zero/no data."),
)
ACRES_SUFFIX, YEARS_SUFFIX = " acres", " years"
# ---- end of fixed values ----


def appendix_table(ctx: Context) -> DataFrame:
    """Four scans of the division working set: one for every count and sum and the bracket of the median, one for the
    median, one grouped by management status, cover type, unit and compartment, one grouped by stand (ages)."""
    p = ctx.p
    w = ctx.with_created_date(ctx.division)
    acres, c = F.col("acres"), F.col
    pos = acres.isNotNull() & (acres > 0)
    sc = c("sub_canopy_cover")
    forested = c("canopy_key").isNotNull() & (c("canopy_key") != "0-25")
    no_data = forested & (sc.isNull() | (sc == 0))
    water = c("l3cover_key") == p.water_label
    pre1950 = sum(count_if(F.year(d) < p.min_year) for d in E.DATE_FIELDS)
    sums = [
        F.count(F.lit(1)).alias("n"),
        count_if(c("l3covertype").isNull()).alias("miss_l3"),
        count_if(c("canopy_closure").isNull()).alias("miss_can"),
        zero_sum("acres").alias("total_acres"),
        F.avg("acres").alias("mean_acres"), F.max("acres").alias("max_acres"),
        count_if(pos & (acres < p.size_breaks[1])).alias("small"), count_if(pos).alias("positive"),
        count_if(water).alias("water_stands"), sum_if(water, "acres").alias("water_acres"),
        pre1950.alias("pre1950"),
        count_if(no_data).alias("no_data"), count_if(forested).alias("forested")]
    from standlens.operators.stats import quantile_frame
    base = quantile_frame(w, [], "acres", [0.5], p.quantile_method, p.quantile_accuracy, sums, ctx.division)
    median = c("q_0_5")

    # management status, cover types, units and compartments from one grouped pass, which all four uses share
    cells = one_shuffle(ctx.division.groupBy(missing_as("management_key").alias("status"), "l3covertype", "l3cover_key", "unit_key", "fc_key").agg(
        F.count(F.lit(1)).alias("stands"), zero_sum("acres").alias("acres")))
    units, compartments = (cells.agg(distinct_with_null(k)).scalar() for k in ("unit_key", "fc_key"))
    unspecified = F.coalesce(F.sum(F.when(F.col("status").isin(*E.UNSPECIFIED_MANAGEMENT), F.col("stands"))), F.lit(0))
    mg_row = cells.agg(F.struct(unspecified.alias("n"), F.coalesce(F.try_divide(unspecified.cast("double"), F.sum("stands")), F.lit(0.0)).alias("p"))).scalar()
    ages = E.stand_inventory_age(ctx)
    a = F.col("inventory_age")
    age_row = ages.agg(F.count(F.lit(1)).alias("n"), F.avg(a).alias("mean"),
                       F.percentile(a, 0.5).alias("median"),   # whole years: bounded domain
                       F.try_divide(count_if(a < p.age_breaks[0]).cast("double"), F.count(F.lit(1))).alias("young"),
                       F.try_divide(count_if(a >= p.age_breaks[-1]).cast("double"), F.count(F.lit(1))).alias("old")) \
        .select(F.struct("n", "mean", "median", "young", "old")).scalar()
    # first row of the cover summary in its published order (acres desc, then group order)
    covers = cells.groupBy("l3covertype", "l3cover_key").agg(F.sum("acres").alias("acres"))
    top_cover = covers.agg(F.max_by("l3cover_key", F.struct(
        F.col("acres"), -F.coalesce(F.col("l3covertype"), F.lit(2 ** 31 - 1)).cast("long")))).scalar()

    n = c("n")
    values = [
        comma(n), comma(age_row["n"]), comma(compartments), comma(units), comma(c("total_acres")),
        F.concat(comma("miss_l3"), F.lit(" ("), number(F.try_divide(100 * c("miss_l3"), n)), F.lit("%)")),
        F.concat(comma("miss_can"), F.lit(" ("), number(F.try_divide(100 * c("miss_can"), n)), F.lit("%)")),
        F.concat(comma(mg_row["n"]), F.lit(" ("), percent_label(mg_row["p"]), F.lit(")")),
        F.concat(number(median), F.lit(ACRES_SUFFIX)),
        F.concat(number("mean_acres"), F.lit(ACRES_SUFFIX)),
        F.concat(comma("max_acres"), F.lit(ACRES_SUFFIX)),
        percent_label(F.try_divide(c("small").cast("double"), c("positive"))),
        comma("water_stands"),
        F.concat(comma("water_acres"), F.lit(ACRES_SUFFIX)),
        F.concat(number(F.try_divide(100 * c("water_acres"), c("total_acres"))), F.lit("%")),
        F.concat(number(age_row["mean"]), F.lit(YEARS_SUFFIX)),
        F.concat(number(age_row["median"]), F.lit(YEARS_SUFFIX)),
        percent_label(age_row["young"]), percent_label(age_row["old"]),
        comma("pre1950"), top_cover,
        F.when(c("no_data") > 0, F.concat(comma("no_data"), F.lit(" ("),
                                          number(F.try_divide(100 * c("no_data"), c("forested"))), F.lit("%)"))),
    ]
    one = base.select(*[v.cast("string").alias(f"v{i}") for i, v in enumerate(values)])
    parts = ", ".join(f"'{m}', v{i}, '{t}'" for i, (m, t) in enumerate(APPENDIX))
    return one.selectExpr(f"stack({len(APPENDIX)}, {parts}) AS (metric, value, interpretation)")
