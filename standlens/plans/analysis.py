"""E3: screening, snapshots and the class / area / concentration analysis
(SNP-01..37, JN-06..10). Scope-dependent functions take ``scope`` =
"division" or "department"; the logic is shared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from standlens.functions.classes import SIZE_LABELS_ANALYSIS, labels_for, size_class, year_label
from standlens.functions.codes import int_code_has_prefix
from standlens.functions.formatting import comma, format_acres, format_count, format_percent_value
from standlens.functions.labels import level_order, missing_as
from standlens.operators.shares import count_if, one_shuffle, ratio, scalar_total, sum_if, uses_all, zero_sum
from standlens.operators.snapshots import analysis_years as _analysis_years
from standlens.operators.topk import distributed_rank, top_k
from standlens.plans.context import DEPARTMENT, DIVISION, Context

# ---- fixed values: dataset, check and label texts of the workflow ----
FILTER_NAMES = {
    DIVISION: ("Working dataset", "Cover-type analysis dataset"),
    DEPARTMENT: ("Department working dataset", "Department cover-type analysis dataset"),
}
TERRESTRIAL_NAMES = {
    DIVISION: ("Latest snapshot", "Latest terrestrial snapshot"),
    DEPARTMENT: ("Department latest snapshot", "Department latest terrestrial snapshot"),
}
RETENTION_STEPS = ("Department working dataset", "After cover-type screening", "After date screening",
                   "Latest-condition snapshot", "Latest-condition terrestrial snapshot")
WORKFLOWS = ("WLD workflow", "Department workflow Wildlife subset")
CONSISTENCY_CHECKS = (
    "WLD workflow terrestrial acres",
    "Department workflow Wildlife terrestrial acres",
    "Department minus WLD terrestrial acres",
    "WLD workflow terrestrial stands",
    "Department workflow Wildlife terrestrial stands",
    "Department minus WLD terrestrial stands",
    "Stands only in WLD workflow",
    "Stands only in Department workflow",
    "Matching stands with acre differences",
    "Net acre difference among matching stands",
    "Matching stands with L3 cover differences",
    "Matching stands with L4 cover differences",
    "Matching stands with project-class differences",
    "Matching stands with latest-date differences",
)
NEAR_TOLERANCE = 1.4901161193847656e-08  # sqrt of double machine epsilon
FACET_PREFIX = {"Agriculture": "(a) Agriculture\n", "Herbaceous Openland": "(b) Herbaceous Openland\n"}
GROUP_LABELS = ("Top 5", "Top 10", "Top 20")
CATEGORY_TERRESTRIAL = "Inventoried terrestrial acreage"
CATEGORY_CLASS = {"Agriculture": "Inventoried Agriculture", "Herbaceous Openland": "Inventoried Herbaceous Openland"}
CATEGORY_ORDER = ("Inventoried terrestrial acreage", "Inventoried Agriculture", "Inventoried Herbaceous Openland")
# ---- end of fixed values ----


def _n() -> Column:
    return F.count(F.lit(1))


def _stands_acres() -> list[Column]:
    return [_n().alias("stands"), zero_sum("acres").alias("acres")]


def _unit_order() -> Column:
    return F.asc_nulls_last("unit_key")


# ---------------------------------------------------------------- screening
def code_rule_check(ctx: Context) -> DataFrame:
    """SNP-01: counts for full codes starting with the agriculture prefix."""
    return (ctx.division.filter(int_code_has_prefix("l4covertype_full", ctx.p.agriculture_prefix))
            .groupBy("l4covertype_full", "l3covertype", "l3cover_key", "l4cover_key")
            .agg(_n().alias("n")).orderBy(F.desc("n")))


def project_cover_rule_qa(ctx: Context, scope: str) -> DataFrame:
    """SNP-02."""
    return (ctx.scope(scope).cover.filter(F.col("project_cover_class").isNotNull())
            .groupBy("project_cover_class", "cover_code_chr", "l3covertype", "l3cover_key", "l4cover_key")
            .agg(_n().alias("n")).orderBy(F.desc("n")))


def _stage_aggs(df: DataFrame, stages: list[tuple[str, Column | None]], measures: list[str]) -> DataFrame:
    """One pass over ``df``: per stage (a flag, None = every row) the row
    count, distinct stands and acres, as columns ``<measure>_<i>``."""
    aggs = []
    for i, (_, flag) in enumerate(stages):
        f = F.lit(True) if flag is None else F.coalesce(flag, F.lit(False))
        for m in measures:
            if m == "rows":
                aggs.append(F.count_if(f).alias(f"rows_{i}"))
            elif m == "stands":
                aggs.append(F.count_distinct(F.when(f, F.col("fcskey"))).alias(f"stands_{i}"))
            else:
                aggs.append(F.coalesce(F.sum(F.when(f, F.col("acres"))), F.lit(0.0)).alias(f"acres_{i}"))
    return df.agg(*aggs)


def _funnel(parts: list[tuple[DataFrame, list[tuple[str, Column | None]]]], name_col: str,
            names: dict[str, str], pct: dict[str, str]) -> DataFrame:
    """Stage rows from a few passes (each pass covers the stages that are
    filters of the same frame); percents relative to the first stage."""
    measures = list(names)
    one = _stage_aggs(*parts[0], measures)
    for k, (df, stages) in enumerate(parts[1:], 1):       # each further pass is one row: a scalar subquery, run once
        other = _stage_aggs(df, stages, measures)
        one = one.withColumn(f"p{k}", other.select(F.struct(*other.columns)).scalar())
    rows = []
    for k, (_, stages) in enumerate(parts):
        for i, (name, _) in enumerate(stages):
            at = [f"p{k}.{m}_{i}" if k else f"{m}_{i}" for m in measures]
            shares = [f"try_divide(100 * CAST({x} AS DOUBLE), CAST({m}_0 AS DOUBLE))" for x, m in zip(at, measures)]
            rows.append(", ".join([f"'{name}'", *at, *shares]))
    cols = [name_col, *names.values(), *[pct[m] for m in measures]]
    return one.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS ({', '.join(cols)})")


def cover_filter_summary(ctx: Context, scope: str) -> DataFrame:
    """SNP-03."""
    sc = ctx.scope(scope)
    a, b = FILTER_NAMES[scope]
    kept = F.col("l3cover_key").isNotNull() & (F.col("l3covertype") != 0)   # FLT-02 as a flag
    return _funnel([(sc.working, [(a, None), (b, kept)])], "dataset",
                   {"rows": "rows", "stands": "unique_stands", "acres": "acres"},
                   {"rows": "percent_rows_retained", "stands": "percent_stands_retained",
                    "acres": "percent_acres_retained"})


def stands_time_summary(ctx: Context, scope: str) -> DataFrame:
    """SNP-04 (before the stand-year dedup)."""
    return ctx.scope(scope).timed.agg(
        _n().alias("total_rows"), F.count_distinct("fcskey").alias("unique_stands"),
        F.min("inventory_year_raw").alias("min_inventory_year_raw"),
        F.max("inventory_year_raw").alias("max_inventory_year_raw"),
        F.min("inventory_year").alias("min_analysis_year"), F.max("inventory_year").alias("max_analysis_year"))


def records_per_analysis_year(ctx: Context) -> DataFrame:
    """SNP-05."""
    return ctx.div.timed.groupBy("inventory_year").agg(_n().alias("n")).orderBy("inventory_year")


def stand_record_summary(ctx: Context, scope: str) -> DataFrame:
    """SNP-06 (after the dedup: duplicates must be 0)."""
    one = ctx.scope(scope).dedup.agg(
        _n().alias("rows_after_filtering"),
        F.count_distinct("fcskey", "inventory_year_raw").alias("unique_fcskey_years"),
        F.count_distinct("fcskey").alias("unique_stands"))
    return (one.withColumn("duplicate_stand_year_rows", F.col("rows_after_filtering") - F.col("unique_fcskey_years"))
               .withColumn("repeated_stand_rows", F.col("rows_after_filtering") - F.col("unique_stands")))


def repeated_stands(ctx: Context) -> DataFrame:
    """SNP-07."""
    return ctx.div.dedup.groupBy("fcskey").agg(_n().alias("n")).filter("n > 1").orderBy(F.desc("n"))


def analysis_years(ctx: Context, scope: str) -> DataFrame:
    """SET-05."""
    return _analysis_years(ctx.scope(scope).dedup)


# ---------------------------------------------------------------- snapshots
def annual_cover_summary(ctx: Context, scope: str) -> DataFrame:
    """SNP-08: rolling annual snapshot per L3 x authority, one pass."""
    ex = ctx.scope(scope).exploded()
    g = (ex.groupBy("inventory_year", "l3covertype", "l3cover_key", "authority_key")
         .agg(_n().alias("stands_total"), zero_sum("acres").alias("acres_total")))
    wy = Window.partitionBy("inventory_year")   # rows per year: bounded by cover x authority domains
    return (g.withColumn("total_stands_all_cover", F.sum("stands_total").over(wy))
             .withColumn("total_acres_all_cover", F.sum("acres_total").over(wy))
             .withColumn("percent_of_total_stands", ratio(100 * F.col("stands_total"), "total_stands_all_cover"))
             .withColumn("percent_of_total_acres", ratio(100 * F.col("acres_total"), "total_acres_all_cover"))
             .withColumn("year_label", year_label("inventory_year", ctx.p)))


def _annual_order() -> list[Column]:
    return [F.asc("inventory_year"), F.asc_nulls_last("l3covertype"), F.asc_nulls_last("l3cover_key"),
            F.asc_nulls_last("authority_key")]


def annual_total_summary(ctx: Context, scope: str) -> DataFrame:
    """SNP-09."""
    return (annual_cover_summary(ctx, scope)
            .select("inventory_year", "year_label", "total_stands_all_cover", "total_acres_all_cover")
            .distinct().orderBy("inventory_year"))


def annual_head(ctx: Context) -> DataFrame:
    """SNP-10: first ten rows of the annual series."""
    return annual_cover_summary(ctx, DIVISION).orderBy(*_annual_order()).limit(10)


def annual_tail(ctx: Context) -> DataFrame:
    """SNP-10: last ten rows of the annual series."""
    rev = [F.desc("inventory_year"), F.desc_nulls_first("l3covertype"), F.desc_nulls_first("l3cover_key"),
           F.desc_nulls_first("authority_key")]
    return annual_cover_summary(ctx, DIVISION).orderBy(*rev).limit(10).orderBy(*_annual_order())


def annual_ranges(ctx: Context) -> DataFrame:
    """SNP-10: ranges of the annual totals."""
    return annual_cover_summary(ctx, DIVISION).agg(
        F.min("total_stands_all_cover").alias("min_total_stands_all_cover"),
        F.max("total_stands_all_cover").alias("max_total_stands_all_cover"),
        F.min("total_acres_all_cover").alias("min_total_acres_all_cover"),
        F.max("total_acres_all_cover").alias("max_total_acres_all_cover"),
        F.min("acres_total").alias("min_cover_acres"), F.max("acres_total").alias("max_cover_acres"))


def annual_groups_per_year(ctx: Context) -> DataFrame:
    """SNP-10: groups per year."""
    return annual_cover_summary(ctx, DIVISION).groupBy("inventory_year").agg(_n().alias("n")).orderBy("inventory_year")


def department_snapshot_summary(ctx: Context) -> DataFrame:
    """SNP-11."""
    return ctx.dept.latest.agg(
        _n().alias("snapshot_stands"), F.count_distinct("fcskey").alias("snapshot_unique_stands"),
        zero_sum("acres").alias("snapshot_acres"), F.min("inventory_year_raw").alias("min_inventory_year"),
        F.max("inventory_year_raw").alias("max_inventory_year"))


def latest_totals(ctx: Context) -> DataFrame:
    """SNP-11: division latest snapshot totals (equal the last annual totals)."""
    return ctx.div.latest.agg(_n().alias("latest_snapshot_stands"), zero_sum("acres").alias("latest_snapshot_acres"))


def terrestrial_filter_summary(ctx: Context, scope: str) -> DataFrame:
    """SNP-12."""
    sc = ctx.scope(scope)
    a, b = TERRESTRIAL_NAMES[scope]
    land = F.col("l3cover_key") != ctx.p.water_label                       # FLT-05 as a flag
    return _funnel([(sc.latest_labelled, [(a, None), (b, land)])], "dataset",
                   {"rows": "stands", "acres": "acres"},
                   {"rows": "percent_stands_retained", "acres": "percent_acres_retained"})


def department_retention(ctx: Context) -> DataFrame:
    """SNP-13: five-step funnel of the department scope."""
    d = ctx.dept
    s1, s2, s3, s4, s5 = RETENTION_STEPS
    kept = F.col("l3cover_key").isNotNull() & (F.col("l3covertype") != 0)
    land = F.col("l3cover_key") != ctx.p.water_label
    return _funnel([(d.working, [(s1, None), (s2, kept)]), (d.dedup, [(s3, None)]),
                    (d.latest_labelled, [(s4, None), (s5, land)])], "step",
                   {"rows": "rows_or_stands", "stands": "unique_stands", "acres": "acres"},
                   {"rows": "percent_rows_or_stands_retained", "stands": "percent_unique_stands_retained",
                    "acres": "percent_acres_retained"})


def cover_latest_l3(ctx: Context) -> DataFrame:
    """SNP-14: last analysis year, largest first."""
    a = annual_cover_summary(ctx, DIVISION)
    last = a.agg(F.max("inventory_year")).scalar()
    return (a.filter(F.col("inventory_year") == last)
            .orderBy(F.desc("acres_total"), *_annual_order()[1:])
            .select("inventory_year", "authority_key", "l3covertype", "l3cover_key", "stands_total",
                    "acres_total", "percent_of_total_stands", "percent_of_total_acres"))


def annual_cover_top(ctx: Context) -> DataFrame:
    """SNP-15: annual series of the 12 largest L3 types of the last year."""
    a = annual_cover_summary(ctx, DIVISION)
    top = cover_latest_l3(ctx).limit(ctx.p.latest_top_k).select("l3cover_key").distinct()
    return a.join(F.broadcast(top), "l3cover_key", "left_semi")   # at most k rows


# ---------------------------------------------------------------- cross-scope check
def _compare_frame(df: DataFrame) -> DataFrame:
    """PRJ-21 + PRJ-09: key as text, acres as double, comparison columns."""
    return df.select(F.col("fcskey").cast("string").alias("fcskey"), F.col("acres").cast("double").alias("acres"),
                     "l3cover_key", "l4cover_key", "project_cover_class", "date", "inventory_year_raw")


def wld_compare(ctx: Context) -> DataFrame:
    return _compare_frame(ctx.div.terrestrial)


def department_wld_compare(ctx: Context) -> DataFrame:
    t = ctx.dept.terrestrial.filter(F.col("authority_key").isin(*ctx.p.division))
    return _compare_frame(t)


def snapshot_total_compare(ctx: Context) -> DataFrame:
    """SNP-16."""
    out = None
    for name, df in zip(WORKFLOWS, (wld_compare(ctx), department_wld_compare(ctx))):
        r = df.agg(F.lit(name).alias("workflow"), _n().alias("stands"),
                   F.count_distinct("fcskey").alias("unique_stands"), zero_sum("acres").alias("acres"))
        out = r if out is None else out.unionByName(r)
    return out


def wld_only_stands(ctx: Context) -> DataFrame:
    """JN-06: stands only in the division workflow."""
    return wld_compare(ctx).join(department_wld_compare(ctx).select("fcskey"), "fcskey", "left_anti")


def department_only_stands(ctx: Context) -> DataFrame:
    """JN-06: stands only in the department workflow's division subset."""
    return department_wld_compare(ctx).join(wld_compare(ctx).select("fcskey"), "fcskey", "left_anti")


def _suffixed(df: DataFrame, suffix: str) -> DataFrame:
    """PRJ-20: suffix every non-key column."""
    return df.select("fcskey", *[F.col(c).alias(c + suffix) for c in df.columns if c != "fcskey"])


def matching_stands_compare(ctx: Context) -> DataFrame:
    """JN-07 + SNP-17."""
    a = _suffixed(wld_compare(ctx), "_wld")
    b = _suffixed(department_wld_compare(ctx), "_department")
    m = a.join(b, "fcskey", "inner")
    miss = ctx.p.missing_label

    def same(c):
        return F.coalesce(F.col(c + "_department"), F.lit(miss)) == F.coalesce(F.col(c + "_wld"), F.lit(miss))

    return (m.withColumn("acre_difference", F.col("acres_department") - F.col("acres_wld"))
             .withColumn("same_acres", F.abs(F.col("acres_department") - F.col("acres_wld")) < NEAR_TOLERANCE)
             .withColumn("same_l3cover", same("l3cover_key"))
             .withColumn("same_l4cover", same("l4cover_key"))
             .withColumn("same_project_cover_class", same("project_cover_class"))
             .withColumn("same_date", F.col("date_department") == F.col("date_wld")))


def consistency_summary(ctx: Context) -> DataFrame:
    """SNP-18: fourteen check / value rows. Both snapshots hold one row per
    stand, so one full outer join on the stand key yields every count in a
    single aggregate pass (no pass per check)."""
    a = _suffixed(wld_compare(ctx), "_wld").withColumn("__w", F.lit(True))
    b = _suffixed(department_wld_compare(ctx), "_department").withColumn("__d", F.lit(True))
    j = a.join(b, "fcskey", "full_outer")
    inw, ind = F.coalesce(F.col("__w"), F.lit(False)), F.coalesce(F.col("__d"), F.lit(False))
    both = inw & ind
    miss = ctx.p.missing_label

    def differs(c):
        same = F.coalesce(F.col(c + "_department"), F.lit(miss)) == F.coalesce(F.col(c + "_wld"), F.lit(miss))
        return count_if(both & ~same)

    diff_acres = F.col("acres_department") - F.col("acres_wld")
    wa = F.coalesce(F.sum(F.when(inw, F.col("acres_wld"))), F.lit(0.0))
    da = F.coalesce(F.sum(F.when(ind, F.col("acres_department"))), F.lit(0.0))
    values = [
        wa, da, da - wa, count_if(inw), count_if(ind), count_if(ind) - count_if(inw),
        count_if(inw & ~ind), count_if(ind & ~inw),
        count_if(both & ~(F.abs(diff_acres) < NEAR_TOLERANCE)),
        F.coalesce(F.sum(F.when(both, diff_acres)), F.lit(0.0)),
        differs("l3cover_key"), differs("l4cover_key"), differs("project_cover_class"),
        count_if(both & ~(F.col("date_department") == F.col("date_wld"))),
    ]
    one = j.agg(*[v.cast("double").alias(f"v{i}") for i, v in enumerate(values)])
    parts = ", ".join(f"'{name}', v{i}" for i, name in enumerate(CONSISTENCY_CHECKS))
    return one.selectExpr(f"stack({len(CONSISTENCY_CHECKS)}, {parts}) AS (check, value)")


# ---------------------------------------------------------------- project classes
def _classed(ctx: Context) -> DataFrame:
    """FLT-08 on the division terrestrial snapshot."""
    return ctx.div.terrestrial.filter(F.col("project_cover_class").isNotNull())


def class_units(ctx: Context) -> DataFrame:
    """The terrestrial snapshot by class (none included) and unit: what the class and area tables are sums of."""
    return ctx.div.terrestrial.groupBy("project_cover_class", "unit_key").agg(*_stands_acres())


def project_cover_summary(ctx: Context, ordered: bool = True, units: DataFrame | None = None) -> DataFrame:
    """SNP-19."""
    # with the records of no class; told apart by an aggregate, which keeps the filter above the shared shuffle
    flag = F.max("project_cover_class").alias("__class")
    if units is None:
        every = ctx.div.terrestrial.groupBy("project_cover_class").agg(*_stands_acres(), flag)
    else:
        every = units.groupBy("project_cover_class").agg(F.sum("stands").alias("stands"), F.sum("acres").alias("acres"), flag)
    g = every.filter(F.col("__class").isNotNull())
    for c in ("stands", "acres"):
        g = g.withColumn(f"percent_terrestrial_{c}", ratio(100 * F.col(c), scalar_total(every, F.sum(c))))
    g = g.drop("__class")
    return g.orderBy(F.desc("acres")) if ordered else g


def annual_project_cover_summary(ctx: Context) -> DataFrame:
    """SNP-20: per year, classes against that year's terrestrial snapshot.
    Water is removed after the interval step (a stand whose newest record
    that year is water drops out of that year)."""
    ex = ctx.div.exploded().filter(F.col("l3cover_key") != ctx.p.water_label)
    g = ex.groupBy("inventory_year", "project_cover_class").agg(*_stands_acres())
    wy = Window.partitionBy("inventory_year")   # <= classes + 1 rows per year
    g = (g.withColumn("total_terrestrial_stands", F.sum("stands").over(wy))
          .withColumn("total_terrestrial_acres", F.sum("acres").over(wy))
          .filter(F.col("project_cover_class").isNotNull()))
    return (g.withColumn("percent_terrestrial_stands", ratio(100 * F.col("stands"), "total_terrestrial_stands"))
             .withColumn("percent_terrestrial_acres", ratio(100 * F.col("acres"), "total_terrestrial_acres"))
             .withColumn("year_label", year_label("inventory_year", ctx.p))
             .orderBy("inventory_year", "project_cover_class"))


def _composition(df: DataFrame, keys: list, out: str, ordered: bool) -> DataFrame:
    g = df.groupBy(*keys).agg(*_stands_acres())
    tot = scalar_total(g, F.sum("acres"))
    g = g.withColumn(out, ratio(100 * F.col("acres"), tot))
    return g.orderBy(F.desc("acres")) if ordered else g


def agriculture_composition(ctx: Context, ordered: bool = True) -> DataFrame:
    """SNP-21."""
    a = ctx.div.terrestrial.filter(F.col("project_cover_class") == ctx.p.agriculture_class)
    return _composition(a, ["l3covertype", "l3cover_key"], "percent_of_agriculture_acres", ordered)


def openland_composition(ctx: Context, ordered: bool = True) -> DataFrame:
    """SNP-22."""
    h = ctx.div.terrestrial.filter(F.col("project_cover_class") == ctx.p.openland_label)
    return _composition(h, [missing_as("l4cover_key", ctx.p.missing_label).alias("l4cover_key")],
                        "percent_of_openland_acres", ordered)


def composition_plot(ctx: Context) -> DataFrame:
    """SNP-23: both compositions stacked with class totals and headings."""
    a = agriculture_composition(ctx, ordered=False).select(
        F.lit(ctx.p.agriculture_class).alias("project_cover_class"), F.col("l3cover_key").alias("cover_type"),
        "acres", F.col("percent_of_agriculture_acres").alias("percent_class_acres"))
    h = openland_composition(ctx, ordered=False).select(
        F.lit(ctx.p.openland_label).alias("project_cover_class"), F.col("l4cover_key").alias("cover_type"),
        "acres", F.col("percent_of_openland_acres").alias("percent_class_acres"))
    u = a.unionByName(h)
    u = u.withColumn("total_class_acres", F.sum("acres").over(Window.partitionBy("project_cover_class")))
    label = F.col("project_cover_class")
    for cls, prefix in FACET_PREFIX.items():
        label = F.when(F.col("project_cover_class") == cls,
                       F.concat(F.lit(prefix), comma("total_class_acres"), F.lit(" ac"))).otherwise(label)
    return u.withColumn("facet_label", label)


def stand_size_summary(ctx: Context) -> DataFrame:
    """SNP-24 (exported column order). Quartiles come from the distributed
    exact method: each class can hold most of the records."""
    from standlens.operators.stats import quantile_frame
    c = _classed(ctx)
    j = quantile_frame(c, ["project_cover_class"], "acres", [0.25, 0.5, 0.75], ctx.p.quantile_method, ctx.p.quantile_accuracy, [
        _n().alias("stands"), F.min("acres").alias("min_acres"), F.avg("acres").alias("mean_acres"),
        F.max("acres").alias("max_acres"), F.stddev_samp("acres").alias("sd_acres")])
    return j.select("project_cover_class", "stands", "min_acres", F.col("q_0_25").alias("q1_acres"),
                    F.col("q_0_5").alias("median_acres"), "mean_acres", F.col("q_0_75").alias("q3_acres"),
                    "max_acres", "sd_acres")


def size_distribution(ctx: Context) -> DataFrame:
    """SNP-25: class x size class (null acres land in the last class)."""
    g = (_classed(ctx).groupBy("project_cover_class",
                               size_class("acres", ctx.p, SIZE_LABELS_ANALYSIS).alias("size_class"))
         .agg(_n().alias("n")))
    w = Window.partitionBy("project_cover_class")   # <= 5 size classes per class
    return (g.withColumn("percent_stands", ratio(100 * F.col("n"), F.sum("n").over(w)))
             .orderBy("project_cover_class",
                      level_order("size_class", labels_for(ctx.p.size_breaks, SIZE_LABELS_ANALYSIS, "acres"))))


# ---------------------------------------------------------------- management areas
def management_area_summary(ctx: Context, ordered: bool = True, units: DataFrame | None = None) -> DataFrame:
    """SNP-26: class x unit, share of the class's acres."""
    if units is None:
        g = _classed(ctx).groupBy("project_cover_class", "unit_key").agg(*_stands_acres())
    else:
        g = units.filter(F.col("project_cover_class").isNotNull())
    tot = _per_class(g, F.sum("acres").alias("__tot"))
    g = g.join(F.broadcast(tot), "project_cover_class")
    g = g.withColumn("percent_category_acres", ratio(100 * F.col("acres"), "__tot")).drop("__tot")
    return g.orderBy("project_cover_class", F.desc("acres"), _unit_order()) if ordered else g


def _per_class(m: DataFrame, *aggs: Column) -> DataFrame:
    """One row per class; it needs every column of ``m``, so that what ``m`` is made of is computed once."""
    return (m.groupBy("project_cover_class").agg(*aggs, uses_all(m).alias("__all"))
            .filter(F.col("__all").isNotNull()).drop("__all"))


def top_management_areas(ctx: Context) -> DataFrame:
    """SNP-26: top 15 units per class by acres, ties broken by unit."""
    return top_k(management_area_summary(ctx, ordered=False), ["project_cover_class"], [F.desc("acres"), _unit_order()],
                 ctx.p.area_top_k, ties=False)


def management_area_proportion(ctx: Context, ordered: bool = True, units: DataFrame | None = None) -> DataFrame:
    """SNP-27: per unit and class, acres and share of the unit's acres."""
    agri, herb = ctx.p.project_classes
    cls = F.col("project_cover_class")
    if units is None:
        t, n = ctx.div.terrestrial, lambda c: count_if(cls == c)
    else:
        t, n = units, lambda c: F.coalesce(F.sum(F.when(cls == c, F.col("stands"))), F.lit(0).cast("long"))
    g = t.groupBy("unit_key").agg(
        zero_sum("acres").alias("total_unit_acres"),
        sum_if(cls == agri, "acres").alias("a_acres"), n(agri).alias("a_stands"),
        sum_if(cls == herb, "acres").alias("h_acres"), n(herb).alias("h_stands"))
    long = g.selectExpr("unit_key", "total_unit_acres",
                        f"stack(2, '{agri}', a_acres, a_stands, '{herb}', h_acres, h_stands) "
                        "AS (project_cover_class, category_acres, category_stands)")
    out = (long.filter(F.col("category_acres") > 0)
           .withColumn("percent_unit_acres", ratio(100 * F.col("category_acres"), "total_unit_acres"))
           .select("unit_key", "project_cover_class", "total_unit_acres", "category_stands", "category_acres",
                   "percent_unit_acres"))
    return out.orderBy("project_cover_class", F.desc("percent_unit_acres"), _unit_order()) if ordered else out


def top_management_area_proportion(ctx: Context) -> DataFrame:
    """SNP-27: top 15 units per class by share of unit acres."""
    return top_k(management_area_proportion(ctx, ordered=False), ["project_cover_class"],
                 [F.desc("percent_unit_acres"), _unit_order()], ctx.p.area_top_k, ties=False)


def _full_units(ctx: Context) -> DataFrame:
    t = ctx.div.terrestrial
    agri, herb = ctx.p.project_classes
    cls = F.col("project_cover_class")
    g = t.groupBy("unit_key").agg(
        _n().alias("total_terrestrial_stands"), zero_sum("acres").alias("total_terrestrial_acres"),
        count_if(cls == agri).alias("agriculture_stands"), sum_if(cls == agri, "acres").alias("agriculture_acres"),
        count_if(cls == herb).alias("herbaceous_openland_stands"),
        sum_if(cls == herb, "acres").alias("herbaceous_openland_acres"))
    tot = F.col("total_terrestrial_acres")
    both = F.col("agriculture_acres") + F.col("herbaceous_openland_acres")
    return (g.withColumn("agriculture_percent_terrestrial_acres", ratio(100 * F.col("agriculture_acres"), tot))
             .withColumn("herbaceous_openland_percent_terrestrial_acres",
                         ratio(100 * F.col("herbaceous_openland_acres"), tot))
             .withColumn("agriculture_and_herbaceous_openland_acres", both)
             .withColumn("agriculture_and_herbaceous_openland_percent_terrestrial_acres",
                         ratio(100 * both, tot)))


def _full_order() -> list[Column]:
    return [F.desc("agriculture_and_herbaceous_openland_acres"), F.desc("total_terrestrial_acres"),
            F.asc_nulls_last("unit_key")]
FULL_COLUMNS = ["management_area_rank_by_project_cover_acres", "unit_key", "total_terrestrial_acres",
                "total_terrestrial_stands", "agriculture_acres", "agriculture_stands",
                "agriculture_percent_terrestrial_acres", "herbaceous_openland_acres", "herbaceous_openland_stands",
                "herbaceous_openland_percent_terrestrial_acres", "agriculture_and_herbaceous_openland_acres",
                "agriculture_and_herbaceous_openland_percent_terrestrial_acres"]


def management_area_full(ctx: Context) -> DataFrame:
    """SNP-28: every unit with its rank by combined class acres. The rank is
    computed without collapsing the unit table into one task."""
    r = distributed_rank(_full_units(ctx), [], "agriculture_and_herbaceous_openland_acres", _full_order(),
                         "management_area_rank_by_project_cover_acres",
                         then=[-F.col("total_terrestrial_acres"), F.col("unit_key").isNull(), F.col("unit_key")])
    return r.select(*FULL_COLUMNS).orderBy("management_area_rank_by_project_cover_acres")


def management_area_report(ctx: Context) -> DataFrame:
    """SNP-29: first 15 ranks with their share of the combined acres."""
    full = _full_units(ctx)
    tot = scalar_total(full, zero_sum("agriculture_and_herbaceous_openland_acres"))
    top = full.orderBy(*_full_order()).limit(ctx.p.area_top_k)      # bounded take-ordered top-k
    top = top.withColumn("management_area_rank_by_project_cover_acres",
                         F.row_number().over(Window.orderBy(*_full_order())))   # k rows only
    return (top.withColumn("percent_of_wld_combined_project_cover_acres",
                           ratio(100 * F.col("agriculture_and_herbaceous_openland_acres"), tot))
               .select("management_area_rank_by_project_cover_acres", "unit_key",
                       "agriculture_and_herbaceous_openland_acres", "percent_of_wld_combined_project_cover_acres",
                       "agriculture_and_herbaceous_openland_percent_terrestrial_acres")
               .orderBy("management_area_rank_by_project_cover_acres"))


def acre_concentration(ctx: Context) -> DataFrame:
    """SNP-30: per class, rank, running acres and cumulative percent."""
    m = management_area_summary(ctx, ordered=False).drop("percent_category_acres")
    r = distributed_rank(m, ["project_cover_class"], "acres", [F.desc("acres"), _unit_order()], "rank",
                         running="acres", running_col="cumulative_acres", total_col="total_category_acres",
                         then=[F.col("unit_key").isNull(), F.col("unit_key")])
    return (r.withColumn("cumulative_percent", ratio(100 * F.col("cumulative_acres"), "total_category_acres"))
             .orderBy("project_cover_class", "rank"))


def acre_concentration_table(ctx: Context, m: DataFrame | None = None) -> DataFrame:
    """SNP-31: cumulative percent held by the top 5 / 10 / 20 units. Only the
    top max(k) units per class are ranked (WindowGroupLimit)."""
    m = management_area_summary(ctx, ordered=False) if m is None else m
    cuts = ctx.p.concentration_cuts
    kmax = max(cuts)
    order = [F.desc("acres"), _unit_order()]
    w = Window.partitionBy("project_cover_class").orderBy(*order)
    top = (m.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= kmax)
             .withColumn("cumulative_acres", F.sum("acres").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    per = _per_class(m, F.sum("acres").alias("__tot"), _n().alias("total_management_areas"))
    top = top.join(F.broadcast(per), "project_cover_class")
    top = top.withColumn("cumulative_percent", ratio(100 * F.col("cumulative_acres"), "__tot"))
    aggs = [F.max(F.when(F.col("rank") <= k, F.col("cumulative_percent"))).alias(f"top_{k}_percent") for k in cuts]
    return top.groupBy("project_cover_class").agg(*aggs, F.max("total_management_areas").alias("total_management_areas"))


def acre_concentration_long(ctx: Context) -> DataFrame:
    """SNP-32."""
    t = acre_concentration_table(ctx)
    cuts = ctx.p.concentration_cuts
    parts = ", ".join(f"'Top {k}', top_{k}_percent" for k in cuts)
    return (t.selectExpr("project_cover_class", f"stack({len(cuts)}, {parts}) AS (largest_area_group, "
                         "percent_category_acres)")
             .orderBy("project_cover_class", level_order("largest_area_group", [f"Top {k}" for k in cuts])))


def top_area_by_acres(ctx: Context, m: DataFrame | None = None) -> DataFrame:
    """SNP-33."""
    m = management_area_summary(ctx, ordered=False) if m is None else m
    return (top_k(m, ["project_cover_class"], [F.desc("acres"), _unit_order()], 1, False)
            .select("project_cover_class", F.col("unit_key").alias("top_area_by_acres"),
                    F.col("acres").alias("top_area_acres"),
                    F.col("percent_category_acres").alias("top_area_percent_category_acres")))


def top_area_by_percent(ctx: Context, units: DataFrame | None = None) -> DataFrame:
    """SNP-33."""
    return (top_k(management_area_proportion(ctx, ordered=False, units=units), ["project_cover_class"],
                  [F.desc("percent_unit_acres"), _unit_order()], 1, False)
            .select("project_cover_class", F.col("unit_key").alias("top_area_by_percent"),
                    F.col("percent_unit_acres").alias("top_area_percent_unit_acres"),
                    F.col("category_acres").alias("top_area_by_percent_acres")))


def category_report(ctx: Context) -> DataFrame:
    """JN-08: the unformatted class report. Its parts read the table by class and unit from one shuffle, and nothing is kept; only the
    median needs the records besides. Every joined table has at most one row per class, so each join is a bounded broadcast."""
    units = one_shuffle(class_units(ctx))
    j = project_cover_summary(ctx, ordered=False, units=units)
    size = stand_size_summary(ctx).select("project_cover_class", "mean_acres", "median_acres")
    m = management_area_summary(ctx, ordered=False, units=units)
    for other in (size, top_area_by_acres(ctx, m), top_area_by_percent(ctx, units), acre_concentration_table(ctx, m)):
        j = j.join(F.broadcast(other), "project_cover_class", "left")
    return j


def report_summary(ctx: Context) -> DataFrame:
    """SNP-34: the class report, formatted."""
    j = category_report(ctx)
    fa, fp = format_acres, format_percent_value
    return j.select(
        "project_cover_class", fa("acres").alias("acres"), format_count("stands").alias("stands"),
        fp("percent_terrestrial_stands").alias("percent_terrestrial_stands"),
        fp("percent_terrestrial_acres").alias("percent_terrestrial_acres"),
        fa("mean_acres").alias("mean_acres"), fa("median_acres").alias("median_acres"),
        "top_area_by_acres", fa("top_area_acres").alias("top_area_acres"),
        fp("top_area_percent_category_acres").alias("top_area_percent_category_acres"),
        "top_area_by_percent", fp("top_area_percent_unit_acres").alias("top_area_percent_unit_acres"),
        fa("top_area_by_percent_acres").alias("top_area_by_percent_acres"),
        *[fp(f"top_{k}_percent").alias(f"top_{k}_percent") for k in ctx.p.concentration_cuts],
        "total_management_areas").orderBy(F.desc("acres"))


# ---------------------------------------------------------------- department context
def department_authority_context(ctx: Context) -> DataFrame:
    """SNP-35: per authority (a bounded domain): acres, share, rank; rounded
    half-even after ranking."""
    t = ctx.dept.terrestrial
    g = t.groupBy("authority_key").agg(_n().alias("stands"), F.count_distinct("fcskey").alias("unique_stands"),
                                       zero_sum("acres").alias("terrestrial_acres"))
    g = g.withColumn("percent_department_terrestrial_acres",
                     ratio(100 * F.col("terrestrial_acres"), scalar_total(g, F.sum("terrestrial_acres"))))
    w = Window.orderBy(F.desc("terrestrial_acres"), F.asc_nulls_last("authority_key"))
    return (g.withColumn("authority_acre_rank", F.row_number().over(w))
             .withColumn("terrestrial_acres", F.bround("terrestrial_acres", 0))
             .withColumn("percent_department_terrestrial_acres", F.bround("percent_department_terrestrial_acres", 1))
             .select("authority_acre_rank", "authority_key", "terrestrial_acres",
                     "percent_department_terrestrial_acres", "stands", "unique_stands")
             .orderBy("authority_acre_rank"))


def class_authority(ctx: Context) -> DataFrame:
    """Class x authority with the totals of both levels, from one scan: the records are summed by class (none included) and
    authority, and windows over that small table add the land base of the authority and then the class."""
    g = ctx.dept.terrestrial.groupBy("project_cover_class", "authority_key").agg(
        _n().alias("stands"), F.count_distinct("fcskey").alias("unique_stands"), zero_sum("acres").alias("acres"))
    land = Window.partitionBy("authority_key")
    g = g.withColumn("total_authority_terrestrial_acres", F.sum("acres").over(land)).filter(F.col("project_cover_class").isNotNull())
    return g.withColumn("total_department_class_acres", F.sum("acres").over(Window.partitionBy("project_cover_class")))


def department_class_authority_context(ctx: Context, ordered: bool = True) -> DataFrame:
    """SNP-36 + JN-09: class x authority, share of the class and of the
    authority's terrestrial land base; rounded half-even."""
    g = class_authority(ctx)
    g = g.withColumn("percent_department_class_acres", ratio(100 * F.col("acres"), "total_department_class_acres"))
    g = g.withColumn("percent_authority_terrestrial_landbase",
                     ratio(100 * F.col("acres"), "total_authority_terrestrial_acres"))
    if ordered:
        g = g.orderBy("project_cover_class", F.desc("acres"))
    return (g.withColumn("acres", F.bround("acres", 0))
             .withColumn("total_department_class_acres", F.bround("total_department_class_acres", 0))
             .withColumn("percent_department_class_acres", F.bround("percent_department_class_acres", 1))
             .withColumn("total_authority_terrestrial_acres", F.bround("total_authority_terrestrial_acres", 0))
             .withColumn("percent_authority_terrestrial_landbase",
                         F.bround("percent_authority_terrestrial_landbase", 1))
             .select("project_cover_class", "authority_key", "acres", "percent_department_class_acres",
                     "total_department_class_acres", "percent_authority_terrestrial_landbase",
                     "total_authority_terrestrial_acres", "stands", "unique_stands"))


def authority_comparison(ctx: Context) -> DataFrame:
    """SNP-37: three divisions only; shares re-based to 100% for the land base
    and for each class (computed from the rounded acres, as published)."""
    c = department_class_authority_context(ctx, ordered=False).filter(F.col("authority_key").isin(*ctx.p.comparison_divisions))
    cat = F.lit(None).cast("string")
    for cls, name in CATEGORY_CLASS.items():
        cat = F.when(F.col("project_cover_class") == cls, F.lit(name)).otherwise(cat)
    # a row for the class and one for the land base, which the classes of an authority repeat
    both = F.array(F.struct(cat.alias("category"), F.col("acres")),
                   F.struct(F.lit(CATEGORY_TERRESTRIAL).alias("category"), F.col("total_authority_terrestrial_acres").alias("acres")))
    u = c.select("authority_key", F.inline(both)).filter(F.col("category").isNotNull())
    u = u.groupBy("category", "authority_key").agg(F.max("acres").alias("acres"))
    u = u.withColumn("percent_acres", ratio(100 * F.col("acres"), F.sum("acres").over(Window.partitionBy("category"))))
    return u.orderBy(level_order("category", CATEGORY_ORDER), level_order("authority_key", ctx.p.comparison_divisions))


def authority_comparison_check(ctx: Context) -> DataFrame:
    """SNP-37 check: every category sums to 100."""
    return authority_comparison(ctx).groupBy("category").agg(F.coalesce(F.sum("percent_acres"), F.lit(0.0))
                                                             .alias("total_percent"))
