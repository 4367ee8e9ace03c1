"""Exact quantiles in two scans, without a sort and without gathering a group's values in one task.

``percentile`` merges, per group, a map of every distinct value in a single task; when one group holds most of the data and the
values are continuous, that map grows with the data. Here:

1. the first scan counts each group and brackets each target between two sketch quantiles (``percentile_approx``, whose error
   in rank is at most n / accuracy), MARGIN such errors below and above; groups of fewer than SMALL values are bracketed whole;
2. the second scan counts what lies below each bracket and counts the values inside it, about 2 * MARGIN / ACCURACY of the
   group, value by value (partial before the shuffle);
3. running counts over the few values inside give the two order statistics around the position (n - 1) * p, and the
   quantile interpolates them exactly like ``percentile`` (R type 7).

The counts also tell whether a bracket was right. ``exact_quantiles`` plans two scans and nothing else; if a bracket missed, or holds more
than BOUND different values, the query fails and says so. ``narrowed_quantiles`` runs as many scans as it takes: every bracket is
verified, a bracket that missed moves, one that holds too much narrows, and only then are its values ranked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY, MARGIN, SMALL = 20_000, 4, 20_000
#: Different values of a bracket that one task ranks, and the cells that a narrowing scan divides a bracket into.
BOUND, CELLS = 1_000_000, 64


def _name(p: float) -> str:
    return f"q_{str(p).replace('.', '_')}"


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float],
                    extra: Sequence[Column] = (), again: DataFrame | None = None) -> DataFrame:
    """One row per group with columns ``q_<p>`` (nulls ignored; null for a group without values) and the ``extra`` aggregates,
    which the first scan computes along. The groups must be few: their brackets are broadcast. ``again``: what the second scan
    reads, if the same values can be had without the joins that only ``extra`` needs."""
    by = list(by)
    v = F.col(value).cast("double")
    slack = MARGIN / ACCURACY
    ends = [e for p in probs for e in (max(0.0, p - slack), min(1.0, p + slack))]
    # one rank is more than the margin where a group is small: there the bracket is all of it
    bracket = F.when(F.count(v) < SMALL, F.array(*[F.min(v), F.max(v)] * len(probs))).otherwise(F.percentile_approx(v, ends, ACCURACY))
    first = df.groupBy(*by).agg(F.count(v).alias("__n"), bracket.alias("__b"), *extra)
    # the few groups as one array, a scalar subquery: however often it is used, Spark runs the first scan once
    table = first.agg(F.collect_list(F.struct(*first.columns)).alias("a")).scalar()

    def groups(prefix: str, *cols: str) -> DataFrame:
        one = df.sparkSession.range(1).select(table.alias("a")).select(F.inline("a"))
        return F.broadcast(one.select(*[F.col(c).alias(prefix + c) for c in by], *cols))

    def same(prefix: str) -> list[Column]:
        return [F.col(c).eqNullSafe(F.col(prefix + c)) for c in by]

    rows = (df if again is None else again).select(*by, v.alias("__v")).filter(F.col("__v").isNotNull())
    rows = rows.join(groups("__g_", "__b"), same("__g_")) if by else rows.withColumn("__b", F.get(table, F.lit(0)).getField("__b"))
    # per target: the value if it lies in the bracket, null if below it
    lo, hi = (lambda i: F.col("__b")[2 * i]), (lambda i: F.col("__b")[2 * i + 1])
    hits = F.filter(F.array(*[F.when(F.col("__v") <= hi(i), F.struct(F.lit(i).alias("i"), F.when(F.col("__v") >= lo(i), F.col("__v")).alias("x")))
                              for i in range(len(probs))]), lambda h: h.isNotNull())
    counted = (rows.select(*by, F.explode(hits).alias("__h")).groupBy(*by, F.col("__h.i").alias("__i"), F.col("__h.x").alias("__x"))
               .agg(F.count(F.lit(1)).alias("__c")))
    each = Window.partitionBy(*by, "__i")
    run = each.orderBy(F.asc_nulls_first("__x"))
    placed = counted.withColumn("__last", F.sum("__c").over(run) - 1).withColumn("__first", F.col("__last") - F.col("__c") + 1)
    placed = (placed.join(groups("__g_", "__n"), same("__g_")) if by
              else placed.withColumn("__n", F.get(table, F.lit(0)).getField("__n")))
    placed = placed.withColumn("__values", F.count("__x").over(each))
    aggs = [F.max("__values").alias("__values")]
    for i, p in enumerate(probs):
        pos = (F.col("__n") - 1).cast("double") * F.lit(float(p))
        for end, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            aggs.append(F.max(F.when((F.col("__i") == i) & (F.col("__first") <= at) & (at <= F.col("__last")), F.col("__x"))).alias(f"__{end}_{i}"))
    found = placed.groupBy(*by).agg(*aggs)
    others = [c for c in first.columns if c not in (*by, "__n", "__b")]
    if by:
        out = groups("__s_", "__n", *others).join(found, same("__s_"), "left")
    else:
        # one subquery, taken apart in the next step: written once per field it could run once per field
        out = groups("__s_", "__n", *others).withColumn("__f", found.select(F.struct(*found.columns)).scalar())
        out = out.select("*", "__f.*").drop("__f")
    cols = [F.col(f"__s_{c}").alias(c) for c in by]
    for i, p in enumerate(probs):
        pos = (F.col("__n") - 1).cast("double") * F.lit(float(p))
        a, b, xl, xh = F.floor(pos), F.ceil(pos), F.col(f"__lo_{i}"), F.col(f"__hi_{i}")
        wrong = (F.col("__n") > 0) & (xl.isNull() | xh.isNull() | (F.col("__values") > BOUND))
        fail = F.raise_error(F.lit("the bracket of a quantile missed or holds too much; use quantile_method='narrowing'")).cast("double")
        cols.append(F.when(wrong, fail).when(a == b, xl).otherwise((b - pos) * xl + (pos - a) * xh).alias(_name(p)))
    return out.select(*cols, *others)


class _Target:
    """One order statistic of one group (counted from 0), the bracket to be tried next, and what surely encloses it."""

    def __init__(self, group: int, rank: int, least: float, most: float, lo: float, hi: float) -> None:
        self.group, self.rank = group, rank
        self.outer, self.bracket = (least, most), (lo, hi)
        self.below, self.done = 0, False

    def judge(self, below: int, inside: int, least: float | None, most: float | None, grid: list[float] | None, bound: int) -> None:
        """What a scan found: values below the bracket and inside, the ends of those inside and quantiles of them. Each call
        leaves less between the outer bounds or in the bracket."""
        lo, hi = self.bracket
        if self.rank < below:
            self.outer = self.bracket = (self.outer[0], math.nextafter(lo, -math.inf))
        elif self.rank >= below + inside:
            self.outer = self.bracket = (math.nextafter(hi, math.inf), self.outer[1])
        else:
            self.outer, self.below = (least, most), below
            self.done = inside <= bound or least == most
            at = (self.rank - below) / inside * CELLS
            new = (grid[max(0, math.floor(at) - 1)], grid[min(CELLS, math.ceil(at) + 1)])
            if new in ((lo, hi), (least, most)):              # the quantiles are too coarse here: try one half
                new = (least, max(least, min(math.nextafter(most, -math.inf), least / 2 + most / 2)))
            self.bracket = (least, most) if self.done else new


def narrowed_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], extra: Sequence[Column] = (),
                       again: DataFrame | None = None, bound: int | None = None) -> DataFrame:
    """The same as ``exact_quantiles``, with as many scans as it takes (three where the first brackets are right): the driver holds
    a few numbers for each group and target. No task ranks more than ``bound`` values of a target; NaN counts as a missing value here."""
    by, bound, spark = list(by), BOUND if bound is None else bound, df.sparkSession

    def clean(d: DataFrame) -> Column:
        x = d[value].cast("double")
        return F.when(~F.isnan(x), x)

    v, slack = clean(df), MARGIN / ACCURACY
    ends = [e for p in probs for e in (max(0.0, p - slack), min(1.0, p + slack))]
    grouped = df.groupBy(*by).agg(F.count(v).alias("__n"), F.min(v).alias("__min"), F.max(v).alias("__max"),
                                  F.percentile_approx(v, ends, ACCURACY).alias("__b"), *extra)
    groups = grouped.collect()                                # few, as the caller says
    position = {(g, i): (r["__n"] - 1) * p for g, r in enumerate(groups) if r["__n"] for i, p in enumerate(probs)}
    wanted = {(g, k): i for (g, i), x in position.items() for k in (math.floor(x), math.ceil(x))}
    targets = [_Target(g, k, groups[g]["__min"], groups[g]["__max"], *groups[g]["__b"][2 * i:2 * i + 2]) for (g, k), i in sorted(wanted.items())]
    source = df if again is None else again
    rows = source.select(*by, clean(source).alias("__v")).filter(F.col("__v").isNotNull())

    def tried(some: list[_Target]) -> DataFrame:
        names = [f.name for f in grouped.schema.fields if f.name in by]
        schema = T.StructType([*[T.StructField(f"__g_{c}", grouped.schema[c].dataType) for c in names],
                               *[T.StructField(c, T.LongType()) for c in ("__g", "__rank")], *[T.StructField(c, T.DoubleType()) for c in ("__lo", "__hi")]])
        data = [(*[groups[t.group][c] for c in names], t.group, t.rank, float(t.bracket[0]), float(t.bracket[1])) for t in some]
        few = F.broadcast(spark.createDataFrame(data, schema))
        return rows.join(few, [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in by]) if by else rows.crossJoin(few)

    while open_ := [t for t in targets if not t.done]:
        x = F.when((F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi")), F.col("__v"))
        seen = tried(open_).groupBy("__g", "__rank").agg(
            F.count_if(F.col("__v") < F.col("__lo")).alias("below"), F.count(x).alias("inside"), F.min(x).alias("least"), F.max(x).alias("most"),
            F.percentile_approx(x, [j / CELLS for j in range(CELLS + 1)], ACCURACY).alias("grid"))
        seen = {(r["__g"], r["__rank"]): r for r in seen.collect()}
        for t in open_:
            r = seen[t.group, t.rank]
            t.judge(r.below, r.inside, r.least, r.most, r.grid, bound)

    found: dict[tuple[int, int], float] = {}
    if targets:
        inside = tried(targets).filter((F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi")))
        counted = inside.groupBy("__g", "__rank", "__v").agg(F.count(F.lit(1)).alias("__c"))
        upto = F.sum("__c").over(Window.partitionBy("__g", "__rank").orderBy("__v"))
        places = spark.createDataFrame([(t.group, t.rank, t.rank - t.below) for t in targets], "g long, k long, at long")
        placed = counted.withColumn("__to", upto).join(F.broadcast(places), (F.col("__g") == F.col("g")) & (F.col("__rank") == F.col("k")))
        hit = placed.filter((F.col("__to") - F.col("__c") <= F.col("at")) & (F.col("at") < F.col("__to")))
        found = {(r.g, r.k): r["__v"] for r in hit.select("g", "k", "__v").collect()}                 # one a target

    others = [f for f in grouped.schema.fields if f.name not in (*by, "__n", "__min", "__max", "__b")]
    quantile: dict[tuple[int, int], float] = {}
    for (g, i), x in position.items():
        a, b = math.floor(x), math.ceil(x)
        quantile[g, i] = found[g, a] if a == b else (b - x) * found[g, a] + (x - a) * found[g, b]
    schema = T.StructType([*[grouped.schema[c] for c in by], *[T.StructField(_name(p), T.DoubleType()) for p in probs], *others])
    data = [(*[r[c] for c in by], *[quantile.get((g, i)) for i in range(len(probs))], *[r[f.name] for f in others]) for g, r in enumerate(groups)]
    return spark.createDataFrame(data, schema)
