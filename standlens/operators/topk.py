"""Top-k per group (WIN-04) and rank / running totals (WIN-03).

``rank() <= k`` keeps ties (R ``slice_max`` default); ``row_number() <= k``
does not (``with_ties = FALSE``), ties broken by the extra order columns.
Both plan as WindowGroupLimit, which prunes before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from standlens.operators.shares import one_shuffle


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, ties: bool) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    fn = F.rank() if ties else F.row_number()
    return df.withColumn("__r", fn.over(w)).filter(F.col("__r") <= k).drop("__r")


def magnitude(c: Column) -> Column:
    """A whole number that never falls as ``c`` rises, the same for values within about 1.5 percent of each other: some thousand
    different ones over all doubles. Null stays null; NaN (greater than all, as in a sort) gets the greatest."""
    x = c.cast("double")
    size = F.floor(F.log1p(F.when(F.abs(x) > 1e300, 1e300).otherwise(F.abs(x))) * 64)      # least() would make 1e300 of null
    return F.when(F.isnan(x), F.lit(1 << 40)).otherwise(F.when(x < 0, -size).otherwise(size)).cast("long")


#: Rows of one magnitude that a window may hold, and the parts that a magnitude with more of them is cut into, about.
CROWD, PARTS = 20_000, 128


def distributed_rank(df: DataFrame, by: Sequence[str], main: str, order: Sequence[Column], rank_col: str,
                     running: str | None = None, running_col: str | None = None, total_col: str | None = None,
                     then: Sequence[Column] = (), crowd: int | None = None) -> DataFrame:
    """``row_number()`` (and optionally a running sum of ``running`` and its total) within ``by`` groups over ``order``, whose
    first column is ``main`` (a number) descending, without sending a whole group to one task.

    Rows are dealt by the magnitude of ``main``. A magnitude of more than ``crowd`` rows (many units of equal acres) is dealt further
    at marks: some of its rows, picked by a hash of all their columns, whose sort keys are ``main`` and ``then``, columns that
    ascend where ``order`` goes on. Counts and sums per (group, magnitude, part) form a small table; what lies before a part
    is its offset, and rows number themselves inside it. All of this depends on the rows alone, so nothing has to be stored
    or sampled beforehand; ``df`` is computed once, as one shuffle that all passes read.
    """
    keys, crowd = list(by), CROWD if crowd is None else crowd
    s = one_shuffle(df).withColumn("__m", magnitude(F.col(main)))
    key = F.struct((-F.col(main).cast("double")).alias("k0"), *[c.alias(f"k{i}") for i, c in enumerate(then, 1)])

    def same(left: DataFrame, right: DataFrame, prefix: str, names: list[str]) -> list[Column]:
        return [left[c].eqNullSafe(right[prefix + c]) for c in names]

    def prefixed(t: DataFrame, prefix: str, names: list[str], *more: Column) -> DataFrame:
        return t.select(*[F.col(c).alias(prefix + c) for c in names], *more)

    dealt = [*keys, "__m"]
    crowded = s.groupBy(*dealt).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd)
    crowded = prefixed(crowded, "__c_", dealt, F.col("n").alias("__n"))
    marks = s.join(crowded, same(s, crowded, "__c_", dealt))
    marks = marks.filter(F.pmod(F.xxhash64(*df.columns), F.lit(1 << 40)) / F.lit(float(1 << 40)) < PARTS / F.col("__n"))
    marks = marks.groupBy(*dealt).agg(F.sort_array(F.collect_list(key)).alias("__marks"))
    marks = prefixed(marks, "__p_", dealt, F.col("__marks"))
    s = s.join(marks, same(s, marks, "__p_", dealt), "left").drop(*[f"__p_{c}" for c in dealt])
    part = F.size(F.filter("__marks", lambda x: x < F.col("__key")))
    s = s.withColumn("__key", key).withColumn("__s", F.when(F.col("__marks").isNull(), 0).otherwise(part)).drop("__marks", "__key")

    dealt.append("__s")
    per = s.groupBy(*dealt).agg(F.count(F.lit(1)).alias("__n"), (F.coalesce(F.sum(running), F.lit(0.0)) if running else F.max(F.lit(0.0))).alias("__v"))
    above = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("__m"), F.asc("__s")).rowsBetween(Window.unboundedPreceding, -1)
    offs = prefixed(per, "__o_", dealt, F.coalesce(F.sum("__n").over(above), F.lit(0)).alias("__off_n"),
                    F.coalesce(F.sum("__v").over(above), F.lit(0.0)).alias("__off_v"),
                    F.sum("__v").over(Window.partitionBy(*keys)).alias("__total"))
    j = s.join(offs, same(s, offs, "__o_", dealt), "left")
    local = Window.partitionBy(*dealt).orderBy(*order)
    out = j.withColumn(rank_col, (F.col("__off_n") + F.row_number().over(local)).cast("int"))
    if running and running_col:
        out = out.withColumn(running_col, F.col("__off_v") + F.sum(running).over(
            local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    if total_col:
        out = out.withColumn(total_col, F.col("__total"))
    return out.drop("__m", "__s", "__off_n", "__off_v", "__total", *[f"__o_{c}" for c in dealt])
