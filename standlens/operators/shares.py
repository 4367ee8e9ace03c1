"""Shares of a grand total (WIN-01) and of a partition (WIN-02).

A grand total is a one-row global aggregate of the *grouped* result, used as a scalar subquery:
Spark runs it once and substitutes the value, so the summary is neither
moved into one partition (as an empty ``Window.partitionBy()`` would) nor
joined. The subquery uses every column of the grouped result, so it has the same shuffle as
the result itself: Spark reuses it, and the records are read once. Division follows ``try_divide``: x/0 gives null instead of R's
Inf/NaN (ANSI mode would raise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scalar_total(df: DataFrame, expr: Column) -> Column:
    """A one-row aggregate of the grouped result ``df`` as a Column. All columns are kept in use: with columns pruned
    away the aggregation below would be another one, and the records would be read again for it."""
    return df.agg(F.struct(expr.alias("x"), uses_all(df).alias("h")).alias("s")).scalar().getField("x")


def uses_all(df: DataFrame) -> Column:
    """An aggregate that needs every column of ``df``."""
    return F.max(F.xxhash64(*df.columns))


def one_shuffle(grouped: DataFrame) -> DataFrame:
    """``grouped`` for several readers at once: a condition that every row meets needs all columns and, depending on the partition, lets
    no filter below it. So the shuffle of the grouped table is the same for all of them, and Spark runs it once and reuses it."""
    every = F.xxhash64(*grouped.columns) >= F.lit(-(1 << 63))
    return grouped.filter(every & (F.spark_partition_id() >= 0))


def ratio(num: Column | str, den: Column | str, scale: float = 1.0) -> Column:
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    out = F.try_divide(n.cast("double"), d.cast("double"))
    return out * F.lit(scale) if scale != 1.0 else out


def with_share_within(df: DataFrame, by: list[str], value: str, out: str, scale: float = 1.0,
                      total_col: str | None = None) -> DataFrame:
    """``out = scale * value / sum(value) over (partition by by)``."""
    tot = F.sum(value).over(Window.partitionBy(*by))
    if total_col:
        df = df.withColumn(total_col, tot)
        return df.withColumn(out, ratio(F.col(value), F.col(total_col), scale))
    return df.withColumn(out, ratio(F.col(value), tot, scale))


def zero_sum(c: Column | str) -> Column:
    """R ``sum(x, na.rm = TRUE)``: nothing or all-null sums to 0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(col), F.lit(0.0))


def count_if(cond: Column) -> Column:
    """R ``sum(cond, na.rm = TRUE)`` for a logical: null conditions count 0."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def sum_if(cond: Column, value: Column | str) -> Column:
    """R ``sum(x[cond], na.rm = TRUE)``."""
    v = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(F.when(cond, v)), F.lit(0.0))


def distinct_with_null(*cols: str) -> Column:
    """R ``n_distinct``: null counts as one value of its own."""
    if len(cols) == 1:
        c = F.col(cols[0])
        has_null = F.coalesce(F.max(F.when(c.isNull(), 1).otherwise(0)), F.lit(0))   # 0 on empty input
        return (F.count_distinct(c) + has_null).cast("long")
    return F.count_distinct(F.struct(*cols))
