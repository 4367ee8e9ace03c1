"""Keep-the-first-row operators (DED-01..03).

R's ``distinct(key, .keep_all = TRUE)`` keeps the first row in the current
order. Spark has no file order, so callers pass a *total* order ending in a
tie-break. ``row_number() == 1`` plans as a partial WindowGroupLimit before
the shuffle, so even a key holding a large share of the rows sends only one
row per map task across the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
