"""Plain forms of operators, for comparison only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from standlens.operators.snapshots import latest_per_stand


def naive_annual_snapshots(dedup: DataFrame, years: list[int]) -> DataFrame:
    """The rolling snapshot as the workflow makes it: one latest-per-stand pass per year."""
    out = None
    for y in years:
        snap = latest_per_stand(dedup.filter(F.col("inventory_year_raw") <= y)).withColumn("inventory_year", F.lit(y))
        out = snap if out is None else out.unionByName(snap)
    return out
