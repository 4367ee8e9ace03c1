"""Latest-condition and rolling annual snapshots (DED-02, DED-03, SNP-08).

The workflow rebuilds "latest record per stand with raw year <= Y" once per
analysis year Y, which costs years x records. Here each record (already one
per stand and raw year) gets the interval of analysis years for which it is
the stand's newest record:

    valid_from = greatest(raw_year, first_analysis_year)
    valid_to   = lead(raw_year) over (stand by raw_year) - 1, else last year

and is exploded over that interval once. The ``lead`` window is per stand
and holds at most one row per valid year (bounded by the year window), and
the exploded rows are partially aggregated before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from standlens.config import Params
from standlens.functions.classes import clamp_year, valid_year
from standlens.operators.dedup import first_per_key

TIE_BREAK = ("tb1", "tb2", "tb3")


def _tie_break(df: DataFrame) -> list[Column]:
    return [F.col(c).asc() for c in TIE_BREAK if c in df.columns]


def add_inventory_years(df: DataFrame, p: Params) -> DataFrame:
    """PRJ-15 + FLT-04: raw year, clamped analysis year, valid window."""
    return (df.withColumn("inventory_year_raw", F.year("date"))
              .withColumn("inventory_year", clamp_year("inventory_year_raw", p))
              .filter(valid_year("inventory_year_raw", p)))


def stand_year_dedup(df: DataFrame) -> DataFrame:
    """DED-02: one row per (stand, raw year): newest date, then input order."""
    return first_per_key(df, ["fcskey", "inventory_year_raw"],
                         [F.col("date").desc_nulls_last(), *_tie_break(df)])


def latest_per_stand(df: DataFrame) -> DataFrame:
    """DED-03: one row per stand: newest raw year, then newest date."""
    return first_per_key(df, ["fcskey"],
                         [F.col("inventory_year_raw").desc_nulls_last(), F.col("date").desc_nulls_last(),
                          *_tie_break(df)])


def analysis_year_bounds(time_tbl: DataFrame) -> tuple[Column, Column]:
    """First and last analysis (clamped) year as scalar subqueries."""
    b = time_tbl.agg(F.min("inventory_year").alias("lo"), F.max("inventory_year").alias("hi"))
    return b.select("lo").scalar(), b.select("hi").scalar()


def analysis_years(time_tbl: DataFrame) -> DataFrame:
    """SET-05: every year from the first to the last analysis year."""
    b = time_tbl.agg(F.min("inventory_year").alias("lo"), F.max("inventory_year").alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi")).alias("inventory_year"))


def with_next_year(dedup: DataFrame) -> DataFrame:
    """``next_year_raw``: the raw year of the stand's next record, null for its latest."""
    w = Window.partitionBy("fcskey").orderBy("inventory_year_raw")
    return dedup.withColumn("next_year_raw", F.lead("inventory_year_raw").over(w))


def explode_validity(dedup: DataFrame, out_col: str = "inventory_year",
                     bounds_from: DataFrame | None = None) -> DataFrame:
    """Each (stand, raw year) record once per analysis year in which it is
    the stand's latest record with raw year <= that year.

    ``bounds_from`` may be the table before the stand-year dedup (same set
    of years, no shuffle needed to get them). A table that was stored with ``next_year_raw`` needs no window."""
    lo, hi = analysis_year_bounds(dedup if bounds_from is None else bounds_from)
    if "next_year_raw" not in dedup.columns:
        dedup = with_next_year(dedup)
    return (dedup
            .withColumn("__from", F.greatest(F.col("inventory_year_raw"), lo))
            .withColumn("__to", F.coalesce(F.col("next_year_raw") - 1, hi))
            .filter(F.col("__from") <= F.col("__to"))
            .withColumn(out_col, F.explode(F.sequence("__from", "__to")))
            .drop("__from", "__to", "next_year_raw"))
