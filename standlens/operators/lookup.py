"""Domain lookups (PRJ-02..06, SET-01) and lookup joins (JN-01..05).

Joins follow R's ``left_join``: a null key matches a null code. Lookups
whose row count is known on the driver (literal domains) are broadcast;
all others (file domains, one unit per compartment owner) are
joined without a hint, so Spark broadcasts them only when its estimate of their bytes or the runtime
shuffle statistics show they are small, and otherwise sort-merge joins them
with skewed partitions split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from standlens.functions.codes import code_digits
from standlens.functions.labels import clean_cover_label

# ---- fixed values: manual L3 crosswalk of the workflow ----
L3_CROSSWALK = [
    (419, "Mixed Upland Deciduous"),
    (421, "Planted Pines"),
    (422, "Natural Pines"),
    (423, "Other (Non-Pine) Upland Conifers"),
    (424, "Other Upland Conifers"),
    (431, "Upland Mixed Forest"),
]
SOURCE_DOMAIN = "Cover_Type_Domain"
SOURCE_CROSSWALK = "IFMAP manual crosswalk"
# ---- end of fixed values ----


@dataclass
class Lookup:
    """A code -> label table plus, when known, a bound on its row count."""

    df: DataFrame
    key: str
    max_rows: int | None = None


def _rename(domain: DataFrame, key: str, label: str) -> DataFrame:
    return domain.select(F.col("code").cast("int").alias(key), F.col(label))


def canopy_lookup(domain: DataFrame) -> DataFrame:
    """PRJ-02."""
    return _rename(domain, "canopy_closure", "canopy_key")


def l4_lookup(domain: DataFrame) -> DataFrame:
    """PRJ-03: full cover code -> cleaned label."""
    return domain.select(F.col("code").cast("int").alias("l4covertype_full"),
                         clean_cover_label("l4cover_key").alias("l4cover_key"))


def ordered_l4(domain: DataFrame) -> DataFrame:
    """PRJ-03 with the domain's input order, where it has one."""
    order = F.col("input_order") if "input_order" in domain.columns else F.lit(0)
    return domain.select(F.col("code").cast("int").alias("l4covertype_full"),
                         clean_cover_label("l4cover_key").alias("l4cover_key"), order.alias("_ord"))


def management_lookup(domain: DataFrame) -> DataFrame:
    """PRJ-04."""
    return _rename(domain, "managed_site", "management_key")


def authority_lookup(domain: DataFrame) -> DataFrame:
    """PRJ-05."""
    return _rename(domain, "management_type", "authority_key")


def unit_lookup(domain: DataFrame) -> DataFrame:
    """PRJ-06 (unit codes stay long: they are compartment-owner ids)."""
    return domain.select(F.col("code").alias("unit_name"), F.col("unit_key"))


def crosswalk(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("l3covertype", T.IntegerType(), False),
                           T.StructField("l3cover_key", T.StringType(), False)])
    from standlens.sources.literal import literal_table
    return literal_table(spark, L3_CROSSWALK, schema).withColumn("l3_key_source", F.lit(SOURCE_CROSSWALK))


def l3_lookup(l4: DataFrame, manual: DataFrame) -> DataFrame:
    """SET-01: 3-digit domain rows, then the manual rows; per code the first
    row wins: domain before crosswalk, in the domain by input order (``_ord``, if ``l4`` has it)."""
    if "_ord" not in l4.columns:
        l4 = l4.withColumn("_ord", F.lit(0))
    from_domain = (l4.filter(code_digits("l4covertype_full") == 3)
                   .select(F.col("l4covertype_full").alias("l3covertype"),
                           F.col("l4cover_key").alias("l3cover_key"),
                           F.lit(SOURCE_DOMAIN).alias("l3_key_source"), "_ord"))
    both = (from_domain.withColumn("_prio", F.lit(0))
            .unionByName(manual.withColumn("_prio", F.lit(1)).withColumn("_ord", F.lit(None).cast(l4.schema["_ord"].dataType))))
    from standlens.operators.dedup import first_per_key
    return first_per_key(both, ["l3covertype"], [F.col("_prio"), F.col("_ord")]).drop("_prio", "_ord")


def duplicate_codes(lookup: DataFrame, key: str) -> DataFrame:
    """Codes that occur more than once in a lookup (a left join would fan
    rows out on them). Empty for a valid domain."""
    return lookup.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


#: Rows up to which a lookup of known size is broadcast: codes and short labels, some 100 bytes each.
BROADCAST_ROWS = 10_000


def lookup_join(df: DataFrame, lk: Lookup, left_key: str | None = None) -> DataFrame:
    """Many-to-one left join of labels onto ``df`` with null-safe keys.

    The lookup must be unique on its key (file domains are checked when they are read);
    otherwise a left join fans rows out.
    """
    lkey = left_key or lk.key
    right = lk.df
    if lk.max_rows is not None and lk.max_rows <= BROADCAST_ROWS:
        right = F.broadcast(right)
    rk = "__lk_" + lk.key
    right = right.withColumnRenamed(lk.key, rk)
    out = df.join(right, df[lkey].eqNullSafe(right[rk]), "left").drop(rk)
    return out
