"""Binding of the driver's TPC-H-style tables to the inventory data model.

``stands`` = lineitem (one row per inventory record, ``l_orderkey`` is the
stand key), ``compartments`` = supplier x 4 joined to nation, domains are
code tables. The column expressions are the binding's own SQL text, so the
DuckDB oracle uses the very same definitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values of the binding (must equal the test specification) ----
COVER_CODE_EXPR = (
    "CASE l_partkey % 16 WHEN 1 THEN 0 WHEN 2 THEN 211 WHEN 3 THEN 2121 WHEN 4 THEN 222 "
    "WHEN 5 THEN 310 WHEN 6 THEN 3101 WHEN 7 THEN 31021 WHEN 8 THEN 320 WHEN 9 THEN 4191 "
    "WHEN 10 THEN 42110 WHEN 11 THEN 4221 WHEN 12 THEN 4319 WHEN 13 THEN 500 WHEN 14 THEN 6221 "
    "WHEN 15 THEN 310 END"
)
CANOPY_EXPR = "NULLIF(l_linenumber % 6, 0)"
MANAGED_SITE_EXPR = "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END"
SUB_CANOPY_EXPR = (
    "CASE WHEN l_tax = 0 THEN NULL WHEN l_tax = 0.01 THEN 0 "
    "ELSE CAST(ROUND(l_tax * 100) AS INT) END"
)
ACRES_EXPR = (
    "CASE WHEN l_linenumber = 7 AND l_discount = 0.10 THEN NULL "
    "WHEN l_quantity = 1 AND l_linenumber = 1 THEN 0 "
    "ELSE l_quantity * l_linenumber / 2.0E0 END"
)
DATE_EXPR = (
    "CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN NULL "
    "WHEN l_linenumber = 1 AND l_quantity = 49 THEN CAST('1899-12-30' AS {ntz}) "
    "ELSE l_shipdate END"
)
FC_KEY_EXPR = "l_suppkey * 4 + l_partkey % 4"
LAST_EDITED_EXPR = "l_shipdate + INTERVAL '30' DAY"

CANOPY_DOMAIN = [(1, "0-25"), (2, "25-50"), (3, "50-75"), (4, "75-100"), (5, "Unspecified")]
MANAGEMENT_DOMAIN = [(1, "Managed"), (2, "Unspecified")]
AUTHORITY_DOMAIN = [(1, "State Forests"), (2, "State Parks"), (3, "Partner Lands"), (5, "Wildlife")]
COVER_DOMAIN = [
    (211, "211 - Cropland (OI)"),
    (212, "212 - Forage"),
    (2121, "2121 - Forage - Mixed"),
    (222, "222 - Orchards/Vineyards/Nursery (OI)"),
    (310, "310 - Herbaceous Openland"),
    (3101, "3101 - Grass - Mixed"),
    (31021, "31021 - Warm Grass (OI)"),
    (320, "320 - Upland Shrub"),
    (4191, "4191 - Mixed Deciduous"),
    (42110, "42110 - Planted Pine"),
    (4221, "4221 - Natural Pine"),
    (4319, "4319 - Mixed Forest"),
    (500, "500 - Water"),
    (622, "622 - Emergent Wetland"),
    (6221, "6221 - Cattail"),
]
UNIT_LABEL_EXPR = "CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE s_name END"
COMPARTMENT_COPIES = 4          # fc_key = s_suppkey * 4 + i, i in 0..3
DUPLICATE_EVERY = 40            # one duplicate compartment row per fc_key % 40 = 0
# ---- end of fixed values ----

TIE_BREAK = ("tb1", "tb2", "tb3")


@dataclass
class Inputs:
    """Raw inputs of one run: stand records, compartments, domains.

    ``stands`` carries ``tb1..tb3``, a total row order used wherever the
    workflow keeps "the first row" of a group.
    """

    spark: SparkSession
    stands: DataFrame
    compartments: DataFrame
    domains: dict[str, DataFrame]
    created_dates: DataFrame | None = None  # (fcskey, created_date)
    # row counts known on the driver (literal domains); absent = unbounded
    domain_rows: dict[str, int] | None = None

    def with_created_date(self, df: DataFrame) -> DataFrame:
        """Attach ``created_date`` (many records to one order: left join). Orders grow with the records, so both sides are shuffled
        whatever their size; a task's share of the orders is hashed and the records are not sorted."""
        if self.created_dates is None or "created_date" in df.columns:
            return df
        return df.join(self.created_dates.hint("shuffle_hash"), "fcskey", "left")


def _domain(spark: SparkSession, rows, label: str) -> DataFrame:
    from standlens.sources.literal import literal_table
    schema = T.StructType([T.StructField("code", T.LongType(), False), T.StructField(label, T.StringType(), True)])
    return literal_table(spark, rows, schema)


def tpch_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")

    stands = li.select(
        F.col("l_orderkey").alias("fcskey"),
        F.expr(FC_KEY_EXPR).alias("fc_key"),
        F.expr(COVER_CODE_EXPR).cast("int").alias("l4covertype"),
        F.expr(CANOPY_EXPR).cast("int").alias("canopy_closure"),
        F.expr(MANAGED_SITE_EXPR).cast("int").alias("managed_site"),
        F.expr(SUB_CANOPY_EXPR).alias("sub_canopy_cover"),
        F.expr(ACRES_EXPR).alias("acres"),
        F.expr(DATE_EXPR.format(ntz="TIMESTAMP_NTZ")).alias("date"),
        F.expr(LAST_EDITED_EXPR).alias("last_edited_date"),
        F.col("l_linenumber").alias("tb1"),
        F.col("l_partkey").alias("tb2"),
        F.col("l_suppkey").alias("tb3"),
    )
    created = orders.select(F.col("o_orderkey").alias("fcskey"), F.col("o_orderdate").alias("created_date"))

    # nation has 25 rows by definition of the schema: a bounded broadcast
    base = (
        supplier.select("s_suppkey", "s_nationkey", "s_acctbal",
                        F.explode(F.sequence(F.lit(0), F.lit(COMPARTMENT_COPIES - 1))).alias("i"))
        .join(F.broadcast(nation.select("n_nationkey", "n_regionkey")),
              F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            (F.col("s_suppkey") * COMPARTMENT_COPIES + F.col("i")).alias("fc_key"),
            (F.col("n_regionkey") + 1).alias("management_type"),
            F.col("s_suppkey").alias("unit_name"),
            F.floor(F.abs("s_acctbal")).cast("double").alias("acres"),
        )
    )
    dup = base.filter(F.col("fc_key") % DUPLICATE_EVERY == 0).withColumn("acres", F.col("acres") + 1)
    compartments = base.unionByName(dup)

    domains = {
        "canopy_closure": _domain(spark, CANOPY_DOMAIN, "canopy_key"),
        "cover_type": _domain(spark, COVER_DOMAIN, "l4cover_key"),
        "management": _domain(spark, MANAGEMENT_DOMAIN, "management_key"),
        "authority": _domain(spark, AUTHORITY_DOMAIN, "authority_key"),
        "unit_name": supplier.select(F.col("s_suppkey").alias("code"),
                                     F.expr(UNIT_LABEL_EXPR).alias("unit_key")),
    }
    rows = {"canopy_closure": len(CANOPY_DOMAIN), "cover_type": len(COVER_DOMAIN),
            "management": len(MANAGEMENT_DOMAIN), "authority": len(AUTHORITY_DOMAIN)}
    return Inputs(spark, stands, compartments, domains, created, rows)
