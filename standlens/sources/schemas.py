"""Explicit schemas: inputs are never read with schema inference."""

from pyspark.sql import types as T

STANDS = T.StructType([
    T.StructField("fcskey", T.LongType(), False),
    T.StructField("fc_key", T.LongType(), True),
    T.StructField("l4covertype", T.IntegerType(), True),
    T.StructField("canopy_closure", T.IntegerType(), True),
    T.StructField("managed_site", T.IntegerType(), True),
    T.StructField("sub_canopy_cover", T.IntegerType(), True),
    T.StructField("acres", T.DoubleType(), True),
    T.StructField("date", T.TimestampNTZType(), True),
    T.StructField("created_date", T.TimestampNTZType(), True),
    T.StructField("last_edited_date", T.TimestampNTZType(), True),
])

# Optional opaque geometry (WKB); never used in a predicate.
GEOMETRY = T.StructField("geometry", T.BinaryType(), True)

COMPARTMENTS = T.StructType([
    T.StructField("fc_key", T.LongType(), True),
    T.StructField("management_type", T.IntegerType(), True),
    T.StructField("unit_name", T.LongType(), True),
    T.StructField("acres", T.DoubleType(), True),
])

# A coded-value domain: integer code plus one label column.
DOMAIN = T.StructType([
    T.StructField("code", T.LongType(), True),
    T.StructField("label", T.StringType(), True),
])

# Label column name of each domain after the lookup rename.
DOMAIN_LABELS = {
    "canopy_closure": "canopy_key",
    "cover_type": "l4cover_key",
    "management": "management_key",
    "authority": "authority_key",
    "unit_name": "unit_key",
}
