"""Small literal tables built on the JVM side.

``createDataFrame`` from a Python list goes through a Python RDD, so every
use starts Python workers. A literal domain is instead an ``inline`` of an
array of structs over a one-row range: a plain JVM plan with a row count
known on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)]) for r in rows]
    out = spark.range(1).select(F.inline(F.array(*structs)))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
