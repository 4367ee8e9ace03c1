"""Inputs from real layers (SRC-01..03) instead of the TPC-H binding.

"First row in input order" is exact for files, for stands, for compartments and for domains: the order is the record's file path and its
place in the file (``readers.input_position``), deterministic on every recomputation. A domain with a
repeated code is refused: a left join onto it would multiply records. Whether a domain is broadcast is left to
Spark's own size estimate and to AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from standlens.operators.lookup import duplicate_codes
from standlens.sources.fixture import Inputs
from standlens.sources.readers import input_position, read_compartments, read_domains, read_stands


def with_input_order(df: DataFrame) -> DataFrame:
    """Add tb1..tb3, the rows' order in their files, to a frame read straight from parquet files."""
    return df.withColumns(dict(zip(("tb1", "tb2", "tb3"), input_position("parquet"))))


def checked_domain(name: str, df: DataFrame) -> DataFrame:
    twice = [r.code for r in duplicate_codes(df, "code").limit(5).collect()]
    if twice:
        raise ValueError(f"domain {name}: codes occur more than once, e.g. {twice}")
    return df


def file_inputs(spark: SparkSession, stands_path: str, compartments_path: str, domain_paths: dict[str, str],
                domain_format: str = "csv", layer_format: str = "parquet") -> Inputs:
    stands = read_stands(spark, stands_path, True, layer_format, input_order=True)      # created_date is on the records
    compartments = read_compartments(spark, compartments_path, True, layer_format, input_order=True)
    domains = {name: checked_domain(name, df) for name, df in read_domains(spark, domain_paths, domain_format).items()}
    return Inputs(spark, stands, compartments, domains, None, None)
