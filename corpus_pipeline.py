"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, PII, packing.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept and returns a DataFrame; ``run`` writes it
as Parquet to the shared folder and reads it again as the next stage's documents. All stages but the last
return the columns of documents; ``n_chars`` follows the text. Rejected documents and all but one row of a near-duplicate
group go, repeated rows and rows without ids included; lines that fail or repeat, and personal data, leave the texts. The last stage returns one row per packed piece.

Nulls: a null text has no words and is rejected by the first stage; null ids, languages and sources pass through.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from standlens.llm import line_dedup, packing, pii, quality, simhash
from standlens.llm.common import stored


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(quality.clean(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(line_dedup.dedup(docs, min_docs=10, min_chars=1))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.single(docs, shingle=3, max_bits=3)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(pii.redact(docs, pii.fit(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.op4_packing(spark, sf_dir, docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("pii", pii_redaction),
    ("packing", pack),
]

#: SQL cannot express the trained span classifier of the PII stage, nor packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
