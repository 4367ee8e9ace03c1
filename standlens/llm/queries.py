"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import (bpe, embed_dedup, extract, importance, langid, lexical, line_dedup, lm, packing, pii, quality, simhash,
               topk)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_language_id": langid.op1_language_id,
        "op2_embedding_dedup": embed_dedup.op2_embedding_dedup,
        "op3_extract": extract.op3_extract,
        "op4_packing": packing.op4_packing,
        "op5_lm_score": lm.op5_lm_score,
        "op6_quality_rules": quality.op6_quality_rules,
        "op7_line_dedup": line_dedup.op7_line_dedup,
        "op8_bpe": bpe.op8_bpe,
        "op9_simhash": simhash.op9_simhash,
        "op10_pii": pii.op10_pii,
        "op11_lexical_search": lexical.op11_lexical_search,
        "op12_importance": importance.op12_importance,
        "op13_topk_search": topk.op13_topk_search,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    out = {"op6_quality_rules": quality.OP6_SQL, "op7_line_dedup": line_dedup.OP7_SQL, "op11_lexical_search": lexical.OP11_SQL,
           "op12_importance": importance.OP12_SQL, "op13_topk_search": topk.OP13_SQL}
    if corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
