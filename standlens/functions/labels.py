"""Label cleaning, missing-value labels and ordered categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: label patterns and canopy classes of the workflow ----
LEADING_CODE_PATTERN = r"^[0-9]+\s*-\s*"
TRAILING_OI_PATTERN = r"\s*\(OI\)$"
CANOPY_CLASS_MAP = {"0-25": "0–<25", "25-50": "25–<50", "50-75": "50–<75", "75-100": "75–100"}
CANOPY_NA_VALUES = ("NA", "Missing", "Missing / NA", "Unspecified")
CANOPY_CLASS_ORDER = ("0–<25", "25–<50", "50–<75", "75–100", "NA")
CANOPY_KEY_ORDER = ("0-25", "25-50", "50-75", "75-100", "Unspecified", "Missing / NA")
MISSING_LABEL = "Missing / NA"
# ---- end of fixed values ----


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_cover_label(label: Column | str) -> Column:
    """PRJ-03: drop the leading code and first dash, then a trailing "(OI)".
    Inner dashes survive ("2121 - Forage - Mixed" -> "Forage - Mixed")."""
    return F.regexp_replace(F.regexp_replace(_c(label), LEADING_CODE_PATTERN, ""), TRAILING_OI_PATTERN, "")


def missing_as(label: Column | str, text: str = MISSING_LABEL) -> Column:
    """PRJ-12: null label -> "Missing / NA"."""
    return F.coalesce(_c(label), F.lit(text))


def canopy_class(canopy_key: Column | str) -> Column:
    """PRJ-11: four ranges relabelled, null and the missing spellings pooled
    as "NA"; any other value falls outside the class levels and is null."""
    k = _c(canopy_key)
    expr = F.when(k.isNull(), F.lit("NA"))
    for src, dst in CANOPY_CLASS_MAP.items():
        expr = expr.when(k == src, F.lit(dst))
    return expr.when(k.isin(*CANOPY_NA_VALUES), F.lit("NA")).otherwise(F.lit(None).cast("string"))


def factor(label: Column | str, levels: Sequence[str]) -> Column:
    """PRJ-17: values outside ``levels`` become null (R factor semantics)."""
    c = _c(label)
    return F.when(c.isin(*levels), c)


def level_order(label: Column | str, levels: Sequence[str]) -> Column:
    """Position of a label in ``levels`` (1-based), null when absent: sort key."""
    c = _c(label)
    pos = F.array_position(F.array(*[F.lit(v) for v in levels]), c)
    return F.when(pos > 0, pos.cast("int"))
