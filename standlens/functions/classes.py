"""Classifiers: project cover class, size and age classes, years (PRJ-10..16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from standlens.config import Params
from standlens.functions.codes import code_text

# ---- fixed values: class labels of the workflow ----
SIZE_LABELS_PROFILE = ("<5 acres", "5–20 acres", "20–50 acres", "50–100 acres", "100+ acres")
SIZE_LABELS_ANALYSIS = ("<5", "5–19", "20–49", "50–99", "≥100")
AGE_LABELS = ("0–<5 years", "5–<10 years", "10–<15 years", "15+ years")
BASELINE_PREFIX = "≤"
# ---- end of fixed values ----
DEFAULT_SIZE_BREAKS = Params.__dataclass_fields__["size_breaks"].default
DEFAULT_AGE_BREAKS = Params.__dataclass_fields__["age_breaks"].default


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def step_class(value: Column | str, breaks: Sequence[float], labels: Sequence[str]) -> Column:
    """First label whose upper break exceeds the value; else the last label.
    A null value matches no break and so lands in the last class."""
    assert len(labels) == len(breaks) + 1
    v = _c(value)
    expr = None
    for b, lab in zip(breaks, labels):
        expr = F.when(v < b, F.lit(lab)) if expr is None else expr.when(v < b, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def _fmt(b: float) -> str:
    return f"{b:g}"


def labels_for(breaks: Sequence[float], fixed: Sequence[str], unit: str) -> Sequence[str]:
    """The workflow's fixed labels for its own breaks; for other breaks,
    labels generated from them ("<5 acres", "5–20 acres", ..., "100+ acres")."""
    if len(fixed) == len(breaks) + 1 and tuple(breaks) in (DEFAULT_SIZE_BREAKS, DEFAULT_AGE_BREAKS):
        return fixed
    out = [f"<{_fmt(breaks[0])} {unit}"]
    out += [f"{_fmt(a)}–{_fmt(b)} {unit}" for a, b in zip(breaks, breaks[1:])]
    return out + [f"{_fmt(breaks[-1])}+ {unit}"]


def size_class(acres: Column | str, p: Params, labels: Sequence[str] = SIZE_LABELS_PROFILE) -> Column:
    """PRJ-13."""
    return step_class(acres, p.size_breaks, labels_for(p.size_breaks, labels, "acres"))


def age_class(age: Column | str, p: Params) -> Column:
    """PRJ-14."""
    return step_class(age, p.age_breaks, labels_for(p.age_breaks, AGE_LABELS, "years"))


def project_cover_class(l4code: Column | str, l3label: Column | str, p: Params) -> Column:
    """PRJ-10: code text starting with the agriculture prefix -> Agriculture;
    else L3 label equal to the focal label -> that label; else null."""
    return (
        F.when(code_text(_c(l4code)).startswith(p.agriculture_prefix), F.lit(p.agriculture_class))
        .when(_c(l3label) == p.openland_label, F.lit(p.openland_label))
        .otherwise(F.lit(None).cast("string"))
    )


def clamp_year(raw_year: Column | str, p: Params) -> Column:
    """PRJ-15: years at or before the baseline collapse onto the baseline."""
    y = _c(raw_year)
    return F.when(y <= p.baseline_year, F.lit(p.baseline_year)).otherwise(y)


def year_label(year: Column | str, p: Params) -> Column:
    """PRJ-16: "≤<baseline>" for the baseline year, else the year's text."""
    y = _c(year)
    return F.when(y == p.baseline_year, F.lit(f"{BASELINE_PREFIX}{p.baseline_year}")).otherwise(y.cast("string"))


def valid_year(year: Column | str, p: Params) -> Column:
    """FLT-04: non-null year within [min_year, current_year]."""
    y = _c(year)
    return y.isNotNull() & (y >= p.min_year) & (y <= p.current_year)
