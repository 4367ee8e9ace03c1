"""Report text formatting (PRJ-18, PRJ-19). format_number rounds HALF_EVEN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent_label(ratio: Column | str, digits: int = 1) -> Column:
    """0.1234 -> "12.3%"."""
    return F.concat(F.format_number(_c(ratio) * 100, digits), F.lit("%"))


def comma(x: Column | str, digits: int = 0) -> Column:
    """1234.4 -> "1,234"."""
    return F.format_number(_c(x), digits)


def number(x: Column | str, digits: int = 1) -> Column:
    """Plain number text; thousands separated by a space."""
    return F.regexp_replace(F.format_number(_c(x), digits), ",", " ")


def format_acres(x: Column | str) -> Column:
    return F.concat(comma(x, 0), F.lit(" ac"))


def format_count(x: Column | str) -> Column:
    return comma(x, 0)


def format_percent_value(x: Column | str) -> Column:
    """12.345 (already a percent) -> "12.3%"."""
    return F.concat(number(x, 1), F.lit("%"))
