"""Hierarchical cover-code helpers (PRJ-07, FLT-03, AGG-01)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_text(code: Column | str) -> Column:
    return F.col(code).cast("string") if isinstance(code, str) else code.cast("string")


def parent_code(code: Column | str, digits: int = 3) -> Column:
    """Level-3 parent of a mixed-level code: its first ``digits`` characters
    as an integer (31021 -> 310). Text that is not a number becomes null."""
    return F.substring(code_text(code), 1, digits).try_cast("int")


def code_digits(code: Column | str) -> Column:
    """Number of characters of the code's text form (null for null)."""
    return F.length(code_text(code))


def has_prefix(code: Column | str, prefix: str) -> Column:
    """Code text starts with ``prefix``; null code gives null (drops in filter)."""
    return code_text(code).startswith(prefix)


def int_code_has_prefix(code: str, prefix: str, max_digits: int = 19) -> Column:
    """``has_prefix`` for an integer code column, written as numeric ranges
    so parquet can push it down and skip row groups by min/max statistics.

    The text of a non-negative integer starts with a digit string P (no
    leading zero) exactly when P * 10^k <= code < (P + 1) * 10^k for some
    k >= 0; negative codes start with "-" and never match. A null code
    gives null, as with the text form.
    """
    if not prefix.isdigit():
        return has_prefix(code, prefix)
    c = F.col(code)
    if prefix.startswith("0"):
        return c == 0 if prefix == "0" else F.lit(False) & c.isNotNull()
    lo = int(prefix)
    long_max = 2 ** 63 - 1
    cond = None
    for k in range(0, max(0, max_digits - len(prefix)) + 1):
        low, high = lo * 10 ** k, (lo + 1) * 10 ** k
        if low > long_max:                 # no integer column value can be this large
            break
        part = (c >= low) & (c < high) if high <= long_max else (c >= low)
        cond = part if cond is None else cond | part
    return cond
