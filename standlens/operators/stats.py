"""Distribution summaries: quartiles (R type 7), plus the usual moments.

``quantile_frame`` returns one row per group with ``q_<p>`` columns by one
of four methods (see ``Params.quantile_method``):

* ``distributed``: exact, via ``operators.quantiles`` (two scans, no group's values
  gathered in one task; fails if a bracket is wrong or too full);
* ``narrowing``: exact whatever the values are; runs its scans when it is called, three or more, until every bracket is right;
* ``local``: Spark's ``percentile`` (exact; partial aggregates keep one
  (value, count) pair per distinct value and group, merged in one task per
  group): right when the value domain is bounded, e.g. ages in years;
* ``approx``: ``percentile_approx`` with a fixed-size sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from standlens.operators.quantiles import _name, exact_quantiles, narrowed_quantiles


def quantiles(value: str, probs: list[float], exact: bool = True, accuracy: int = 100_000) -> Column:
    """Aggregate expression (array of quantiles) for bounded value domains."""
    c = F.col(value)
    if exact:
        return F.percentile(c, probs)
    return F.percentile_approx(c, probs, accuracy).cast("array<double>")


def quantile_frame(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float],
                   method: str = "distributed", accuracy: int = 100_000, extra: Sequence[Column] = (),
                   again: DataFrame | None = None) -> DataFrame:
    """One row per group: ``q_<p>`` columns (null for a group without values) and the ``extra`` aggregates."""
    if method == "distributed":
        return exact_quantiles(df, by, value, probs, extra, again)
    if method == "narrowing":
        return narrowed_quantiles(df, by, value, probs, extra, again)
    q = quantiles(value, list(probs), method == "local", accuracy)
    g = df.groupBy(*by).agg(q.alias("__q"), *extra)
    return g.select(*by, *[F.col("__q")[i].alias(_name(p)) for i, p in enumerate(probs)],
                    *[c for c in g.columns if c not in (*by, "__q")])
