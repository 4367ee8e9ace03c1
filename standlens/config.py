"""Frozen run parameters.

The workflow this library reproduces hides its parameters as constants;
here they live in one immutable object. ``current_year`` is always an
argument, never the wall clock, so runs are reproducible.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    current_year: int
    baseline_year: int = 2015
    min_year: int = 1950
    # authorities that make up the working division
    division: tuple[str, ...] = ("Wildlife",)
    # code-branch prefix of the agriculture class and the focal L3 label
    agriculture_prefix: str = "2"
    agriculture_class: str = "Agriculture"
    openland_label: str = "Herbaceous Openland"
    water_label: str = "Water"
    missing_label: str = "Missing / NA"
    # size-class breaks (acres) and inventory-age breaks (years)
    size_breaks: tuple[float, ...] = (5.0, 20.0, 50.0, 100.0)
    age_breaks: tuple[int, ...] = (5, 10, 15)
    # top-k cuts
    unit_top_k: int = 10
    cover_top_k: int = 10
    latest_top_k: int = 12
    area_top_k: int = 15
    concentration_cuts: tuple[int, ...] = (5, 10, 20)
    water_min_acres: float = 1.0
    histogram_bins: int = 50
    comparison_divisions: tuple[str, ...] = ("State Forests", "Wildlife", "State Parks")
    # quantiles of continuous values: "distributed" (exact, no group gathered
    # in one task; two scans, lazily), "narrowing" (the same with verified
    # brackets that move and narrow, run at once), "local" (Spark percentile: one map of distinct values per
    # group in one task), "approx" (fixed-size percentile_approx sketch)
    quantile_method: str = "distributed"
    quantile_accuracy: int = 100_000

    @property
    def project_classes(self) -> tuple[str, str]:
        return (self.agriculture_class, self.openland_label)

    def with_overrides(self, values: dict) -> "Params":
        """A copy with fields replaced (lists become tuples); unknown keys fail."""
        from dataclasses import fields, replace
        known = {f.name for f in fields(self)}
        bad = set(values) - known
        if bad:
            raise ValueError(f"unknown parameters: {sorted(bad)}")
        return replace(self, **{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


# Parameters of the test binding (see FIXTURES.md): the Wildlife division
# maps to one region; the year window is shifted to the test data's dates.
FIXTURE_PARAMS = Params(current_year=2001, baseline_year=1997, min_year=1950)
