"""Command line for the whole workflow.

    python -m standlens --sf-dir DIR --out DIR                      # driver's TPC-H tables
    python -m standlens --stands P --compartments P \\
        --domain canopy_closure=P --domain cover_type=P --domain management=P \\
        --domain authority=P --domain unit_name=P --out DIR --current-year 2025   # real layers

Parameters default to the workflow's own (baseline 2015, minimum 1950, division Wildlife) for
real layers and to the test binding's for ``--sf-dir``.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import replace

from standlens.config import FIXTURE_PARAMS, Params
from standlens.plans.context import Context
from standlens.session import SCALE_CONF, configure, local_session
from standlens.workflow import run_workflow


def parse(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="standlens")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="folder with the driver's parquet tables")
    src.add_argument("--stands", help="stand records (parquet)")
    ap.add_argument("--compartments", help="compartment layer (parquet)")
    ap.add_argument("--domain", action="append", default=[], help="name=path of a code,label CSV (repeat)")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--current-year", type=int)
    ap.add_argument("--baseline-year", type=int)
    ap.add_argument("--min-year", type=int)
    ap.add_argument("--division", action="append", help="authority label of the division (repeat)")
    ap.add_argument("--params", help="JSON file of Params fields to override (e.g. size_breaks, area_top_k)")
    ap.add_argument("--master", default=None, help="local[N] for a local run; omit under spark-submit")
    return ap.parse_args(argv)


def params(a: argparse.Namespace) -> Params:
    if a.sf_dir:
        p = FIXTURE_PARAMS
    else:
        if a.current_year is None:
            raise SystemExit("--current-year is required for real layers")
        p = Params(current_year=a.current_year)
    changes = {k: v for k, v in (("current_year", a.current_year), ("baseline_year", a.baseline_year),
                                 ("min_year", a.min_year)) if v is not None}
    if a.division:
        changes["division"] = tuple(a.division)
    p = replace(p, **changes)
    if a.params:
        with open(a.params) as fh:
            p = p.with_overrides(json.load(fh))
    return p


def main(argv=None) -> None:
    a = parse(argv)
    if a.master:
        spark = local_session(cores=a.master.removeprefix("local[").rstrip("]") or "*")
    else:
        from pyspark.sql import SparkSession
        spark = configure(SparkSession.builder.appName("standlens").config(map=SCALE_CONF).getOrCreate())
    p = params(a)
    if a.sf_dir:
        ctx = Context.from_tpch(spark, a.sf_dir, p)
    else:
        from standlens.sources.files import file_inputs
        if not a.compartments or not a.domain:
            raise SystemExit("--compartments and --domain are required with --stands")
        domains = dict(d.split("=", 1) for d in a.domain)
        ctx = Context(spark, file_inputs(spark, a.stands, a.compartments, domains), p)
    print(json.dumps(run_workflow(ctx, a.out), indent=1))


if __name__ == "__main__":
    main()
