"""Summarise the physical plans of the headline queries (exchanges, partial
limits, broadcasts, pushed filters) over the prepared hand-off.
Usage: python scripts/plan_summary.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bench import HEADLINE  # noqa: E402
from standlens.config import FIXTURE_PARAMS  # noqa: E402
from standlens.plans.context import Context  # noqa: E402
from standlens.plans.registry import queries  # noqa: E402
from standlens.session import checkpoint_dir, local_session  # noqa: E402
from standlens.sources.sinks import prepared_context, write_department  # noqa: E402


def summarise(plan: str) -> dict:
    ex = re.findall(r"Exchange (hashpartitioning\(([^)]*)\)|rangepartitioning|SinglePartition)", plan)
    hash_keys = sorted({re.sub(r"#\d+L?", "", k).split(", ")[0] for _, k in ex if k})
    return {
        "hash": sum(1 for e, _ in ex if e.startswith("hash")),
        "range": sum(1 for e, _ in ex if e == "rangepartitioning"),
        "single": sum(1 for e, _ in ex if e == "SinglePartition"),
        "broadcast": plan.count("BroadcastExchange"),
        "partial_limit": len(re.findall(r"WindowGroupLimit .*Partial", plan)),
        "subqueries": plan.count("Subquery subquery"),
        "partition_filters": "PartitionFilters: [isnotnull(authority_key" in plan,
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]", plan)),
        "hash_keys": ", ".join(hash_keys[:4]),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    raw = Context.from_tpch(spark, sf, FIXTURE_PARAMS)
    path = os.path.join(checkpoint_dir(spark), f"plan-summary-{os.getpid()}")
    ctx = prepared_context(raw, write_department(raw, path))
    reg = queries()
    print("| query | hash exch. | range | single | broadcast | partial limit | scalar subq. | pruned | pushed |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name in HEADLINE:
        plan = reg[name].run(ctx)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| {name} | {s['hash']} | {s['range']} | {s['single']} | {s['broadcast']} | {s['partial_limit']} | "
              f"{s['subqueries']} | {'yes' if s['partition_filters'] else 'no'} | {s['pushed']} |")


if __name__ == "__main__":
    main()
