"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Step 1 (prepare) writes the decoded department set once, partitioned by
authority, to the session's checkpoint folder, as the workflow hands its
prepared set to the later steps, plus each scope's stand-year table and
latest snapshot (the workflow saves its snapshots too); its time is
reported as ``prepare``. ``decode_and_join_from_raw`` runs the lookups and the compartment join (JN-01..04) from the raw
tables, without storing anything. Every other query then runs on the stored tables; ``jn_04_department_working`` there is a scan of
the stored set, not the join. All are executed fully with a ``noop`` write (no driver collection). Prints one JSON
line: per-query median seconds, their sum as ``value``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from standlens.config import FIXTURE_PARAMS  # noqa: E402
from standlens.plans.context import Context  # noqa: E402
from standlens.plans.registry import queries  # noqa: E402
from standlens.session import checkpoint_dir, local_session  # noqa: E402
from standlens.sources.sinks import prepared_context, write_department  # noqa: E402

FROM_RAW = "decode_and_join_from_raw"
HEADLINE = [
    "jn_04_department_working",
    "agg_09_inventory_base_summary",
    "eda_02_missing_summary",
    "eda_08_cover_summary",
    "eda_19_acre_summary",
    "eda_27_stand_inventory_age_summary",
    "eda_31_water_by_unit",
    "eda_32_appendix_summary",
    "snp_08_annual_cover_summary_division",
    "snp_08_annual_cover_summary_department",
    "snp_13_department_retention",
    "snp_18_consistency_summary",
    "snp_20_annual_project_cover_summary",
    "snp_24_stand_size_summary",
    "snp_28_management_area_full",
    "snp_30_acre_concentration",
    "snp_34_report_summary",
    "snp_36_class_authority_context",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=cpus)
    base = checkpoint_dir(spark)
    raw = Context.from_tpch(spark, sf_dir, FIXTURE_PARAMS)
    prep_path = os.path.join(base, f"prepared-{os.getpid()}-{int(time.time())}")
    t = time.perf_counter()
    write_department(raw, prep_path)
    ctx = prepared_context(raw, prep_path)
    # the stand-year table and latest snapshot of both scopes, written once
    ctx.div.materialize(prep_path + "-snapshots")
    ctx.dept.materialize(prep_path + "-snapshots")
    prepare_sec = time.perf_counter() - t
    reg = queries()
    times: dict[str, float] = {"prepare": round(prepare_sec, 3)}
    for name, source in [(FROM_RAW, raw), *[(n, ctx) for n in HEADLINE]]:
        samples = []
        for _ in range(runs):
            t = time.perf_counter()
            reg["jn_04_department_working" if name == FROM_RAW else name].run(source).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t)
        times[name] = round(statistics.median(samples), 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_median_query_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
