"""The three workflow steps as one Spark job, writing every output.

Step 1 (prepare): department and division hand-offs, reusable compartment
layer and lookups. Step 2 (explore/QC): the appendix table. Step 3
(analyse): the seven report tables and both snapshots. Later steps read
the step-1 hand-off, so the decode-and-join work runs once. ``out_dir``
must be shared storage on a cluster.
"""

from __future__ import annotations

import os
from dataclasses import replace

from standlens.plans.context import Context
from standlens.sources import sinks


def run_workflow(ctx: Context, out_dir: str) -> dict[str, str]:
    step1 = os.path.join(out_dir, "step1")
    outputs = {"department": sinks.write_department(ctx, os.path.join(step1, "stands_department_working"))}
    prepared = sinks.prepared_context(ctx, outputs["department"])
    if ctx.p.quantile_method == "distributed":      # a job that runs at once can as well look where the quantiles lie
        prepared.p = replace(ctx.p, quantile_method="narrowing")
    # the department hand-off has no geometry; where the records have one, the division's keeps it
    source = ctx if "geometry" in ctx.inputs.stands.columns else prepared
    outputs["division"] = sinks.write_division(source, os.path.join(step1, "stands_working"))
    outputs.update(sinks.write_compartments(ctx, os.path.join(step1, "supplemental")))
    # the stand-year table and latest snapshot feed most step-3 tables
    prepared.div.materialize(os.path.join(out_dir, "work"))
    prepared.dept.materialize(os.path.join(out_dir, "work"))
    outputs.update(sinks.write_reports(prepared, os.path.join(out_dir, "reports")))
    outputs.update(sinks.write_snapshots(prepared, os.path.join(out_dir, "step3")))
    return outputs
