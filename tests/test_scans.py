"""How often queries read their records, and that building a plan starts no job."""

import glob
import json
import os
import subprocess
import sys
import textwrap

from standlens.plans.registry import queries

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
#: Queries that write a layer and read it back: the write is part of the query.
SINKS = ("src_", "prj_01_", "prj_09_")

#: Reads of the table named, at most (the quantiles need a second scan).
LIMITS = {
    "eda_05_unit_summary": ("division", 1), "eda_05_unit_top10": ("division", 1), "eda_06_cover_200_summary": ("division", 1),
    "eda_08_cover_summary": ("division", 1), "eda_11_sub_canopy_availability": ("division", 1), "eda_19_acre_summary": ("division", 2),
    "eda_32_appendix_summary": ("division", 4), "snp_19_project_cover_summary": ("latest", 1), "snp_24_stand_size_summary": ("latest", 2),
    "snp_28_management_area_full": ("latest", 1), "snp_30_acre_concentration": ("latest", 1), "snp_34_report_summary": ("latest", 3),
    "snp_36_class_authority_context": ("dept_latest", 1), "snp_37_authority_comparison": ("dept_latest", 1), "jn_08_category_report": ("latest", 3),
    "snp_37_authority_comparison_check": ("dept_latest", 1), "jn_09_landbase_join": ("dept_latest", 1),
    "win_01_share_of_total": ("department", 1), "win_03_rank_running_total": ("department", 1),
}

SCRIPT = textwrap.dedent("""
    import json, sys
    from pyspark.sql import SparkSession
    from standlens.config import FIXTURE_PARAMS
    from standlens.plans.context import Context
    from standlens.plans.registry import queries
    from standlens.session import SCALE_CONF
    from standlens.sources.sinks import prepared_context, write_department
    out, names = sys.argv[1], sys.argv[2].split(",")
    conf = SCALE_CONF | {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": "file://" + out, "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.sql.warehouse.dir": out + "/warehouse"}
    spark = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    raw = Context.from_tpch(spark, "/root/testdata/sf0.001", FIXTURE_PARAMS)
    ctx = prepared_context(raw, write_department(raw, out + "/prepared"))
    ctx.div.materialize(out + "/snapshots")
    ctx.dept.materialize(out + "/snapshots")
    sizes = {"division": ctx.division.count(), "department": ctx.department.count(), "latest": ctx.div.latest.count(),
             "dept_latest": ctx.dept.latest.count()}
    for n in names:
        spark.sparkContext.setJobGroup(n, n)
        queries()[n].run(ctx).collect()
    print("SIZES", json.dumps(sizes))
    spark.stop()
""")


def test_records_are_read_once(tmp_path):
    out = str(tmp_path)
    done = subprocess.run([sys.executable, "-c", SCRIPT, out, ",".join(LIMITS)], cwd=ROOT, capture_output=True, text=True, timeout=600,
                          env=os.environ | {"PYTHONPATH": ROOT})
    assert "SIZES" in done.stdout, done.stderr[-2000:]
    sizes = json.loads(done.stdout.split("SIZES", 1)[1])
    group, read = {}, {}
    for path in glob.glob(f"{out}/local-*"):
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    for s in e["Stage IDs"]:
                        group.setdefault(s, e["Properties"].get("spark.jobGroup.id"))
                elif e["Event"] == "SparkListenerTaskEnd":
                    n = (e.get("Task Metrics") or {}).get("Input Metrics", {}).get("Records Read", 0)
                    read[group.get(e["Stage ID"])] = read.get(group.get(e["Stage ID"]), 0) + n
    over = {n: read[n] / sizes[t] for n, (t, most) in LIMITS.items() if read[n] > most * sizes[t] + 50}
    assert over == {}


def test_the_report_keeps_nothing(spark, ctx):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    queries()["snp_34_report_summary"].run(ctx).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_building_plans_starts_no_job(spark, ctx):
    sc = spark.sparkContext
    sc.setJobGroup("build", "build")
    try:
        for name, q in queries().items():
            if not name.startswith(SINKS):
                q.run(ctx)
        assert list(sc.statusTracker().getJobIdsForGroup("build")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
