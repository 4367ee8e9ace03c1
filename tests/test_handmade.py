"""End-to-end cases on hand-made records (FIXTURES.md section 3)."""

import datetime as dt

import pytest

from standlens.config import Params
from standlens.plans import analysis as A
from standlens.plans import profile as E
from standlens.plans.context import DEPARTMENT, DIVISION, Context
from standlens.sources import fixture as fx
from standlens.sources.fixture import Inputs
from standlens.sources.literal import literal_table

P = Params(current_year=2001, baseline_year=1997)
STANDS_DDL = ("fcskey long, fc_key long, l4covertype int, canopy_closure int, managed_site int, "
              "sub_canopy_cover int, acres double, date timestamp_ntz, last_edited_date timestamp_ntz, "
              "tb1 int, tb2 long, tb3 long")


def d(y, m=6, day=1):
    return dt.datetime(y, m, day)


ROWS = [
    # stand 100: water -> land -> water, Wildlife compartment 1
    (100, 1, 500, 1, 1, None, 10.0, d(1998), None, 1, 0, 0),
    (100, 1, 310, 1, 1, None, 10.0, d(1999), None, 2, 0, 0),
    (100, 1, 500, 1, 1, None, 10.0, d(2000), None, 3, 0, 0),
    # stand 200 changes authority: Wildlife in 1998, State Forests in 2000
    (200, 1, 211, 2, 2, None, 5.0, d(1998), None, 1, 0, 0),
    (200, 2, 211, 2, 2, None, 5.0, d(2000), None, 2, 0, 0),
    # stand 300 only before 1950, stand 400 only in the future
    (300, 1, 310, 1, 1, None, 20.0, d(1899, 12, 30), None, 1, 0, 0),
    (400, 1, 310, 1, 1, None, 20.0, d(2005), None, 1, 0, 0),
    # stand 500: two records on the same date; the first in input order wins
    (500, 1, 3101, 3, 1, 4, 50.0, d(1999, 5, 1), None, 1, 0, 0),
    (500, 1, 3101, 3, 1, 4, 100.0, d(1999, 5, 1), None, 2, 0, 0),
    # stand 600: zero acres in a unit of its own (compartment 3)
    (600, 3, 310, 1, 1, None, 0.0, d(2001), None, 1, 0, 0),
]
COMPARTMENTS = [(1, 5, 10, 100.0), (2, 1, 20, 100.0), (3, 5, 30, 100.0)]
UNITS = [(10, "Unit A"), (20, "Unit B"), (30, "Unit C")]


def make_ctx(spark, rows=ROWS):
    stands = spark.createDataFrame(rows, STANDS_DDL) if rows else spark.createDataFrame([], STANDS_DDL)
    comps = spark.createDataFrame(COMPARTMENTS, "fc_key long, management_type int, unit_name long, acres double")
    from pyspark.sql import types as T
    dom = T.StructType([T.StructField("code", T.LongType()), T.StructField("unit_key", T.StringType())])
    domains = {
        "canopy_closure": fx._domain(spark, fx.CANOPY_DOMAIN, "canopy_key"),
        "cover_type": fx._domain(spark, fx.COVER_DOMAIN, "l4cover_key"),
        "management": fx._domain(spark, fx.MANAGEMENT_DOMAIN, "management_key"),
        "authority": fx._domain(spark, fx.AUTHORITY_DOMAIN, "authority_key"),
        "unit_name": literal_table(spark, UNITS, dom),
    }
    rowsn = {"canopy_closure": 5, "cover_type": 15, "management": 2, "authority": 4, "unit_name": 3}
    return Context(spark, Inputs(spark, stands, comps, domains, None, rowsn), P)


@pytest.fixture(scope="module")
def hctx(spark):
    return make_ctx(spark)


def test_valid_window_and_same_date_tie(hctx):
    dedup = {(r.fcskey, r.inventory_year_raw): r.acres for r in hctx.div.dedup.collect()}
    assert not any(k[0] in (300, 400) for k in dedup)
    assert dedup[(500, 1999)] == 50.0


def test_water_land_water_in_annual_snapshots(hctx):
    ann = A.annual_project_cover_summary(hctx).collect()
    open_land = {r.inventory_year: r.stands for r in ann if r.project_cover_class == "Herbaceous Openland"}
    # stand 100 is land only in 1999; stand 500 (grass) from 1999; stand 600 (open land) in 2001
    assert open_land == {1999: 2, 2000: 1, 2001: 2}
    tot = {r.inventory_year: r.total_terrestrial_stands for r in ann}
    assert tot[2000] == 2     # stand 100 is water in 2000 and drops out; stands 200 and 500 remain


def test_authority_change_scopes(hctx):
    v = {r.check: r.value for r in A.consistency_summary(hctx).collect()}
    # division: stand 200's newest Wildlife record (1998); department: its newest record is State Forests
    assert v["Stands only in WLD workflow"] == 1.0
    assert v["Stands only in Department workflow"] == 0.0
    dept_latest = {r.fcskey: r.authority_key for r in hctx.dept.latest.collect()}
    assert dept_latest[200] == "State Forests"


def test_one_row_class_and_zero_acre_unit(hctx):
    size = {r.project_cover_class: r for r in A.stand_size_summary(hctx).collect()}
    assert size["Agriculture"].stands == 1 and size["Agriculture"].sd_acres is None
    full = {r.unit_key: r for r in A.management_area_full(hctx).collect()}
    assert full["Unit C"].total_terrestrial_acres == 0.0
    assert full["Unit C"].agriculture_percent_terrestrial_acres is None      # 0 / 0 -> null, not an error
    assert full["Unit C"].agriculture_acres == 0.0                          # absent class: zero, not null
    sizes = {r.size_class: r.n for r in E.acre_size(hctx).collect()}
    # division records with acres > 0: stand 100 (3 x 10), 200 (5, Wildlife record only), 300 and 400
    # (20 each), 500 (50 and 100); 600 has 0 acres
    assert sizes == {"5–20 acres": 4, "20–50 acres": 2, "50–100 acres": 1, "100+ acres": 1}


def test_repeated_lookup_key_is_detected(spark):
    from standlens.operators.lookup import duplicate_codes
    lk = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "code int, label string")
    assert [r.code for r in duplicate_codes(lk, "code").collect()] == [1]


def test_empty_input_gives_empty_or_zero_results(spark):
    ectx = make_ctx(spark, rows=[])
    assert A.annual_cover_summary(ectx, DIVISION).count() == 0
    assert A.report_summary(ectx).count() == 0
    assert A.management_area_full(ectx).count() == 0
    ret = A.department_retention(ectx).collect()
    assert [r.rows_or_stands for r in ret] == [0] * 5 and all(r.percent_acres_retained is None for r in ret)
    w = {r.metric: r.working for r in E.working_summary(ectx).collect()}
    assert w == {"Compartments": 0.0, "Stands": 0.0, "Acres": 0.0}
    assert A.annual_cover_summary(ectx, DEPARTMENT).count() == 0
