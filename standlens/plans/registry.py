"""Registered queries: inventory ID -> Spark plan and oracle SQL.

callable takes a ``Context``; each SQL string runs in DuckDB over the
driver's tables. Both sides round doubles to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame

from standlens.plans import analysis as A
from standlens.plans import appendix as X
from standlens.plans import prepare as P
from standlens.plans import profile as E
from standlens.plans.context import DEPARTMENT, DIVISION, Context
from standlens.plans.oracle import R, q


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Context], DataFrame]
    sql: str | None


def pct_label(x: str) -> str:
    return f"format('{{:,.1f}}', CAST(100 * ({x}) AS DOUBLE)) || '%'"


def comma(x: str) -> str:
    return f"format('{{:,.0f}}', CAST({x} AS DOUBLE))"


def number(x: str) -> str:
    return f"replace(format('{{:,.1f}}', CAST({x} AS DOUBLE)), ',', ' ')"


STANDS_COLS = ("fcskey, fc_key, l4covertype, canopy_closure, managed_site, sub_canopy_cover, acres, date, "
               "last_edited_date, tb1, tb2, tb3")
CODED_COLS = STANDS_COLS + ", l4covertype_full, l3covertype, canopy_key, l4cover_key, management_key"
LABELLED_COLS = CODED_COLS + ", l3cover_key, l3_key_source"
WORKING_COLS = LABELLED_COLS + ", authority_key, management_type, unit_key, unit_name"
COVER_COLS = WORKING_COLS + ", cover_code_chr, project_cover_class"
TIMED_COLS = COVER_COLS + ", inventory_year_raw, inventory_year"


def _cols(df: DataFrame, cols: str) -> DataFrame:
    return df.select(*[c.strip() for c in cols.split(",")])


def _share_sql(src: str, keys: str, extra: str = "") -> str:
    return f"""SELECT {keys}, count(*) AS stands, coalesce(sum(acres), 0) AS acres{extra} FROM {src} GROUP BY ALL"""


REG: list[Query] = []


def reg(name: str, run: Callable[[Context], DataFrame], sql: str | None) -> None:
    REG.append(Query(name, run, None if sql is None else q(sql)))


# ------------------------------------------------------------------ E1 lookups and joins
reg("prj_06_unit_lookup", lambda c: c.unit_lookup, "SELECT * FROM unit_lk")
reg("prj_07_cover_code_rollup",
    lambda c: c.stands_coded.select("fcskey", "tb1", "tb2", "tb3", "l4covertype_full", "l3covertype"),
    "SELECT fcskey, tb1, tb2, tb3, l4covertype_full, l3covertype FROM coded")
reg("jn_01_stand_domain_labels", lambda c: _cols(c.stands_coded, CODED_COLS), f"SELECT {CODED_COLS} FROM coded")
reg("jn_02_stand_l3_labels", lambda c: _cols(c.stands_labelled, LABELLED_COLS),
    f"SELECT {LABELLED_COLS} FROM labelled")
reg("jn_03_compartment_labels", lambda c: c.compartments_labelled,
    "SELECT authority_key, management_type, unit_key, unit_name, fc_key, acres FROM comp_lab")
reg("ded_01_compartments_unique", lambda c: c.compartments_unique,
    "SELECT fc_key, authority_key, management_type, unit_key, unit_name, acres FROM comp_u")
reg("jn_04_department_working", lambda c: _cols(c.department, WORKING_COLS), f"SELECT {WORKING_COLS} FROM dept")
reg("flt_01_division_working", lambda c: _cols(c.division, WORKING_COLS), f"SELECT {WORKING_COLS} FROM wld")

# ------------------------------------------------------------------ E1 checks
reg("agg_01_cover_level_counts", P.cover_level_counts, """
SELECT 'Level ' || coalesce(CAST(length(CAST(l4covertype_full AS VARCHAR)) AS VARCHAR), 'NA') AS cover_level,
       CAST(length(CAST(l4covertype_full AS VARCHAR)) AS INTEGER) AS cover_code_digits, count(*) AS n
FROM coded GROUP BY ALL""")
reg("agg_02_cover_code_counts", P.cover_code_counts,
    "SELECT l4covertype_full, l4cover_key, count(*) AS n FROM coded GROUP BY ALL")
reg("agg_03_cover_hierarchy_summary", P.cover_hierarchy_summary, """
SELECT l3covertype, count(*) AS stand_records,
       count(DISTINCT l4covertype_full) + coalesce(max(CASE WHEN l4covertype_full IS NULL THEN 1 ELSE 0 END), 0)
         AS unique_full_cover_codes
FROM coded GROUP BY ALL""")
_L3_CHECK = """
chk AS (
  SELECT 'Cover type domain' AS stage, c.l3covertype, l.l4cover_key AS l3cover_key_check
  FROM (SELECT DISTINCT l3covertype FROM coded) c
  LEFT JOIN l4_lk l ON c.l3covertype IS NOT DISTINCT FROM l.l4covertype_full
  UNION ALL
  SELECT 'Domain plus manual crosswalk', c.l3covertype, l.l3cover_key
  FROM (SELECT DISTINCT l3covertype FROM coded) c
  LEFT JOIN l3_lk l ON c.l3covertype IS NOT DISTINCT FROM l.l3covertype)"""


def _l3_check(ctx: Context) -> DataFrame:
    from pyspark.sql import functions as F
    a = P.l3_lookup_check(ctx, False, ordered=False).select(F.lit(P.STAGE_DOMAIN).alias("stage"), "*")
    b = P.l3_lookup_check(ctx, True, ordered=False).select(F.lit(P.STAGE_CROSSWALK).alias("stage"), "*")
    return a.unionByName(b)


reg("jn_05_l3_lookup_check", _l3_check, f", {_L3_CHECK} SELECT * FROM chk")
reg("agg_04_l3_lookup_coverage", P.l3_lookup_coverage, f""", {_L3_CHECK}
SELECT stage, count(*) AS total_l3_codes, count(l3cover_key_check) AS l3_codes_with_description,
       count(*) FILTER (WHERE l3cover_key_check IS NULL) AS l3_codes_missing_description
FROM chk GROUP BY stage""")
reg("agg_05_l3_missing_descriptions", P.l3_missing_descriptions,
    f", {_L3_CHECK} SELECT stage, l3covertype FROM chk WHERE l3cover_key_check IS NULL")
reg("agg_06_l3_label_counts", P.l3_label_counts,
    "SELECT l3covertype, l3cover_key, count(*) AS n FROM labelled GROUP BY ALL")
reg("agg_07_records_per_authority", P.records_per_authority,
    "SELECT authority_key, count(*) AS n FROM dept GROUP BY ALL")
reg("set_03_unit_key_check", P.unit_key_check, "SELECT DISTINCT authority_key, unit_key FROM dept")
_COMP_ACRES = """
SELECT 'Wildlife compartments' AS dataset, count(*) AS compartments,
       count(DISTINCT fc_key) + coalesce(max(CASE WHEN fc_key IS NULL THEN 1 ELSE 0 END), 0) AS unique_compartments,
       CAST(NULL AS BIGINT) AS stands, CAST(NULL AS BIGINT) AS unique_stands, coalesce(sum(acres), 0) AS acres
FROM comp_lab WHERE authority_key IN ('Wildlife')"""
_WORK_SUM = """
SELECT 'Prepared working stand dataset' AS dataset,
       count(DISTINCT fc_key) + coalesce(max(CASE WHEN fc_key IS NULL THEN 1 ELSE 0 END), 0) AS compartments,
       count(DISTINCT fc_key) + coalesce(max(CASE WHEN fc_key IS NULL THEN 1 ELSE 0 END), 0) AS unique_compartments,
       count(*) AS stands, count(DISTINCT fcskey) + coalesce(max(CASE WHEN fcskey IS NULL THEN 1 ELSE 0 END), 0) AS unique_stands,
       coalesce(sum(acres), 0) AS acres
FROM wld"""
reg("agg_08_compartment_acres_summary", P.compartment_acres_summary, _COMP_ACRES)
reg("agg_09_inventory_base_summary", P.inventory_base_summary, f"{_COMP_ACRES} UNION ALL {_WORK_SUM}")
reg("agg_10_inventory_base_difference", P.inventory_base_difference, f"""
SELECT c.acres AS compartment_acres, s.acres AS stand_acres, c.acres - s.acres AS acre_difference,
       {R('100 * (c.acres - s.acres) / c.acres', 'percent_difference')},
       {R('100 * s.acres / c.acres', 'percent_accounted_for')}
FROM ({_COMP_ACRES}) c, ({_WORK_SUM}) s""")
reg("agg_11_compartments_reusable_check", P.compartments_reusable_check, """
SELECT count(*) AS records, count(DISTINCT fc_key) + coalesce(max(CASE WHEN fc_key IS NULL THEN 1 ELSE 0 END), 0) AS unique_compartments,
       count(DISTINCT authority_key) AS management_authorities, count(DISTINCT unit_key) AS management_areas
FROM comp_u""")

# ------------------------------------------------------------------ E2 profile
_SCOPE_SUM = """
SELECT metric, v AS {col} FROM (
  SELECT CAST(count(DISTINCT fc_key) + coalesce(max(CASE WHEN fc_key IS NULL THEN 1 ELSE 0 END), 0) AS DOUBLE) AS "Compartments",
         CAST(count(*) AS DOUBLE) AS "Stands", coalesce(sum(acres), 0) AS "Acres" FROM {src})
UNPIVOT (v FOR metric IN ("Compartments", "Stands", "Acres"))"""
reg("eda_01_working_summary", E.working_summary, _SCOPE_SUM.format(col="working", src="wld"))
reg("eda_01_department_summary", E.department_summary, _SCOPE_SUM.format(col="department", src="dept"))
_MISS = " UNION ALL ".join(
    f"SELECT '{lab}' AS variable, count(*) FILTER (WHERE {c} IS NULL) AS missing_values, "
    f"count(*) FILTER (WHERE {c} = 0) AS zero_values, count(*) AS total_rows FROM wld"
    for lab, c in E.MISSING_VARIABLES)
reg("eda_02_missing_summary", E.missing_summary, f"""
SELECT *, {R('100 * missing_values / total_rows', 'percent_missing')}, {R('100 * zero_values / total_rows', 'percent_zero')}
FROM ({_MISS})""")
reg("eda_03_authority_summary", E.authority_summary, f"""
SELECT authority_key, n, {R('n / sum(n) OVER ()', 'percent')}, {pct_label('n / sum(n) OVER ()')} AS percent_label
FROM (SELECT authority_key, count(*) AS n FROM wld GROUP BY ALL)""")
reg("eda_04_unique_units", E.unique_units,
    "SELECT count(DISTINCT unit_key) + coalesce(max(CASE WHEN unit_key IS NULL THEN 1 ELSE 0 END), 0) AS unique_units FROM wld")
_UNIT = f"""
SELECT unit_key, stands, acres, {R('stands / sum(stands) OVER ()', 'percent_stands')},
       {R('acres / sum(acres) OVER ()', 'percent_acres')}
FROM ({_share_sql('wld', 'unit_key')})"""
reg("eda_05_unit_summary", E.unit_summary, _UNIT)
reg("eda_05_unit_top10", E.unit_top, f"SELECT * FROM ({_UNIT}) QUALIFY rank() OVER (ORDER BY acres DESC) <= 10")
_AGRI_SRC = "(SELECT * FROM wld WHERE starts_with(CAST(l3covertype AS VARCHAR), '2'))"
reg("eda_06_cover_200_summary", E.cover_200_summary, f"""
SELECT l3covertype, l3cover_key, stands, acres,
       {R('p2s', 'percent_200_stands')}, {R('p2a', 'percent_200_acres')},
       {R('pts', 'percent_total_stands')}, {R('pta', 'percent_total_acres')},
       {pct_label('p2s')} AS percent_200_stands_label, {pct_label('p2a')} AS percent_200_acres_label,
       {pct_label('pts')} AS percent_total_stands_label, {pct_label('pta')} AS percent_total_acres_label
FROM (SELECT *, stands / sum(stands) OVER () AS p2s, acres / sum(acres) OVER () AS p2a,
             stands / (SELECT count(*) FROM wld) AS pts, acres / (SELECT coalesce(sum(acres), 0) FROM wld) AS pta
      FROM ({_share_sql(_AGRI_SRC, 'l3covertype, l3cover_key')}))""")
reg("eda_07_cover_200_by_unit_summary", E.cover_200_by_unit_summary, f"""
SELECT unit_key, l3covertype, l3cover_key, stands, acres, CAST(tus AS BIGINT) AS total_unit_200_stands,
       {R('stands / tus', 'percent_unit_200_stands')}, tua AS total_unit_200_acres,
       {R('acres / tua', 'percent_unit_200_acres')},
       {pct_label('stands / tus')} AS percent_unit_200_stands_label,
       {pct_label('acres / tua')} AS percent_unit_200_acres_label
FROM (SELECT *, sum(stands) OVER (PARTITION BY unit_key) AS tus, sum(acres) OVER (PARTITION BY unit_key) AS tua
      FROM ({_share_sql(_AGRI_SRC, 'unit_key, l3covertype, l3cover_key')}))""")
_COVER = f"""
SELECT l3covertype, l3cover_key, stands, acres, {R('ps', 'percent_stands')}, {R('pa', 'percent_acres')},
       {pct_label('ps')} AS percent_stands_label, {pct_label('pa')} AS percent_acres_label
FROM (SELECT *, stands / sum(stands) OVER () AS ps, acres / sum(acres) OVER () AS pa
      FROM ({_share_sql('wld', 'l3covertype, l3cover_key')}))"""
reg("eda_08_cover_summary", E.cover_summary, _COVER)
reg("eda_08_cover_compare", E.cover_compare, f"""
SELECT l3cover_key, metric, percent FROM (
  SELECT l3cover_key, percent_stands AS "Stands", percent_acres AS "Acres" FROM ({_COVER})
  QUALIFY rank() OVER (ORDER BY acres DESC) <= 10)
UNPIVOT (percent FOR metric IN ("Stands", "Acres"))""")
reg("eda_09_cover_acres_per_stand", E.cover_acres_per_stand, f"""
SELECT l3cover_key, stands, acres, {R('acres / stands', 'acres_per_stand')}
FROM ({_share_sql('wld', 'l3covertype, l3cover_key')})""")
_CANOPY_CLASS = """CASE WHEN canopy_key IS NULL THEN 'NA' WHEN canopy_key = '0-25' THEN '0–<25'
  WHEN canopy_key = '25-50' THEN '25–<50' WHEN canopy_key = '50-75' THEN '50–<75' WHEN canopy_key = '75-100' THEN '75–100'
  WHEN canopy_key IN ('NA', 'Missing', 'Missing / NA', 'Unspecified') THEN 'NA' END"""
_CANOPY = f"""
SELECT canopy_key, stands, acres, {R('100 * stands / sum(stands) OVER ()', 'percent_stands')},
       {R('100 * acres / sum(acres) OVER ()', 'percent_acres')}
FROM ({_share_sql(f'(SELECT * REPLACE ({_CANOPY_CLASS} AS canopy_key) FROM wld)', 'canopy_key')})"""
reg("eda_10_canopy_summary", E.canopy_summary, _CANOPY)
reg("eda_10_canopy_compare", E.canopy_compare, f"""
SELECT canopy_key, metric, percent FROM (
  SELECT canopy_key, percent_stands AS "Stands", percent_acres AS "Acres" FROM ({_CANOPY}))
UNPIVOT (percent FOR metric IN ("Stands", "Acres"))""")
_FOREST = "(SELECT * FROM wld WHERE canopy_key IS NOT NULL AND canopy_key <> '0-25')"
_SUBAV = f"""
SELECT status AS sub_canopy_data_status, records, unique_stands, acres,
       {R('100 * records / sum(records) OVER ()', 'percent_records')},
       {R('100 * unique_stands / sum(unique_stands) OVER ()', 'percent_unique_stands')},
       {R('100 * acres / sum(acres) OVER ()', 'percent_acres')}
FROM (SELECT CASE WHEN sub_canopy_cover IS NULL OR sub_canopy_cover = 0 THEN 'Missing / No data' ELSE 'Available' END
             AS status, count(*) AS records, count(DISTINCT fcskey) AS unique_stands, coalesce(sum(acres), 0) AS acres
      FROM {_FOREST} GROUP BY ALL)"""
reg("eda_11_sub_canopy_availability", E.sub_canopy_availability, _SUBAV)
reg("eda_11_sub_canopy_no_data", E.sub_canopy_no_data,
    f"SELECT * FROM ({_SUBAV}) WHERE sub_canopy_data_status = 'Missing / No data'")
reg("eda_12_sub_canopy_composition", E.sub_canopy_composition, f"""
SELECT sub_canopy_cover, records, unique_stands, acres,
       {R('100 * records / sum(records) OVER ()', 'percent_available_records')},
       {R('100 * unique_stands / sum(unique_stands) OVER ()', 'percent_available_unique_stands')},
       {R('100 * acres / sum(acres) OVER ()', 'percent_available_acres')}
FROM (SELECT CAST(sub_canopy_cover AS VARCHAR) AS sub_canopy_cover, count(*) AS records,
             count(DISTINCT fcskey) AS unique_stands, coalesce(sum(acres), 0) AS acres
      FROM {_FOREST} WHERE sub_canopy_cover IS NOT NULL AND sub_canopy_cover <> 0 GROUP BY ALL)""")
reg("eda_13_canopy_by_cover", E.canopy_by_cover, f"""
SELECT canopy_key, l3cover_key, stands, acres,
       {R('stands / sum(stands) OVER (PARTITION BY canopy_key)', 'percent_within_canopy')}
FROM ({_share_sql('''(SELECT * REPLACE (CASE WHEN coalesce(canopy_key, 'Missing / NA') IN
   ('0-25', '25-50', '50-75', '75-100', 'Unspecified', 'Missing / NA') THEN coalesce(canopy_key, 'Missing / NA') END
   AS canopy_key) FROM wld)''', 'canopy_key, l3cover_key')})""")


def _mgmt_sql(src: str) -> str:
    return f"""
SELECT managed_site, management_key, stands, acres, {R('stands / sum(stands) OVER ()', 'percent_stands')},
       {R('acres / sum(acres) OVER ()', 'percent_acres')}
FROM ({_share_sql(f"(SELECT * REPLACE (coalesce(management_key, 'Missing / NA') AS management_key) FROM {src})",
                  'managed_site, management_key')})"""


def _compare_sql(inner: str, key: str, a: str = "Stands", b: str = "Acres") -> str:
    return f"""
SELECT {key}, metric, percent FROM (SELECT {key}, percent_stands AS "{a}", percent_acres AS "{b}" FROM ({inner}))
UNPIVOT (percent FOR metric IN ("{a}", "{b}"))"""


_OPEN = "(SELECT * FROM wld WHERE canopy_key = '0-25')"
reg("eda_14_management_summary", E.management_summary, _mgmt_sql("wld"))
reg("eda_14_management_compare", E.management_compare, _compare_sql(_mgmt_sql("wld"), "management_key"))
reg("eda_15_open_canopy_management", E.open_canopy_management, _mgmt_sql(_OPEN))
reg("eda_15_open_canopy_compare", E.open_canopy_management_compare,
    _compare_sql(_mgmt_sql(_OPEN), "management_key", "Percent of Stands", "Percent of Acres"))
reg("eda_16_duplicate_stands", E.duplicate_stands,
    "SELECT fcskey, count(*) AS n FROM wld GROUP BY fcskey HAVING count(*) > 1")
_POS = "(SELECT * FROM wld WHERE acres IS NOT NULL AND acres > 0)"
reg("eda_17_acre_size", E.acre_size, f"""
SELECT size_class, n, {R('n / sum(n) OVER ()', 'percent')} FROM (
  SELECT CASE WHEN acres < 5 THEN '<5 acres' WHEN acres < 20 THEN '5–20 acres' WHEN acres < 50 THEN '20–50 acres'
              WHEN acres < 100 THEN '50–100 acres' ELSE '100+ acres' END AS size_class, count(*) AS n
  FROM {_POS} GROUP BY ALL)""")
reg("eda_18_log_acre_histogram", E.log_acre_histogram, f"""
, x AS (SELECT log10(acres) AS x FROM {_POS}), b AS (SELECT min(x) AS lo, max(x) AS hi FROM x)
SELECT bin, count(*) AS n, {R('lo + (bin - 1) * ((hi - lo) / 50)', 'log10_lower')},
       {R('lo + bin * ((hi - lo) / 50)', 'log10_upper')}
FROM (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((x - lo) / (hi - lo) * 50) + 1, 50) END AS INTEGER) AS bin,
             lo, hi FROM x, b)
GROUP BY bin, lo, hi""")
reg("eda_19_acre_summary", E.acre_summary, f"""
SELECT min(acres) AS min_acres, {R('quantile_cont(acres, 0.25)', 'q1_acres')},
       {R('quantile_cont(acres, 0.5)', 'median_acres')}, {R('avg(acres)', 'mean_acres')},
       {R('quantile_cont(acres, 0.75)', 'q3_acres')}, max(acres) AS max_acres, {R('stddev_samp(acres)', 'sd_acres')},
       {R('100 * stddev_samp(acres) / avg(acres)', 'cv_percent')}
FROM wld""")
reg("eda_20_largest_stands", E.largest_stands, """
SELECT acres, l3covertype, l3cover_key, l4covertype_full, l4cover_key, fc_key, unit_key
FROM wld ORDER BY acres DESC NULLS LAST, tb1, tb2, tb3, fcskey LIMIT 10""")
_DATED = "(SELECT w.*, c.created_date FROM wld w LEFT JOIN created c ON w.fcskey = c.fcskey)"
reg("eda_21_date_summary", E.date_summary, f"""
SELECT min(date) AS min_date, max(date) AS max_date, min(created_date) AS min_created_date,
       max(created_date) AS max_created_date, min(last_edited_date) AS min_last_edited_date,
       max(last_edited_date) AS max_last_edited_date FROM {_DATED}""")
_DLONG = f"""(SELECT date_field, CAST(year(date_value) AS INTEGER) AS year FROM (
  SELECT date, created_date, last_edited_date FROM {_DATED})
  UNPIVOT INCLUDE NULLS (date_value FOR date_field IN (date, created_date, last_edited_date)))"""
reg("eda_22_date_year_counts", E.date_year_counts, f"SELECT date_field, year, count(*) AS n FROM {_DLONG} GROUP BY ALL")
reg("eda_23_pre1950_summary", E.pre1950_summary,
    f"SELECT date_field, year, count(*) AS n FROM {_DLONG} WHERE year < 1950 GROUP BY ALL")
reg("eda_24_date_year_summary", E.date_year_summary, f"""
SELECT date_field, year, count(*) AS n FROM {_DLONG}
WHERE year IS NOT NULL AND year >= 1950 AND year <= 2001 GROUP BY ALL""")
reg("eda_25_inventory_year_summary", E.inventory_year_summary, """
SELECT CAST(year(date) AS INTEGER) AS inventory_year, count(*) AS n FROM wld
WHERE year(date) IS NOT NULL AND year(date) >= 1950 AND year(date) <= 2001 GROUP BY ALL""")
_AGE = """(SELECT fcskey, most_recent_inventory_year, 2001 - most_recent_inventory_year AS inventory_age FROM (
  SELECT fcskey, CAST(max(year(date)) AS INTEGER) AS most_recent_inventory_year FROM wld
  WHERE year(date) IS NOT NULL AND year(date) >= 1950 AND year(date) <= 2001 GROUP BY fcskey))"""
reg("eda_26_stand_inventory_age", E.stand_inventory_age, f"SELECT * FROM {_AGE}")
reg("eda_27_stand_inventory_age_summary", E.stand_inventory_age_summary, f"""
SELECT count(*) AS unique_stands, min(inventory_age) AS min_age, {R('quantile_cont(inventory_age, 0.25)', 'q1_age')},
       {R('quantile_cont(inventory_age, 0.5)', 'median_age')}, {R('avg(inventory_age)', 'mean_age')},
       {R('quantile_cont(inventory_age, 0.75)', 'q3_age')}, max(inventory_age) AS max_age,
       {R('stddev_samp(inventory_age)', 'sd_age')}
FROM {_AGE}""")
reg("eda_28_age_by_year", E.age_by_year, f"""
SELECT inventory_age, n, {R('n / sum(n) OVER ()', 'percent')}
FROM (SELECT inventory_age, count(*) AS n FROM {_AGE} GROUP BY ALL)""")
reg("eda_29_age_by_class", E.age_by_class, f"""
SELECT age_class, n, {R('n / sum(n) OVER ()', 'percent')} FROM (
  SELECT CASE WHEN inventory_age < 5 THEN '0–<5 years' WHEN inventory_age < 10 THEN '5–<10 years'
              WHEN inventory_age < 15 THEN '10–<15 years' ELSE '15+ years' END AS age_class, count(*) AS n
  FROM {_AGE} GROUP BY ALL)""")
reg("eda_30_water_summary", E.water_summary, f"""
SELECT water_stands, water_acres, total_stands, total_acres,
       {R('100 * water_stands / total_stands', 'percent_total_stands')},
       {R('100 * water_acres / total_acres', 'percent_total_acres')}
FROM (SELECT count(*) FILTER (WHERE l3cover_key = 'Water') AS water_stands,
             coalesce(sum(acres) FILTER (WHERE l3cover_key = 'Water'), 0) AS water_acres,
             count(*) AS total_stands, coalesce(sum(acres), 0) AS total_acres FROM wld)""")
_WBU = f"""
SELECT unit_key, total_acres, water_acres, {R('100 * water_acres / total_acres', 'percent_water')}
FROM (SELECT unit_key, coalesce(sum(acres), 0) AS total_acres,
             coalesce(sum(acres) FILTER (WHERE l3cover_key = 'Water'), 0) AS water_acres FROM wld GROUP BY ALL)
WHERE water_acres > 1"""
reg("eda_31_water_by_unit", E.water_by_unit, _WBU)
reg("eda_31_water_top_acres", E.water_by_unit_top_acres,
    f"SELECT * FROM ({_WBU}) QUALIFY rank() OVER (ORDER BY water_acres DESC) <= 10")
reg("eda_31_water_top_percent", E.water_by_unit_top_percent,
    f"SELECT * FROM ({_WBU}) QUALIFY rank() OVER (ORDER BY percent_water DESC) <= 10")


def _appendix_sql() -> str:
    pos = "(SELECT * FROM wld WHERE acres IS NOT NULL AND acres > 0)"
    mg = f"(SELECT * FROM ({_mgmt_sql('wld')}) WHERE management_key IN ('Unspecified', 'Missing / NA'))"
    vals = [
        comma("(SELECT count(*) FROM wld)"),
        comma(f"(SELECT count(*) FROM {_AGE})"),
        comma("(SELECT count(DISTINCT fc_key) + coalesce(max(CASE WHEN fc_key IS NULL THEN 1 ELSE 0 END), 0) FROM wld)"),
        comma("(SELECT count(DISTINCT unit_key) + coalesce(max(CASE WHEN unit_key IS NULL THEN 1 ELSE 0 END), 0) FROM wld)"),
        comma("(SELECT coalesce(sum(acres), 0) FROM wld)"),
        f"{comma('(SELECT count(*) FILTER (WHERE l3covertype IS NULL) FROM wld)')} || ' (' || "
        f"{number('(SELECT 100 * count(*) FILTER (WHERE l3covertype IS NULL) / count(*) FROM wld)')} || '%)'",
        f"{comma('(SELECT count(*) FILTER (WHERE canopy_closure IS NULL) FROM wld)')} || ' (' || "
        f"{number('(SELECT 100 * count(*) FILTER (WHERE canopy_closure IS NULL) / count(*) FROM wld)')} || '%)'",
        f"{comma(f'(SELECT coalesce(sum(stands), 0) FROM {mg})')} || ' (' || "
        f"{pct_label(f'(SELECT coalesce(sum(percent_stands), 0) FROM {mg})')} || ')'",
        f"{number('(SELECT quantile_cont(acres, 0.5) FROM wld)')} || ' acres'",
        f"{number('(SELECT avg(acres) FROM wld)')} || ' acres'",
        f"{comma('(SELECT max(acres) FROM wld)')} || ' acres'",
        pct_label(f"(SELECT count(*) FILTER (WHERE acres < 20) / count(*) FROM {pos})"),
        comma("(SELECT count(*) FILTER (WHERE l3cover_key = 'Water') FROM wld)"),
        f"{comma('(SELECT coalesce(sum(acres) FILTER (WHERE l3cover_key = ' + chr(39) + 'Water' + chr(39) + '), 0) FROM wld)')} || ' acres'",
        f"{number('(SELECT 100 * coalesce(sum(acres) FILTER (WHERE l3cover_key = ' + chr(39) + 'Water' + chr(39) + '), 0) / coalesce(sum(acres), 0) FROM wld)')} || '%'",
        f"{number(f'(SELECT avg(inventory_age) FROM {_AGE})')} || ' years'",
        f"{number(f'(SELECT quantile_cont(inventory_age, 0.5) FROM {_AGE})')} || ' years'",
        pct_label(f"(SELECT count(*) FILTER (WHERE inventory_age < 5) / count(*) FROM {_AGE})"),
        pct_label(f"(SELECT count(*) FILTER (WHERE inventory_age >= 15) / count(*) FROM {_AGE})"),
        comma(f"(SELECT count(*) FROM {_DLONG} WHERE year < 1950)"),
        "(SELECT l3cover_key FROM (SELECT l3covertype, l3cover_key, coalesce(sum(acres), 0) AS a FROM wld GROUP BY ALL) "
        "ORDER BY a DESC, l3covertype ASC NULLS LAST LIMIT 1)",
        f"(SELECT {comma('records')} || ' (' || {number('percent_records')} || '%)' FROM ({_SUBAV}) "
        "WHERE sub_canopy_data_status = 'Missing / No data')",
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({v} AS VARCHAR) AS value, '{t}' AS interpretation"
        for v, (m, t) in zip(vals, X.APPENDIX))
    return rows


reg("eda_32_appendix_summary", X.appendix_table, _appendix_sql())

# ------------------------------------------------------------------ E3 screening (both scopes)
SC = {DIVISION: "w", DEPARTMENT: "d"}
SRC = {DIVISION: "wld", DEPARTMENT: "dept"}
SUFFIX = {DIVISION: "division", DEPARTMENT: "department"}

reg("snp_01_code_rule_check", A.code_rule_check, """
SELECT l4covertype_full, l3covertype, l3cover_key, l4cover_key, count(*) AS n FROM wld
WHERE starts_with(CAST(l4covertype_full AS VARCHAR), '2') GROUP BY ALL""")
reg("flt_02_cover_screen", lambda c: _cols(c.div.cover, COVER_COLS), f"SELECT {COVER_COLS} FROM w_cover")
reg("ded_02_stand_year_dedup", lambda c: _cols(c.div.dedup, TIMED_COLS), f"SELECT {TIMED_COLS} FROM w_dedup")
reg("ded_03_latest_per_stand", lambda c: _cols(c.div.latest, TIMED_COLS), f"SELECT {TIMED_COLS} FROM w_latest")
reg("flt_05_terrestrial_snapshot", lambda c: _cols(c.div.terrestrial, TIMED_COLS), f"SELECT {TIMED_COLS} FROM w_terr")
reg("ded_03_department_latest_labelled", lambda c: _cols(c.dept.latest_labelled, TIMED_COLS),
    f"SELECT {TIMED_COLS} FROM d_latest_lab")

for scope in (DIVISION, DEPARTMENT):
    s, src, sfx = SC[scope], SRC[scope], SUFFIX[scope]
    a, b = A.FILTER_NAMES[scope]
    ta, tb = A.TERRESTRIAL_NAMES[scope]
    reg(f"snp_02_project_cover_rule_qa_{sfx}", partial(A.project_cover_rule_qa, scope=scope), f"""
SELECT project_cover_class, cover_code_chr, l3covertype, l3cover_key, l4cover_key, count(*) AS n
FROM {s}_cover WHERE project_cover_class IS NOT NULL GROUP BY ALL""")
    reg(f"snp_03_cover_filter_summary_{sfx}", partial(A.cover_filter_summary, scope=scope), f"""
, base AS (SELECT count(*) AS rows, count(DISTINCT fcskey) AS unique_stands, coalesce(sum(acres), 0) AS acres FROM {src}),
  scr AS (SELECT count(*) AS rows, count(DISTINCT fcskey) AS unique_stands, coalesce(sum(acres), 0) AS acres FROM {s}_cover),
  u AS (SELECT '{a}' AS dataset, * FROM base UNION ALL SELECT '{b}', * FROM scr)
SELECT u.dataset, u.rows, u.unique_stands, u.acres, {R('100 * u.rows / base.rows', 'percent_rows_retained')},
       {R('100 * u.unique_stands / base.unique_stands', 'percent_stands_retained')},
       {R('100 * u.acres / base.acres', 'percent_acres_retained')}
FROM u, base""")
    reg(f"snp_04_stands_time_summary_{sfx}", partial(A.stands_time_summary, scope=scope), f"""
SELECT count(*) AS total_rows, count(DISTINCT fcskey) AS unique_stands,
       min(inventory_year_raw) AS min_inventory_year_raw, max(inventory_year_raw) AS max_inventory_year_raw,
       min(inventory_year) AS min_analysis_year, max(inventory_year) AS max_analysis_year FROM {s}_timed""")
    reg(f"snp_06_stand_record_summary_{sfx}", partial(A.stand_record_summary, scope=scope), f"""
SELECT rows_after_filtering, unique_fcskey_years, unique_stands,
       rows_after_filtering - unique_fcskey_years AS duplicate_stand_year_rows,
       rows_after_filtering - unique_stands AS repeated_stand_rows
FROM (SELECT count(*) AS rows_after_filtering, count(DISTINCT (fcskey, inventory_year_raw)) AS unique_fcskey_years,
             count(DISTINCT fcskey) AS unique_stands FROM {s}_dedup)""")
    reg(f"set_05_analysis_years_{sfx}", partial(A.analysis_years, scope=scope),
        f"SELECT y AS inventory_year FROM {s}_years")
    _ann = f"""
SELECT inventory_year, l3covertype, l3cover_key, authority_key, stands_total, acres_total,
       total_stands_all_cover, total_acres_all_cover,
       {R('100 * stands_total / total_stands_all_cover', 'percent_of_total_stands')},
       {R('100 * acres_total / total_acres_all_cover', 'percent_of_total_acres')},
       CASE WHEN inventory_year = 1997 THEN '≤1997' ELSE CAST(inventory_year AS VARCHAR) END AS year_label
FROM {s}_annual"""
    reg(f"snp_08_annual_cover_summary_{sfx}", partial(A.annual_cover_summary, scope=scope), _ann)
    reg(f"snp_09_annual_total_summary_{sfx}", partial(A.annual_total_summary, scope=scope), f"""
SELECT DISTINCT inventory_year, year_label, total_stands_all_cover, total_acres_all_cover FROM ({_ann})""")
    reg(f"snp_12_terrestrial_filter_summary_{sfx}", partial(A.terrestrial_filter_summary, scope=scope), f"""
, base AS (SELECT count(*) AS stands, coalesce(sum(acres), 0) AS acres FROM {s}_latest_lab),
  ter AS (SELECT count(*) AS stands, coalesce(sum(acres), 0) AS acres FROM {s}_terr),
  u AS (SELECT '{ta}' AS dataset, * FROM base UNION ALL SELECT '{tb}', * FROM ter)
SELECT u.dataset, u.stands, u.acres, {R('100 * u.stands / base.stands', 'percent_stands_retained')},
       {R('100 * u.acres / base.acres', 'percent_acres_retained')} FROM u, base""")

_ANN_W = f"""
SELECT inventory_year, l3covertype, l3cover_key, authority_key, stands_total, acres_total,
       total_stands_all_cover, total_acres_all_cover,
       {R('100 * stands_total / total_stands_all_cover', 'percent_of_total_stands')},
       {R('100 * acres_total / total_acres_all_cover', 'percent_of_total_acres')},
       CASE WHEN inventory_year = 1997 THEN '≤1997' ELSE CAST(inventory_year AS VARCHAR) END AS year_label
FROM w_annual"""
reg("snp_05_records_per_analysis_year", A.records_per_analysis_year,
    "SELECT inventory_year, count(*) AS n FROM w_timed GROUP BY ALL")
reg("snp_07_repeated_stands", A.repeated_stands,
    "SELECT fcskey, count(*) AS n FROM w_dedup GROUP BY fcskey HAVING count(*) > 1")
reg("snp_10_annual_head", A.annual_head, f"""
SELECT * FROM ({_ANN_W}) ORDER BY inventory_year, l3covertype NULLS LAST, l3cover_key NULLS LAST,
  authority_key NULLS LAST LIMIT 10""")
reg("snp_10_annual_tail", A.annual_tail, f"""
SELECT * FROM ({_ANN_W}) ORDER BY inventory_year DESC, l3covertype DESC NULLS FIRST, l3cover_key DESC NULLS FIRST,
  authority_key DESC NULLS FIRST LIMIT 10""")
reg("snp_10_annual_ranges", A.annual_ranges, """
SELECT min(total_stands_all_cover) AS min_total_stands_all_cover, max(total_stands_all_cover) AS max_total_stands_all_cover,
       min(total_acres_all_cover) AS min_total_acres_all_cover, max(total_acres_all_cover) AS max_total_acres_all_cover,
       min(acres_total) AS min_cover_acres, max(acres_total) AS max_cover_acres FROM w_annual""")
reg("snp_10_annual_groups_per_year", A.annual_groups_per_year,
    "SELECT inventory_year, count(*) AS n FROM w_annual GROUP BY ALL")
reg("snp_11_department_snapshot_summary", A.department_snapshot_summary, """
SELECT count(*) AS snapshot_stands, count(DISTINCT fcskey) AS snapshot_unique_stands,
       coalesce(sum(acres), 0) AS snapshot_acres, min(inventory_year_raw) AS min_inventory_year,
       max(inventory_year_raw) AS max_inventory_year FROM d_latest""")
reg("snp_11_latest_totals", A.latest_totals,
    "SELECT count(*) AS latest_snapshot_stands, coalesce(sum(acres), 0) AS latest_snapshot_acres FROM w_latest")
_RET = " UNION ALL ".join(
    f"SELECT {i} AS k, '{name}' AS step, count(*) AS rows_or_stands, count(DISTINCT fcskey) AS unique_stands, "
    f"coalesce(sum(acres), 0) AS acres FROM {src}"
    for i, (name, src) in enumerate(zip(A.RETENTION_STEPS, ("dept", "d_cover", "d_dedup", "d_latest_lab", "d_terr"))))
reg("snp_13_department_retention", A.department_retention, f"""
, u AS ({_RET}), base AS (SELECT * FROM u WHERE k = 0)
SELECT u.step, u.rows_or_stands, u.unique_stands, u.acres,
       {R('100 * u.rows_or_stands / base.rows_or_stands', 'percent_rows_or_stands_retained')},
       {R('100 * u.unique_stands / base.unique_stands', 'percent_unique_stands_retained')},
       {R('100 * u.acres / base.acres', 'percent_acres_retained')} FROM u, base""")
_LATEST_L3 = f"""
SELECT inventory_year, authority_key, l3covertype, l3cover_key, stands_total, acres_total,
       percent_of_total_stands, percent_of_total_acres
FROM ({_ANN_W}) WHERE inventory_year = (SELECT max(inventory_year) FROM w_annual)"""
reg("snp_14_cover_latest_l3", A.cover_latest_l3, _LATEST_L3)
reg("snp_15_annual_cover_top12", A.annual_cover_top, f"""
SELECT l3cover_key, inventory_year, l3covertype, authority_key, stands_total, acres_total, total_stands_all_cover,
       total_acres_all_cover, percent_of_total_stands, percent_of_total_acres, year_label
FROM ({_ANN_W}) WHERE l3cover_key IN (
  SELECT l3cover_key FROM ({_LATEST_L3}) ORDER BY acres_total DESC, l3covertype NULLS LAST, l3cover_key NULLS LAST,
  authority_key NULLS LAST LIMIT 12)""")

# ------------------------------------------------------------------ E3 cross-scope check
_CMP = "CAST(fcskey AS VARCHAR) AS fcskey, CAST(acres AS DOUBLE) AS acres, l3cover_key, l4cover_key, " \
       "project_cover_class, date, inventory_year_raw"
_WC = f"(SELECT {_CMP} FROM w_terr)"
_DC = f"(SELECT {_CMP} FROM d_terr WHERE authority_key IN ('Wildlife'))"
reg("snp_16_snapshot_total_compare", A.snapshot_total_compare, f"""
SELECT 'WLD workflow' AS workflow, count(*) AS stands, count(DISTINCT fcskey) AS unique_stands,
       coalesce(sum(acres), 0) AS acres FROM {_WC}
UNION ALL
SELECT 'Department workflow Wildlife subset', count(*), count(DISTINCT fcskey), coalesce(sum(acres), 0) FROM {_DC}""")
reg("jn_06_wld_only_stands", A.wld_only_stands, f"SELECT * FROM {_WC} a WHERE fcskey NOT IN (SELECT fcskey FROM {_DC})")
reg("jn_06_department_only_stands", A.department_only_stands,
    f"SELECT * FROM {_DC} a WHERE fcskey NOT IN (SELECT fcskey FROM {_WC})")
_MATCH = f"""
SELECT a.fcskey, a.acres AS acres_wld, a.l3cover_key AS l3cover_key_wld, a.l4cover_key AS l4cover_key_wld,
       a.project_cover_class AS project_cover_class_wld, a.date AS date_wld, a.inventory_year_raw AS inventory_year_raw_wld,
       b.acres AS acres_department, b.l3cover_key AS l3cover_key_department, b.l4cover_key AS l4cover_key_department,
       b.project_cover_class AS project_cover_class_department, b.date AS date_department,
       b.inventory_year_raw AS inventory_year_raw_department,
       b.acres - a.acres AS acre_difference, abs(b.acres - a.acres) < 1.4901161193847656e-08 AS same_acres,
       coalesce(b.l3cover_key, 'Missing / NA') = coalesce(a.l3cover_key, 'Missing / NA') AS same_l3cover,
       coalesce(b.l4cover_key, 'Missing / NA') = coalesce(a.l4cover_key, 'Missing / NA') AS same_l4cover,
       coalesce(b.project_cover_class, 'Missing / NA') = coalesce(a.project_cover_class, 'Missing / NA')
         AS same_project_cover_class,
       b.date = a.date AS same_date
FROM {_WC} a JOIN {_DC} b ON a.fcskey = b.fcskey"""
reg("snp_17_matching_stands_compare", A.matching_stands_compare, _MATCH)
_CHK_VALS = [
    f"(SELECT coalesce(sum(acres), 0) FROM {_WC})", f"(SELECT coalesce(sum(acres), 0) FROM {_DC})",
    f"(SELECT coalesce(sum(acres), 0) FROM {_DC}) - (SELECT coalesce(sum(acres), 0) FROM {_WC})",
    f"(SELECT count(*) FROM {_WC})", f"(SELECT count(*) FROM {_DC})",
    f"(SELECT count(*) FROM {_DC}) - (SELECT count(*) FROM {_WC})",
    f"(SELECT count(*) FROM {_WC} WHERE fcskey NOT IN (SELECT fcskey FROM {_DC}))",
    f"(SELECT count(*) FROM {_DC} WHERE fcskey NOT IN (SELECT fcskey FROM {_WC}))",
    f"(SELECT count(*) FILTER (WHERE NOT same_acres) FROM m)", "(SELECT coalesce(sum(acre_difference), 0) FROM m)",
    "(SELECT count(*) FILTER (WHERE NOT same_l3cover) FROM m)", "(SELECT count(*) FILTER (WHERE NOT same_l4cover) FROM m)",
    "(SELECT count(*) FILTER (WHERE NOT same_project_cover_class) FROM m)",
    "(SELECT count(*) FILTER (WHERE NOT same_date) FROM m)",
]
reg("snp_18_consistency_summary", A.consistency_summary, f", m AS ({_MATCH})\n" + " UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", {R(f'CAST({v} AS DOUBLE)', 'value')}"
    for name, v in zip(A.CONSISTENCY_CHECKS, _CHK_VALS)))

# ------------------------------------------------------------------ E3 project classes
_CLS = "(SELECT * FROM w_terr WHERE project_cover_class IS NOT NULL)"
_PCS = f"""
SELECT project_cover_class, stands, acres,
       {R('100 * stands / (SELECT count(*) FROM w_terr)', 'percent_terrestrial_stands')},
       {R('100 * acres / (SELECT coalesce(sum(acres), 0) FROM w_terr)', 'percent_terrestrial_acres')}
FROM ({_share_sql(_CLS, 'project_cover_class')})"""
reg("snp_19_project_cover_summary", A.project_cover_summary, _PCS)
reg("snp_20_annual_project_cover_summary", A.annual_project_cover_summary, f"""
, t AS (SELECT * FROM w_snap WHERE l3cover_key <> 'Water'),
  tot AS (SELECT snap_year, count(*) AS ts, coalesce(sum(acres), 0) AS ta FROM t GROUP BY snap_year),
  g AS (SELECT snap_year, project_cover_class, count(*) AS stands, coalesce(sum(acres), 0) AS acres
        FROM t WHERE project_cover_class IS NOT NULL GROUP BY ALL)
SELECT g.snap_year AS inventory_year, project_cover_class, stands, acres, ts AS total_terrestrial_stands,
       ta AS total_terrestrial_acres, {R('100 * stands / ts', 'percent_terrestrial_stands')},
       {R('100 * acres / ta', 'percent_terrestrial_acres')},
       CASE WHEN g.snap_year = 1997 THEN '≤1997' ELSE CAST(g.snap_year AS VARCHAR) END AS year_label
FROM g JOIN tot ON g.snap_year = tot.snap_year""")
_AGC = f"""
SELECT l3covertype, l3cover_key, stands, acres, {R('100 * acres / sum(acres) OVER ()', 'percent_of_agriculture_acres')}
FROM ({_share_sql("(SELECT * FROM w_terr WHERE project_cover_class = 'Agriculture')", 'l3covertype, l3cover_key')})"""
_HOC = f"""
SELECT l4cover_key, stands, acres, {R('100 * acres / sum(acres) OVER ()', 'percent_of_openland_acres')}
FROM ({_share_sql('''(SELECT * REPLACE (coalesce(l4cover_key, 'Missing / NA') AS l4cover_key) FROM w_terr
                      WHERE project_cover_class = 'Herbaceous Openland')''', 'l4cover_key')})"""
reg("snp_21_agriculture_composition", A.agriculture_composition, _AGC)
reg("snp_22_openland_composition", A.openland_composition, _HOC)
reg("snp_23_composition_plot", A.composition_plot, f"""
, u AS (SELECT 'Agriculture' AS project_cover_class, l3cover_key AS cover_type, acres,
               percent_of_agriculture_acres AS percent_class_acres FROM ({_AGC})
        UNION ALL
        SELECT 'Herbaceous Openland', l4cover_key, acres, percent_of_openland_acres FROM ({_HOC})),
  v AS (SELECT *, sum(acres) OVER (PARTITION BY project_cover_class) AS total_class_acres FROM u)
SELECT *, CASE WHEN project_cover_class = 'Agriculture' THEN '(a) Agriculture' || chr(10) || {comma('total_class_acres')} || ' ac'
               WHEN project_cover_class = 'Herbaceous Openland'
                 THEN '(b) Herbaceous Openland' || chr(10) || {comma('total_class_acres')} || ' ac'
               ELSE project_cover_class END AS facet_label FROM v""")
_SIZE = f"""
SELECT project_cover_class, count(*) AS stands, min(acres) AS min_acres, {R('quantile_cont(acres, 0.25)', 'q1_acres')},
       {R('quantile_cont(acres, 0.5)', 'median_acres')}, {R('avg(acres)', 'mean_acres')},
       {R('quantile_cont(acres, 0.75)', 'q3_acres')}, max(acres) AS max_acres, {R('stddev_samp(acres)', 'sd_acres')}
FROM {_CLS} GROUP BY ALL"""
reg("snp_24_stand_size_summary", A.stand_size_summary, _SIZE)
reg("snp_25_size_distribution", A.size_distribution, f"""
SELECT project_cover_class, size_class, n, {R('100 * n / sum(n) OVER (PARTITION BY project_cover_class)', 'percent_stands')}
FROM (SELECT project_cover_class,
             CASE WHEN acres < 5 THEN '<5' WHEN acres < 20 THEN '5–19' WHEN acres < 50 THEN '20–49'
                  WHEN acres < 100 THEN '50–99' ELSE '≥100' END AS size_class, count(*) AS n
      FROM {_CLS} GROUP BY ALL)""")
_MAS_RAW = f"""
SELECT project_cover_class, unit_key, stands, acres,
       100 * acres / sum(acres) OVER (PARTITION BY project_cover_class) AS percent_category_acres
FROM ({_share_sql(_CLS, 'project_cover_class, unit_key')})"""
_UNIT_ORD = "unit_key ASC NULLS LAST"
reg("snp_26_management_area_summary", A.management_area_summary,
    f"SELECT project_cover_class, unit_key, stands, acres, {R('percent_category_acres')} FROM ({_MAS_RAW})")
reg("snp_26_top_management_areas", A.top_management_areas, f"""
SELECT project_cover_class, unit_key, stands, acres, {R('percent_category_acres')} FROM ({_MAS_RAW})
QUALIFY row_number() OVER (PARTITION BY project_cover_class ORDER BY acres DESC, {_UNIT_ORD}) <= 15""")
_PROP_RAW = """
SELECT unit_key, project_cover_class, total_unit_acres, category_stands, category_acres,
       100 * category_acres / total_unit_acres AS percent_unit_acres FROM (
  SELECT unit_key, total_unit_acres, 'Agriculture' AS project_cover_class, a_acres AS category_acres,
         a_stands AS category_stands FROM u
  UNION ALL SELECT unit_key, total_unit_acres, 'Herbaceous Openland', h_acres, h_stands FROM u)
WHERE category_acres > 0"""
_PROP_U = """
, u AS (SELECT unit_key, coalesce(sum(acres), 0) AS total_unit_acres,
               coalesce(sum(acres) FILTER (WHERE project_cover_class = 'Agriculture'), 0) AS a_acres,
               count(*) FILTER (WHERE project_cover_class = 'Agriculture') AS a_stands,
               coalesce(sum(acres) FILTER (WHERE project_cover_class = 'Herbaceous Openland'), 0) AS h_acres,
               count(*) FILTER (WHERE project_cover_class = 'Herbaceous Openland') AS h_stands
        FROM w_terr GROUP BY unit_key)"""
_PROP_COLS = f"unit_key, project_cover_class, total_unit_acres, category_stands, category_acres, {R('percent_unit_acres')}"
reg("snp_27_management_area_proportion", A.management_area_proportion,
    f"{_PROP_U} SELECT {_PROP_COLS} FROM ({_PROP_RAW})")
reg("snp_27_top_management_area_proportion", A.top_management_area_proportion, f"""{_PROP_U}
SELECT {_PROP_COLS} FROM ({_PROP_RAW})
QUALIFY row_number() OVER (PARTITION BY project_cover_class ORDER BY percent_unit_acres DESC, {_UNIT_ORD}) <= 15""")
_FULL_RAW = """
, fu AS (SELECT unit_key, count(*) AS total_terrestrial_stands, coalesce(sum(acres), 0) AS total_terrestrial_acres,
                count(*) FILTER (WHERE project_cover_class = 'Agriculture') AS agriculture_stands,
                coalesce(sum(acres) FILTER (WHERE project_cover_class = 'Agriculture'), 0) AS agriculture_acres,
                count(*) FILTER (WHERE project_cover_class = 'Herbaceous Openland') AS herbaceous_openland_stands,
                coalesce(sum(acres) FILTER (WHERE project_cover_class = 'Herbaceous Openland'), 0)
                  AS herbaceous_openland_acres
         FROM w_terr GROUP BY unit_key),
  fr AS (SELECT *, agriculture_acres + herbaceous_openland_acres AS agriculture_and_herbaceous_openland_acres,
                CAST(row_number() OVER (ORDER BY agriculture_acres + herbaceous_openland_acres DESC,
                     total_terrestrial_acres DESC, unit_key ASC NULLS LAST) AS INTEGER)
                  AS management_area_rank_by_project_cover_acres FROM fu)"""
reg("snp_28_management_area_full", A.management_area_full, f"""{_FULL_RAW}
SELECT management_area_rank_by_project_cover_acres, unit_key, total_terrestrial_acres, total_terrestrial_stands,
       agriculture_acres, agriculture_stands,
       {R('100 * agriculture_acres / total_terrestrial_acres', 'agriculture_percent_terrestrial_acres')},
       herbaceous_openland_acres, herbaceous_openland_stands,
       {R('100 * herbaceous_openland_acres / total_terrestrial_acres', 'herbaceous_openland_percent_terrestrial_acres')},
       agriculture_and_herbaceous_openland_acres,
       {R('100 * agriculture_and_herbaceous_openland_acres / total_terrestrial_acres',
          'agriculture_and_herbaceous_openland_percent_terrestrial_acres')}
FROM fr""")
reg("snp_29_management_area_report", A.management_area_report, f"""{_FULL_RAW}
SELECT management_area_rank_by_project_cover_acres, unit_key, agriculture_and_herbaceous_openland_acres,
       {R('100 * agriculture_and_herbaceous_openland_acres / (SELECT sum(agriculture_and_herbaceous_openland_acres) FROM fr)',
          'percent_of_wld_combined_project_cover_acres')},
       {R('100 * agriculture_and_herbaceous_openland_acres / total_terrestrial_acres',
          'agriculture_and_herbaceous_openland_percent_terrestrial_acres')}
FROM fr WHERE management_area_rank_by_project_cover_acres <= 15""")
_CONC_RAW = f"""
, mas AS ({_MAS_RAW}),
  conc AS (SELECT project_cover_class, unit_key, stands, acres,
                  CAST(row_number() OVER (PARTITION BY project_cover_class ORDER BY acres DESC, {_UNIT_ORD}) AS INTEGER) AS rank,
                  sum(acres) OVER (PARTITION BY project_cover_class ORDER BY acres DESC, {_UNIT_ORD}
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_acres,
                  sum(acres) OVER (PARTITION BY project_cover_class) AS total_category_acres FROM mas),
  ctab AS (SELECT project_cover_class,
                  max(100 * cumulative_acres / total_category_acres) FILTER (WHERE rank <= 5) AS top_5_percent,
                  max(100 * cumulative_acres / total_category_acres) FILTER (WHERE rank <= 10) AS top_10_percent,
                  max(100 * cumulative_acres / total_category_acres) FILTER (WHERE rank <= 20) AS top_20_percent,
                  count(*) AS total_management_areas FROM conc GROUP BY project_cover_class)"""
reg("snp_30_acre_concentration", A.acre_concentration, f"""{_CONC_RAW}
SELECT project_cover_class, unit_key, stands, acres, rank, cumulative_acres, total_category_acres,
       {R('100 * cumulative_acres / total_category_acres', 'cumulative_percent')} FROM conc""")
reg("snp_31_acre_concentration_table", A.acre_concentration_table, f"""{_CONC_RAW}
SELECT project_cover_class, {R('top_5_percent')}, {R('top_10_percent')}, {R('top_20_percent')}, total_management_areas
FROM ctab""")
reg("snp_32_acre_concentration_long", A.acre_concentration_long, f"""{_CONC_RAW}
SELECT project_cover_class, largest_area_group, {R('percent_category_acres')} FROM (
  SELECT project_cover_class, top_5_percent AS "Top 5", top_10_percent AS "Top 10", top_20_percent AS "Top 20" FROM ctab)
UNPIVOT INCLUDE NULLS (percent_category_acres FOR largest_area_group IN ("Top 5", "Top 10", "Top 20"))""")
_TOP_A = f"""
SELECT project_cover_class, unit_key AS top_area_by_acres, acres AS top_area_acres,
       percent_category_acres AS top_area_percent_category_acres FROM ({_MAS_RAW})
QUALIFY row_number() OVER (PARTITION BY project_cover_class ORDER BY acres DESC, {_UNIT_ORD}) = 1"""
_TOP_P = f"""
SELECT project_cover_class, unit_key AS top_area_by_percent, percent_unit_acres AS top_area_percent_unit_acres,
       category_acres AS top_area_by_percent_acres FROM ({_PROP_RAW})
QUALIFY row_number() OVER (PARTITION BY project_cover_class ORDER BY percent_unit_acres DESC, {_UNIT_ORD}) = 1"""
reg("snp_33_top_area_by_acres", A.top_area_by_acres, f"""
SELECT project_cover_class, top_area_by_acres, top_area_acres, {R('top_area_percent_category_acres')} FROM ({_TOP_A})""")
reg("snp_33_top_area_by_percent", A.top_area_by_percent, f"""{_PROP_U}
SELECT project_cover_class, top_area_by_percent, {R('top_area_percent_unit_acres')}, top_area_by_percent_acres
FROM ({_TOP_P})""")


def _fa(x: str) -> str:
    return f"{comma(x)} || ' ac'"


def _fp(x: str) -> str:
    return f"{number(x)} || '%'"


reg("snp_34_report_summary", A.report_summary, f"""{_PROP_U}{_CONC_RAW},
  pcs AS (SELECT project_cover_class, count(*) AS stands, coalesce(sum(acres), 0) AS acres,
                 100 * count(*) / (SELECT count(*) FROM w_terr) AS pts,
                 100 * coalesce(sum(acres), 0) / (SELECT coalesce(sum(acres), 0) FROM w_terr) AS pta
          FROM {_CLS} GROUP BY ALL),
  sz AS (SELECT project_cover_class, avg(acres) AS mean_acres, quantile_cont(acres, 0.5) AS median_acres
         FROM {_CLS} GROUP BY ALL),
  ta AS ({_TOP_A}), tp AS ({_TOP_P})
SELECT pcs.project_cover_class, {_fa('pcs.acres')} AS acres, {comma('pcs.stands')} AS stands,
       {_fp('pts')} AS percent_terrestrial_stands, {_fp('pta')} AS percent_terrestrial_acres,
       {_fa('mean_acres')} AS mean_acres, {_fa('median_acres')} AS median_acres,
       top_area_by_acres, {_fa('top_area_acres')} AS top_area_acres,
       {_fp('top_area_percent_category_acres')} AS top_area_percent_category_acres,
       top_area_by_percent, {_fp('top_area_percent_unit_acres')} AS top_area_percent_unit_acres,
       {_fa('top_area_by_percent_acres')} AS top_area_by_percent_acres,
       {_fp('top_5_percent')} AS top_5_percent, {_fp('top_10_percent')} AS top_10_percent,
       {_fp('top_20_percent')} AS top_20_percent, total_management_areas
FROM pcs LEFT JOIN sz USING (project_cover_class) LEFT JOIN ta USING (project_cover_class)
LEFT JOIN tp USING (project_cover_class) LEFT JOIN ctab USING (project_cover_class)""")

# ------------------------------------------------------------------ E3 department context
reg("snp_35_department_authority_context", A.department_authority_context, """
SELECT CAST(row_number() OVER (ORDER BY terrestrial_acres DESC, authority_key ASC NULLS LAST) AS INTEGER)
         AS authority_acre_rank, authority_key, round_even(terrestrial_acres, 0) AS terrestrial_acres,
       round_even(100 * terrestrial_acres / sum(terrestrial_acres) OVER (), 1) AS percent_department_terrestrial_acres,
       stands, unique_stands
FROM (SELECT authority_key, count(*) AS stands, count(DISTINCT fcskey) AS unique_stands,
             coalesce(sum(acres), 0) AS terrestrial_acres FROM d_terr GROUP BY ALL)""")
_CTX36 = """
, land AS (SELECT authority_key, coalesce(sum(acres), 0) AS la, count(*) AS ls FROM d_terr GROUP BY ALL),
  g AS (SELECT project_cover_class, authority_key, count(*) AS stands, count(DISTINCT fcskey) AS unique_stands,
               coalesce(sum(acres), 0) AS acres FROM d_terr WHERE project_cover_class IS NOT NULL GROUP BY ALL),
  ctx AS (SELECT g.project_cover_class, g.authority_key, round_even(g.acres, 0) AS acres,
                 round_even(100 * g.acres / sum(g.acres) OVER (PARTITION BY g.project_cover_class), 1)
                   AS percent_department_class_acres,
                 round_even(sum(g.acres) OVER (PARTITION BY g.project_cover_class), 0) AS total_department_class_acres,
                 round_even(100 * g.acres / land.la, 1) AS percent_authority_terrestrial_landbase,
                 round_even(land.la, 0) AS total_authority_terrestrial_acres, g.stands, g.unique_stands
          FROM g LEFT JOIN land ON g.authority_key IS NOT DISTINCT FROM land.authority_key)"""
reg("snp_36_class_authority_context", A.department_class_authority_context, f"{_CTX36} SELECT * FROM ctx")
_CMP37 = f"""{_CTX36},
  u AS (SELECT DISTINCT 'Inventoried terrestrial acreage' AS category, authority_key,
               total_authority_terrestrial_acres AS acres
        FROM ctx WHERE authority_key IN ('State Forests', 'Wildlife', 'State Parks')
        UNION ALL
        SELECT CASE project_cover_class WHEN 'Agriculture' THEN 'Inventoried Agriculture'
                    ELSE 'Inventoried Herbaceous Openland' END, authority_key, acres
        FROM ctx WHERE authority_key IN ('State Forests', 'Wildlife', 'State Parks')
          AND project_cover_class IN ('Agriculture', 'Herbaceous Openland')),
  v AS (SELECT *, 100 * acres / sum(acres) OVER (PARTITION BY category) AS percent_acres FROM u)"""
reg("snp_37_authority_comparison", A.authority_comparison,
    f"{_CMP37} SELECT category, authority_key, acres, {R('percent_acres')} FROM v")
reg("snp_37_authority_comparison_check", A.authority_comparison_check,
    f"{_CMP37} SELECT category, {R('coalesce(sum(percent_acres), 0)', 'total_percent')} FROM v GROUP BY category")


def queries() -> dict[str, Query]:
    return {x.name: x for x in REG}

# ------------------------------------------------------------------ building blocks with table output
from standlens.plans import blocks as B  # noqa: E402

_RAW = "SELECT fcskey, fc_key, l4covertype, canopy_closure, managed_site, sub_canopy_cover, acres, date, last_edited_date FROM st"
reg("prj_01_clean_names", B.clean_names_stands, _RAW)
reg("src_01_read_stands", B.stands_through_reader, _RAW)
reg("src_02_read_compartments", B.compartments_through_reader, "SELECT fc_key, management_type, unit_name, acres FROM comp")
reg("src_01_read_stands_two_headers", B.stands_in_two_spellings, _RAW)
reg("src_02_read_compartments_two_headers", B.compartments_in_two_spellings, "SELECT fc_key, management_type, unit_name, acres FROM comp")
reg("src_03_read_domains", B.domains_through_reader, """
SELECT 'unit_name' AS domain, unit_name AS code, unit_key AS label FROM unit_lk
UNION ALL SELECT 'cover_type', code, label FROM cover_dom
UNION ALL SELECT * FROM (VALUES ('canopy_closure', 1, '0-25'), ('canopy_closure', 2, '25-50'), ('canopy_closure', 3, '50-75'),
  ('canopy_closure', 4, '75-100'), ('canopy_closure', 5, 'Unspecified'), ('management', 1, 'Managed'), ('management', 2, 'Unspecified'),
  ('authority', 1, 'State Forests'), ('authority', 2, 'State Parks'), ('authority', 3, 'Partner Lands'), ('authority', 5, 'Wildlife'))""")
_HANDED = "fcskey, fc_key, tb1, tb2, tb3, acres, date, l3covertype, l3cover_key, l4cover_key, canopy_key, management_key, authority_key, unit_key"
reg("src_04_division_handoff", B.division_handoff, f"SELECT {_HANDED}, created_date FROM wld LEFT JOIN created USING (fcskey)")
reg("src_05_department_handoff", B.department_handoff, f"SELECT {_HANDED}, created_date FROM dept LEFT JOIN created USING (fcskey)")
_SNAP = "fcskey, inventory_year_raw, date, acres, l3cover_key, project_cover_class, unit_key"
reg("src_06_snapshots", B.snapshots_written, f"""
SELECT 'snapshot_latest' AS snapshot, {_SNAP} FROM w_latest UNION ALL SELECT 'snapshot_terrestrial', {_SNAP} FROM w_terr""")
REG.append(Query("src_07_report_csv", B.report_written, next(x.sql for x in REG if x.name == "snp_28_management_area_full")))
REG.append(Query("src_07_reports", B.reports_written, " UNION ALL ".join(f"""
SELECT '{name}' AS report, key, field, round(TRY_CAST(raw AS DOUBLE), 6) AS number, CASE WHEN TRY_CAST(raw AS DOUBLE) IS NULL THEN raw END AS text
FROM (UNPIVOT (SELECT concat_ws('|', {', '.join(keys)}) AS key, CAST(COLUMNS(*) AS VARCHAR) FROM ({next(x.sql for x in REG if x.name == query)}))
      ON COLUMNS(* EXCLUDE (key)) INTO NAME field VALUE raw)""" for name, (query, keys) in B.REPORTS.items())))
reg("src_08_compartment_layer", B.compartments_written, """
SELECT fc_key, authority_key, management_type, unit_key, unit_name, acres, hex('POINT ' || CAST(fc_key AS VARCHAR)) AS geometry FROM comp_u""")
reg("prj_08_column_order", B.column_order, """
SELECT concat_ws('|', coalesce(canopy_key, '-'), coalesce(CAST(canopy_closure AS VARCHAR), '-'), coalesce(l3cover_key, '-'),
  coalesce(CAST(l3covertype AS VARCHAR), '-'), coalesce(l4cover_key, '-'), coalesce(CAST(l4covertype_full AS VARCHAR), '-'),
  coalesce(management_key, '-')) AS front, count(*) AS n FROM labelled GROUP BY ALL""")
reg("prj_09_geometry_dropped", B.geometry_dropped, "SELECT fcskey, tb1, tb2, tb3, authority_key, FALSE AS has_geometry FROM dept")


def _in_use(src: str, code: str, key: str, rows: str, labels: str) -> str:
    """Labels, spelt out here and not taken from the code under test, against the codes that occur."""
    return f"""
SELECT coalesce(c, k) AS {key}, {labels}, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM (SELECT CAST({code} AS INTEGER) AS c, count(*) AS n FROM {src} GROUP BY ALL)
FULL JOIN (SELECT * FROM (VALUES {rows}) t(k, {labels})) ON c IS NOT DISTINCT FROM k"""


reg("prj_02_canopy_lookup", B.canopy_labels, _in_use(
    "st", "canopy_closure", "canopy_closure", "(1, '0-25'), (2, '25-50'), (3, '50-75'), (4, '75-100'), (5, 'Unspecified')", "canopy_key"))
reg("prj_03_l4_lookup", B.l4_labels, _in_use("st", "l4covertype", "l4covertype_full", """
(211, 'Cropland'), (212, 'Forage'), (2121, 'Forage - Mixed'), (222, 'Orchards/Vineyards/Nursery'), (310, 'Herbaceous Openland'),
(3101, 'Grass - Mixed'), (31021, 'Warm Grass'), (320, 'Upland Shrub'), (4191, 'Mixed Deciduous'), (42110, 'Planted Pine'),
(4221, 'Natural Pine'), (4319, 'Mixed Forest'), (500, 'Water'), (622, 'Emergent Wetland'), (6221, 'Cattail')""", "l4cover_key"))
reg("prj_04_management_lookup", B.management_labels, _in_use(
    "st", "managed_site", "managed_site", "(1, 'Managed'), (2, 'Unspecified')", "management_key"))
reg("prj_05_authority_lookup", B.authority_labels, _in_use(
    "comp", "management_type", "management_type", "(1, 'State Forests'), (2, 'State Parks'), (3, 'Partner Lands'), (5, 'Wildlife')", "authority_key"))
reg("set_01_l3_lookup", B.l3_labels, _in_use("coded", "l3covertype", "l3covertype", ", ".join(
    [f"({c}, '{t}', 'Cover_Type_Domain')" for c, t in ((211, 'Cropland'), (212, 'Forage'), (222, 'Orchards/Vineyards/Nursery'),
     (310, 'Herbaceous Openland'), (320, 'Upland Shrub'), (500, 'Water'), (622, 'Emergent Wetland'))]
    + [f"({c}, '{t}', 'IFMAP manual crosswalk')" for c, t in ((419, 'Mixed Upland Deciduous'), (421, 'Planted Pines'), (422, 'Natural Pines'),
       (423, 'Other (Non-Pine) Upland Conifers'), (424, 'Other Upland Conifers'), (431, 'Upland Mixed Forest'))]), "l3cover_key, l3_key_source"))
reg("prj_10_project_cover_class", B.project_class_mapping, """
SELECT CAST(l4covertype_full AS VARCHAR) AS cover_code_chr, l3cover_key,
       CASE WHEN starts_with(CAST(l4covertype_full AS VARCHAR), '2') THEN 'Agriculture'
            WHEN l3cover_key = 'Herbaceous Openland' THEN 'Herbaceous Openland' END AS project_cover_class,
       count(*) AS n FROM dept GROUP BY ALL""")
reg("prj_11_canopy_class", B.canopy_class_mapping,
    f"SELECT canopy_key, {_CANOPY_CLASS} AS canopy_class, count(*) AS n FROM dept GROUP BY ALL")
reg("prj_12_missing_labels", B.missing_label_mapping, """
SELECT label_column, label, count(*) AS n FROM (
  SELECT coalesce(canopy_key, 'Missing / NA') AS canopy_key, coalesce(management_key, 'Missing / NA') AS management_key,
         coalesce(l3cover_key, 'Missing / NA') AS l3cover_key, coalesce(authority_key, 'Missing / NA') AS authority_key,
         coalesce(l4cover_key, 'Missing / NA') AS l4cover_key FROM dept)
UNPIVOT (label FOR label_column IN (canopy_key, management_key, l3cover_key, authority_key, l4cover_key))
GROUP BY ALL""")
reg("prj_13_size_class", B.size_class_mapping, """
SELECT CASE WHEN acres < 5 THEN '<5 acres' WHEN acres < 20 THEN '5–20 acres' WHEN acres < 50 THEN '20–50 acres'
            WHEN acres < 100 THEN '50–100 acres' ELSE '100+ acres' END AS size_class_profile,
       CASE WHEN acres < 5 THEN '<5' WHEN acres < 20 THEN '5–19' WHEN acres < 50 THEN '20–49'
            WHEN acres < 100 THEN '50–99' ELSE '≥100' END AS size_class_analysis,
       count(*) AS n, min(acres) AS min_acres, max(acres) AS max_acres FROM dept GROUP BY ALL""")
reg("prj_14_age_class", B.age_class_mapping, f"""
SELECT inventory_age, CASE WHEN inventory_age < 5 THEN '0–<5 years' WHEN inventory_age < 10 THEN '5–<10 years'
            WHEN inventory_age < 15 THEN '10–<15 years' ELSE '15+ years' END AS age_class, count(*) AS n
FROM {_AGE} GROUP BY ALL""")
reg("prj_15_inventory_years", B.inventory_year_mapping, """
SELECT CAST(year(date) AS INTEGER) AS inventory_year_raw,
       CAST(CASE WHEN year(date) <= 1997 THEN 1997 ELSE year(date) END AS INTEGER) AS inventory_year, count(*) AS n
FROM dept GROUP BY ALL""")
reg("prj_16_year_labels", B.year_label_mapping, """
SELECT y AS inventory_year, CASE WHEN y = 1997 THEN '≤1997' ELSE CAST(y AS VARCHAR) END AS year_label FROM d_years""")
reg("prj_17_ordered_categories", B.ordered_canopy_keys, """
SELECT coalesce(canopy_key, 'Missing / NA') AS canopy_key,
       CASE WHEN coalesce(canopy_key, 'Missing / NA') IN ('0-25', '25-50', '50-75', '75-100', 'Unspecified', 'Missing / NA')
            THEN coalesce(canopy_key, 'Missing / NA') END AS canopy_level,
       CAST(CASE coalesce(canopy_key, 'Missing / NA') WHEN '0-25' THEN 1 WHEN '25-50' THEN 2 WHEN '50-75' THEN 3
            WHEN '75-100' THEN 4 WHEN 'Unspecified' THEN 5 WHEN 'Missing / NA' THEN 6 END AS INTEGER) AS canopy_level_order,
       count(*) AS n FROM dept GROUP BY ALL""")
_DCS = f"""
SELECT l3covertype, l3cover_key, stands, acres, {R('ps', 'percent_stands')}, {R('pa', 'percent_acres')},
       {pct_label('ps')} AS percent_stands_label, {pct_label('pa')} AS percent_acres_label
FROM (SELECT *, stands / sum(stands) OVER () AS ps, acres / sum(acres) OVER () AS pa
      FROM ({_share_sql('dept', 'l3covertype, l3cover_key')}))"""
reg("prj_18_percent_labels", B.department_cover_shares, _DCS)
reg("jn_10_join_to_totals", B.canopy_against_totals, """
SELECT *, total_acres - acres AS other_acres FROM (
  SELECT canopy_key, stands, acres, CAST(sum(stands) OVER () AS BIGINT) AS total_stands, sum(acres) OVER () AS total_acres
  FROM (SELECT canopy_key, count(*) AS stands, coalesce(sum(acres), 0) AS acres FROM dept GROUP BY ALL))""")
reg("win_01_share_of_total", B.authority_shares, f"""
SELECT authority_key, stands, acres, {R('stands / sum(stands) OVER ()', 'share_stands')}, {R('acres / sum(acres) OVER ()', 'share_acres')}
FROM (SELECT authority_key, count(*) AS stands, coalesce(sum(acres), 0) AS acres FROM dept GROUP BY ALL)""")
reg("prj_19_report_formats", B.report_formats, f"""
SELECT project_cover_class, {_fa('acres')} AS acres, {comma('stands')} AS stands,
       {_fp('percent_terrestrial_acres')} AS percent_terrestrial_acres FROM ({_PCS})""")
reg("prj_20_suffix_rename", B.suffixed_compare, f"""
SELECT fcskey, acres AS acres_wld, l3cover_key AS l3cover_key_wld, l4cover_key AS l4cover_key_wld,
       project_cover_class AS project_cover_class_wld, date AS date_wld, inventory_year_raw AS inventory_year_raw_wld
FROM {_WC}""")
reg("prj_21_comparison_casts", A.wld_compare, f"SELECT * FROM {_WC}")
reg("flt_03_agriculture_branch", B.agriculture_branch, """
SELECT l3covertype, count(*) AS n FROM dept WHERE starts_with(CAST(l3covertype AS VARCHAR), '2') GROUP BY ALL""")
reg("flt_04_valid_year_window", B.valid_year_window, "SELECT inventory_year_raw, count(*) AS n FROM d_timed GROUP BY ALL")
reg("flt_06_canopy_subsets", B.canopy_subsets, """
SELECT CASE WHEN canopy_key = '0-25' THEN 'open' ELSE 'forested' END AS subset, canopy_key, count(*) AS n,
       coalesce(sum(acres), 0) AS acres FROM dept WHERE canopy_key IS NOT NULL GROUP BY ALL""")
reg("flt_07_positive_acres", B.positive_acres, """
SELECT count(*) AS records, coalesce(sum(acres), 0) AS acres, min(acres) AS min_acres FROM dept
WHERE acres IS NOT NULL AND acres > 0""")
reg("flt_08_project_class_records", B.project_class_records,
    "SELECT fcskey, project_cover_class, acres, unit_key FROM w_terr WHERE project_cover_class IS NOT NULL")
reg("jn_07_matching_stands", B.matching_stands, f"""
SELECT a.fcskey, a.acres AS acres_wld, a.l3cover_key AS l3cover_key_wld, a.l4cover_key AS l4cover_key_wld,
       a.project_cover_class AS project_cover_class_wld, a.date AS date_wld, a.inventory_year_raw AS inventory_year_raw_wld,
       b.acres AS acres_department, b.l3cover_key AS l3cover_key_department, b.l4cover_key AS l4cover_key_department,
       b.project_cover_class AS project_cover_class_department, b.date AS date_department,
       b.inventory_year_raw AS inventory_year_raw_department
FROM {_WC} a JOIN {_DC} b ON a.fcskey = b.fcskey""")
reg("jn_08_category_report", A.category_report, f"""{_PROP_U}{_CONC_RAW},
  pcs AS ({_PCS}),
  sz AS (SELECT project_cover_class, {R('avg(acres)', 'mean_acres')}, {R('quantile_cont(acres, 0.5)', 'median_acres')}
         FROM {_CLS} GROUP BY ALL),
  ta AS ({_TOP_A}), tp AS ({_TOP_P})
SELECT pcs.*, mean_acres, median_acres, top_area_by_acres, top_area_acres,
       {R('top_area_percent_category_acres')}, top_area_by_percent, {R('top_area_percent_unit_acres')},
       top_area_by_percent_acres, {R('top_5_percent')}, {R('top_10_percent')}, {R('top_20_percent')},
       total_management_areas
FROM pcs LEFT JOIN sz USING (project_cover_class) LEFT JOIN ta USING (project_cover_class)
LEFT JOIN tp USING (project_cover_class) LEFT JOIN ctab USING (project_cover_class)""")
reg("jn_09_landbase_join", B.landbase_join, f"""
, land AS (SELECT authority_key, coalesce(sum(acres), 0) AS total_authority_terrestrial_acres FROM d_terr GROUP BY ALL),
  g AS (SELECT project_cover_class, authority_key, coalesce(sum(acres), 0) AS acres FROM d_terr
        WHERE project_cover_class IS NOT NULL GROUP BY ALL)
SELECT g.authority_key, g.project_cover_class, g.acres, land.total_authority_terrestrial_acres,
       {R('100 * g.acres / land.total_authority_terrestrial_acres', 'percent_authority_terrestrial_landbase')}
FROM g LEFT JOIN land ON g.authority_key IS NOT DISTINCT FROM land.authority_key""")
reg("set_02_scope_summaries", B.scope_summaries,
    _SCOPE_SUM.format(col="value", src="wld").replace("SELECT metric, v AS value", "SELECT metric, v AS value, 'division' AS scope")
    + " UNION ALL " +
    _SCOPE_SUM.format(col="value", src="dept").replace("SELECT metric, v AS value", "SELECT metric, v AS value, 'department' AS scope"))
reg("set_04_wide_to_long", B.cover_shares_long, f"""
SELECT l3cover_key, metric, percent FROM (SELECT l3cover_key, percent_stands AS "Stands", percent_acres AS "Acres"
  FROM ({_DCS})) UNPIVOT INCLUDE NULLS (percent FOR metric IN ("Stands", "Acres"))""")
reg("win_02_share_within_partition", B.share_within_authority, f"""
SELECT authority_key, l3cover_key, stands, {R('stands / sum(stands) OVER (PARTITION BY authority_key)', 'percent_within_authority')}
FROM (SELECT authority_key, l3cover_key, count(*) AS stands FROM dept GROUP BY ALL)""")
reg("win_03_rank_running_total", B.unit_rank_running_total, """
SELECT authority_key, unit_key, acres,
       CAST(row_number() OVER (PARTITION BY authority_key ORDER BY acres DESC, unit_key ASC NULLS LAST) AS INTEGER) AS rank,
       sum(acres) OVER (PARTITION BY authority_key ORDER BY acres DESC, unit_key ASC NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_acres
FROM (SELECT authority_key, unit_key, coalesce(sum(acres), 0) AS acres FROM dept GROUP BY ALL)""")
reg("win_04_top_k_per_group", B.top_covers_per_authority, """
SELECT authority_key, l3cover_key, acres FROM (
  SELECT authority_key, l3cover_key, coalesce(sum(acres), 0) AS acres FROM dept GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY authority_key ORDER BY acres DESC, l3cover_key ASC NULLS LAST) <= 3""")
