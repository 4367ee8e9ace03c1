"""Independent DuckDB SQL for every registered query (the correctness oracle).

The prelude rebuilds the whole pipeline from the driver's tables in plain
SQL. It computes rolling snapshots the direct way (one latest-per-stand pass
per analysis year, as the workflow does), so it checks the one-pass interval
method rather than repeating it. Doubles are rounded to 6 places on both
sides of the comparison.
"""

from __future__ import annotations

from standlens.config import FIXTURE_PARAMS, Params
from standlens.operators.lookup import L3_CROSSWALK, SOURCE_CROSSWALK, SOURCE_DOMAIN
from standlens.sources import fixture as fx


def _values(rows) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def R(expr: str, name: str | None = None, digits: int = 6) -> str:
    """round(expr, 6) AS name."""
    return f"round({expr}, {digits}) AS {name or expr}"


def _scope_ctes(src: str, pfx: str, p: Params, relabel: bool) -> str:
    """Screened, dated, deduplicated and snapshot CTEs of one scope."""
    b, lo, hi = p.baseline_year, p.min_year, p.current_year
    latest_lab = (f"SELECT * REPLACE (coalesce(l3cover_key, '{p.missing_label}') AS l3cover_key, "
                  f"coalesce(authority_key, '{p.missing_label}') AS authority_key) FROM {pfx}_latest"
                  if relabel else f"SELECT * FROM {pfx}_latest")
    return f""",
{pfx}_cover AS (
  SELECT *, CAST(l4covertype_full AS VARCHAR) AS cover_code_chr,
         CASE WHEN starts_with(CAST(l4covertype_full AS VARCHAR), '{p.agriculture_prefix}') THEN '{p.agriculture_class}'
              WHEN l3cover_key = '{p.openland_label}' THEN '{p.openland_label}' END AS project_cover_class
  FROM {src} WHERE l3cover_key IS NOT NULL AND l3covertype <> 0),
{pfx}_timed AS (
  SELECT * FROM (
    SELECT *, CAST(year(date) AS INTEGER) AS inventory_year_raw,
           CAST(CASE WHEN year(date) <= {b} THEN {b} ELSE year(date) END AS INTEGER) AS inventory_year
    FROM {pfx}_cover)
  WHERE inventory_year_raw IS NOT NULL AND inventory_year_raw >= {lo} AND inventory_year_raw <= {hi}),
{pfx}_dedup AS (
  SELECT * FROM {pfx}_timed
  QUALIFY row_number() OVER (PARTITION BY fcskey, inventory_year_raw ORDER BY date DESC NULLS LAST, tb1, tb2, tb3) = 1),
{pfx}_latest AS (
  SELECT * FROM {pfx}_dedup
  QUALIFY row_number() OVER (PARTITION BY fcskey ORDER BY inventory_year_raw DESC, date DESC NULLS LAST, tb1, tb2, tb3) = 1),
{pfx}_latest_lab AS ({latest_lab}),
{pfx}_terr AS (SELECT * FROM {pfx}_latest_lab WHERE l3cover_key <> '{p.water_label}'),
{pfx}_years AS (
  SELECT CAST(unnest(range(min(inventory_year), max(inventory_year) + 1)) AS INTEGER) AS y FROM {pfx}_dedup),
{pfx}_snap AS (
  SELECT y.y AS snap_year, d.* FROM {pfx}_years y JOIN {pfx}_dedup d ON d.inventory_year_raw <= y.y
  QUALIFY row_number() OVER (PARTITION BY y.y, d.fcskey ORDER BY d.inventory_year_raw DESC, d.date DESC NULLS LAST) = 1),
{pfx}_annual AS (
  SELECT *, CAST(sum(stands_total) OVER (PARTITION BY inventory_year) AS BIGINT) AS total_stands_all_cover,
         sum(acres_total) OVER (PARTITION BY inventory_year) AS total_acres_all_cover
  FROM (SELECT snap_year AS inventory_year, l3covertype, l3cover_key, authority_key, count(*) AS stands_total,
               coalesce(sum(acres), 0) AS acres_total
        FROM {pfx}_snap GROUP BY ALL))"""


def prelude(p: Params = FIXTURE_PARAMS) -> str:
    ts = "TIMESTAMP"
    l3_manual = _values([(c, lab, SOURCE_CROSSWALK) for c, lab in L3_CROSSWALK])
    div = ", ".join(f"'{a}'" for a in p.division)
    return f"""WITH
st AS (
  SELECT l_orderkey AS fcskey, {fx.FC_KEY_EXPR} AS fc_key,
         CAST({fx.COVER_CODE_EXPR} AS INTEGER) AS l4covertype,
         CAST({fx.CANOPY_EXPR} AS INTEGER) AS canopy_closure,
         CAST({fx.MANAGED_SITE_EXPR} AS INTEGER) AS managed_site,
         {fx.SUB_CANOPY_EXPR} AS sub_canopy_cover,
         {fx.ACRES_EXPR} AS acres,
         {fx.DATE_EXPR.format(ntz=ts)} AS date,
         {fx.LAST_EDITED_EXPR} AS last_edited_date,
         l_linenumber AS tb1, l_partkey AS tb2, l_suppkey AS tb3
  FROM lineitem),
created AS (SELECT o_orderkey AS fcskey, o_orderdate AS created_date FROM orders),
canopy_lk AS (SELECT CAST(c AS INTEGER) AS canopy_closure, l AS canopy_key FROM (VALUES {_values(fx.CANOPY_DOMAIN)}) t(c, l)),
cover_dom AS (SELECT CAST(c AS INTEGER) AS code, l AS label FROM (VALUES {_values(fx.COVER_DOMAIN)}) t(c, l)),
l4_lk AS (SELECT code AS l4covertype_full,
                 regexp_replace(regexp_replace(label, '^[0-9]+\\s*-\\s*', ''), '\\s*\\(OI\\)$', '') AS l4cover_key
          FROM cover_dom),
mgmt_lk AS (SELECT CAST(c AS INTEGER) AS managed_site, l AS management_key FROM (VALUES {_values(fx.MANAGEMENT_DOMAIN)}) t(c, l)),
auth_lk AS (SELECT CAST(c AS INTEGER) AS management_type, l AS authority_key FROM (VALUES {_values(fx.AUTHORITY_DOMAIN)}) t(c, l)),
unit_lk AS (SELECT s_suppkey AS unit_name, {fx.UNIT_LABEL_EXPR} AS unit_key FROM supplier),
l3_lk AS (
  SELECT l3covertype, l3cover_key, l3_key_source FROM (
    SELECT l4covertype_full AS l3covertype, l4cover_key AS l3cover_key, '{SOURCE_DOMAIN}' AS l3_key_source, 0 AS prio
    FROM l4_lk WHERE length(CAST(l4covertype_full AS VARCHAR)) = 3
    UNION ALL
    SELECT CAST(c AS INTEGER), l, s, 1 FROM (VALUES {l3_manual}) t(c, l, s))
  QUALIFY row_number() OVER (PARTITION BY l3covertype ORDER BY prio) = 1),
coded AS (
  SELECT st.*, st.l4covertype AS l4covertype_full,
         TRY_CAST(substr(CAST(st.l4covertype AS VARCHAR), 1, 3) AS INTEGER) AS l3covertype,
         c.canopy_key, l4.l4cover_key, m.management_key
  FROM st
  LEFT JOIN canopy_lk c ON st.canopy_closure IS NOT DISTINCT FROM c.canopy_closure
  LEFT JOIN l4_lk l4 ON st.l4covertype IS NOT DISTINCT FROM l4.l4covertype_full
  LEFT JOIN mgmt_lk m ON st.managed_site IS NOT DISTINCT FROM m.managed_site),
labelled AS (
  SELECT coded.*, l3.l3cover_key, l3.l3_key_source
  FROM coded LEFT JOIN l3_lk l3 ON coded.l3covertype IS NOT DISTINCT FROM l3.l3covertype),
comp_base AS (
  SELECT s.s_suppkey * {fx.COMPARTMENT_COPIES} + r.i AS fc_key, n.n_regionkey + 1 AS management_type,
         s.s_suppkey AS unit_name, CAST(FLOOR(ABS(s.s_acctbal)) AS DOUBLE) AS acres
  FROM supplier s, (SELECT CAST(range AS INTEGER) AS i FROM range({fx.COMPARTMENT_COPIES})) r, nation n
  WHERE s.s_nationkey = n.n_nationkey),
comp AS (
  SELECT * FROM comp_base
  UNION ALL SELECT fc_key, management_type, unit_name, acres + 1 FROM comp_base WHERE fc_key % {fx.DUPLICATE_EVERY} = 0),
comp_lab AS (
  SELECT a.authority_key, c.management_type, u.unit_key, c.unit_name, c.fc_key, c.acres
  FROM comp c
  LEFT JOIN auth_lk a ON c.management_type IS NOT DISTINCT FROM a.management_type
  LEFT JOIN unit_lk u ON c.unit_name IS NOT DISTINCT FROM u.unit_name),
comp_u AS (
  SELECT * FROM comp_lab
  QUALIFY row_number() OVER (PARTITION BY fc_key ORDER BY acres ASC NULLS LAST, management_type, unit_name) = 1),
dept AS (
  SELECT l.*, a.authority_key, a.management_type, a.unit_key, a.unit_name
  FROM labelled l LEFT JOIN comp_u a ON l.fc_key IS NOT DISTINCT FROM a.fc_key),
wld AS (SELECT * FROM dept WHERE authority_key IN ({div}))""" + _scope_ctes("wld", "w", p, False) + _scope_ctes(
        "dept", "d", p, True)


def q(body: str, p: Params = FIXTURE_PARAMS) -> str:
    return prelude(p) + "\n" + body.strip()
