"""DuckDB text of the binding and the two gold facts (independent of Spark).

The oracle SQL of every query is ``WITH <PRELUDE>, <query CTEs> SELECT ...``
over the raw test tables, so the check covers the joins, the binding and the
query together.
"""

from __future__ import annotations

AS_OF_TS = "TIMESTAMP '2001-11-04 12:00:00'"
AS_OF_DATE = "DATE '2001-11-04'"

_PRICE = "CAST(l.l_extendedprice AS DECIMAL(12,2))"

PRELUDE = f"""
premiums AS (
  SELECT
    CAST(s.s_nationkey AS INTEGER) AS territory,
    CASE l.l_returnflag WHEN 'A' THEN 'F' WHEN 'R' THEN 'M' END AS gender,
    CASE WHEN o.o_orderpriority = '5-LOW' AND l.l_linenumber = 7 THEN ''
         ELSE CAST(1900 + o.o_custkey % 100 AS VARCHAR) || substr(CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR), 5, 6)
    END AS birthdate,
    CAST(l.l_linenumber - 1 AS INTEGER) AS ypc,
    CAST({_PRICE} AS DECIMAL(18,2)) AS current_premium,
    CAST({_PRICE} * CAST(80 + l.l_quantity AS DECIMAL(3,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS indicated_premium,
    CAST({_PRICE} * (CAST(1.00 AS DECIMAL(3,2)) - CAST(l.l_discount AS DECIMAL(3,2))) AS DECIMAL(18,4)) AS selected_premium,
    CAST({_PRICE} * CAST(0.70 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS underlying_premium,
    CAST({_PRICE} * CAST(l.l_discount AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS fixed_expenses,
    CAST({_PRICE} * CAST(70 + 5 * (s.s_nationkey % 16) AS DECIMAL(4,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4))
      AS underlying_total_premium,
    CAST(1.0 + l.l_tax AS DECIMAL(5,2)) AS cgr_factor,
    l.l_linestatus || l.l_returnflag AS cgr,
    l.l_shipdate AS ingested_at,
    substr(CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR), 1, 7) AS batch_id,
    CAST(20000 + s.s_nationkey AS VARCHAR) AS "GEO_id",
    CAST(20000 + o.o_custkey % 25 AS VARCHAR) AS zipcode,
    'XX' AS state_province_code,
    CAST(s.s_nationkey AS BIGINT) AS county_code,
    CAST(24000 + s.s_nationkey AS BIGINT) AS fips_county_code,
    CAST(CASE WHEN l.l_linenumber < 7 THEN l.l_linenumber END AS INTEGER) AS division_number,
    l.l_linestatus AS rating_level
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
territory_dim AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS territory, CAST(n.n_regionkey AS BIGINT) AS area,
         n.n_name AS town, r.r_name AS county, CAST(20000 + n.n_nationkey AS BIGINT) AS zipcode
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE n.n_nationkey < 23
  UNION ALL
  SELECT CAST(n.n_nationkey AS BIGINT), CAST(n.n_regionkey AS BIGINT),
         n.n_name || ' EAST', r.r_name, CAST(20000 + n.n_nationkey AS BIGINT)
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE n.n_nationkey < 23 AND n.n_nationkey % 4 = 0
),
dp03 AS (
  SELECT CAST(20000 + c_nationkey AS BIGINT) AS "GEO_id2", CAST(COUNT(*) AS BIGINT) AS "HC01_VC03",
         CAST(25 + 2 * c_nationkey AS DOUBLE) AS "HC01_VC04", CAST(40 + c_nationkey AS DOUBLE) AS "HC01_VC05"
  FROM customer WHERE c_nationkey % 5 <> 0 GROUP BY c_nationkey
),
dp05 AS (
  SELECT CAST(20000 + s_nationkey AS BIGINT) AS "GEO_id2", CAST(COUNT(*) AS BIGINT) AS "HC01_VC03",
         CAST(80 + s_nationkey AS BIGINT) AS "HC01_VC04"
  FROM supplier WHERE s_nationkey % 3 <> 0 GROUP BY s_nationkey
),
fact_current AS (
  SELECT p.gender, p.birthdate, p.ypc, p.current_premium, p.indicated_premium, p.selected_premium,
         p.underlying_premium, p.fixed_expenses, p.underlying_total_premium, p.cgr_factor, p.cgr,
         p.ingested_at, p.batch_id,
         t.territory, t.area, t.town, t.county, t.zipcode,
         a3."HC01_VC03" AS acs03_total_population, a3."HC01_VC04" AS acs03_median_age,
         a3."HC01_VC05" AS acs03_married_percent,
         a5."HC01_VC03" AS acs05_total_population, a5."HC01_VC04" AS acs05_speak_english_only
  FROM premiums p
  JOIN territory_dim t ON CAST(p.territory AS INTEGER) = CAST(t.territory AS INTEGER)
  LEFT JOIN dp03 a3 ON CAST(a3."GEO_id2" AS VARCHAR) = CAST(t.zipcode AS VARCHAR)
  LEFT JOIN dp05 a5 ON CAST(a5."GEO_id2" AS VARCHAR) = CAST(t.zipcode AS VARCHAR)
),
legacy_territory AS (
  SELECT territory, zipcode, MIN(area) AS area, MIN(town) AS town, MIN(county) AS county
  FROM territory_dim GROUP BY territory, zipcode
),
fact_legacy AS (
  SELECT p."GEO_id", p.gender, p.birthdate, p.state_province_code, p.zipcode, p.county_code,
         p.fips_county_code, p.division_number, p.rating_level, p.current_premium, p.indicated_premium,
         p.cgr_factor,
         COALESCE(CAST(t.territory AS VARCHAR), 'Unknown') AS territory_label,
         t.area AS territory_area, t.town AS territory_town, t.county AS territory_county,
         a3."HC01_VC03" AS acs03_total_population, a3."HC01_VC04" AS acs03_median_age,
         a3."HC01_VC05" AS acs03_married_percent,
         a5."HC01_VC03" AS acs05_total_population, a5."HC01_VC04" AS acs05_speak_english_only,
         p.ingested_at, p.batch_id
  FROM premiums p
  LEFT JOIN legacy_territory t ON CAST(t.zipcode AS VARCHAR) = p."GEO_id"
  LEFT JOIN dp03 a3 ON CAST(a3."GEO_id2" AS VARCHAR) = p."GEO_id"
  LEFT JOIN dp05 a5 ON CAST(a5."GEO_id2" AS VARCHAR) = p."GEO_id"
)
"""


def with_prelude(query: str) -> str:
    """Prefix the binding CTEs; a query's own WITH list is appended to them."""
    q = query.strip()
    if q[:4].upper() == "WITH":
        return "WITH " + PRELUDE.strip() + ",\n" + q[4:].lstrip()
    return "WITH " + PRELUDE.strip() + "\n" + q


def avg(x: str, digits: int | None = 2) -> str:
    """Average as ``double(sum) / count`` (same arithmetic as the Spark side)."""
    core = f"CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0)"
    return core if digits is None else f"ROUND({core}, {digits})"


def money(x: str) -> str:
    return f"CAST(ROUND({x}, 2) AS DECIMAL(38,2))"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str, digits: int = 2) -> str:
    return f"ROUND({div(a, b)} * 100.0, {digits})"


def share(a: str, b: str, digits: int = 2) -> str:
    return f"ROUND((CAST({a} AS DOUBLE) * 100.0) / NULLIF(CAST({b} AS DOUBLE), 0), {digits})"


def cnt_if(pred: str) -> str:
    return f"COUNT(CASE WHEN {pred} THEN 1 END)"


def fixed2(x: str) -> str:
    return f"CAST(CAST(ROUND({x}, 2) AS DECIMAL(38,2)) AS VARCHAR)"


def q(text: str) -> str:
    """Quote a Python string as a SQL literal."""
    return "'" + text.replace("'", "''") + "'"
