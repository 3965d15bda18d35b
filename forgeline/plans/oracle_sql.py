"""DuckDB statements that restate each registered query independently.

The domain views are restated as SQL CTEs over the driver tables; each
operator is then written the plain-SQL way (ASOF JOIN, correlated lookups,
``median``, ``row_number``), so the comparison checks the Spark design
(calendar expansion, bucketed exact quantiles, skew-safe dedupe) against a
brute-force formulation.
"""

from __future__ import annotations

from forgeline.constants import (
    COST_COMPONENT_COLUMNS, DECOMPOSITION_RATIOS, DEFAULT_RATIOS, DUPLICATE_REASON,
    PIPELINE_FALLBACK_PRICES, PIPELINE_MATERIAL_FAMILY, PIPELINE_PROCESS_CODE,
    PROCESS_CLASSES, SURFACE_FINISH_PRESETS, TOLERANCE_IT_INDEX, TRACKED_MATERIALS,
    VALIDATION_RULES,
)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else repr(float(v)) + "e0"
                                     if isinstance(v, float) else str(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


OID = ("CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || "
       "CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)")
COST_TOTAL = "CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -l_extendedprice ELSE l_extendedprice END"

CTES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTES[name] = sql
    DEPS[name] = deps or []


cte("proc", "SELECT * FROM " + values(list(enumerate(PROCESS_CLASSES + ["weaving_socks"])), ["pidx", "pcode"]))
cte("mat", "SELECT * FROM " + values(list(enumerate(TRACKED_MATERIALS + ["CARBON_FIBER", "UNOBTANIUM"])),
                                     ["midx", "mcode"]))
cte("m_orders", f"""
SELECT {OID} AS order_id,
  'PART-' || CAST(l_partkey AS VARCHAR) AS part_id,
  CASE WHEN l_linenumber % 2 = 0 THEN '  ' || UPPER(pcode) || ' ' ELSE pcode END AS process_code,
  mcode AS material_code,
  CAST(l_quantity AS INTEGER) AS quantity,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS batch_size,
  CASE l_linenumber % 5 WHEN 0 THEN 'as_machined' WHEN 1 THEN ' Fine' WHEN 2 THEN '1.6' WHEN 3 THEN 'bogus' END
    AS surface_finish_ra,
  'it' || CAST(4 + l_suppkey % 11 AS VARCHAR) AS tolerance_band,
  DATE '2024-01-01' + CAST(l_orderkey % 45 AS INTEGER) AS order_date,
  DATE '2024-01-01' + CAST(l_orderkey % 45 AS INTEGER) + l_linenumber AS completion_date,
  'FACILITY_0' || CAST(1 + l_suppkey % 3 AS VARCHAR) AS facility_id,
  CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'pending' END AS status,
  {COST_TOTAL} AS cost_total
FROM lineitem LEFT JOIN proc ON (l_suppkey * 7 + l_linenumber) % 20 = pidx
JOIN mat ON l_suppkey % 18 = midx""", ["proc", "mat"])
_INVOICES = f"""
SELECT {OID} AS order_id, {COST_TOTAL} AS cost_total,
  CASE WHEN l_returnflag = 'A' THEN l_extendedprice * 0.40e0 END AS cost_machine_time,
  CASE WHEN l_returnflag = 'A' THEN l_extendedprice * 0.20e0 END AS cost_setup,
  CASE WHEN l_returnflag = 'A' AND l_linenumber <> 3 THEN l_extendedprice * 0.10e0 END AS cost_tooling,
  CASE WHEN l_returnflag = 'A' THEN l_extendedprice * 0.25e0 END AS cost_raw_material,
  CASE WHEN l_returnflag = 'A' THEN l_extendedprice * 0.05e0 END AS cost_finishing,
  CASE WHEN l_returnflag = 'A' THEN 'exact' WHEN l_tax >= 0.06e0 THEN 'estimated' ELSE 'decomposed' END AS label_source
FROM lineitem{{where}}"""


cte("m_invoices_all", _INVOICES.format(where=""))
cte("m_invoices", _INVOICES.format(where=""))
cte("m_invoices_partial", _INVOICES.format(where=" WHERE l_tax < 0.075e0"))
_GEOMETRY = """
SELECT 'PART-' || CAST(p_partkey AS VARCHAR) AS part_id,
  CASE WHEN p_partkey % 41 <> 0 THEN p_size * 13.0e0 END AS bounding_box_x,
  p_size * 7.0e0 + 5.0e0 AS bounding_box_y,
  p_size * 3.0e0 + 2.0e0 AS bounding_box_z,
  p_size * p_size * p_size * 110.0e0 AS volume,
  p_retailprice * 10.0e0 AS surface_area,
  CASE WHEN p_partkey % 20 <> 0 THEN (p_partkey % 97 + 3) / 10.0e0 END AS wall_thickness_min,
  CASE WHEN p_partkey % 20 <> 0 THEN (p_partkey % 97 + 9) / 7.0e0 END AS wall_thickness_avg,
  p_size * 13.0e0 / (p_size * 3.0e0 + 2.0e0) AS aspect_ratio,
  CASE WHEN p_partkey % 15 <> 0 THEN CAST(p_partkey % 23 AS INTEGER) END AS hole_count,
  CASE WHEN p_partkey % 6 <> 0 THEN 0.5e0 + (p_partkey % 40) / 2.0e0 END AS hole_diameter_min,
  CASE WHEN p_partkey % 25 = 1 THEN NULL WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS undercut_flag,
  CASE WHEN p_partkey % 20 <> 0 THEN CAST((p_partkey % 97 + 3) / 10.0e0 < 1.5e0 AS INTEGER) END AS thin_wall_flag,
  CASE WHEN p_partkey % 33 <> 0 THEN (p_partkey % 101) / 100.0e0 END AS curvature_complexity,
  CASE WHEN p_partkey % 31 <> 0 THEN (p_partkey % 89) / 88.0e0 END AS symmetry_score
FROM part"""
cte("m_geometry_all", _GEOMETRY)
cte("m_geometry", _GEOMETRY)
cte("m_geometry_partial", _GEOMETRY + " WHERE p_partkey % 10 <> 9")
cte("m_prices", """
SELECT CAST(ts AS DATE) - CAST((datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) + midx) % (midx + 1) AS INTEGER) AS date,
  mcode AS material_code, 1.0e0 + value AS price_usd_per_kg, 'live' AS source, event_id AS seq
FROM events JOIN mat ON user_id % 18 = midx
WHERE event_type = 'purchase'""", ["mat"])
cte("m_equipment", """
SELECT 'FACILITY_0' || CAST(1 + user_id % 3 AS VARCHAR) AS facility_id,
  'M' || CAST(user_id AS VARCHAR) AS machine_id, pcode AS process_code,
  CAST(date_trunc('week', ts) AS DATE) AS week_start,
  30.0e0 + value AS effective_hourly_rate_usd, event_id AS seq
FROM events JOIN proc ON (user_id * 7) % 20 = pidx
WHERE event_type = 'view'""", ["proc"])
cte("fb_pipeline", "SELECT * FROM " + values(list(PIPELINE_FALLBACK_PRICES.items()), ["fb_mat", "fb_price"]))

# --- S1 -> J1 -> J3 -> J2 ---------------------------------------------------
cte("ex", """
SELECT o.order_id, o.part_id, o.process_code, o.material_code, o.quantity, o.batch_size,
  o.surface_finish_ra, o.tolerance_band, o.order_date, o.completion_date, o.facility_id,
  i.cost_total, i.cost_machine_time, i.cost_setup, i.cost_tooling, i.cost_raw_material,
  i.cost_finishing, i.label_source AS cost_label_source
FROM m_orders o LEFT JOIN m_invoices i ON o.order_id = i.order_id
WHERE o.status = 'completed'""", ["m_orders", "m_invoices"])
cte("j1", """
SELECT ex.*, g.* EXCLUDE (part_id) FROM ex JOIN m_geometry g ON ex.part_id = g.part_id
WHERE g.bounding_box_x IS NOT NULL""", ["ex", "m_geometry"])
cte("eq_week", """
SELECT process_code, facility_id, week_start, arg_max(effective_hourly_rate_usd, seq) AS rate
FROM m_equipment GROUP BY process_code, facility_id, week_start""", ["m_equipment"])
cte("j3", """
SELECT j1.*, e.rate AS effective_hourly_rate
FROM j1 ASOF LEFT JOIN eq_week e
  ON j1.process_code = e.process_code AND j1.facility_id = e.facility_id AND j1.order_date >= e.week_start""",
    ["j1", "eq_week"])
cte("pday", """
SELECT material_code, date, arg_min(price_usd_per_kg, seq) AS price
FROM m_prices GROUP BY material_code, date""", ["m_prices"])
cte("j2", """
SELECT j3.*, COALESCE(
  (SELECT p.price FROM pday p WHERE p.material_code = j3.material_code AND p.date = j3.order_date),
  (SELECT p.price FROM pday p WHERE p.material_code = j3.material_code
     AND abs(datediff('day', j3.order_date, p.date)) <= 7 ORDER BY p.date DESC LIMIT 1),
  fb.fb_price) AS material_price_per_kg
FROM j3 LEFT JOIN fb_pipeline fb ON fb.fb_mat = j3.material_code""", ["j3", "pday", "fb_pipeline"])


def r2(x: str, places: int = 2) -> str:
    """Spark's round() on a double rounds its shortest decimal text (half up); DuckDB
    rounds the binary value.  Rounding the decimal parsed from the text form
    reproduces Spark's result."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {places}) AS DOUBLE)"


def _map_case(col: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {v!r}" for k, v in mapping.items())
    return f"COALESCE(CASE {col} {whens} END, {default})"


_ratio_cases = []
for i, comp in enumerate(COST_COMPONENT_COLUMNS):
    whens = " ".join(f"WHEN {_q(p)} THEN {r[i]!r}e0" for p, r in DECOMPOSITION_RATIOS.items())
    _ratio_cases.append(f"CASE process_code {whens} ELSE {DEFAULT_RATIOS[i]!r}e0 END")

cte("nrm0", """
SELECT * REPLACE (lower(trim(process_code)) AS process_code, upper(trim(material_code)) AS material_code,
                  upper(trim(tolerance_band)) AS tolerance_band)
FROM j2""", ["j2"])
cte("med_g", """
SELECT process_code, median(wall_thickness_min) AS g_min, median(wall_thickness_avg) AS g_avg
FROM nrm0 GROUP BY process_code""", ["nrm0"])
cte("med_all", """
SELECT median(wall_thickness_min) AS a_min, median(wall_thickness_avg) AS a_avg,
  avg(hole_diameter_min) AS a_hd FROM nrm0""", ["nrm0"])
_finish = _map_case("lower(trim(n.surface_finish_ra))", SURFACE_FINISH_PRESETS,
                    "TRY_CAST(trim(n.surface_finish_ra) AS DOUBLE), 3.2e0")
cte("nrm", f"""
SELECT n.* REPLACE (
    COALESCE(n.wall_thickness_min, g.g_min, a.a_min, 1.5e0) AS wall_thickness_min,
    COALESCE(n.wall_thickness_avg, g.g_avg, a.a_avg, 1.5e0) AS wall_thickness_avg,
    CAST(COALESCE(n.hole_count, 0) AS INTEGER) AS hole_count,
    COALESCE(n.hole_diameter_min, a.a_hd, 5.0e0) AS hole_diameter_min,
    CAST(COALESCE(n.undercut_flag, 0) AS INTEGER) AS undercut_flag,
    COALESCE(n.symmetry_score, 0.5e0) AS symmetry_score,
    COALESCE(n.curvature_complexity, 0.0e0) AS curvature_complexity,
    COALESCE(n.cost_label_source, 'estimated') AS cost_label_source,
    COALESCE(n.batch_size, n.quantity) AS batch_size,
    {_finish} AS surface_finish_ra,
    CAST(COALESCE(n.wall_thickness_min, g.g_min, a.a_min, 1.5e0) < 1.5e0 AS INTEGER) AS thin_wall_flag),
  CAST(n.wall_thickness_min IS NULL AS INTEGER) AS wall_thickness_min_imputed,
  CAST(n.wall_thickness_avg IS NULL AS INTEGER) AS wall_thickness_avg_imputed,
  CAST({_map_case('n.process_code', PIPELINE_PROCESS_CODE, '0')} AS INTEGER) AS process_code_encoded,
  CAST({_map_case('n.material_code', PIPELINE_MATERIAL_FAMILY, '0')} AS INTEGER) AS material_code_encoded,
  ln(1 + CAST(n.quantity AS DOUBLE)) AS log_quantity,
  n.volume * n.material_price_per_kg / 1e6 AS volume_x_price,
  CAST({_map_case('n.tolerance_band', TOLERANCE_IT_INDEX, '5')} AS DOUBLE) AS tolerance_index
FROM nrm0 n LEFT JOIN med_g g ON n.process_code IS NOT DISTINCT FROM g.process_code
CROSS JOIN med_all a""", ["nrm0", "med_g", "med_all"])
_complete = " AND ".join(f"COALESCE({c} >= 0, false)" for c in COST_COMPONENT_COLUMNS)
_usable = "(cost_total IS NOT NULL AND cost_total > 0)"
cte("lbl", "SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN {_usable} AND NOT ({_complete}) THEN {r2(f'cost_total * {_ratio_cases[i]}')} "
    f"ELSE CAST({c} AS DOUBLE) END AS {c}" for i, c in enumerate(COST_COMPONENT_COLUMNS)) +
    f", CASE WHEN {_usable} AND {_complete} THEN 'exact' WHEN {_usable} THEN 'estimated' "
    f"ELSE cost_label_source END AS cost_label_source) FROM nrm", ["nrm"])


def _validation_sql() -> str:
    """Fills/casts, then the reported reason = last failing rule (reverse CASE)."""
    fills = []
    checks = []   # in rule order: (bucket, column, condition)
    for col, typ, policy, rng, allowed, default in VALIDATION_RULES:
        v = col
        if policy in ("required", "drop_row"):
            checks.append(("Null", col, f"{col} IS NULL"))
        val = col
        if policy == "default_value" and default is not None:
            val = f"COALESCE({col}, {_q(default) if isinstance(default, str) else repr(default)})"
        elif policy == "fallback_to_historical_avg":
            val = f"COALESCE({col}, 5.0e0)"
        if typ == "int":
            val = f"CAST(trunc(COALESCE(CAST({val} AS DOUBLE), 0)) AS INTEGER)"
        elif typ == "float":
            val = f"CAST({val} AS DOUBLE)"
        fills.append(f"{val} AS {col}")
        if rng is not None:
            checks.append((f"Column '{col}'", col,
                           f"{val} IS NOT NULL AND ({val} < {float(rng[0])!r}e0 OR {val} > {float(rng[1])!r}e0)"))
        if allowed is not None:
            lst = ", ".join(_q(a) if isinstance(a, str) else str(a) for a in allowed)
            if typ == "string":
                checks.append((f"Column '{col}'", col, f"({val} IS NULL OR {val} NOT IN ({lst}))"))
            else:
                checks.append((f"Column '{col}'", col, f"{val} NOT IN ({lst})"))
    bucket = "CASE WHEN __rn > 1 THEN " + _q(DUPLICATE_REASON) + " " + " ".join(
        f"WHEN {c} THEN {_q(b)}" for b, _, c in reversed(checks)) + " END"
    column = "CASE WHEN __rn > 1 THEN NULL " + " ".join(
        f"WHEN {c} THEN {_q(col)}" for _, col, c in reversed(checks)) + " END"
    inner = ("SELECT *, row_number() OVER (PARTITION BY part_id, process_code "
             "ORDER BY completion_date, order_id) AS __rn FROM lbl")
    return (f"SELECT * REPLACE ({', '.join(fills)}), {bucket} AS reject_bucket, {column} AS reject_column "
            f"FROM ({inner}) q")


cte("ann", _validation_sql(), ["lbl"])


def with_ctes(names: list[str], body: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    if body.lstrip().upper().startswith("WITH"):
        body = f"SELECT * FROM ({body}) __b"
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + body
