"""Registered scoring queries: constraints, featurizers, validators, predictions, costs, recommend, explain."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from forgeline.constants import (
    CONSTRAINT_DEFAULTS, COST_FEATURE_COLUMNS, FEATURE_COLUMNS, FEATURE_RANGES, FEATURE_REQUIRED, FETCHER_FALLBACK_PRICES,
    MATERIAL_COMMODITY, PROCESS_CATALOG_BOUNDS, PROCESS_CLASSES, ROUTED_PROCESSES, COST_PROCESS_CODE, COST_MATERIAL_FAMILY, FEATURE_HISTORICAL_PRICES, TOLERANCE_IT_INDEX,
)
from forgeline.functions import features as fx
from forgeline.operators import rules, validate
from forgeline.operators.common import lookup
from forgeline.plans import scoring
from forgeline.plans.evaluate import best_class, ranked_classes
from forgeline.plans.oracle_sql import OID, _map_case, _q, cte, r2, values
from forgeline.plans.registry import register
from forgeline.schemas import GEOMETRY_COLUMNS
from forgeline.session import materialize, shared_path
from forgeline.sources.tables import Domain

ALL_LIST = "[" + ", ".join(_q(p) for p in PROCESS_CLASSES) + "]"


def _excluded_sql(code: str, wmin: str, wavg: str, und: str, bx: str, by: str, bz: str) -> str:
    return (f"(({code} IN ('injection_molding', 'die_casting') AND {und} = 1)"
            f" OR ({code} = 'injection_molding' AND ({bx} > 600.0e0 OR {by} > 600.0e0 OR {bz} > 600.0e0))"
            f" OR ({code} = 'sand_casting' AND {wmin} < 2.0e0)"
            f" OR ({code} IN ('injection_molding', 'die_casting', 'forging') AND {wmin} < 0.8e0)"
            f" OR ({code} IN ('cnc_milling', 'cnc_turning', '5axis_cnc', 'turning_milling') AND {wmin} < 0.5e0)"
            f" OR ({code} IN ('sheet_metal_bending', 'sheet_metal_stamping', 'laser_cutting') AND {wavg} > 12.0e0))")


cte("m_ngeo", """
SELECT 'PART-' || CAST(p_partkey AS VARCHAR) AS part_id, p_partkey AS k,
  p_size * 13.0e0 AS bx, p_size * 7.0e0 + 5.0e0 AS by_, p_size * 3.0e0 + 2.0e0 AS bz,
  p_size * p_size * p_size * 110.0e0 AS volume, p_retailprice * 10.0e0 AS surface_area,
  list_transform(range(1, p_partkey % 5 + 1), lambda i: (p_partkey % 97 + i * 3) / 10.0e0) AS walls,
  list_slice(list_transform(range(1, p_partkey % 5 + 1), lambda i: 0.5e0 + ((p_partkey + i) % 40) / 2.0e0),
             1, p_partkey % 3) AS hole_d,
  list_transform(range(1, p_partkey % 5 + 1), lambda i: ((p_partkey * i) % 101) / 100.0e0) AS curv,
  CASE WHEN p_partkey % 4 = 0 THEN CAST([] AS DOUBLE[])
       ELSE [(p_partkey % 89) / 88.0e0, (p_partkey % 7) / 7.0e0, (p_partkey % 13) / 13.0e0] END AS axes,
  p_partkey % 5 = 0 AS has_undercuts
FROM part""")
cte("a1", """
SELECT part_id, bx AS bounding_box_x, by_ AS bounding_box_y, bz AS bounding_box_z, volume, surface_area,
  list_min(walls) AS wall_thickness_min, list_avg(walls) AS wall_thickness_avg,
  CASE WHEN least(bx, by_, bz) > 0 THEN greatest(bx, by_, bz) / least(bx, by_, bz) ELSE 1.0e0 END AS aspect_ratio,
  CAST(len(hole_d) AS INTEGER) AS hole_count, list_min(hole_d) AS hole_diameter_min,
  CAST(has_undercuts AS INTEGER) AS undercut_flag,
  COALESCE(CAST(list_min(walls) < 1.5e0 AS INTEGER), 0) AS thin_wall_flag,
  COALESCE(least(greatest(list_aggregate(curv, 'var_pop') / 0.85e0, 0.0e0), 1.0e0), 0.0e0) AS curvature_complexity,
  COALESCE(list_max(axes), 0.0e0) AS symmetry_score
FROM m_ngeo""", ["m_ngeo"])
cte("m_req", """
SELECT r.row_id, r.class_idx, r.p, r.rnk, o.quantity, g.part_id, g.volume,
  COALESCE(g.wall_thickness_min, 2.0e0) AS wmin, COALESCE(g.wall_thickness_avg, 3.0e0) AS wavg,
  COALESCE(g.undercut_flag, 0) AS und, g.bounding_box_x AS bx, g.bounding_box_y AS by_, g.bounding_box_z AS bz,
  c.process AS process_code
FROM m_ranked r JOIN m_orders o ON o.order_id = r.row_id
JOIN m_geometry g ON g.part_id = 'PART-' || split_part(r.row_id, '-', 3)
JOIN classes c ON c.class_idx = r.class_idx
WHERE g.bounding_box_x IS NOT NULL""", ["m_ranked", "m_orders", "m_geometry", "classes"])
cte("m_kept", f"""
SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY rnk) AS pos FROM m_req
WHERE rnk <= 6 AND NOT {_excluded_sql('process_code', 'wmin', 'wavg', 'und', 'bx', 'by_', 'bz')}""", ["m_req"])


def _display_case(col: str) -> str:
    return _map_case(col, rules.API_DISPLAY_NAMES, col).replace(" THEN ", " THEN ")


def _score_requests(d: Domain, **of_scores: Column):
    """Scored requests with their part's features; ``of_scores``: what is needed of the probabilities, worked
    out before the join so that the 18 of them are not shuffled."""
    g = scoring.serving_feature_defaults(d.geometry.where(F.col("bounding_box_x").isNotNull()))
    wanted = [c.alias(n) for n, c in of_scores.items()]
    return d.score_requests.select("row_id", "true_idx", *wanted, "part_id", "quantity").join(g, "part_id")


def _best(k: int) -> Column:
    return F.slice(ranked_classes(F.col("proba")), 1, k)


@register("p17_feasible_processes", f"""
SELECT part_id, array_to_string(list_filter({ALL_LIST}, lambda c: NOT {_excluded_sql(
    'c', 'COALESCE(wall_thickness_min, 10.0e0)', 'COALESCE(wall_thickness_avg, 5.0e0)',
    'COALESCE(undercut_flag, 0)', 'COALESCE(bounding_box_x, 0.0e0)', 'COALESCE(bounding_box_y, 0.0e0)',
    'COALESCE(bounding_box_z, 0.0e0)')}), ',') AS feasible_codes,
  CAST(len(list_filter({ALL_LIST}, lambda c: NOT {_excluded_sql(
    'c', 'COALESCE(wall_thickness_min, 10.0e0)', 'COALESCE(wall_thickness_avg, 5.0e0)',
    'COALESCE(undercut_flag, 0)', 'COALESCE(bounding_box_x, 0.0e0)', 'COALESCE(bounding_box_y, 0.0e0)',
    'COALESCE(bounding_box_z, 0.0e0)')})) AS INTEGER) AS n_feasible
FROM m_geometry_all""", [], ["m_geometry_all"])
def p17_feasible_processes(d: Domain):
    """Feasible processes per part after the hard constraints (missing inputs -> defaults)."""
    f = d.all_geometry.withColumn("feasible", rules.feasible_processes())
    return f.select("part_id", F.array_join("feasible", ",").alias("feasible_codes"),
                    F.size("feasible").alias("n_feasible"))


@register("p19_heuristic_ranking", """
SELECT part_id, CASE WHEN wall_thickness_min < 1.5e0 THEN 'additive_fdm,sheet_metal_bending,laser_cutting'
  WHEN volume > 5e6 THEN 'sand_casting,die_casting,forging'
  ELSE 'cnc_milling,sheet_metal_bending,injection_molding' END AS heuristic_top3 FROM m_geometry_all""",
          [], ["m_geometry_all"])
def p19_heuristic_ranking(d: Domain):
    """Three-rule heuristic baseline ranking."""
    return d.all_geometry.select("part_id", F.array_join(rules.heuristic_ranking(), ",").alias("heuristic_top3"))


A1_DOUBLES = ["bounding_box_x", "bounding_box_y", "bounding_box_z", "volume", "surface_area", "wall_thickness_min",
              "wall_thickness_avg", "aspect_ratio", "hole_diameter_min", "curvature_complexity", "symmetry_score"]


@register("a1_training_features", "SELECT * FROM a1", A1_DOUBLES, ["a1"])
def a1_training_features(d: Domain):
    """Training featurizer over nested geometry (array/map higher-order functions)."""
    return fx.training_features(d.nested_geometry)


@register("a2_serving_features", """
SELECT part_id, bx AS bounding_box_x, by_ AS bounding_box_y, bz AS bounding_box_z, volume, surface_area,
  COALESCE(list_min(walls), 2.0e0) AS wall_thickness_min, COALESCE(list_avg(walls), 3.0e0) AS wall_thickness_avg,
  CASE WHEN least(bx, by_, bz) > 0 THEN greatest(bx, by_, bz) / least(bx, by_, bz) ELSE 1.0e0 END AS aspect_ratio,
  CAST(len(hole_d) AS DOUBLE) AS hole_count, COALESCE(list_min(hole_d), 0.0e0) AS hole_diameter_min,
  CAST(has_undercuts AS DOUBLE) AS undercut_flag,
  CAST(COALESCE(list_min(walls), 2.0e0) < 1.5e0 AS DOUBLE) AS thin_wall_flag,
  COALESCE(list_avg(curv), 0.0e0) AS curvature_complexity, COALESCE(list_avg(axes), 0.5e0) AS symmetry_score
FROM m_ngeo""", A1_DOUBLES + ["hole_count", "undercut_flag", "thin_wall_flag"], ["m_ngeo"])
def a2_serving_features(d: Domain):
    """Serving featurizer (different empty defaults and reducers than A1)."""
    g = d.nested_geometry
    req = g.select("part_id", F.struct(*[F.col(c) for c in g.columns if c != "part_id"]).alias("geometry"),
                   F.struct(F.lit("AL6061").alias("material_code"), F.lit(10).alias("quantity"),
                            F.lit(None).cast("double").alias("surface_finish_spec"),
                            F.lit(None).cast("string").alias("surface_finish_preset"),
                            F.lit("IT8").alias("tolerance_band"), F.lit(None).cast("int").alias("max_lead_time_days"),
                            F.lit(None).cast("int").alias("batch_size")).alias("requirements"),
                   F.lit(3).alias("top_k"))
    return fx.serving_features(req).select("part_id", *FEATURE_COLUMNS)


def _v9_sql() -> str:
    checks = [f"WHEN {n} IS NULL OR isnan(CAST({n} AS DOUBLE)) THEN {_q(f'Required feature {chr(39)}{n}{chr(39)} is missing or NaN')}"
              for n in FEATURE_REQUIRED]
    for n, lo, hi in FEATURE_RANGES:
        checks.append(f"WHEN {n} IS NOT NULL AND (CAST({n} AS DOUBLE) < {float(lo)!r}e0 OR CAST({n} AS DOUBLE) > "
                      f"{float(hi)!r}e0) THEN {_q(f'Feature {chr(39)}{n}{chr(39)} is outside expected range [{lo}, {hi}]')}")
    checks.append("WHEN wall_thickness_min IS NOT NULL AND thin_wall_flag <> CAST(wall_thickness_min < 1.5e0 AS INTEGER) "
                  "THEN 'Inconsistency: thin_wall_flag disagrees with wall_thickness_min'")
    checks.append("WHEN aspect_ratio < 1.0e0 THEN 'aspect_ratio is less than 1.0'")
    checks.append("WHEN volume <> 0 AND bounding_box_x <> 0 AND bounding_box_y <> 0 AND bounding_box_z <> 0 AND "
                  "volume > bounding_box_x * bounding_box_y * bounding_box_z * 1.05e0 "
                  "THEN 'Part volume exceeds bounding box volume'")
    return "SELECT part_id, CASE " + " ".join(checks) + " END AS feature_error FROM a1"


@register("v9_feature_vector_errors", _v9_sql(), [], ["a1"])
def v9_feature_vector_errors(d: Domain):
    """V9: first failing feature-vector check per part (NULL = valid)."""
    return validate.feature_vector_errors(fx.training_features(d.nested_geometry)).select("part_id", "feature_error")


@register("m5_top3_predictions", f"""
SELECT r.row_id, CAST(r.rnk AS INTEGER) AS rank, c.process AS process_code,
  {_map_case('c.process', rules.PROCESS_DISPLAY_NAMES, 'c.process')} AS process_name,
  {r2('r.p', 4)} AS probability,
  CASE WHEN r.p >= 0.55e0 THEN 'high' WHEN r.p >= 0.25e0 THEN 'medium' ELSE 'low' END AS confidence
FROM m_ranked r JOIN classes c ON c.class_idx = r.class_idx WHERE r.rnk <= 3""", [], ["m_ranked", "classes"])
def m5_top3_predictions(d: Domain):
    """Top-3 prediction table with name, probability and tier."""
    return scoring.top_k_predictions(d.scores, 3)


@register("m9_fallback_estimate", f"""
SELECT order_id, {r2('t * 0.40e0')} AS machine_time_cost, {r2('t * 0.15e0 / q')} AS setup_cost,
  {r2('t * 0.10e0')} AS tooling_cost, {r2('m')} AS raw_material_cost, {r2('t * 0.05e0')} AS finishing_cost,
  {r2('t')} AS total_cost, 'low' AS confidence
FROM (SELECT order_id, m, m * 3.5e0 AS t, q FROM (
  SELECT j1.order_id, COALESCE(j1.volume, 50000.0e0) / 1e6 * 2.7e0 * COALESCE(fb.p, 5.0e0) AS m,
    greatest(1.0e0, COALESCE(CAST(j1.quantity AS DOUBLE), 10.0e0)) AS q
  FROM j1 LEFT JOIN (SELECT * FROM {values(list(FETCHER_FALLBACK_PRICES.items()), ['mat', 'p'])}) fb
    ON fb.mat = j1.material_code) a) b""",
          [], ["j1"])
def m9_fallback_estimate(d: Domain):
    """Fallback cost estimate for every priced order (17-entry fetcher table, default 5.00)."""
    from forgeline.sources.readers import extract_completed
    from forgeline.operators.joins import join_geometry
    j = join_geometry(extract_completed(d.orders, d.invoices), d.geometry)
    price = F.coalesce(lookup(FETCHER_FALLBACK_PRICES, F.col("material_code")), F.lit(5.0))
    e = j.select("order_id", scoring.fallback_estimate(F.col("volume"), price, F.col("quantity")).alias("c"))
    return e.select("order_id", "c.*")


@register("m13_cost_features", f"""
SELECT o.order_id,
  CAST({_map_case('lower(trim(o.process_code))', COST_PROCESS_CODE, '0')} AS INTEGER) AS process_code_encoded,
  CAST(o.quantity AS DOUBLE) AS quantity,
  CASE WHEN o.quantity >= 0 THEN ln(o.quantity + 1.0e0) ELSE 0.0e0 END AS log_quantity,
  CASE WHEN o.batch_size IS NULL OR o.batch_size = 0 THEN CAST(o.quantity AS DOUBLE) ELSE CAST(o.batch_size AS DOUBLE) END
    AS batch_size,
  CAST({_map_case('o.tolerance_band', TOLERANCE_IT_INDEX, '5')} AS INTEGER) AS tolerance_index,
  CAST({_map_case('o.material_code', COST_MATERIAL_FAMILY, '0')} AS INTEGER) AS material_code_encoded,
  {_map_case('o.material_code', FEATURE_HISTORICAL_PRICES, '5.0e0')} AS material_price_per_kg,
  999 AS price_staleness_days,
  COALESCE(g.volume, 0.0e0) * {_map_case('o.material_code', FEATURE_HISTORICAL_PRICES, '5.0e0')} / 1e6 AS volume_x_price
FROM m_orders o LEFT JOIN m_geometry g ON g.part_id = o.part_id""",
          ["quantity", "log_quantity", "batch_size", "material_price_per_kg", "volume_x_price"],
          ["m_orders", "m_geometry"])
def m13_cost_features(d: Domain):
    """Cost-model feature builder (offline prices, staleness 999)."""
    o = d.orders.withColumn("process_code", F.lower(F.trim("process_code"))) \
        .join(d.geometry.select("part_id", "volume"), "part_id", "left") \
        .withColumn("surface_finish_spec", F.lit(None).cast("double"))
    f = fx.cost_features(o)
    return f.select("order_id", "process_code_encoded", "quantity", "log_quantity", "batch_size", "tolerance_index",
                    "material_code_encoded", "material_price_per_kg", "price_staleness_days", "volume_x_price")


@register("m8_cost_predictions", f"""
WITH lp AS (SELECT row_id, process_code, component, ln(1 + {r2('y_pred')}) AS lp FROM m_costpred),
ntr AS (SELECT process_code, count(*) AS n FROM m_costpred GROUP BY process_code),
w AS (SELECT row_id, process_code,
  COALESCE({r2("greatest(0.0e0, exp(max(lp) FILTER (WHERE component = 'machine_time_cost')) - 1)")}, 0.0e0) AS machine_time_cost,
  COALESCE({r2("greatest(0.0e0, exp(max(lp) FILTER (WHERE component = 'setup_cost')) - 1)")}, 0.0e0) AS setup_cost,
  CASE WHEN process_code IN ('additive_fdm', 'additive_slm', 'laser_cutting') THEN 0.0e0 ELSE
    COALESCE({r2("greatest(0.0e0, exp(max(lp) FILTER (WHERE component = 'tooling_cost')) - 1)")}, 0.0e0) END AS tooling_cost,
  COALESCE({r2("greatest(0.0e0, exp(max(lp) FILTER (WHERE component = 'raw_material_cost')) - 1)")}, 0.0e0) AS raw_material_cost,
  COALESCE({r2("greatest(0.0e0, exp(max(lp) FILTER (WHERE component = 'finishing_cost')) - 1)")}, 0.0e0) AS finishing_cost
  FROM lp GROUP BY row_id, process_code)
SELECT w.*, {r2('machine_time_cost + setup_cost + tooling_cost + raw_material_cost + finishing_cost')} AS total_cost,
  CASE WHEN ntr.n >= 80 THEN 'high' WHEN ntr.n >= 25 THEN 'medium' ELSE 'low' END AS confidence
FROM w LEFT JOIN ntr USING (process_code)""", [], ["m_costpred"])
def m8_cost_predictions(d: Domain):
    """Cost breakdown from per-component log predictions (no-tooling rule, confidence)."""
    cp = d.cost_predictions
    lp = cp.select("row_id", "process_code", "component", F.log1p(F.round("y_pred", 2)).alias("log_pred"))
    n = cp.groupBy("process_code").agg(F.count(F.lit(1)).alias("n_training"))
    return scoring.predict_costs(lp, n)


@register("m14_recommendations", f"""
SELECT row_id, CAST(rnk AS INTEGER) AS rank, process_code, {_map_case('process_code', rules.API_DISPLAY_NAMES, 'process_code')}
  AS process_name, {r2('p', 4)} AS probability,
  CASE WHEN p >= 0.55e0 THEN 'high' WHEN p >= 0.25e0 THEN 'medium' ELSE 'low' END AS confidence,
  {r2('volume / 1e6 * 2.7e0 * 5.0e0 * 3.5e0')} AS total_cost,
  {r2('volume / 1e6 * 2.7e0 * 5.0e0 * 3.5e0 * 0.15e0 / greatest(1.0e0, CAST(quantity AS DOUBLE))')} AS setup_cost
FROM m_kept WHERE pos <= 3""", [], ["m_kept"])
def m14_recommendations(d: Domain):
    """Feasible top-3 recommendations with cost estimates (one row each)."""
    return scoring.flat_costs(scoring.recommendation_rows(_score_requests(d, best=_best(3 + scoring.EXTRA_CANDIDATES)), 3))


_ROUTED = ", ".join(_q(p) for p in ROUTED_PROCESSES)
cte("m_served", f"""
WITH req AS (SELECT r.row_id, r.rnk, r.p, c.process AS process_code, o.l_quantity AS quantity,
    COALESCE(list_min(g.walls), 2.0e0) AS wmin, COALESCE(list_avg(g.walls), 3.0e0) AS wavg,
    CAST(g.has_undercuts AS INTEGER) AS und, g.bx, g.by_, g.bz, g.volume, mcode AS material_code,
    1 + CAST(split_part(r.row_id, '-', 2) AS BIGINT) % 6 AS top_k, 4 + CAST(split_part(r.row_id, '-', 4) AS BIGINT) % 11 AS it
  FROM m_ranked r JOIN classes c ON c.class_idx = r.class_idx
  JOIN (SELECT {OID} AS row_id, CAST(min(l_quantity) AS INTEGER) AS l_quantity FROM lineitem GROUP BY 1) o ON o.row_id = r.row_id
  JOIN m_ngeo g ON g.part_id = 'PART-' || split_part(r.row_id, '-', 3)
  JOIN mat ON CAST(split_part(r.row_id, '-', 4) AS BIGINT) % 18 = midx
  WHERE r.rnk <= 8)
SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY rnk) AS pos FROM req
WHERE top_k <= 5 AND it <= 12 AND rnk <= top_k + 3
  AND NOT {_excluded_sql('process_code', 'wmin', 'wavg', 'und', 'bx', 'by_', 'bz')}""",
    ["m_ranked", "classes", "m_ngeo", "mat"])
cte("m_modelcost", f"""
SELECT process_code, {", ".join(
    (f"CASE WHEN process_code IN ('additive_fdm', 'additive_slm', 'laser_cutting') THEN 0.0e0 ELSE " if c == 'tooling_cost' else "(")
    + "COALESCE(" + r2(f"greatest(0.0e0, exp(avg(ln(1 + y_true)) FILTER (WHERE component = '{c}')) - 1)") + ", 0.0e0)"
    + (" END" if c == 'tooling_cost' else ")") + f" AS {c}"
    for c in ('machine_time_cost', 'setup_cost', 'tooling_cost', 'raw_material_cost', 'finishing_cost'))}
FROM m_costpred GROUP BY process_code""", ["m_costpred"])


def _json_requests(d: Domain):
    """Each scored order line as a service request in JSON text."""
    g = d.nested_geometry
    nested = g.select("part_id", F.struct(*[c for c in g.columns if c != "part_id"]).alias("geometry"))
    r = d.score_requests.join(nested, "part_id").select(
        "row_id", "part_id", "geometry",
        F.struct("material_code", "quantity", "tolerance_band").alias("requirements"), "top_k")
    return r.select("row_id", F.to_json(F.struct("part_id", "geometry", "requirements", "top_k")).alias("json"))


def _mean_model_costs(d: Domain):
    """Cost models of one constant per process and component: the mean log cost (fits are in queries_ml)."""
    cp = d.cost_predictions
    mean = cp.groupBy("process_code", "component").agg(F.avg(F.log1p("y_true")).alias("log_pred"))
    n = cp.groupBy("process_code").agg(F.count(F.lit(1)).alias("n_training"))
    return scoring.predict_costs(mean.select(F.col("process_code").alias("row_id"), "process_code", "component", "log_pred"), n)


def _served(d: Domain, flat: bool = False):
    return scoring.serve(_json_requests(d), d.scores, _mean_model_costs(d), FETCHER_FALLBACK_PRICES, flat)


@register("m14_served_recommendations", f"""
SELECT s.row_id, CAST(s.rnk AS INTEGER) AS rank, s.process_code, {r2('s.p', 4)} AS probability,
  COALESCE(CASE WHEN s.process_code IN ({_ROUTED}) THEN {r2('m.machine_time_cost + m.setup_cost + m.tooling_cost + m.raw_material_cost + m.finishing_cost')} END,
    {r2('s.volume / 1e6 * 2.7e0 * COALESCE(fb.p, 5.0e0) * 3.5e0')}) AS total_cost
FROM m_served s LEFT JOIN m_modelcost m USING (process_code)
LEFT JOIN (SELECT * FROM {values(list(FETCHER_FALLBACK_PRICES.items()), ['fmat', 'p'])}) fb ON fb.fmat = s.material_code
WHERE s.pos <= s.top_k""", [], ["m_served", "m_modelcost"])
def m14_served_recommendations(d: Domain):
    """JSON requests validated, constrained, ranked and costed by the routed model, the rough
    estimate at the material's price elsewhere; ``top_k`` of each request (one row per recommendation)."""
    rows, _ = _served(d, flat=True)
    return scoring.flat_costs(rows).select("row_id", "rank", "process_code", "probability", "total_cost")


@register("v10_request_quarantine", f"""
SELECT row_id, CAST(CAST(top_k > 5 AS INTEGER) + CAST(it > 12 AS INTEGER) AS INTEGER) AS n_errors
FROM (SELECT DISTINCT {OID} AS row_id, 1 + l_linenumber % 6 AS top_k, 4 + l_suppkey % 11 AS it FROM lineitem
      JOIN part ON p_partkey = l_partkey) r
WHERE top_k > 5 OR it > 12""")
def v10_request_quarantine(d: Domain):
    """Requests that break a rule, or have no feasible process, with their errors (kept, not raised)."""
    _, quarantine = _served(d)
    return quarantine.where(~F.array_contains("errors", "no feasible process")).select("row_id", F.size("errors").alias("n_errors"))


@register("a7_response_json", """
SELECT row_id, CAST(count(*) FILTER (WHERE pos <= top_k) AS INTEGER) AS n_recommendations,
  CAST(any_value(top_k) + 3 - count(*) FILTER (WHERE pos <= top_k) AS INTEGER) AS constraint_filtered_count,
  arg_min(process_code, rnk) AS first_process
FROM m_served GROUP BY row_id""", [], ["m_served"])
def a7_response_json(d: Domain):
    """Responses written as JSON text and read back; requests with at least one recommendation."""
    responses, _ = _served(d)
    text = responses.where(F.col("n_recommendations") > 0).select("row_id", F.to_json(F.struct(
        "part_id", "recommendations", F.lit("classifier_v2_cost_v2").alias("model_version"), "constraint_filtered_count")).alias("json"))
    back = text.select("row_id", F.from_json("json", "part_id string, recommendations array<struct<rank int, process_code string>>, "
                                             "constraint_filtered_count int").alias("r"))
    return back.select("row_id", F.size("r.recommendations").alias("n_recommendations"), "r.constraint_filtered_count",
                       F.col("r.recommendations")[0]["process_code"].alias("first_process"))


_P18_SQL = f"""
SELECT part_id, array_to_string(list_sort(list(process)), ',') AS feasible, CAST(count(*) AS INTEGER) AS n_feasible
FROM m_geometry_all, (SELECT * FROM (VALUES {", ".join(
    "(" + ", ".join([_q(p)] + ["NULL" if v is None else f"{float(v)!r}e0" for v in b]) + ")" for p, *b in PROCESS_CATALOG_BOUNDS)})
  AS t(process, wlo, whi, hlo, hhi, qlo)) c
WHERE (wall_thickness_min IS NULL OR (COALESCE(wall_thickness_min >= wlo, true) AND COALESCE(wall_thickness_min <= whi, true)))
  AND (hole_diameter_min IS NULL OR (COALESCE(hole_diameter_min >= hlo, true) AND COALESCE(hole_diameter_min <= hhi, true)))
GROUP BY part_id"""


@register("p18_catalog_feasible", _P18_SQL, [], ["m_geometry_all"])
def p18_catalog_feasible(d: Domain):
    """Processes of the catalog whose wall and hole bounds admit each part."""
    from forgeline.functions.catalog import catalog_feasible
    f = catalog_feasible(d.all_geometry)
    return f.select("part_id", F.array_join(F.array_sort("catalog_feasible"), ",").alias("feasible"),
                    F.size("catalog_feasible").alias("n_feasible"))


@register("s15_catalog_file_feasible", _P18_SQL, [], ["m_geometry_all"])
def s15_catalog_file_feasible(d: Domain):
    """The process catalog written as its ragged text file, parsed, and its bounds applied to every part."""
    from forgeline.functions.catalog import CATALOG_FIELDS, catalog_feasible
    from forgeline.sources.readers import read_process_catalog

    def text(v, at_least=False):
        return "any" if v is None else f"{'>=' if at_least else ''}{v:g}"
    path = shared_path(d.spark, "process-catalog", uuid.uuid4().hex)
    lines = [",".join(CATALOG_FIELDS)] + [
        ",".join([p, p.replace("_", " "), "any", text(wlo), text(whi), text(hlo), text(hhi), text(q, True), *(["any"] if i % 3 == 0 else []), '"Bounds, in mm"'])
        for i, (p, wlo, whi, hlo, hhi, q) in enumerate(PROCESS_CATALOG_BOUNDS)]
    d.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    catalog = read_process_catalog(d.spark, path)
    # a reference table of a few dozen rows becomes literals
    bounds = [tuple(r) for r in catalog.select("process_code", "wall_min_mm", "wall_max_mm", "hole_dia_min_mm", "hole_dia_max_mm", "min_quantity").collect()]
    f = catalog_feasible(d.all_geometry, bounds)
    return f.select("part_id", F.array_join(F.array_sort("catalog_feasible"), ",").alias("feasible"),
                    F.size("catalog_feasible").alias("n_feasible"))


@register("a4_feature_vectors", "SELECT part_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS v{i}" for i, c in enumerate(FEATURE_COLUMNS))
          + ", array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} IS NULL THEN {i} END" for i, c in enumerate(FEATURE_COLUMNS))
          + "], lambda x: x IS NOT NULL), ',') AS missing FROM m_geometry_all", [f"v{i}" for i in range(len(FEATURE_COLUMNS))], ["m_geometry_all"])
def a4_feature_vectors(d: Domain):
    """A4: ordered classifier vectors, NaN for a missing feature: the entries, and the places that hold NaN."""
    v = fx.ordered_vector(d.all_geometry, FEATURE_COLUMNS)
    at = F.filter(F.sequence(F.lit(0), F.lit(len(FEATURE_COLUMNS) - 1)), lambda i: F.isnan(F.get("features", i)))
    return v.select("part_id", *[F.nanvl(F.get("features", F.lit(i)), F.lit(None).cast("double")).alias(f"v{i}") for i in range(len(FEATURE_COLUMNS))],
                    F.array_join(at.cast("array<string>"), ",").alias("missing"))


_A5_SQL = {"quantity": "CAST(o.quantity AS DOUBLE)", "log_quantity": "CASE WHEN o.quantity >= 0 THEN ln(o.quantity + 1.0e0) ELSE 0.0e0 END",
           "batch_size": "CASE WHEN o.batch_size IS NULL OR o.batch_size = 0 THEN CAST(o.quantity AS DOUBLE) ELSE CAST(o.batch_size AS DOUBLE) END",
           "material_code_encoded": _map_case("o.material_code", COST_MATERIAL_FAMILY, "0"),
           "material_price_per_kg": _map_case("o.material_code", FEATURE_HISTORICAL_PRICES, "5.0e0"), "surface_finish_ra": "NULL",
           "tolerance_index": _map_case("o.tolerance_band", TOLERANCE_IT_INDEX, "5"),
           "volume_x_price": f"COALESCE(g.volume, 0.0e0) * {_map_case('o.material_code', FEATURE_HISTORICAL_PRICES, '5.0e0')} / 1e6"}


@register("a5_cost_vectors", "SELECT o.order_id, " + ", ".join(
    f"COALESCE(CAST({_A5_SQL.get(c, 'g.' + c)} AS DOUBLE), 0.0e0) AS v{i}" for i, c in enumerate(COST_FEATURE_COLUMNS))
    + " FROM m_orders o LEFT JOIN m_geometry g ON g.part_id = o.part_id", [f"v{i}" for i in range(len(COST_FEATURE_COLUMNS))], ["m_orders", "m_geometry"])
def a5_cost_vectors(d: Domain):
    """A5: ordered cost-model vectors of every order, 0.0 for a missing feature (parts without geometry, no finish)."""
    o = d.orders.drop("surface_finish_ra").join(d.geometry.select("part_id", *FEATURE_COLUMNS), "part_id", "left") \
        .withColumn("surface_finish_spec", F.lit(None).cast("double"))
    v = fx.ordered_vector(fx.cost_features(o), COST_FEATURE_COLUMNS, 0.0)
    return v.select("order_id", *[F.get("features", F.lit(i)).alias(f"v{i}") for i in range(len(COST_FEATURE_COLUMNS))])


@register("u3_column_differences", " UNION ALL ".join(
    [f"SELECT '{c}' AS column_name, true AS expected, {'false' if c == 'symmetry_score' else 'true'} AS present, "
     f"{'CAST(NULL AS BIGINT) AS n_values' if c == 'symmetry_score' else f'CAST(count({c}) AS BIGINT) AS n_values FROM m_geometry_all'}" for c in GEOMETRY_COLUMNS]
    + ["SELECT 'scanner', false, true, CAST(count(*) AS BIGINT) FROM m_geometry_all"]), [], ["m_geometry_all"])
def u3_column_differences(d: Domain):
    """Expected against actual columns of a geometry delivery that lacks one column and has another too many."""
    from forgeline.sources.readers import column_differences
    delivered = d.all_geometry.drop("symmetry_score").withColumn("scanner", F.lit("a"))
    return column_differences(delivered, GEOMETRY_COLUMNS)


@register("j11_commodity_prices", f"""
SELECT CASE material_code {" ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in MATERIAL_COMMODITY.items())} END AS commodity_family,
  CAST(count(*) AS BIGINT) AS n_prices, avg(price_usd_per_kg) AS avg_price
FROM m_prices GROUP BY 1""", ["avg_price"], ["m_prices"])
def j11_commodity_prices(d: Domain):
    """Archived prices by commodity family of their material (NULL: not in the index)."""
    from forgeline.operators.joins import with_commodity
    return with_commodity(d.prices).groupBy("commodity_family").agg(
        F.count(F.lit(1)).alias("n_prices"), F.avg("price_usd_per_kg").alias("avg_price"))


@register("m14_recommend_counts", """
SELECT r.row_id, CAST(least(COALESCE(k.kept, 0), 3) AS INTEGER) AS n_recommendations,
  CAST(6 - least(COALESCE(k.kept, 0), 3) AS INTEGER) AS constraint_filtered_count,
  CAST(6 - COALESCE(k.kept, 0) AS INTEGER) AS excluded_by_constraints
FROM (SELECT DISTINCT row_id FROM m_req) r LEFT JOIN (SELECT row_id, count(*) AS kept FROM m_kept GROUP BY row_id) k
  ON k.row_id = r.row_id""", [], ["m_req", "m_kept"])
def m14_recommend_counts(d: Domain):
    """Per request, recommendations kept, the reference's filtered count and the true one."""
    r = scoring.recommend(_score_requests(d, best=_best(3 + scoring.EXTRA_CANDIDATES)), 3)
    return r.select("row_id", "n_recommendations",
                    F.col("constraint_filtered_count").cast("int").alias("constraint_filtered_count"),
                    F.col("excluded_by_constraints").cast("int").alias("excluded_by_constraints"))


def _explain_sql() -> str:
    parts = []
    for i, f in enumerate(FEATURE_COLUMNS):
        v = f"COALESCE(CAST(x.{f} AS DOUBLE), 0.0e0)"
        cases = []
        for proc, feat, cond, yes, no in rules.EXPLANATION_RULES:
            if feat != f:
                continue
            if cond.startswith("between"):
                lo, hi = cond.replace("between", "").split("and")
                c = f"{v} BETWEEN {float(lo)!r}e0 AND {float(hi)!r}e0"
            else:
                op, num = cond.split()
                c = f"{v} {'=' if op == '==' else op} {float(num)!r}e0"
            cases.append(f"WHEN x.predicted_process = {_q(proc)} THEN CASE WHEN {c} THEN {yes!r}e0 ELSE {no!r}e0 END")
        other = ("0.15e0" if f == "volume" else "0.01e0")
        expr = (f"CASE {' '.join(cases)} WHEN x.predicted_process IN ('cnc_milling', 'injection_molding', "
                f"'sheet_metal_bending') THEN 0.01e0 ELSE {other} END")
        parts.append(f"SELECT x.row_id, x.predicted_process, {i} AS pos, {_q(f)} AS feature_name, round({expr}, 4) AS c "
                     f"FROM x")
    return " UNION ALL ".join(parts)


@register("m15_explanations", f"""
WITH x AS (SELECT r.row_id, r.process_code AS predicted_process, g.* EXCLUDE (part_id) FROM m_req r
           JOIN (SELECT part_id, bounding_box_x, bounding_box_y, bounding_box_z, volume, surface_area,
                   COALESCE(wall_thickness_min, 2.0e0) AS wall_thickness_min,
                   COALESCE(wall_thickness_avg, 3.0e0) AS wall_thickness_avg, aspect_ratio,
                   COALESCE(CAST(hole_count AS DOUBLE), 0.0e0) AS hole_count,
                   COALESCE(hole_diameter_min, 0.0e0) AS hole_diameter_min,
                   COALESCE(CAST(undercut_flag AS DOUBLE), 0.0e0) AS undercut_flag,
                   CAST(COALESCE(wall_thickness_min, 2.0e0) < 1.5e0 AS DOUBLE) AS thin_wall_flag,
                   COALESCE(curvature_complexity, 0.0e0) AS curvature_complexity,
                   COALESCE(symmetry_score, 0.5e0) AS symmetry_score FROM m_geometry) g
             ON g.part_id = r.part_id WHERE r.rnk = 1),
c AS ({_explain_sql()}),
t AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY abs(c) DESC, pos) AS k FROM c)
SELECT row_id, any_value(predicted_process) AS predicted_process,
  max(CASE WHEN k = 1 AND abs(c) > 0.01e0 THEN feature_name END) AS reason_1,
  max(CASE WHEN k = 2 AND abs(c) > 0.01e0 THEN feature_name END) AS reason_2,
  CAST(count(*) FILTER (WHERE k <= 2 AND abs(c) > 0.01e0) AS INTEGER) AS n_reasons
FROM t GROUP BY row_id""", [], ["m_req", "m_geometry"])
def m15_explanations(d: Domain):
    """Heuristic explanation of the top-1 process: top-2 reasons by |contribution|."""
    top = best_class(F.col("proba"))
    req = _score_requests(d, predicted_process=F.element_at(scoring.class_array(), top["idx"] + 1))
    e = rules.explain(req)
    return e.select("row_id", "predicted_process",
                    F.try_element_at("top_reasons", F.lit(1))["feature_name"].alias("reason_1"),
                    F.try_element_at("top_reasons", F.lit(2))["feature_name"].alias("reason_2"),
                    F.size("top_reasons").alias("n_reasons"))


@register("m18_cost_metrics_non_estimated", """
SELECT avg(CASE WHEN y_true >= 1.0e0 THEN abs((y_true - y_pred) / y_true) END) * 100 AS mape,
  avg(abs(y_true - y_pred)) AS mae, CAST(count(*) AS BIGINT) AS n_rows
FROM m_costpred c LEFT JOIN m_invoices_all i ON i.order_id = c.row_id
WHERE i.label_source <> 'estimated' OR i.label_source IS NULL""", ["mape", "mae"], ["m_costpred", "m_invoices_all"])
def m18_cost_metrics_non_estimated(d: Domain):
    """Cost-model error metrics over rows whose label is not estimated (NULL source kept)."""
    from forgeline.plans import evaluate as ev
    from forgeline.sources.readers import training_rows_without_estimated
    lbl = d.all_invoices.select(F.col("order_id").alias("row_id"), F.col("label_source").alias("cost_label_source"))
    rows = training_rows_without_estimated(d.cost_predictions.join(lbl, "row_id", "left"))
    m = ev.cost_metrics(rows, [])
    return m.select("mape", "mae", rows.agg(F.count(F.lit(1))).scalar().alias("n_rows"))


@register("p24_review_queue", """
WITH sup AS (SELECT true_idx AS cls, count(*) AS support FROM m_pred GROUP BY true_idx),
v9 AS (""" + _v9_sql() + """)
SELECT p.row_id,
  (p.top1_p < 0.25e0) OR (v.part_id IS NULL OR v.feature_error IS NOT NULL) OR COALESCE(s.support, 0) < 30 AS review
FROM m_pred p LEFT JOIN v9 v ON v.part_id = 'PART-' || split_part(p.row_id, '-', 3)
LEFT JOIN sup s ON s.cls = p.pred_idx""", [], ["m_pred", "a1"])
def p24_review_queue(d: Domain):
    """Route predictions to manual review: low tier, malformed or missing geometry, or a
    predicted class with fewer than 30 true examples."""
    from forgeline.plans import evaluate as ev
    r = ev.with_ranks(d.scores).withColumn("part_id", F.concat(F.lit("PART-"), F.split("row_id", "-").getItem(2)))
    v9 = validate.feature_vector_errors(fx.training_features(d.nested_geometry)) \
        .select("part_id", "feature_error", F.lit(True).alias("__has_geo"))
    sup = d.scores.groupBy(F.col("true_idx").alias("pred_idx")).agg(F.count(F.lit(1)).alias("support"))
    j = r.join(v9, "part_id", "left").join(materialize(sup, "class-support"), "pred_idx", "left")
    bad_geo = F.col("__has_geo").isNull() | F.col("feature_error").isNotNull()
    return j.select("row_id", rules.review_queue_flag(rules.probability_tier(F.col("top1_p")), bad_geo,
                                                      F.col("support")).alias("review"))


@register("p20_ranking_overrides", """
WITH r AS (SELECT row_id, list(process_code ORDER BY rnk) AS ranked, any_value(volume) AS volume
           FROM m_req WHERE rnk <= 6 GROUP BY row_id),
g AS (SELECT r.row_id, r.ranked, m.wall_thickness_min AS wmin, m.curvature_complexity AS curv, m.volume
      FROM r JOIN m_geometry m ON m.part_id = 'PART-' || split_part(r.row_id, '-', 3)),
ic AS (SELECT row_id, wmin, CASE WHEN curv > 0.7e0 AND wmin < 2 AND volume > 1000
                 AND NOT list_contains(list_slice(ranked, 1, 3), 'investment_casting')
               THEN list_concat(list_slice(ranked, 1, 2), ['investment_casting'],
                                list_filter(list_slice(ranked, 3, 100), lambda x: x <> 'investment_casting'))
               ELSE ranked END AS ranked FROM g)
SELECT row_id, array_to_string(CASE WHEN wmin < 0.8e0
    THEN list_concat(['additive_slm'], list_filter(ranked, lambda x: x <> 'additive_slm')) ELSE ranked END, ',')
  AS ranked_codes FROM ic""", [], ["m_req", "m_geometry"])
def p20_ranking_overrides(d: Domain):
    """P20 (documented, enabled here): investment casting forced into the top 3 for organic thin parts,
    additive_slm first for walls < 0.8, applied to the model's top-6 ranking."""
    req = _score_requests(d, best=_best(6)).drop("wall_thickness_min", "curvature_complexity", "volume") \
        .join(d.geometry.select("part_id", "wall_thickness_min", "curvature_complexity", "volume"), "part_id")
    ranked = F.transform(scoring.codes_of(F.col("best")), lambda s: s["process_code"])
    out = req.select("row_id", "wall_thickness_min", "curvature_complexity", "volume", ranked.alias("ranked"))
    return out.select("row_id", F.array_join(rules.ranking_overrides(F.col("ranked"), enabled=True), ",")
                      .alias("ranked_codes"))


@register("p23_suppress_low_confidence_cost", f"""
SELECT row_id, CAST(rnk AS INTEGER) AS rank, process_code,
  CASE WHEN p >= 0.25e0 THEN {r2('volume / 1e6 * 2.7e0 * 5.0e0 * 3.5e0')} END AS total_cost
FROM m_kept WHERE pos <= 3""", [], ["m_kept"])
def p23_suppress_low_confidence_cost(d: Domain):
    """P23 (documented, enabled here): recommendations keep no cost estimate when their tier is low."""
    e = scoring.recommendation_rows(_score_requests(d, best=_best(3 + scoring.EXTRA_CANDIDATES)), 3)
    cost = rules.suppress_low_confidence_cost(F.col("cost_estimate"), F.col("confidence"), enabled=True)
    return e.select("row_id", "rank", "process_code", cost["total_cost"].alias("total_cost"))
