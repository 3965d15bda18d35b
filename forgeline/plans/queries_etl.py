"""Registered ETL queries: sources, joins, normalisation, labels, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from forgeline.operators import joins, labels, normalize as nz, validate
from forgeline.plans import etl
from forgeline.plans.registry import register
from forgeline.sources import readers
from forgeline.sources.tables import Domain

ETL_DOUBLES = ["surface_finish_ra", "cost_total", "cost_machine_time", "cost_setup", "cost_tooling",
               "cost_raw_material", "cost_finishing", "bounding_box_x", "bounding_box_y", "bounding_box_z",
               "volume", "surface_area", "wall_thickness_min", "wall_thickness_avg", "aspect_ratio",
               "hole_diameter_min", "curvature_complexity", "symmetry_score", "effective_hourly_rate",
               "material_price_per_kg", "log_quantity", "volume_x_price", "tolerance_index"]
TC = ", ".join(etl.TRAINING_COLUMNS)


@register("etl_clean_training_rows", f"SELECT {TC} FROM ann WHERE reject_bucket IS NULL",
          ETL_DOUBLES, ["ann"])
def etl_clean_training_rows(d: Domain):
    """Flagship (S1,J1,J3,J2,P1-P12,G1,G2,L1,V2-V8,W1): validated, priced, labelled rows."""
    return etl.clean_training_rows(d)


@register("v6_rejected_rows", "SELECT order_id, part_id, process_code, reject_bucket, reject_column "
          "FROM ann WHERE reject_bucket IS NOT NULL", [], ["ann"])
def v6_rejected_rows(d: Domain):
    """Every rejected row with its last-failing-rule bucket and column."""
    a = etl.annotated_training_rows(d)
    return a.where(F.col("reject_bucket").isNotNull()).select(
        "order_id", "part_id", "process_code", "reject_bucket", "reject_column")


@register("g6_drop_summary", """
SELECT reject_bucket, CAST(count(*) AS BIGINT) AS rows,
  CAST((SELECT count(*) FROM ann) AS BIGINT) AS total_rows,
  CAST((SELECT count(*) FROM ann WHERE reject_bucket IS NULL) AS BIGINT) AS kept_rows,
  round((SELECT count(*) FROM ann WHERE reject_bucket IS NULL) * 100.0e0
        / greatest((SELECT count(*) FROM ann), 1), 1) AS pass_rate_pct
FROM ann WHERE reject_bucket IS NOT NULL GROUP BY reject_bucket""", ["pass_rate_pct"], ["ann"])
def g6_drop_summary(d: Domain):
    """Rows per drop-reason bucket and the pass rate."""
    return validate.drop_summary(etl.annotated_training_rows(d))


@register("s1_completed_extract", "SELECT * FROM ex", ["cost_total", "cost_machine_time", "cost_setup",
          "cost_tooling", "cost_raw_material", "cost_finishing"], ["ex"])
def s1_completed_extract(d: Domain):
    """Completed orders LEFT JOIN invoices (sorted by completion date)."""
    return readers.extract_completed(d.orders, d.invoices, sort=True)


@register("s1_extract_window", """
SELECT * FROM ex WHERE completion_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-31'
  AND facility_id IN ('FACILITY_01', 'FACILITY_03')""",
          ["cost_total", "cost_machine_time", "cost_setup", "cost_tooling", "cost_raw_material",
           "cost_finishing"], ["ex"])
def s1_extract_window(d: Domain):
    """Inclusive completion-date bounds and a facility list (pushed to the scan)."""
    return readers.extract_completed(d.orders, d.invoices, "2024-01-10", "2024-01-31",
                                     ["FACILITY_01", "FACILITY_03"])


@register("s2_offline_extract", """
SELECT * FROM m_orders WHERE completion_date >= DATE '2024-01-05' AND completion_date <= DATE '2024-02-10'
  AND facility_id IN ('FACILITY_02')""", ["cost_total"], ["m_orders"])
def s2_offline_extract(d: Domain):
    """Offline extract: same filters, no status filter, defaults for absent columns."""
    out = readers.extract_offline(d.orders, "2024-01-05", "2024-02-10", ["FACILITY_02"])
    return out.select(*d.orders.columns)


@register("s3_geometry_for_orders", """
SELECT * FROM m_geometry WHERE part_id IN (SELECT part_id FROM m_orders WHERE status = 'completed')""",
          ["bounding_box_x", "bounding_box_y", "bounding_box_z", "volume", "surface_area",
           "wall_thickness_min", "wall_thickness_avg", "aspect_ratio", "hole_diameter_min",
           "curvature_complexity", "symmetry_score"], ["m_geometry", "m_orders"])
def s3_geometry_for_orders(d: Domain):
    """S3: geometry rows of the completed orders' part set (semi join)."""
    return readers.geometry_for_parts(d.geometry, d.orders.where(F.col("status") == "completed"))


@register("j1_orders_geometry", "SELECT order_id, part_id, volume, bounding_box_x FROM j1",
          ["volume", "bounding_box_x"], ["j1"])
def j1_orders_geometry(d: Domain):
    """Orders joined to geometry, rows without a bounding box dropped."""
    ex = readers.extract_completed(d.orders, d.invoices)
    return joins.join_geometry(ex, d.geometry).select("order_id", "part_id", "volume", "bounding_box_x")


@register("j1_missing_geometry", """
SELECT part_id, CAST(count(*) AS BIGINT) AS dropped_rows FROM m_orders o
WHERE NOT EXISTS (SELECT 1 FROM m_geometry_partial g WHERE g.part_id = o.part_id AND g.bounding_box_x IS NOT NULL)
GROUP BY part_id""", [], ["m_orders", "m_geometry_partial"])
def j1_missing_geometry(d: Domain):
    """J1 report: order rows lost per part (no geometry or null bounding box)."""
    return joins.missing_geometry(d.orders, d.partial_geometry)


@register("w8_first_missing_parts", """
SELECT DISTINCT part_id FROM m_orders o
WHERE NOT EXISTS (SELECT 1 FROM m_geometry_partial g WHERE g.part_id = o.part_id AND g.bounding_box_x IS NOT NULL)
ORDER BY part_id LIMIT 10""", [], ["m_orders", "m_geometry_partial"])
def w8_first_missing_parts(d: Domain):
    """The first 10 missing part ids (the log sample; a top-n report)."""
    return joins.first_missing_parts(d.orders, d.partial_geometry, 10)


@register("j2_price_at_order_date", "SELECT order_id, material_code, order_date, material_price_per_kg FROM "
          "(SELECT * FROM j2)", ["material_price_per_kg"], ["j2"])
def j2_price_at_order_date(d: Domain):
    """Archived price at the order date (exact, else latest within +-7 days, else fallback)."""
    ex = readers.extract_completed(d.orders, d.invoices)
    j = joins.join_geometry(ex, d.geometry)
    j = joins.price_at_date(j, d.prices)
    return j.select("order_id", "material_code", "order_date", "material_price_per_kg")


@register("j2_price_all_orders", """
SELECT o.order_id, COALESCE(
  (SELECT p.price FROM pday p WHERE p.material_code = o.material_code AND p.date = o.order_date),
  (SELECT p.price FROM pday p WHERE p.material_code = o.material_code
     AND abs(datediff('day', o.order_date, p.date)) <= 7 ORDER BY p.date DESC LIMIT 1),
  fb.fb_price) AS material_price_per_kg
FROM m_orders o LEFT JOIN fb_pipeline fb ON fb.fb_mat = o.material_code""",
          ["material_price_per_kg"], ["m_orders", "pday", "fb_pipeline"])
def j2_price_all_orders(d: Domain):
    """J2 over every order line (no geometry filter)."""
    return joins.price_at_date(d.orders, d.prices).select("order_id", "material_price_per_kg")


@register("j3_rate_as_of", "SELECT order_id, process_code, facility_id, order_date, effective_hourly_rate FROM j3",
          ["effective_hourly_rate"], ["j3"])
def j3_rate_as_of(d: Domain):
    """Machine rate as of the order date (raw process code, same facility)."""
    ex = readers.extract_completed(d.orders, d.invoices)
    j = joins.rate_as_of(joins.join_geometry(ex, d.geometry), d.equipment, date_bounds=d.orders.select("order_date"))
    return j.select("order_id", "process_code", "facility_id", "order_date", "effective_hourly_rate")


@register("j3_rate_clean_codes", """
SELECT o.order_id, e.rate AS effective_hourly_rate
FROM (SELECT order_id, lower(trim(process_code)) AS process_code, facility_id, order_date FROM m_orders) o
ASOF LEFT JOIN eq_week e ON o.process_code = e.process_code AND o.facility_id = e.facility_id
  AND o.order_date >= e.week_start""", ["effective_hourly_rate"], ["m_orders", "eq_week"])
def j3_rate_clean_codes(d: Domain):
    """J3 with codes cleaned first (the T5 ``clean_first`` option), all order lines."""
    o = d.orders.select("order_id", nz.clean_process(F.col("process_code")).alias("process_code"),
                        "facility_id", "order_date")
    return joins.rate_as_of(o, d.equipment).select("order_id", "effective_hourly_rate")


@register("w7_rate_intervals", """
SELECT process_code, facility_id, week_start AS valid_from,
  lead(week_start) OVER (PARTITION BY process_code, facility_id ORDER BY week_start) AS valid_to, rate
FROM eq_week""", ["rate"], ["eq_week"])
def w7_rate_intervals(d: Domain):
    """Validity intervals of the weekly machine rates (latest row per week)."""
    return joins.rate_intervals(d.equipment)


@register("j4_geometry_coverage", """
WITH req AS (SELECT DISTINCT part_id FROM m_orders)
SELECT CAST(count(*) AS BIGINT) AS requested,
  CAST(count(g.part_id) AS BIGINT) AS covered,
  CAST(count(*) - count(g.part_id) AS BIGINT) AS missing,
  round(count(g.part_id) * 100.0e0 / greatest(count(*), 1), 1) AS coverage_pct
FROM req LEFT JOIN (SELECT DISTINCT part_id FROM m_geometry_partial) g ON req.part_id = g.part_id""",
          ["coverage_pct"], ["m_orders", "m_geometry_partial"])
def j4_geometry_coverage(d: Domain):
    """Requested / covered / missing part ids and coverage percent."""
    return joins.geometry_coverage(d.orders, d.partial_geometry)


@register("u2_part_set_ops", """
SELECT part_id, 'covered' AS status FROM (SELECT part_id FROM m_orders INTERSECT SELECT part_id FROM m_geometry_partial)
UNION ALL
SELECT part_id, 'missing' AS status FROM (SELECT DISTINCT part_id FROM m_orders EXCEPT SELECT part_id FROM m_geometry_partial)""",
          [], ["m_orders", "m_geometry_partial"])
def u2_part_set_ops(d: Domain):
    """Requested ∩ loaded and requested − loaded part ids."""
    return joins.part_set_ops(d.orders, d.partial_geometry)


@register("s7_price_upsert", """
WITH batch AS (SELECT DISTINCT date, material_code FROM m_prices WHERE date = DATE '2024-01-15')
SELECT date, material_code, price_usd_per_kg, source FROM m_prices p
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.date = p.date AND b.material_code = p.material_code)
UNION ALL
SELECT date, material_code, price_usd_per_kg * 1.1e0, 'fallback' FROM m_prices WHERE date = DATE '2024-01-15'""",
          ["price_usd_per_kg"], ["m_prices"])
def s7_price_upsert(d: Domain):
    """Replace one day's archived rows with a new batch (anti join + union)."""
    p = d.prices.select("date", "material_code", "price_usd_per_kg", "source")
    batch = p.where(F.col("date") == F.lit("2024-01-15").cast("date")).select(
        "date", "material_code", (F.col("price_usd_per_kg") * 1.1).alias("price_usd_per_kg"))
    return joins.upsert_prices(p, batch, source="fallback").select(
        "date", "material_code", "price_usd_per_kg", "source")


@register("p25_tracked_prices", "SELECT date, material_code, price_usd_per_kg FROM m_prices "
          "WHERE material_code IN ('AL6061','AL7075','AL2024','SS304','SS316L','SS17-4','MS_A36','MS_1018',"
          "'TI6AL4V','PEEK','POM','PA66','ABS','PLA','PETG','INCONEL625')", ["price_usd_per_kg"], ["m_prices"])
def p25_tracked_prices(d: Domain):
    """P25: prices restricted to the tracked materials."""
    return readers.tracked_prices(d.prices).select("date", "material_code", "price_usd_per_kg")


@register("p_normalized_orders", """
SELECT order_id, lower(trim(process_code)) AS process_code, upper(trim(material_code)) AS material_code,
  upper(trim(tolerance_band)) AS tolerance_band,
  CAST(COALESCE(CASE upper(trim(tolerance_band)) WHEN 'IT4' THEN 1 WHEN 'IT5' THEN 2 WHEN 'IT6' THEN 3
    WHEN 'IT7' THEN 4 WHEN 'IT8' THEN 5 WHEN 'IT9' THEN 6 WHEN 'IT10' THEN 7 WHEN 'IT11' THEN 8
    WHEN 'IT12' THEN 9 END, 5) AS DOUBLE) AS tolerance_index,
  COALESCE(CASE lower(trim(surface_finish_ra)) WHEN 'as_machined' THEN 3.2e0 WHEN 'fine' THEN 1.6e0
    WHEN 'very_fine' THEN 0.8e0 WHEN 'mirror' THEN 0.1e0 END, TRY_CAST(trim(surface_finish_ra) AS DOUBLE), 3.2e0)
    AS surface_finish_ra,
  COALESCE(batch_size, quantity) AS batch_size,
  ln(1 + CAST(quantity AS DOUBLE)) AS log_quantity,
  CASE WHEN quantity >= 0 THEN ln(quantity + 1.0e0) ELSE 0.0e0 END AS safe_log_quantity
FROM m_orders""", ["tolerance_index", "surface_finish_ra", "log_quantity", "safe_log_quantity"], ["m_orders"])
def p_normalized_orders(d: Domain):
    """P1,P2,P3,P8,P9: code cleaning, IT index, surface finish, log quantity, batch default."""
    o = d.orders
    return o.select(
        "order_id",
        nz.clean_process(F.col("process_code")).alias("process_code"),
        nz.clean_upper(F.col("material_code")).alias("material_code"),
        nz.clean_upper(F.col("tolerance_band")).alias("tolerance_band"),
        nz.tolerance_index(nz.clean_upper(F.col("tolerance_band"))).alias("tolerance_index"),
        nz.surface_finish_ra(F.col("surface_finish_ra")).alias("surface_finish_ra"),
        F.coalesce("batch_size", "quantity").alias("batch_size"),
        F.log1p(F.col("quantity").cast("double")).alias("log_quantity"),
        nz.safe_log1p(F.col("quantity").cast("double")).alias("safe_log_quantity"),
    )


@register("g1_process_wall_medians", """
SELECT lower(trim(o.process_code)) AS process_code, median(g.wall_thickness_min) AS wall_thickness_min,
  median(g.wall_thickness_avg) AS wall_thickness_avg
FROM m_orders o JOIN m_geometry g ON o.part_id = g.part_id
GROUP BY lower(trim(o.process_code))""", ["wall_thickness_min", "wall_thickness_avg"], ["m_orders", "m_geometry"])
def g1_process_wall_medians(d: Domain):
    """G1: exact per-process medians of wall min/avg (skew-safe bucketed quantiles)."""
    from forgeline.operators.quantiles import exact_medians
    j = d.orders.select(nz.clean_process(F.col("process_code")).alias("process_code"), "part_id") \
        .join(d.geometry, "part_id")
    med = exact_medians(j, ["process_code"], ["wall_thickness_min", "wall_thickness_avg"])
    groups = j.select("process_code").distinct()
    from forgeline.operators.common import join_null_safe
    return join_null_safe(groups, med, ["process_code"], "left")


@register("l1_cost_labels", """
SELECT order_id, process_code, cost_total, cost_machine_time, cost_setup, cost_tooling, cost_raw_material,
  cost_finishing, cost_label_source FROM lbl""",
          ["cost_total", "cost_machine_time", "cost_setup", "cost_tooling", "cost_raw_material", "cost_finishing"],
          ["lbl"])
def l1_cost_labels(d: Domain):
    """Exact vs decomposed cost labels after normalisation."""
    return etl.training_rows(d).select(
        "order_id", "process_code", "cost_total", "cost_machine_time", "cost_setup", "cost_tooling",
        "cost_raw_material", "cost_finishing", "cost_label_source")


@register("l3_components_sum_check", """
SELECT order_id, CAST(round(CAST(CAST(COALESCE(cost_machine_time, 0) + COALESCE(cost_setup, 0) + COALESCE(cost_tooling, 0)
  + COALESCE(cost_raw_material, 0) + COALESCE(cost_finishing, 0) AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE) AS components_sum,
  abs(cost_total - (COALESCE(cost_machine_time, 0) + COALESCE(cost_setup, 0) + COALESCE(cost_tooling, 0)
  + COALESCE(cost_raw_material, 0) + COALESCE(cost_finishing, 0))) <= 0.05e0 AS components_match_total
FROM m_invoices_all""", ["components_sum"], ["m_invoices_all"])
def l3_components_sum_check(d: Domain):
    """L3: invoice components vs total cross-check."""
    return labels.components_sum_check(d.all_invoices).select("order_id", "components_sum", "components_match_total")


@register("j12_enrich_extra_source", """
SELECT o.order_id, o.part_id, o.facility_id, i.label_source, i.cost_total AS invoice_total
FROM m_orders o LEFT JOIN m_invoices_partial i ON i.order_id = o.order_id""", ["invoice_total"], ["m_orders", "m_invoices_partial"])
def j12_enrich_extra_source(d: Domain):
    """The documented extension recipe: attach an extra source to the orders by order_id (left)."""
    extra = d.partial_invoices.select("order_id", "label_source", F.col("cost_total").alias("invoice_total"))
    return joins.enrich(d.orders.select("order_id", "part_id", "facility_id"), extra, ["order_id"])
