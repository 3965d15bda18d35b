"""Registered quality queries: coverage, staleness, drift, label mix, freshness, funnel."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from forgeline.constants import DRIFT_NUMERIC_COLUMNS
from forgeline.operators import joins
from forgeline.operators.normalize import clean_codes
from forgeline.plans import etl, quality
from forgeline.plans.oracle_sql import cte
from forgeline.plans.registry import register
from forgeline.session import materialize
from forgeline.sources import readers
from forgeline.sources.tables import Domain

AS_OF = _dt.date(2024, 2, 1)

cte("clean_rows", "SELECT * FROM ann WHERE reject_bucket IS NULL", ["ann"])
cte("pdate", """
SELECT o.order_id, o.material_code, o.order_date, COALESCE(
  (SELECT p.date FROM pday p WHERE p.material_code = o.material_code AND p.date = o.order_date),
  (SELECT p.date FROM pday p WHERE p.material_code = o.material_code
     AND abs(datediff('day', o.order_date, p.date)) <= 7 ORDER BY p.date DESC LIMIT 1)) AS price_date
FROM m_orders o""", ["m_orders", "pday"])
cte("stale", """
SELECT order_id, price_date, CAST(COALESCE(datediff('day', price_date, order_date), 999) AS INTEGER)
  AS price_staleness_days FROM pdate""", ["pdate"])
_unpivot_cols = ", ".join(DRIFT_NUMERIC_COLUMNS)
cte("dr", f"""
SELECT lower(trim(process_code)) AS process_code, CAST(split_part(order_id, '-', 1) AS BIGINT) % 2 AS half,
  CAST(volume AS DOUBLE) AS volume, CAST(surface_area AS DOUBLE) AS surface_area,
  CAST(wall_thickness_min AS DOUBLE) AS wall_thickness_min, CAST(wall_thickness_avg AS DOUBLE) AS wall_thickness_avg,
  CAST(quantity AS DOUBLE) AS quantity, CAST(material_price_per_kg AS DOUBLE) AS material_price_per_kg,
  CASE WHEN CAST(split_part(order_id, '-', 1) AS BIGINT) % 2 = 1 THEN cost_total * 1.3e0 ELSE cost_total END
    AS cost_total
FROM j2""", ["j2"])
cte("dlong", f"""
SELECT half, feature, value FROM (UNPIVOT (SELECT half, {_unpivot_cols} FROM dr)
  ON {_unpivot_cols} INTO NAME feature VALUE value) u WHERE NOT isnan(value)""", ["dr"])
cte("ks", """
SELECT feature, max(abs(cb / tb - cn / tn)) AS ks_stat, CAST(max(tb) AS BIGINT) AS n_base,
  CAST(max(tn) AS BIGINT) AS n_new
FROM (SELECT feature, value,
        sum(nb) OVER (PARTITION BY feature ORDER BY value) AS cb,
        sum(nn) OVER (PARTITION BY feature ORDER BY value) AS cn,
        sum(nb) OVER (PARTITION BY feature) AS tb, sum(nn) OVER (PARTITION BY feature) AS tn
      FROM (SELECT feature, value, count(*) FILTER (WHERE half = 0) AS nb,
                   count(*) FILTER (WHERE half = 1) AS nn FROM dlong GROUP BY feature, value) v) c
GROUP BY feature HAVING max(tb) >= 5 AND max(tn) >= 5""", ["dlong"])
_LAM = "(sqrt(n_base * n_new / (n_base + n_new)) * ks_stat)"
_KS_P = (f"CASE WHEN ks_stat <= 0 THEN 1.0e0 ELSE least(1.0e0, greatest(0.0e0, CASE WHEN {_LAM} < 0.5e0 THEN "
         f"1.0e0 - sqrt(2.0e0 * pi()) / {_LAM} * list_sum(list_transform(range(1, 41), lambda k: "
         f"exp(-power(2.0e0 * k - 1.0e0, 2) * power(pi(), 2) / (8.0e0 * {_LAM} * {_LAM})))) ELSE "
         f"list_sum(list_transform(range(1, 101), lambda k: 2.0e0 * power(-1.0e0, k - 1) * exp(-2.0e0 * k * k * {_LAM} * {_LAM}))) "
         "END)) END")
cte("ksp", f"SELECT *, {_KS_P} AS ks_pval, {_KS_P} < 0.01e0 AS ks_flag FROM ks", ["ks"])
cte("shares", """
SELECT COALESCE(b.process_code, n.process_code) AS process_code, COALESCE(b.p, 0.0e0) AS base_prop,
  COALESCE(n.p, 0.0e0) AS new_prop, abs(COALESCE(n.p, 0.0e0) - COALESCE(b.p, 0.0e0)) AS diff,
  abs(COALESCE(n.p, 0.0e0) - COALESCE(b.p, 0.0e0)) > 0.15e0 AS share_flag
FROM (SELECT process_code, count(*) / sum(count(*)) OVER () AS p FROM dr
      WHERE half = 0 AND process_code IS NOT NULL GROUP BY process_code) b
FULL OUTER JOIN (SELECT process_code, count(*) / sum(count(*)) OVER () AS p FROM dr
      WHERE half = 1 AND process_code IS NOT NULL GROUP BY process_code) n ON b.process_code = n.process_code""",
    ["dr"])


def _drift_halves(d: Domain):
    e = materialize(clean_codes(etl.enriched_orders(d)), "drift")
    half = F.split(F.col("order_id"), "-").getItem(0).cast("bigint") % 2
    base = e.where(half == 0)
    new = e.where(half == 1).withColumn("cost_total", F.col("cost_total") * 1.3)
    return base, new


@register("g3_process_counts", """
SELECT process_code, CAST(count(*) AS BIGINT) AS n FROM clean_rows WHERE process_code IS NOT NULL
GROUP BY process_code""", [], ["clean_rows"])
def g3_process_counts(d: Domain):
    """Rows per process code in the validated training rows."""
    return quality.code_counts(etl.clean_training_rows(d), "process_code")


@register("g4_coverage_findings", """
SELECT 'process_code' AS dimension, process_code AS code, CAST(count(*) AS BIGINT) AS n,
  CASE WHEN count(*) < 20 THEN 'CRITICAL' WHEN count(*) < 100 THEN 'WARNING' ELSE 'OK' END AS severity,
  CASE WHEN count(*) >= 100 THEN 'OK' WHEN count(*) >= 20 THEN 'WARN' ELSE 'FAIL' END AS status
FROM clean_rows WHERE process_code IS NOT NULL GROUP BY process_code
UNION ALL
SELECT 'material_code', material_code, CAST(count(*) AS BIGINT),
  CASE WHEN count(*) < 5 THEN 'WARNING' ELSE 'OK' END, CASE WHEN count(*) < 5 THEN 'WARN' ELSE 'OK' END
FROM clean_rows WHERE material_code IS NOT NULL GROUP BY material_code""", [], ["clean_rows"])
def g4_coverage_findings(d: Domain):
    """Per-code coverage severity (CRITICAL < 20, WARNING < 100; material < 5)."""
    return quality.coverage_findings(etl.clean_training_rows(d))


@register("g4_coverage_verdict", """
SELECT CAST((SELECT count(*) FROM clean_rows) AS BIGINT) AS n_rows,
  CAST(count(*) FILTER (WHERE severity = 'CRITICAL') AS BIGINT) AS n_critical,
  CAST(count(*) FILTER (WHERE severity = 'WARNING') AS BIGINT) AS n_warnings,
  (SELECT count(*) FROM clean_rows) > 0 AND count(*) FILTER (WHERE severity = 'CRITICAL') = 0 AS is_valid
FROM (SELECT CASE WHEN count(*) < 20 THEN 'CRITICAL' WHEN count(*) < 100 THEN 'WARNING' ELSE 'OK' END AS severity
      FROM clean_rows WHERE process_code IS NOT NULL GROUP BY process_code
      UNION ALL
      SELECT CASE WHEN count(*) < 5 THEN 'WARNING' ELSE 'OK' END FROM clean_rows
      WHERE material_code IS NOT NULL GROUP BY material_code) f""", [], ["clean_rows"])
def g4_coverage_verdict(d: Domain):
    """Overall coverage verdict."""
    return quality.coverage_verdict(etl.clean_training_rows(d))


@register("p15_price_staleness", """
SELECT order_id, price_date, price_staleness_days, price_staleness_days < 7 AS is_live FROM stale""",
          [], ["stale"])
def p15_price_staleness(d: Domain):
    """Price date from the archive lookup and its age at the order date (999 = fallback)."""
    j = joins.price_at_date(d.orders, d.prices, keep_date=True)
    return quality.price_staleness(j, F.col("order_date")).select(
        "order_id", "price_date", "price_staleness_days", "is_live")


@register("g5_staleness_summary", """
SELECT avg(price_staleness_days) AS avg_staleness_days, max(price_staleness_days) AS max_staleness_days,
  max(price_staleness_days) > 7 AS stale_warning FROM stale""", ["avg_staleness_days"], ["stale"])
def g5_staleness_summary(d: Domain):
    """Average / maximum staleness and the stale warning."""
    j = joins.price_at_date(d.orders, d.prices, keep_date=True)
    return quality.staleness_summary(quality.price_staleness(j, F.col("order_date")))


@register("g7_mean_shift", """
SELECT feature, CAST(count(*) FILTER (WHERE half = 0) AS BIGINT) AS n_base,
  CAST(count(*) FILTER (WHERE half = 1) AS BIGINT) AS n_new,
  avg(value) FILTER (WHERE half = 0) AS base_mean, stddev_samp(value) FILTER (WHERE half = 0) AS base_std,
  avg(value) FILTER (WHERE half = 1) AS new_mean,
  CASE WHEN stddev_samp(value) FILTER (WHERE half = 0) > 0 THEN abs(avg(value) FILTER (WHERE half = 1)
    - avg(value) FILTER (WHERE half = 0)) / stddev_samp(value) FILTER (WHERE half = 0) ELSE 0.0e0 END AS std_shift,
  CASE WHEN stddev_samp(value) FILTER (WHERE half = 0) > 0 THEN abs(avg(value) FILTER (WHERE half = 1)
    - avg(value) FILTER (WHERE half = 0)) / stddev_samp(value) FILTER (WHERE half = 0) ELSE 0.0e0 END > 0.5e0
    AS shift_flag
FROM dlong GROUP BY feature HAVING count(*) FILTER (WHERE half = 0) >= 5 AND count(*) FILTER (WHERE half = 1) >= 5""",
          ["base_mean", "base_std", "new_mean", "std_shift"], ["dlong"])
def g7_mean_shift(d: Domain):
    """Mean-shift drift per numeric column (base = even orders, new = odd, cost x 1.3)."""
    base, new = _drift_halves(d)
    return quality.mean_shift(base, new)


@register("g8_ks_drift", "SELECT feature, ks_stat, n_base, n_new, ks_pval, ks_flag FROM ksp",
          ["ks_stat", "ks_pval"], ["ksp"])
def g8_ks_drift(d: Domain):
    """Two-sample KS statistic and p-value per numeric column."""
    base, new = _drift_halves(d)
    return quality.ks_two_sample(base, new)


@register("g8_ks_exact", None)
def g8_ks_exact(d: Domain):
    """KS drift per numeric column with exact p-values for samples of up to KS_EXACT_ROWS rows, asymptotic beyond."""
    base, new = _drift_halves(d)
    return quality.ks_two_sample(base, new, exact_rows=quality.KS_EXACT_ROWS)


@register("g9_process_share_drift", "SELECT * FROM shares", ["base_prop", "new_prop", "diff"], ["shares"])
def g9_process_share_drift(d: Domain):
    """Process-share drift over the union of codes."""
    base, new = _drift_halves(d)
    return quality.process_share_drift(base, new)


@register("g10_drift_verdict", """
SELECT COALESCE(bool_or(ks_flag), false) AS numeric_drift, CAST(count(*) FILTER (WHERE ks_flag) AS BIGINT)
  AS n_numeric_flags,
  (SELECT COALESCE(bool_or(share_flag), false) FROM shares) AS process_drift,
  CAST((SELECT count(*) FILTER (WHERE share_flag) FROM shares) AS BIGINT) AS n_process_flags,
  COALESCE(bool_or(ks_flag), false) OR (SELECT COALESCE(bool_or(share_flag), false) FROM shares) AS drift_detected
FROM ksp""", [], ["ksp", "shares"])
def g10_drift_verdict(d: Domain):
    """Overall drift verdict."""
    base, new = _drift_halves(d)
    return quality.drift_verdict(base, new)


@register("g29_label_source_mix", """
SELECT cost_label_source, CAST(count(*) AS BIGINT) AS n, count(*) / sum(count(*)) OVER () AS share
FROM clean_rows GROUP BY cost_label_source""", ["share"], ["clean_rows"])
def g29_label_source_mix(d: Domain):
    """Label source mix of the validated rows."""
    return quality.label_source_mix(etl.clean_training_rows(d))


@register("g33_price_freshness", """
SELECT material_code, max(date) AS latest_date, datediff('day', max(date), DATE '2024-02-01') AS age_days,
  CASE WHEN datediff('day', max(date), DATE '2024-02-01') >= 7 THEN 'WARN' ELSE 'OK' END AS status
FROM m_prices GROUP BY material_code""", [], ["m_prices"])
def g33_price_freshness(d: Domain):
    """Latest price per material, age at 2024-02-01, OK / WARN."""
    return quality.price_freshness(d.prices, AS_OF)


@register("g34_row_funnel", """
SELECT 'no_geometry' AS cause, CAST(count(*) AS BIGINT) AS rows FROM ex
WHERE NOT EXISTS (SELECT 1 FROM m_geometry g WHERE g.part_id = ex.part_id AND g.bounding_box_x IS NOT NULL)
UNION ALL
SELECT COALESCE(reject_bucket, 'kept'), CAST(count(*) AS BIGINT) FROM ann GROUP BY COALESCE(reject_bucket, 'kept')""",
          [], ["ex", "m_geometry", "ann"])
def g34_row_funnel(d: Domain):
    """Source-to-output funnel by first loss cause."""
    ex = readers.extract_completed(d.orders, d.invoices)
    return quality.row_funnel(ex, d.geometry, etl.annotated_training_rows(d))
