"""Registered feature / price analytics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from forgeline.constants import FEATURE_COLUMNS, FETCHER_FALLBACK_PRICES, PROCESS_CLASSES
from forgeline.operators.common import lookup
from forgeline.operators.joins import join_geometry
from forgeline.operators.normalize import clean_process
from forgeline.plans import analytics as an
from forgeline.plans.oracle_sql import cte, r2, values
from forgeline.plans.registry import register
from forgeline.sources.readers import extract_completed
from forgeline.sources.tables import Domain

cte("feat", "SELECT lower(trim(process_code)) AS process_code, j1.* EXCLUDE (process_code) FROM j1", ["j1"])
_UNP = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS)


def _features(d: Domain):
    j = join_geometry(extract_completed(d.orders, d.invoices), d.geometry)
    return j.withColumn("process_code", clean_process(F.col("process_code")))


@register("g24_anova_f", f"""
WITH l AS (SELECT label, feature, value FROM (UNPIVOT (SELECT process_code AS label, {_UNP} FROM feat
             WHERE process_code IS NOT NULL) ON {', '.join(FEATURE_COLUMNS)} INTO NAME feature VALUE value) u),
g AS (SELECT feature, label, count(*) AS n, avg(value) AS m, COALESCE(var_samp(value), 0.0e0) AS v FROM l
      GROUP BY feature, label),
t AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS nn, count(*) OVER (PARTITION BY feature) AS k,
        sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS grand FROM g)
SELECT feature, (sum(n * (m - grand) * (m - grand)) / (max(k) - 1)) / NULLIF(sum((n - 1) * v) / (max(nn) - max(k)), 0)
  AS f_stat, CAST(max(k) AS BIGINT) AS n_classes, CAST(max(nn) AS BIGINT) AS n_rows FROM t GROUP BY feature""",
          ["f_stat"], ["feat"])
def g24_anova_f(d: Domain):
    """ANOVA F of each geometry feature across process classes."""
    return an.anova_f(_features(d))


@register("g25_correlation_pairs", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r, "
    f"abs(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))) > 0.8e0 AS high FROM feat"
    for a, b in combinations(FEATURE_COLUMNS, 2)) + ") x", ["r"], ["feat"])
def g25_correlation_pairs(d: Domain):
    """Pearson correlation of every feature pair, flagged above |r| > 0.8."""
    return an.correlation_pairs(_features(d))


@register("g30_class_feature_stats", """
SELECT process_code, avg(volume) AS mean, stddev_samp(volume) AS std,
  avg(CAST(undercut_flag AS DOUBLE)) AS undercut_rate, CAST(count(*) AS BIGINT) AS n,
  quantile_cont(volume, 0.25) AS q1, quantile_cont(volume, 0.5) AS median, quantile_cont(volume, 0.75) AS q3
FROM feat WHERE process_code IS NOT NULL GROUP BY process_code""",
          ["mean", "std", "undercut_rate", "q1", "median", "q3"], ["feat"])
def g30_class_feature_stats(d: Domain):
    """Class-conditional volume statistics (mean, std, exact quartiles) and undercut rate."""
    return an.class_feature_stats(_features(d), "volume")


@register("g31_price_sensitivity", f"""
WITH b AS (SELECT process_code, volume, greatest(1.0e0, COALESCE(CAST(quantity AS DOUBLE), 10.0e0)) AS q,
             COALESCE(fb.p, 5.0e0) AS price FROM feat
           LEFT JOIN (SELECT * FROM {values(list(FETCHER_FALLBACK_PRICES.items()), ['mat', 'p'])}) fb
             ON fb.mat = feat.material_code),
g AS (SELECT process_code, s AS price_change,
        {r2('COALESCE(volume, 50000.0e0) / 1e6 * 2.7e0 * (price * (1 + s)) * 3.5e0')} AS c,
        {r2('COALESCE(volume, 50000.0e0) / 1e6 * 2.7e0 * price * 3.5e0')} AS c0
      FROM b, (SELECT unnest([-0.5, -0.4, -0.3, -0.2, -0.1, 0.0, 0.1, 0.2, 0.3, 0.4, 0.5]::DOUBLE[]) AS s) grid)
SELECT process_code, regr_slope((c - c0) / c0, price_change) AS sensitivity, CAST(count(*) AS BIGINT) AS n
FROM g WHERE c0 > 0 GROUP BY process_code""", ["sensitivity"], ["feat"])
def g31_price_sensitivity(d: Domain):
    """Price-sensitivity coefficient per process over a -50%..+50% grid (fallback formula)."""
    f = _features(d).withColumn("material_price_per_kg",
                                F.coalesce(lookup(FETCHER_FALLBACK_PRICES, F.col("material_code")), F.lit(5.0)))
    return an.price_sensitivity(f)


@register("g32_outage_error_drift", """
SELECT lag_days, avg(abs(p_old - p) / p) AS mean_abs_rel_error, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT l.lag_days, a.price AS p, b.price AS p_old FROM pday a
  CROSS JOIN (SELECT unnest([0, 7, 30]) AS lag_days) l
  JOIN pday b ON b.material_code = a.material_code AND b.date = a.date - CAST(l.lag_days AS INTEGER)) x
GROUP BY lag_days""", ["mean_abs_rel_error"], ["pday"])
def g32_outage_error_drift(d: Domain):
    """Relative price error after a 0 / 7 / 30 day feed outage."""
    return an.outage_error_drift(d.prices)


@register("w9_last_event_per_user", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS last_event_id, max(ts) AS last_ts,
  arg_max(event_type, (ts, event_id)) AS last_event_type FROM events GROUP BY user_id""", [])
def w9_last_event_per_user(d: Domain):
    """Latest entry per key of a log (max_by over (ts, id); partial aggregation, skew-safe)."""
    e = d.table("events")
    last = e.groupBy("user_id").agg(F.max_by(F.struct("event_id", "ts", "event_type"),
                                             F.struct("ts", "event_id")).alias("r"))
    return last.select("user_id", F.col("r.event_id").alias("last_event_id"), F.col("r.ts").alias("last_ts"),
                       F.col("r.event_type").alias("last_event_type"))


@register("p22_log_volume", "SELECT part_id, ln(1 + volume) AS log_volume FROM m_geometry_all", ["log_volume"],
          ["m_geometry_all"])
def p22_log_volume(d: Domain):
    """log(volume + 1) per part."""
    return d.all_geometry.select("part_id", F.log1p("volume").alias("log_volume"))


@register("g26_vif", None)
def g26_vif(d: Domain):
    """Variance inflation factors from the inverse of the 14 x 14 correlation matrix (rows-only)."""
    return d.spark.createDataFrame(an.vif(_features(d)), "feature string, vif double")


@register("s10_feature_table", "SELECT order_id, " + ", ".join(FEATURE_COLUMNS) + ", process_code, CAST("
          + "CASE process_code " + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(PROCESS_CLASSES))
          + " END AS INTEGER) AS label "
          "FROM feat", ["bounding_box_x", "bounding_box_y", "bounding_box_z", "volume", "surface_area",
                        "wall_thickness_min", "wall_thickness_avg", "aspect_ratio", "hole_diameter_min",
                        "curvature_complexity", "symmetry_score"], ["feat"])
def s10_feature_table(d: Domain):
    """Feature columns with the label index in label-map order (unknown codes -> NULL)."""
    f = _features(d)
    idx = lookup({p: i for i, p in enumerate(PROCESS_CLASSES)}, F.col("process_code")).cast("int")
    return f.select("order_id", *FEATURE_COLUMNS, "process_code", idx.alias("label"))
