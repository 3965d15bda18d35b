"""Registered evaluation queries: classifier ranking metrics and cost-model error metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from forgeline.operators.normalize import clean_process
from forgeline.plans import evaluate as ev
from forgeline.plans.oracle_sql import OID, cte, r2, values
from forgeline.plans.registry import register
from forgeline.sources.tables import PREDICTION_COMPONENTS, Domain

cte("m_keys", "SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem")
cte("m_scores", f"""
SELECT {OID} AS row_id, CAST((l_partkey + l_suppkey) % 18 AS INTEGER) AS true_idx, CAST(c AS INTEGER) AS class_idx,
  w / sum(w) OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS p
FROM (SELECT k.*, c, CAST(1 + (l_partkey * 31 + l_suppkey * 17 + c * 97 + l_linenumber * 13) % 101 AS DOUBLE) AS w
      FROM m_keys k CROSS JOIN range(0, 18) t(c)) x""", ["m_keys"])
cte("m_ranked", """
SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY p DESC, class_idx DESC) AS rnk FROM m_scores""",
    ["m_scores"])
cte("m_pred", """
SELECT r.row_id, r.true_idx, r.class_idx AS pred_idx, r.p AS top1_p,
  (SELECT t.rnk FROM m_ranked t WHERE t.row_id = r.row_id AND t.class_idx = r.true_idx) AS true_rank
FROM m_ranked r WHERE r.rnk = 1""", ["m_ranked"])
cte("m_conf", "SELECT true_idx, pred_idx, CAST(count(*) AS BIGINT) AS n FROM m_pred GROUP BY true_idx, pred_idx",
    ["m_pred"])
cte("classes", "SELECT * FROM " + values(list(enumerate(ev.PROCESS_CLASSES)), ["class_idx", "process"]))
cte("m_prf", """
SELECT c.class_idx, c.process, COALESCE(t.tp, 0) AS tp, COALESCE(p.predicted, 0) AS predicted,
  COALESCE(t.support, 0) AS support,
  COALESCE(CAST(t.tp AS DOUBLE) / NULLIF(p.predicted, 0), 0.0e0) AS precision,
  COALESCE(CAST(t.tp AS DOUBLE) / NULLIF(t.support, 0), 0.0e0) AS recall
FROM classes c
LEFT JOIN (SELECT true_idx, sum(n) AS support, sum(n) FILTER (WHERE true_idx = pred_idx) AS tp FROM m_conf
           GROUP BY true_idx) t ON t.true_idx = c.class_idx
LEFT JOIN (SELECT pred_idx, sum(n) AS predicted FROM m_conf GROUP BY pred_idx) p ON p.pred_idx = c.class_idx""",
    ["classes", "m_conf"])
cte("m_prf1", """
SELECT *, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0.0e0) AS f1 FROM m_prf""", ["m_prf"])
cte("comps", "SELECT * FROM " + values(list(enumerate(PREDICTION_COMPONENTS)), ["cidx", "cname"]))
cte("m_costpred", f"""
SELECT {OID} AS row_id, CAST((l_suppkey * 7 + l_linenumber) % 18 AS INTEGER) AS process_idx, pcode AS process_code,
  cname AS component, l_extendedprice AS y_true,
  l_extendedprice * (1.0e0 + ((l_suppkey * 7 + l_partkey) % 41 - 20) / 100.0e0) AS y_pred
FROM lineitem JOIN proc ON (l_suppkey * 7 + l_linenumber) % 18 = pidx JOIN comps ON l_linenumber % 5 = cidx""",
    ["proc", "comps"])
cte("m_pct", "SELECT (y_pred - y_true) / greatest(y_true, 1e-6) * 100 AS pct_error FROM m_costpred", ["m_costpred"])

_COST_AGG = """
  avg(CASE WHEN y_true >= 1.0e0 THEN abs((y_true - y_pred) / y_true) END) * 100 AS mape,
  avg(abs(y_true - y_pred)) AS mae,
  COALESCE(avg(CASE WHEN y_true > 0 THEN CAST(abs((y_true - y_pred) / y_true) <= 0.10e0 AS DOUBLE) END), 0.0e0)
    AS within_10pct,
  avg(y_pred - y_true) AS bias, CAST(count(*) FILTER (WHERE y_true > 0) AS BIGINT) AS n"""
COST_DOUBLES = ["mape", "mae", "within_10pct", "bias"]


@register("w2_top3_classes", "SELECT row_id, CAST(rnk AS INTEGER) AS rank, class_idx, p FROM m_ranked WHERE rnk <= 3",
          ["p"], ["m_ranked"])
def w2_top3_classes(d: Domain):
    """Top-3 classes per prediction row (ties -> higher class index)."""
    return ev.top_k_table(d.scores, 3)


@register("g12_topk_accuracy", """
SELECT avg(CAST(true_rank <= 1 AS DOUBLE)) AS top_1_accuracy, avg(CAST(true_rank <= 3 AS DOUBLE)) AS top_3_accuracy,
  avg(CAST(true_rank <= 5 AS DOUBLE)) AS top_5_accuracy FROM m_pred""",
          ["top_1_accuracy", "top_3_accuracy", "top_5_accuracy"], ["m_pred"])
def g12_topk_accuracy(d: Domain):
    """Top-1/3/5 accuracy."""
    return ev.top_k_accuracy(d.scores)


@register("g14_coverage_at_3", """
SELECT avg(CAST(true_rank <= 3 AS DOUBLE)) AS top_3_accuracy,
  COALESCE(avg(CAST(true_rank <= 3 AS DOUBLE)) FILTER (WHERE top1_p >= 0.15e0), 0.0e0) AS top_3_accuracy_high_confidence,
  COALESCE(avg(CAST(true_rank <= 3 AS DOUBLE)) FILTER (WHERE top1_p < 0.15e0), 0.0e0) AS top_3_accuracy_low_confidence,
  avg(CAST(top1_p >= 0.15e0 AS DOUBLE)) AS high_confidence_fraction,
  avg(CAST(top1_p < 0.15e0 AS DOUBLE)) AS low_confidence_fraction FROM m_pred""",
          ["top_3_accuracy", "top_3_accuracy_high_confidence", "top_3_accuracy_low_confidence",
           "high_confidence_fraction", "low_confidence_fraction"], ["m_pred"])
def g14_coverage_at_3(d: Domain):
    """Coverage at 3 split by top-1 confidence 0.15."""
    return ev.coverage_at_k(d.scores, 3)


@register("g21_confusion", """
SELECT true_idx, pred_idx, n, n / sum(n) OVER (PARTITION BY true_idx) AS row_share FROM m_conf""",
          ["row_share"], ["m_conf"])
def g21_confusion(d: Domain):
    """Confusion counts (active classes only) with row-normalised share."""
    return ev.confusion_normalized(d.scores)


@register("g13_per_class_report", f"""
SELECT process, {r2('precision', 3)} AS precision, {r2('recall', 3)} AS recall, {r2('f1', 3)} AS f1,
  CAST(support AS BIGINT) AS support FROM m_prf1""", [], ["m_prf1"])
def g13_per_class_report(d: Domain):
    """Per-class precision / recall / F1 / support (zero division -> 0)."""
    return ev.per_class_report(d.scores)


@register("g15_f1_summary", """
SELECT avg(f1) AS macro_f1, sum(f1 * support) / sum(support) AS weighted_f1 FROM m_prf1
WHERE support > 0 OR predicted > 0""", ["macro_f1", "weighted_f1"], ["m_prf1"])
def g15_f1_summary(d: Domain):
    """Macro and weighted F1."""
    return ev.f1_summary(d.scores)


@register("g28_confusion_pairs", """
SELECT least(true_idx, pred_idx) AS class_a, greatest(true_idx, pred_idx) AS class_b, CAST(sum(n) AS BIGINT) AS n,
  sum(n) / sum(sum(n)) OVER () AS error_share
FROM m_conf WHERE true_idx <> pred_idx GROUP BY least(true_idx, pred_idx), greatest(true_idx, pred_idx)""",
          ["error_share"], ["m_conf"])
def g28_confusion_pairs(d: Domain):
    """Confusion-pair ranking with share of errors."""
    return ev.confusion_pairs(d.scores)


@register("g27_brier_score", """
SELECT avg(s) AS brier FROM (SELECT row_id, sum(power(p - CASE WHEN class_idx = true_idx THEN 1.0e0 ELSE 0.0e0 END, 2))
  AS s FROM m_scores GROUP BY row_id) x""", ["brier"], ["m_scores"])
def g27_brier_score(d: Domain):
    """Multi-class Brier score."""
    return ev.brier_score(d.scores)


@register("g11_class_distribution", """
SELECT lower(trim(process_code)) AS process_code, CAST(count(*) AS BIGINT) AS n, count(*) / sum(count(*)) OVER () AS share,
  count(*) < 100 AS below_min FROM m_orders WHERE process_code IS NOT NULL GROUP BY lower(trim(process_code))""",
          ["share"], ["m_orders"])
def g11_class_distribution(d: Domain):
    """Class distribution of the order labels with share and small-class flag."""
    o = d.orders.where(F.col("process_code").isNotNull()).select(clean_process(F.col("process_code")).alias("process_code"))
    return ev.class_distribution(o)


@register("g16_cost_metrics", f"SELECT {_COST_AGG} FROM m_costpred", COST_DOUBLES, ["m_costpred"])
def g16_cost_metrics(d: Domain):
    """Overall MAPE (true >= 1), MAE, share within 10%, bias."""
    return ev.cost_metrics(d.cost_predictions, [])


@register("g16_trainer_mape_by_process", """
SELECT process_code, avg(CASE WHEN y_true > 1.0e0 THEN abs((y_true - y_pred) / y_true) END) * 100 AS mape
FROM m_costpred GROUP BY process_code""", ["mape"], ["m_costpred"])
def g16_trainer_mape_by_process(d: Domain):
    """G16 (trainer variant): MAPE over true > 1.0 per process."""
    return ev.cost_metrics(d.cost_predictions, ["process_code"], strict=True).select("process_code", "mape")


@register("g20_per_component_table", f"""
SELECT component, {r2('mape', 1)} AS mape, {r2('mae', 2)} AS mae, {r2('within_10pct * 100', 1)} AS within_10pct, n
FROM (SELECT component, {_COST_AGG} FROM m_costpred GROUP BY component) x""", [], ["m_costpred"])
def g20_per_component_table(d: Domain):
    """Per-component MAPE / MAE / within-10% / n table."""
    return ev.per_component_table(d.cost_predictions)


@register("g23_mape_by_process", """
SELECT process_code, mape, n, CASE WHEN mape < 10 THEN 'under_10' WHEN mape < 15 THEN 'under_15' ELSE 'over_15' END
  AS tier FROM (SELECT process_code, avg(CASE WHEN y_true >= 1.0e0 THEN abs((y_true - y_pred) / y_true) END) * 100
  AS mape, CAST(count(*) FILTER (WHERE y_true > 0) AS BIGINT) AS n FROM m_costpred GROUP BY process_code) x""",
          ["mape"], ["m_costpred"])
def g23_mape_by_process(d: Domain):
    """Per-process MAPE with reliability tier."""
    return ev.mape_by_process(d.cost_predictions)


@register("g23_weighted_mape", """
SELECT sum(mape * n) / sum(n) AS weighted_mape FROM (SELECT process_code,
  avg(CASE WHEN y_true >= 1.0e0 THEN abs((y_true - y_pred) / y_true) END) * 100 AS mape,
  count(*) FILTER (WHERE y_true > 0) AS n FROM m_costpred GROUP BY process_code) x WHERE mape IS NOT NULL""",
          ["weighted_mape"], ["m_costpred"])
def g23_weighted_mape(d: Domain):
    """Support-weighted overall MAPE."""
    return ev.weighted_mape(d.cost_predictions)


@register("g22_pct_error_histogram", """
SELECT bin, lo + bin * (hi - lo) / 40 AS bin_start, lo + (bin + 1) * (hi - lo) / 40 AS bin_end, CAST(count(*) AS BIGINT) AS n
FROM (SELECT CAST(CASE WHEN (hi - lo) / 40 > 0 THEN least(floor((pct_error - lo) / ((hi - lo) / 40)), 39) ELSE 0 END
      AS INTEGER) AS bin, lo, hi FROM m_pct, (SELECT min(pct_error) AS lo, max(pct_error) AS hi FROM m_pct) r) b
GROUP BY bin, lo, hi""", ["bin_start", "bin_end"], ["m_pct"])
def g22_pct_error_histogram(d: Domain):
    """40-bin percentage-error histogram over the data range."""
    return ev.pct_error_histogram(d.cost_predictions)


@register("g22_pct_error_median", "SELECT median(pct_error) AS median_pct_error FROM m_pct",
          ["median_pct_error"], ["m_pct"])
def g22_pct_error_median(d: Domain):
    """Exact median percentage error (bucketed exact quantile)."""
    return ev.pct_error_median(d.cost_predictions)
