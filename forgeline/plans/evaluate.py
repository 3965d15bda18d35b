"""Model evaluation as aggregates.

Classifier metrics read a probability table ``(row_id, true_idx, proba
array<double>)``: ranking is done inside each row's array (no shuffle, no
explode), and the per-class metrics come from the small confusion table
(<= classes^2 rows) produced by one partial aggregation.  Cost metrics read
``(row_id, process_code, component, y_true, y_pred)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgeline.constants import MAPE_MIN_TRUE, PROCESS_CLASSES, TOP1_CONFIDENCE_SPLIT
from forgeline.operators.common import attach_row
from forgeline.operators.quantiles import exact_median

N_CLASSES = len(PROCESS_CLASSES)


# --- W2: ranking inside the probability array ---------------------------------
def ranked_classes(proba: Column) -> Column:
    """array<struct<p, idx>> sorted by probability desc, ties -> higher class index."""
    return F.sort_array(_pairs(proba), asc=False)


def _pairs(proba: Column) -> Column:
    return F.transform(proba, lambda p, i: F.struct(p.alias("p"), i.alias("idx")))


def best_class(proba: Column) -> Column:
    """The first of ``ranked_classes`` without ranking the others."""
    return F.array_max(_pairs(proba))


def true_rank(proba: Column, true_idx: Column) -> Column:
    """1-based rank of the true class under the same ordering."""
    pt = F.element_at(proba, true_idx + 1)
    beats = F.filter(F.transform(proba, lambda p, i: (p > pt) | ((p == pt) & (i > true_idx))), lambda b: b)
    return F.size(beats) + 1


def with_ranks(scores: DataFrame) -> DataFrame:
    """Adds pred_idx (top-1), top1_p and true_rank."""
    top = best_class(F.col("proba"))
    return scores.select("*", top["idx"].alias("pred_idx"), top["p"].alias("top1_p"),
                         true_rank(F.col("proba"), F.col("true_idx")).alias("true_rank"))


def top_k_table(scores: DataFrame, k: int = 3) -> DataFrame:
    """One row per (row_id, rank <= k) with class index and probability."""
    top = F.slice(ranked_classes(F.col("proba")), 1, k)
    return scores.select("row_id", F.posexplode(top).alias("pos", "c")).select(
        "row_id", (F.col("pos") + 1).alias("rank"), F.col("c.idx").alias("class_idx"), F.col("c.p").alias("p"))


# --- G12 / G14 ----------------------------------------------------------------
def top_k_accuracy(scores: DataFrame, ks=(1, 3, 5)) -> DataFrame:
    """Share of rows whose true class is within the top k."""
    r = with_ranks(scores)
    return r.agg(*[F.avg((F.col("true_rank") <= k).cast("double")).alias(f"top_{k}_accuracy") for k in ks])


def coverage_at_k(scores: DataFrame, k: int = 3, threshold: float = TOP1_CONFIDENCE_SPLIT) -> DataFrame:
    """Top-k accuracy overall and split by top-1 probability >= threshold (0.0 for an empty side)."""
    r = with_ranks(scores).withColumn("__hit", (F.col("true_rank") <= k).cast("double")) \
        .withColumn("__hi", F.col("top1_p") >= threshold)
    return r.agg(
        F.avg("__hit").alias(f"top_{k}_accuracy"),
        F.coalesce(F.avg(F.when(F.col("__hi"), F.col("__hit"))), F.lit(0.0)).alias(f"top_{k}_accuracy_high_confidence"),
        F.coalesce(F.avg(F.when(~F.col("__hi"), F.col("__hit"))), F.lit(0.0)).alias(f"top_{k}_accuracy_low_confidence"),
        F.avg(F.col("__hi").cast("double")).alias("high_confidence_fraction"),
        F.avg((~F.col("__hi")).cast("double")).alias("low_confidence_fraction"))


# --- G21 / G13 / G15 / G28 ----------------------------------------------------
def confusion(scores: DataFrame) -> DataFrame:
    """(true_idx, pred_idx, n) over the observed pairs (partial aggregation)."""
    return with_ranks(scores).groupBy("true_idx", "pred_idx").agg(F.count(F.lit(1)).alias("n"))


def confusion_normalized(scores: DataFrame) -> DataFrame:
    """Confusion counts with the row share (fraction of the true class)."""
    c = confusion(scores)   # <= classes^2 rows: the window runs on the small aggregate
    return c.select("true_idx", "pred_idx", "n",
                    (F.col("n") / F.sum("n").over(Window.partitionBy("true_idx"))).alias("row_share"))


def class_table(spark: SparkSession) -> DataFrame:
    """The 18 classes as a literal table (fixed size, built JVM-side)."""
    names = F.array(*[F.lit(p) for p in PROCESS_CLASSES])
    return spark.range(len(PROCESS_CLASSES)).select(
        F.col("id").cast("int").alias("class_idx"), F.element_at(names, F.col("id").cast("int") + 1).alias("process"))


def per_class_counts(scores: DataFrame) -> DataFrame:
    """tp / fp / fn / support per class over the full label list."""
    c = confusion(scores)
    # each confusion cell counts once for its true class and once for its predicted class
    zero = F.lit(0).cast("long")
    both = c.select(F.explode(F.array(
        F.struct(F.col("true_idx").alias("class_idx"), F.col("n").alias("support"),
                 F.when(F.col("true_idx") == F.col("pred_idx"), F.col("n")).otherwise(zero).alias("tp"),
                 zero.alias("predicted")),
        F.struct(F.col("pred_idx").alias("class_idx"), zero.alias("support"), zero.alias("tp"),
                 F.col("n").alias("predicted")))).alias("s")).select("s.*")
    per = both.groupBy("class_idx").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                                         F.sum("predicted").alias("predicted"))
    out = class_table(scores.sparkSession).join(per, "class_idx", "left")
    return out.select("class_idx", "process",
                      F.coalesce("tp", F.lit(0)).alias("tp"),
                      F.coalesce("predicted", F.lit(0)).alias("predicted"),
                      F.coalesce("support", F.lit(0)).alias("support"))


def _prf(df: DataFrame) -> DataFrame:
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    return df.withColumn("precision", prec.cast("double")).withColumn("recall", rec.cast("double")) \
        .withColumn("f1", f1.cast("double"))


def per_class_report(scores: DataFrame) -> DataFrame:
    """Precision / recall / F1 (3 dp, zero division -> 0) and support, sorted by F1 desc."""
    r = _prf(per_class_counts(scores))
    return r.select("process", F.round("precision", 3).alias("precision"), F.round("recall", 3).alias("recall"),
                    F.round("f1", 3).alias("f1"), F.col("support").cast("long").alias("support")) \
        .orderBy(F.desc("f1"), "process")


def f1_summary(scores: DataFrame) -> DataFrame:
    """Macro and support-weighted F1 over the labels seen in truth or prediction."""
    r = _prf(per_class_counts(scores)).where((F.col("support") > 0) | (F.col("predicted") > 0))
    return r.agg(F.avg("f1").alias("macro_f1"),
                 (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def confusion_pairs(scores: DataFrame) -> DataFrame:
    """Off-diagonal confusions by unordered class pair with their share of all errors."""
    c = confusion(scores).where(F.col("true_idx") != F.col("pred_idx"))
    pairs = c.groupBy(F.least("true_idx", "pred_idx").alias("class_a"),
                      F.greatest("true_idx", "pred_idx").alias("class_b")).agg(F.sum("n").alias("n"))
    return pairs.select("class_a", "class_b", "n",
                        (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("error_share"))


def class_distribution(df: DataFrame, label_col: str = "process_code", small: int = 100) -> DataFrame:
    """Class counts (desc), share and a below-``small`` flag."""
    c = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))   # one row per class
    return c.select(label_col, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"),
                                     (F.col("n") < small).alias("below_min")).orderBy(F.desc("n"), label_col)


def brier_score(scores: DataFrame) -> DataFrame:
    """Multi-class Brier = mean over rows of sum_k (p_k - y_k)^2."""
    sq = F.aggregate(F.transform("proba", lambda p, i: F.pow(p - F.when(i == F.col("true_idx"), 1.0)
                                                             .otherwise(0.0), 2)), F.lit(0.0), lambda a, b: a + b)
    return scores.agg(F.avg(sq).alias("brier"))


# --- cost metrics (G16-G20, G22, G23) ----------------------------------------
def _ape(t: Column, p: Column) -> Column:
    return F.abs((t - p) / t)


def cost_metrics(pred: DataFrame, group_cols: list[str], min_true: float = MAPE_MIN_TRUE,
                 strict: bool = False) -> DataFrame:
    """MAPE (true >= 1, trainer variant > 1; none -> NULL), MAE, share within 10% (true > 0),
    bias, per group."""
    t, p = F.col("y_true"), F.col("y_pred")
    keep = (t > min_true) if strict else (t >= min_true)
    return pred.groupBy(*group_cols).agg(
        (F.avg(F.when(keep, _ape(t, p))) * 100).alias("mape"),
        F.avg(F.abs(t - p)).alias("mae"),
        F.coalesce(F.avg(F.when(t > 0, (_ape(t, p) <= 0.10).cast("double"))), F.lit(0.0)).alias("within_10pct"),
        F.avg(p - t).alias("bias"),
        F.count_if(t > 0).alias("n"))


def per_component_table(pred: DataFrame) -> DataFrame:
    """Per component mape (1 dp), mae (2 dp), within_10pct (% 1 dp), n (true > 0), by component."""
    m = cost_metrics(pred, ["component"])
    return m.select("component", F.round("mape", 1).alias("mape"), F.round("mae", 2).alias("mae"),
                    F.round(F.col("within_10pct") * 100, 1).alias("within_10pct"), "n").orderBy("component")


def mape_by_process(pred: DataFrame) -> DataFrame:
    """MAPE per process with reliability tier (< 10, < 15, else)."""
    m = cost_metrics(pred, ["process_code"])
    tier = F.when(F.col("mape") < 10, F.lit("under_10")).when(F.col("mape") < 15, F.lit("under_15")) \
        .otherwise(F.lit("over_15"))
    return m.select("process_code", "mape", "n", tier.alias("tier"))


def weighted_mape(pred: DataFrame) -> DataFrame:
    """Support-weighted overall MAPE across processes."""
    m = cost_metrics(pred, ["process_code"]).where(F.col("mape").isNotNull())
    return m.agg((F.sum(F.col("mape") * F.col("n")) / F.sum("n")).alias("weighted_mape"))


def pct_error_histogram(pred: DataFrame, bins: int = 40) -> DataFrame:
    """(p - t) / max(t, 1e-6) * 100 in ``bins`` equal bins over the data range (last bin closed)."""
    e = pred.select(((F.col("y_pred") - F.col("y_true")) / F.greatest(F.col("y_true"), F.lit(1e-6)) * 100)
                    .alias("pct_error"))
    rng = e.agg(F.min("pct_error").alias("__lo"), F.max("pct_error").alias("__hi"))
    b = attach_row(e, rng)
    width = (F.col("__hi") - F.col("__lo")) / bins
    idx = F.when(width > 0, F.least(F.floor((F.col("pct_error") - F.col("__lo")) / width), F.lit(bins - 1))) \
        .otherwise(F.lit(0)).cast("int")
    h = b.withColumn("bin", idx).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.first("__lo").alias("__lo"), F.first("__hi").alias("__hi"))
    w = (F.col("__hi") - F.col("__lo")) / bins
    return h.select("bin", (F.col("__lo") + F.col("bin") * w).alias("bin_start"),
                    (F.col("__lo") + (F.col("bin") + 1) * w).alias("bin_end"), "n")


def pct_error_median(pred: DataFrame) -> DataFrame:
    """Exact median percentage error."""
    e = pred.select(((F.col("y_pred") - F.col("y_true")) / F.greatest(F.col("y_true"), F.lit(1e-6)) * 100)
                    .alias("pct_error"))
    return exact_median(e, [], "pct_error", "median_pct_error")
