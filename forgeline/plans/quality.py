"""Dataset quality reports: coverage, freshness, drift, label mix, row funnel.

All reports are aggregates.  Numeric drift unpivots the columns into one long
``(column, value)`` table so every column is handled by the same distributed
plan; the KS statistic uses the bucketed running totals of
``operators.quantiles`` so no column is sorted inside a single task.
"""

from __future__ import annotations

import datetime as _dt
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.constants import (
    COVERAGE_MIN_PER_MATERIAL, COVERAGE_MIN_PER_PROCESS, COVERAGE_WARN_PER_PROCESS,
    DRIFT_KS_P_LIMIT, DRIFT_MIN_ROWS, DRIFT_NUMERIC_COLUMNS, DRIFT_PROCESS_SHARE_LIMIT,
    DRIFT_STD_THRESHOLD, FALLBACK_STALENESS_DAYS, LIVE_STALENESS_LIMIT_DAYS, STALE_PRICE_DAYS,
)
from forgeline.operators.common import attach_row
from forgeline.operators.joins import share_comparison
from forgeline.operators.quantiles import running_totals


# --- G3 / G4 -----------------------------------------------------------------
def code_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-null code."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def coverage_findings(df: DataFrame, min_samples: int = COVERAGE_MIN_PER_PROCESS,
                      warn_threshold: int = COVERAGE_WARN_PER_PROCESS,
                      min_material: int = COVERAGE_MIN_PER_MATERIAL) -> DataFrame:
    """One finding per process / material code with its severity and status."""
    out = []
    if "process_code" not in df.columns:      # G4: a finding of its own, an error
        none = df.limit(0).agg(F.count(F.lit(1)).alias("n"))
        out.append(none.select(F.lit("process_code").alias("dimension"), F.lit(None).cast("string").alias("code"), "n",
                               F.lit("ERROR").alias("severity"), F.lit("FAIL").alias("status")))
    else:
        p = code_counts(df, "process_code")
        out.append(p.select(
            F.lit("process_code").alias("dimension"), F.col("process_code").alias("code"), "n",
            F.when(F.col("n") < min_samples, F.lit("CRITICAL"))
             .when(F.col("n") < warn_threshold, F.lit("WARNING")).otherwise(F.lit("OK")).alias("severity"),
            F.when(F.col("n") >= warn_threshold, F.lit("OK"))
             .when(F.col("n") >= min_samples, F.lit("WARN")).otherwise(F.lit("FAIL")).alias("status")))
    if "material_code" in df.columns:
        m = code_counts(df, "material_code")
        out.append(m.select(
            F.lit("material_code").alias("dimension"), F.col("material_code").alias("code"), "n",
            F.when(F.col("n") < min_material, F.lit("WARNING")).otherwise(F.lit("OK")).alias("severity"),
            F.when(F.col("n") < min_material, F.lit("WARN")).otherwise(F.lit("OK")).alias("status")))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def coverage_verdict(df: DataFrame, **kw) -> DataFrame:
    """is_valid (no CRITICAL, non-empty input, process column present) and counts."""
    f = coverage_findings(df, **kw)
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    agg = f.agg(F.count_if(F.col("severity") == "CRITICAL").alias("n_critical"),
                F.count_if(F.col("severity") == "WARNING").alias("n_warnings"))
    out = attach_row(n, agg)
    has_proc = "process_code" in df.columns
    return out.select(
        "n_rows", "n_critical", "n_warnings",
        ((F.col("n_rows") > 0) & (F.col("n_critical") == 0) & F.lit(has_proc)).alias("is_valid"))


# --- P15 / G5 / P21 -----------------------------------------------------------
def price_staleness(df: DataFrame, as_of: Column, price_date_col: str = "price_date") -> DataFrame:
    """Staleness days = as_of - price date (999 without a dated price); live if < 7."""
    st = F.coalesce(F.datediff(as_of, F.col(price_date_col)), F.lit(FALLBACK_STALENESS_DAYS))
    return (df.withColumn("price_staleness_days", st.cast("int"))
            .withColumn("is_live", F.col("price_staleness_days") < LIVE_STALENESS_LIMIT_DAYS))


def staleness_summary(df: DataFrame, limit: int = STALE_PRICE_DAYS) -> DataFrame:
    """Average and maximum staleness; stale warning when max > limit."""
    return df.agg(F.avg("price_staleness_days").alias("avg_staleness_days"),
                  F.max("price_staleness_days").alias("max_staleness_days")) \
        .withColumn("stale_warning", F.col("max_staleness_days") > limit)


# --- G7 / G8 / G9 / G10 -------------------------------------------------------
def _long(df: DataFrame, cols: list[str], side: str) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                             for c in present]))
    return df.select(kv.alias("kv")).select("kv.feature", "kv.value", F.lit(side).alias("side")) \
        .where(F.col("value").isNotNull() & ~F.isnan("value"))


def mean_shift(base: DataFrame, new: DataFrame, cols: list[str] = DRIFT_NUMERIC_COLUMNS) -> DataFrame:
    """|mean_new - mean_base| / std_base (sample std; 0 when std is 0), >= 5 rows each side."""
    long = _long(base, cols, "base").unionByName(_long(new, cols, "new"))
    s = long.groupBy("feature").agg(
        F.count_if(F.col("side") == "base").alias("n_base"),
        F.count_if(F.col("side") == "new").alias("n_new"),
        F.avg(F.when(F.col("side") == "base", F.col("value"))).alias("base_mean"),
        F.stddev_samp(F.when(F.col("side") == "base", F.col("value"))).alias("base_std"),
        F.avg(F.when(F.col("side") == "new", F.col("value"))).alias("new_mean"))
    s = s.where((F.col("n_base") >= DRIFT_MIN_ROWS) & (F.col("n_new") >= DRIFT_MIN_ROWS))
    shift = F.when(F.col("base_std") > 0, F.abs(F.col("new_mean") - F.col("base_mean")) / F.col("base_std")) \
        .otherwise(F.lit(0.0))
    return s.withColumn("std_shift", shift).withColumn("shift_flag", F.col("std_shift") > DRIFT_STD_THRESHOLD)


KS_SERIES_SWITCH = 1.18       # below it the dual series converges faster
KS_TERMS = 12                 # of either series; at the switch its 12th term is far below double precision


def ks_pvalue(d: Column, en: Column) -> Column:
    """Asymptotic Kolmogorov tail at lambda = sqrt(en) * D, clamped to [0, 1].

    Q = 2 sum (-1)^(k-1) exp(-2 k^2 lambda^2) needs about 1/lambda terms, so for a small lambda
    its dual form 1 - sqrt(2 pi)/lambda sum exp(-(2k-1)^2 pi^2 / (8 lambda^2)) is summed instead.
    """
    lam = F.sqrt(en) * d
    ks = [float(k) for k in range(1, KS_TERMS + 1)]
    alternating = sum((F.exp(F.lit(-2.0 * k * k) * lam * lam) * (2.0 if k % 2 else -2.0) for k in ks), F.lit(0.0))
    dual = sum((F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi ** 2 / 8) / (lam * lam)) for k in ks), F.lit(0.0))
    value = F.when(lam < KS_SERIES_SWITCH, F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * dual).otherwise(alternating)
    return F.when(d <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), value)))


KS_EXACT_ROWS = 10_000         # rows of the larger sample up to which the exact distribution is worth its n x m steps


def ks_exact_pvalue(n: int, m: int, d: float) -> float:
    """P(D >= d) of the two-sample KS statistic for samples of n and m rows without ties, exact.

    A random order of both samples is a lattice path from (0, 0) to (n, m).  With ``out(i, j)`` the probability that a path
    to (i, j) has left the band |i/n - j/m| < d, the last step gives out(i, j) = (i out(i-1, j) + j out(i, j-1)) / (i + j),
    and 1 beyond the band.  One array of n + 1 numbers goes through the diagonals i + j = 1 .. n + m.
    """
    limit = round(d * n * m)                                     # D is a whole multiple of 1 / (n m)
    if limit <= 0:
        return 1.0
    i = np.arange(n + 1, dtype=np.int64)
    out = np.zeros(n + 1)
    for s in range(1, n + m + 1):
        lo, hi = max(0, s - m), min(n, s)
        at = i[lo:hi + 1]
        j = s - at
        from_left = np.where(at > 0, at * out[np.maximum(at - 1, 0)], 0.0)
        from_below = np.where(j > 0, j * out[lo:hi + 1], 0.0)
        out[lo:hi + 1] = np.where(np.abs(at * m - j * n) >= limit, 1.0, (from_left + from_below) / s)
    return float(out[n])


def _exact_pvalues(rows: int):
    def run(batches):
        for batch in batches:
            n, m, d = (batch.column(c).to_pylist() for c in ("n_base", "n_new", "ks_stat"))
            exact = [ks_exact_pvalue(a, b, x) if max(a, b) <= rows else None for a, b, x in zip(n, m, d)]
            yield batch.append_column("exact", pa.array(exact, pa.float64()))
    return run


def ks_two_sample(base: DataFrame, new: DataFrame, cols: list[str] = DRIFT_NUMERIC_COLUMNS, exact_rows: int = 0) -> DataFrame:
    """Two-sample KS statistic and p-value per column: asymptotic, or, for samples of up to ``exact_rows``
    rows (``KS_EXACT_ROWS``), exact (a row a column goes through Python then).

    Counts per (column, value) first, then exact running totals per column
    (by value ranges, see ``running_totals``); D = max |F_base - F_new|.
    """
    long = _long(base, cols, "base").unionByName(_long(new, cols, "new"))
    vc = long.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == "base").alias("nb"), F.count_if(F.col("side") == "new").alias("nn"))
    cum = running_totals(vc, ["feature"], "value", ["nb", "nn"])
    gap = F.abs(F.col("cum_nb") / F.col("nb_total") - F.col("cum_nn") / F.col("nn_total"))
    ks = cum.groupBy("feature").agg(F.max(gap).alias("ks_stat"), F.first("nb_total").alias("n_base"),
                                   F.first("nn_total").alias("n_new"))
    ks = ks.where((F.col("n_base") >= DRIFT_MIN_ROWS) & (F.col("n_new") >= DRIFT_MIN_ROWS))
    en = F.col("n_base") * F.col("n_new") / (F.col("n_base") + F.col("n_new"))
    p = ks_pvalue(F.col("ks_stat"), en)
    if exact_rows:
        ks = ks.mapInArrow(_exact_pvalues(exact_rows), ks.schema.simpleString()[len("struct<"):-1].replace(":", " ") + ", exact double")
        p = F.coalesce("exact", p)
    return ks.withColumn("ks_pval", p).drop("exact") \
        .withColumn("ks_flag", F.col("ks_pval") < DRIFT_KS_P_LIMIT)


def process_share_drift(base: DataFrame, new: DataFrame, key: str = "process_code") -> DataFrame:
    """Process shares over the key union; flag when |diff| > 0.15."""
    return share_comparison(base, new, key).withColumn("share_flag", F.col("diff") > DRIFT_PROCESS_SHARE_LIMIT)


def drift_verdict(base: DataFrame, new: DataFrame, use_ks: bool = True) -> DataFrame:
    """Overall drift = any numeric flag (KS, or mean shift without KS) or share flag."""
    if use_ks:
        num = ks_two_sample(base, new).agg(F.coalesce(F.bool_or("ks_flag"), F.lit(False)).alias("numeric_drift"),
                                            F.count_if("ks_flag").alias("n_numeric_flags"))
    else:
        num = mean_shift(base, new).agg(F.coalesce(F.bool_or("shift_flag"), F.lit(False)).alias("numeric_drift"),
                                         F.count_if("shift_flag").alias("n_numeric_flags"))
    cat = process_share_drift(base, new).agg(
        F.coalesce(F.bool_or("share_flag"), F.lit(False)).alias("process_drift"),
        F.count_if("share_flag").alias("n_process_flags"))
    out = attach_row(num, cat)
    return out.withColumn("drift_detected", F.col("numeric_drift") | F.col("process_drift"))


# --- G29 / G33 / G34 -------------------------------------------------------
def label_source_mix(df: DataFrame) -> DataFrame:
    """Rows and share per cost label source."""
    c = df.groupBy("cost_label_source").agg(F.count(F.lit(1)).alias("n"))
    tot = c.agg(F.sum("n").alias("__t"))
    return attach_row(c, tot).select("cost_label_source", "n", (F.col("n") / F.col("__t")).alias("share"))


def price_freshness(prices: DataFrame, as_of: _dt.date, warn_days: int = STALE_PRICE_DAYS) -> DataFrame:
    """Latest price date per material, its age and OK / WARN."""
    latest = prices.groupBy("material_code").agg(F.max("date").alias("latest_date"))
    age = F.datediff(F.lit(as_of), F.col("latest_date"))
    return latest.withColumn("age_days", age).withColumn(
        "status", F.when(F.col("age_days") >= warn_days, F.lit("WARN")).otherwise(F.lit("OK")))


def row_funnel(extracted: DataFrame, geometry: DataFrame, annotated: DataFrame) -> DataFrame:
    """Extracted rows by first loss cause (no geometry, validation bucket, kept)."""
    usable = geometry.where(F.col("bounding_box_x").isNotNull()).select("part_id").distinct()
    lost = extracted.join(usable, "part_id", "left_anti").agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit("no_geometry").alias("cause"), "rows")
    val = annotated.groupBy(F.coalesce(F.col("reject_bucket"), F.lit("kept")).alias("cause")) \
        .agg(F.count(F.lit(1)).alias("rows"))
    return lost.unionByName(val)
