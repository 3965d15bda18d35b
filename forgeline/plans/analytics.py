"""Feature and price analytics from the reports and notebook.

All are grouped aggregates over a long (feature, class, value) table or a
small per-material price series; nothing is pivoted through the driver
except the k x k correlation matrix for VIF (k = 14 features).
"""

from __future__ import annotations

from itertools import combinations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgeline.constants import FEATURE_COLUMNS
from forgeline.operators.quantiles import exact_percentiles

SENSITIVITY_STEPS = [-0.5, -0.4, -0.3, -0.2, -0.1, 0.0, 0.1, 0.2, 0.3, 0.4, 0.5]


def _long(df: DataFrame, cols: list[str], label_col: str) -> DataFrame:
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                             for c in cols]))
    return df.select(F.col(label_col).alias("label"), kv.alias("kv")).select("label", "kv.feature", "kv.value") \
        .where(F.col("value").isNotNull())


def anova_f(df: DataFrame, cols: list[str] = FEATURE_COLUMNS, label_col: str = "process_code") -> DataFrame:
    """One-way ANOVA F statistic of each feature across classes."""
    g = _long(df.where(F.col(label_col).isNotNull()), cols, label_col).groupBy("feature", "label").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"), F.coalesce(F.var_samp("value"), F.lit(0.0)).alias("v"))
    stats = g.groupBy("feature").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_classes"),
                                     (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"))
    g = g.join(stats, "feature")                           # <= classes rows per feature
    s = g.groupBy("feature").agg(
        F.sum(F.col("n") * (F.col("m") - F.col("grand")) ** 2).alias("ssb"),
        F.sum((F.col("n") - 1) * F.col("v")).alias("ssw"), F.first("n_rows").alias("n_rows"),
        F.first("n_classes").alias("n_classes"))
    return s.select("feature", F.try_divide(F.col("ssb") / (F.col("n_classes") - 1),
                                            F.col("ssw") / (F.col("n_rows") - F.col("n_classes"))).alias("f_stat"),
                    "n_classes", "n_rows")


def correlation_pairs(df: DataFrame, cols: list[str] = FEATURE_COLUMNS, limit: float = 0.8) -> DataFrame:
    """Pearson r for every feature pair in one aggregation, flagged above ``limit``."""
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    long = row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                                                   F.col(f"{a}__{b}").alias("r")) for a, b in pairs])).alias("p"))
    return long.select("p.*").withColumn("high", F.abs("r") > limit)


def vif(df: DataFrame, cols: list[str] = FEATURE_COLUMNS, tolerance: float = 1e-9) -> list[tuple[str, float | None]]:
    """Variance inflation factors 1 / (1 - R^2) from the k x k correlation matrix (on the driver).

    All correlations are taken over the rows where every column is present.  A column that
    the others determine has an infinite factor; one that does not vary has none (None).
    """
    whole = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    spread = whole.agg(*[F.stddev_pop(c).alias(c) for c in cols]).first()
    varies = [c for c in cols if spread[c]]
    rs = {(r.feature_a, r.feature_b): r.r for r in correlation_pairs(whole, varies).collect()} if len(varies) > 1 else {}
    m = np.eye(len(varies))
    for i, a in enumerate(varies):
        for j, b in enumerate(varies[:i]):
            m[i, j] = m[j, i] = rs[b, a]
    out: dict[str, float | None] = dict.fromkeys(cols)
    for i, c in enumerate(varies):
        rest = [j for j in range(len(varies)) if j != i]
        values, vectors = np.linalg.eigh(m[np.ix_(rest, rest)]) if rest else (np.zeros(0), np.zeros((0, 0)))
        kept = values > tolerance * max(1.0, values.max(initial=0.0))
        along = (vectors.T @ m[rest, i])[kept] if rest else np.zeros(0)
        unexplained = 1.0 - float((along ** 2 / values[kept]).sum())
        out[c] = math.inf if unexplained < tolerance else 1.0 / unexplained
    return [(c, out[c]) for c in cols]


def class_feature_stats(df: DataFrame, feature: str, label_col: str = "process_code") -> DataFrame:
    """Per-class mean, sample std, quartiles (exact) and undercut rate."""
    base = df.where(F.col(label_col).isNotNull())
    s = base.groupBy(label_col).agg(F.avg(feature).alias("mean"), F.stddev_samp(feature).alias("std"),
                                    F.avg(F.col("undercut_flag").cast("double")).alias("undercut_rate"),
                                    F.count(F.lit(1)).alias("n"))
    q = exact_percentiles(base, [label_col], feature, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    return s.join(q, label_col, "left")


def sensitivity_grid(df: DataFrame, steps: list[float] = SENSITIVITY_STEPS) -> DataFrame:
    """Each part x price multiplier, as an explode of a literal array (no cross join)."""
    return df.select("*", F.explode(F.array(*[F.lit(s) for s in steps])).alias("price_change"))


def price_sensitivity(df: DataFrame, price_col: str = "material_price_per_kg") -> DataFrame:
    """Per process, slope of % cost change on % price change over the grid (fallback formula)."""
    from forgeline.plans.scoring import fallback_estimate
    g = sensitivity_grid(df)
    cost = fallback_estimate(F.col("volume"), F.col(price_col) * (1 + F.col("price_change")), F.col("quantity"))
    base = fallback_estimate(F.col("volume"), F.col(price_col), F.col("quantity"))
    g = g.select("process_code", "price_change", cost["total_cost"].alias("c"), base["total_cost"].alias("c0")) \
        .where(F.col("c0") > 0)
    return g.groupBy("process_code").agg(
        F.regr_slope((F.col("c") - F.col("c0")) / F.col("c0"), F.col("price_change")).alias("sensitivity"),
        F.count(F.lit(1)).alias("n"))


def outage_error_drift(prices: DataFrame, lags: list[int] = (0, 7, 30)) -> DataFrame:
    """Error from using a price ``lag`` days old: mean |p(t-lag) - p(t)| / p(t) per lag."""
    daily = prices.groupBy("material_code", "date").agg(F.min_by("price_usd_per_kg", "seq").alias("p"))
    old = daily.select("material_code", F.col("date").alias("old_date"), F.col("p").alias("p_old"))
    out = []
    for lag in lags:
        j = daily.join(old, (daily.material_code == old.material_code)
                       & (old.old_date == F.date_sub(daily.date, int(lag)))).select(
            F.lit(int(lag)).alias("lag_days"), (F.abs(F.col("p_old") - F.col("p")) / F.col("p")).alias("e"))
        out.append(j.groupBy("lag_days").agg(F.avg("e").alias("mean_abs_rel_error"), F.count(F.lit(1)).alias("n")))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res
