"""Exact order statistics without sending a whole group to one task.

Exact medians (G1, G2, M1), cumulative distributions (KS, W6) and bucketed
histograms all need a running count in value order inside a group.  A plain
``Window.partitionBy(group).orderBy(value)`` sorts every value of a group in
one task, and one process code can hold a third of all rows.  Instead:

1. collapse the data to distinct ``(group, value, count)`` rows (partial
   aggregation before the shuffle; the shuffle key includes the value);
2. range-partition those by ``(group, value)`` into as many partitions as the
   session shuffles into, and write them with their partition number;
3. running totals of the per-partition counts (one row per group and partition)
   give each partition's offset, attached from a table whose size Spark knows;
4. a window over ``(group, partition)`` adds the running count inside the
   partition.  The ranges only balance the work; the result is exact, because
   all values of a range are seen by that range's task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgeline.operators.common import join_null_safe
from forgeline.session import materialize


def running_totals(vc: DataFrame, group_cols: list[str], order_cols: str | list[str],
                   weight_cols: list[str], total_suffix: str | None = "_total") -> DataFrame:
    """Inclusive running sums of ``weight_cols`` in ``order_cols`` order per group.

    ``vc`` must hold one row per distinct group and ``order_cols`` value.  Adds
    ``cum_<w>`` (inclusive running sum) and, when ``total_suffix`` is set,
    ``<w><suffix>`` (group total) columns.
    """
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    n = int(vc.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = vc.repartitionByRange(n, *group_cols, *order).withColumn("__range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    totals = ranged.groupBy(*group_cols, "__range").agg(*[F.sum(w).alias(f"__bt_{w}") for w in weight_cols])
    prev = Window.partitionBy(*group_cols).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_cols)
    offsets = materialize(totals.select(
        *group_cols, "__range",
        *[F.coalesce(F.sum(f"__bt_{w}").over(prev), F.lit(0)).alias(f"__off_{w}") for w in weight_cols],
        *([F.sum(f"__bt_{w}").over(whole).alias(f"{w}{total_suffix}") for w in weight_cols]
          if total_suffix else []),
    ), "offsets")
    out = join_null_safe(ranged, offsets, group_cols + ["__range"])
    inner = (Window.partitionBy(*group_cols, "__range").orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for w in weight_cols:
        out = out.withColumn(f"cum_{w}", F.col(f"__off_{w}") + F.sum(w).over(inner))
    return out.drop("__range", *[f"__off_{w}" for w in weight_cols])


def value_counts(df: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    """Distinct (group, value) rows with their multiplicity; NULL values dropped."""
    return (df.where(F.col(value_col).isNotNull() & ~F.isnan(F.col(value_col)))
            .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("__n")))


def exact_median(df: DataFrame, group_cols: list[str], value_col: str,
                 out_col: str = "median") -> DataFrame:
    """Exact median per group (mean of the two middle values, NULLs ignored).

    Returns one row per group that has at least one non-null value.
    """
    d, gcols = df.select(*group_cols, value_col), list(group_cols)
    return _median_of_counts(value_counts(d, gcols, value_col), gcols, value_col, out_col)


def _median_of_counts(vc: DataFrame, gcols: list[str], value_col: str, out_col: str) -> DataFrame:
    """Exact median per group from distinct (group, value) rows with their multiplicity ``__n``."""
    cum = running_totals(vc, gcols, value_col, ["__n"])
    lo = F.floor((F.col("__n_total") - 1) / 2)
    hi = F.ceil((F.col("__n_total") - 1) / 2)
    first_rank = F.col("cum___n") - F.col("__n")      # 0-based rank of the first copy
    last_rank = F.col("cum___n") - 1
    cov_lo = (first_rank <= lo) & (lo <= last_rank)
    cov_hi = (first_rank <= hi) & (hi <= last_rank)
    picked = cum.where(cov_lo | cov_hi).groupBy(*gcols).agg(
        F.max(F.when(cov_lo, F.col(value_col))).alias("__lo"),
        F.max(F.when(cov_hi, F.col(value_col))).alias("__hi"))
    out = picked.select(*gcols, ((F.col("__lo") + F.col("__hi")) / 2.0).alias(out_col))
    return out


def exact_percentiles(df: DataFrame, group_cols: list[str], value_col: str, probs: list[float],
                      names: list[str]) -> DataFrame:
    """Exact interpolated percentiles per group (same rule as SQL ``percentile_cont``)."""
    d, gcols = df.select(*group_cols, value_col), list(group_cols)
    vc = value_counts(d, gcols, value_col)
    cum = running_totals(vc, gcols, value_col, ["__n"])
    first_rank = F.col("cum___n") - F.col("__n")
    last_rank = F.col("cum___n") - 1
    conds, aggs = [], []
    for p, name in zip(probs, names):
        pos = (F.col("__n_total") - 1) * F.lit(float(p))
        for side, r in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            cov = (first_rank <= r) & (r <= last_rank)
            conds.append(cov)
            aggs.append(F.max(F.when(cov, F.col(value_col))).alias(f"__{name}_{side}"))
        aggs.append(F.first(pos - F.floor(pos)).alias(f"__{name}_frac"))
    keep = conds[0]
    for c in conds[1:]:
        keep = keep | c
    picked = cum.where(keep).groupBy(*gcols).agg(*aggs)
    out = picked.select(*gcols, *[
        (F.col(f"__{n}_lo") + (F.col(f"__{n}_hi") - F.col(f"__{n}_lo")) * F.col(f"__{n}_frac")).alias(n)
        for n in names])
    return out


def exact_medians(df: DataFrame, group_cols: list[str], value_cols: list[str]) -> DataFrame:
    """Exact medians of several columns in one pass (long form, then pivot back).

    Returns group columns plus one ``<col>`` column of medians per value column.
    """
    d, gcols = df, list(group_cols)
    long = d.select(*gcols, F.explode(F.array(*[
        F.struct(F.lit(c).alias("__col"), F.col(c).cast("double").alias("__v")) for c in value_cols
    ])).alias("__kv")).select(*gcols, "__kv.__col", "__kv.__v")
    med = exact_median(long, gcols + ["__col"], "__v", "__m")
    wide = med.groupBy(*gcols).pivot("__col", value_cols).agg(F.first("__m"))
    return wide


def exact_medians_of_counts(counts: DataFrame, group_cols: list[str], name_col: str, value_col: str, n_col: str,
                            value_cols: list[str]) -> DataFrame:
    """``exact_medians`` from kept counts: one row per distinct (group, column name, value) with its multiplicity."""
    gcols = list(group_cols)
    med = _median_of_counts(counts.select(*gcols, name_col, value_col, F.col(n_col).alias("__n")), gcols + [name_col], value_col, "__m")
    return med.groupBy(*gcols).pivot(name_col, value_cols).agg(F.first("__m"))
