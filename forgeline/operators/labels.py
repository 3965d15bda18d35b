"""Cost label building (L1-L3).

The per-process ratio table is a fixed 10-row literal, so it is a literal
map lookup inside the projection: no join, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.constants import COST_COMPONENT_COLUMNS, DECOMPOSITION_RATIOS, DEFAULT_RATIOS


def _ratios(process):
    def row(ratios):
        return F.array(*[F.lit(float(r)) for r in ratios])
    return F.coalesce(F.try_element_at(F.create_map(*[c for p, r in DECOMPOSITION_RATIOS.items() for c in (F.lit(p), row(r))]), process),
                      row(DEFAULT_RATIOS))


def build_labels(df: DataFrame, decomposed_label: str = "estimated") -> DataFrame:
    """L1/L2: complete the five cost components of every row.

    * cost_total NULL or <= 0: row untouched;
    * all five components present and >= 0: source 'exact' (no sum check);
    * otherwise all five are overwritten with round(total * ratio, 2) and the
      source becomes ``decomposed_label`` ('estimated' in the reference).
    """
    if "cost_total" not in df.columns:
        return df
    out = df
    for c in COST_COMPONENT_COLUMNS:                       # L2
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("double"))
    if "cost_label_source" not in out.columns:
        out = out.withColumn("cost_label_source", F.lit("estimated"))
    total = F.col("cost_total").cast("double")
    usable = total.isNotNull() & ~F.isnan(total) & (total > 0)
    complete = F.lit(True)
    for c in COST_COMPONENT_COLUMNS:
        complete = complete & F.coalesce(F.col(c) >= 0, F.lit(False))
    proc = F.col("process_code") if "process_code" in out.columns else F.lit(None).cast("string")
    # decide per row before any component is overwritten
    out = out.withColumn("__lbl", F.when(usable & complete, F.lit(1)).when(usable, F.lit(2)).otherwise(F.lit(0)))
    decompose = F.col("__lbl") == 2
    # by a higher-order function: five roundings in a row make a method too long for the JVM to compile
    out = out.withColumn("__parts", F.when(decompose, F.transform(_ratios(proc), lambda r: F.round(total * r, 2))))
    for i, c in enumerate(COST_COMPONENT_COLUMNS):
        out = out.withColumn(c, F.when(decompose, F.col("__parts")[i]).otherwise(F.col(c).cast("double")))
    src = (F.when(F.col("__lbl") == 1, F.lit("exact"))
           .when(F.col("__lbl") == 2, F.lit(decomposed_label))
           .otherwise(F.col("cost_label_source")))
    return out.withColumn("cost_label_source", src).drop("__lbl", "__parts")


def components_sum_check(df: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """L3: flag rows whose components do not add up to the total (within ``tolerance``)."""
    s = sum(F.coalesce(F.col(c), F.lit(0.0)) for c in COST_COMPONENT_COLUMNS)
    return df.withColumn("components_sum", F.round(s, 2)).withColumn(
        "components_match_total", F.abs(F.col("cost_total") - s) <= F.lit(tolerance))
