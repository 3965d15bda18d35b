"""Cleaning, imputation, encoding and derived features.

Every step is a Column expression; the only aggregates (process medians,
overall medians, hole-diameter mean) are computed once as small tables and
attached with a join, never with a window over raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.constants import (
    DEFAULT_SURFACE_FINISH_RA, DEFAULT_TOLERANCE_INDEX, HOLE_DIAMETER_FALLBACK,
    PIPELINE_MATERIAL_FAMILY, PIPELINE_PROCESS_CODE, SURFACE_FINISH_PRESETS,
    THIN_WALL_MM, TOLERANCE_IT_INDEX, WALL_IMPUTE_FALLBACK,
)
from forgeline.operators.common import attach_row, join_null_safe, lookup
from forgeline.operators.quantiles import exact_medians
from forgeline.session import materialize

WALL_COLUMNS = ["wall_thickness_min", "wall_thickness_avg"]


# --- scalar expressions ----------------------------------------------------
def clean_process(c: Column) -> Column:
    """Trim + lower case (NULL stays NULL)."""
    return F.lower(F.trim(c))


def clean_upper(c: Column) -> Column:
    """Trim + upper case for material and tolerance codes."""
    return F.upper(F.trim(c))


def tolerance_index(band: Column, as_double: bool = True) -> Column:
    """IT4..IT12 -> 1..9, anything else -> 5."""
    v = F.coalesce(lookup(TOLERANCE_IT_INDEX, band), F.lit(DEFAULT_TOLERANCE_INDEX))
    return v.cast("double") if as_double else v.cast("int")


def surface_finish_ra(text: Column) -> Column:
    """Preset name -> Ra; numeric text -> number; otherwise / NULL -> 3.2."""
    key = F.lower(F.trim(text))
    return F.coalesce(lookup(SURFACE_FINISH_PRESETS, key),
                      F.trim(text).try_cast("double"),
                      F.lit(DEFAULT_SURFACE_FINISH_RA))


def encode(mapping: dict, c: Column) -> Column:
    """Literal-map encoding, unknown -> 0."""
    return F.coalesce(lookup(mapping, c), F.lit(0)).cast("int")


def safe_log1p(c: Column) -> Column:
    """P8 (cost variant): log(v+1) for v >= 0, else 0."""
    return F.when(c >= 0, F.log1p(c)).otherwise(F.lit(0.0))


def thin_wall_flag(wall_min: Column) -> Column:
    """wall_thickness_min < 1.5 -> 1, NULL -> 0."""
    return F.coalesce((wall_min < THIN_WALL_MM).cast("int"), F.lit(0))


# --- frame steps -----------------------------------------------------------
def clean_codes(df: DataFrame) -> DataFrame:
    """P1 over the code columns that are present."""
    out = df
    if "process_code" in df.columns:
        out = out.withColumn("process_code", clean_process(F.col("process_code")))
    for c in ("material_code", "tolerance_band"):
        if c in df.columns:
            out = out.withColumn(c, clean_upper(F.col(c)))
    return out


def impute_walls(df: DataFrame, group_col: str = "process_code", medians: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """G1: wall min/avg NULL -> own-process median -> overall median -> 1.5.

    Adds ``<col>_imputed`` flags taken before the fill.  NULL process codes
    form their own group.  Medians are exact (see ``quantiles``); ``medians`` (per group, overall)
    are used in their place where they are kept elsewhere.
    """
    cols = [c for c in WALL_COLUMNS if c in df.columns]
    if not cols:
        return df
    out = df
    for c in cols:
        out = out.withColumn(f"{c}_imputed", F.col(c).isNull().cast("int"))
    overall = exact_medians(df.select(*cols), [], cols) if medians is None else medians[1]
    overall = overall.select(*[F.col(c).alias(f"__all_{c}") for c in cols])
    if group_col in df.columns:
        grp = exact_medians(df.select(group_col, *cols), [group_col], cols) if medians is None else medians[0]
        # a row per process: written, so that its size is known when the orders meet it
        grp = materialize(grp.select(group_col, *[F.col(c).alias(f"__grp_{c}") for c in cols]), "medians")
        out = join_null_safe(out, grp, [group_col], "left")
    out = attach_row(out, _ensure_row(overall, [f"__all_{c}" for c in cols]))
    for c in cols:
        parts = [F.col(c)]
        if group_col in df.columns:
            parts.append(F.col(f"__grp_{c}"))
        parts += [F.col(f"__all_{c}"), F.lit(WALL_IMPUTE_FALLBACK)]
        out = out.withColumn(c, F.coalesce(*parts))
    return out.drop(*[f"__grp_{c}" for c in cols], *[f"__all_{c}" for c in cols])


def _ensure_row(one_row: DataFrame, cols: list[str]) -> DataFrame:
    """A one-row frame even when the aggregate input was empty (all NULL then)."""
    return one_row.agg(*[F.max(c).alias(c) for c in cols])


def fill_constants(df: DataFrame) -> DataFrame:
    """Constant defaults for counts, flags and scores; label source 'estimated'."""
    out = df
    if "hole_count" in df.columns:
        out = out.withColumn("hole_count", F.coalesce(F.col("hole_count"), F.lit(0)).cast("int"))
    if "undercut_flag" in df.columns:
        out = out.withColumn("undercut_flag", F.coalesce(F.col("undercut_flag"), F.lit(0)).cast("int"))
    if "symmetry_score" in df.columns:
        out = out.withColumn("symmetry_score", F.coalesce(F.col("symmetry_score"), F.lit(0.5)))
    if "curvature_complexity" in df.columns:
        out = out.withColumn("curvature_complexity", F.coalesce(F.col("curvature_complexity"), F.lit(0.0)))
    if "cost_label_source" in df.columns:
        out = out.withColumn("cost_label_source", F.coalesce(F.col("cost_label_source"), F.lit("estimated")))
    return out


def impute_hole_diameter(df: DataFrame, mean: DataFrame | None = None) -> DataFrame:
    """hole_diameter_min NULL -> column mean (or the one value of ``mean``) -> 5.0."""
    if "hole_diameter_min" not in df.columns:
        return df
    mean = df.agg(F.avg("hole_diameter_min").alias("__mean_hd")) if mean is None else mean.toDF("__mean_hd")
    out = attach_row(df, mean)
    return out.withColumn("hole_diameter_min", F.coalesce(
        F.col("hole_diameter_min"), F.col("__mean_hd"), F.lit(HOLE_DIAMETER_FALLBACK))).drop("__mean_hd")


def normalize(df: DataFrame, process_map: dict = PIPELINE_PROCESS_CODE,
              material_map: dict = PIPELINE_MATERIAL_FAMILY, wall_medians: tuple[DataFrame, DataFrame] | None = None,
              hole_mean: DataFrame | None = None) -> DataFrame:
    """The ETL normalise stage, in the order its results depend on.

    ``wall_medians`` and ``hole_mean`` stand for the statistics of all rows where these are kept elsewhere.
    """
    out = clean_codes(df)
    out = impute_walls(out, medians=wall_medians)
    out = fill_constants(impute_hole_diameter(out, hole_mean))
    cols = out.columns
    if "process_code" in cols:
        out = out.withColumn("process_code_encoded", encode(process_map, F.col("process_code")))
    if "material_code" in cols:
        out = out.withColumn("material_code_encoded", encode(material_map, F.col("material_code")))
    if "quantity" in cols:
        out = out.withColumn("log_quantity", F.log1p(F.col("quantity").cast("double")))
        if "batch_size" not in cols:
            out = out.withColumn("batch_size", F.col("quantity"))
        else:
            out = out.withColumn("batch_size", F.coalesce(F.col("batch_size"), F.col("quantity")))
    if "volume" in cols and "material_price_per_kg" in cols:
        out = out.withColumn("volume_x_price", F.col("volume") * F.col("material_price_per_kg") / 1e6)
    else:
        out = out.withColumn("volume_x_price", F.lit(0.0))
    if "surface_finish_ra" in cols:
        out = out.withColumn("surface_finish_ra", surface_finish_ra(F.col("surface_finish_ra").cast("string")))
    else:
        out = out.withColumn("surface_finish_ra", F.lit(DEFAULT_SURFACE_FINISH_RA))
    if "tolerance_band" in cols:
        out = out.withColumn("tolerance_index", tolerance_index(F.col("tolerance_band")))
    else:
        out = out.withColumn("tolerance_index", F.lit(float(DEFAULT_TOLERANCE_INDEX)))
    if "wall_thickness_min" in cols:
        out = out.withColumn("thin_wall_flag", thin_wall_flag(F.col("wall_thickness_min")))
    return out
