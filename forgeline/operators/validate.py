"""Row validation with rejected rows kept and explained.

``annotate`` evaluates every rule as a Column predicate in one projection and
keeps all failures; the reported reason is the **last** failing rule in rule
order (the reference overwrites its reason dict), with duplicates last.
Clean and rejected rows are two filters over the same annotated frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.constants import (
    DUPLICATE_KEY, DUPLICATE_REASON, FEATURE_RANGES, FEATURE_REQUIRED,
    HISTORICAL_AVG_PRICE_FILL, REQUEST_FINISH_PRESETS, REQUEST_SOURCE_FORMATS, REQUEST_TOLERANCES, THIN_WALL_MM,
    VALIDATION_RULES, VOLUME_BOX_TOLERANCE,
)
from forgeline.operators.marks import marked
from forgeline.session import materialize


FAILURES = "array<struct<bucket:string,column:string,text:string>>"


class MissingRequiredColumn(ValueError):
    """V1: a column with a 'required' null policy is absent."""


def check_required_columns(df: DataFrame, rules=VALIDATION_RULES) -> None:
    """V1: fail before any plan is built when a required column is absent."""
    for col, _t, policy, *_ in rules:
        if col not in df.columns and policy == "required":
            raise MissingRequiredColumn(f"Missing required column {col}")


def _failure(reason_text: Column, bucket: str, column: str, cond: Column) -> Column:
    return F.when(cond, F.struct(F.lit(bucket).alias("bucket"),
                                 F.lit(column).cast("string").alias("column"),
                                 reason_text.cast("string").alias("text")))


def failing(failures: list[Column]) -> Column:
    """The failures of a row, in rule order.

    Compiled, unlike a filter over an array of all failures; the last one is filtered so that the projection stays
    out of one generated loop, whose method would be too long for the JVM to compile.
    """
    if not failures:
        return F.array().cast(FAILURES)
    *first, last = failures
    none = F.array().cast(FAILURES)
    return F.concat(*[F.when(f.isNotNull(), F.array(f)).otherwise(none) for f in first], F.array_compact(F.array(last)))


def apply_rules(df: DataFrame, rules=VALIDATION_RULES) -> tuple[DataFrame, list[Column]]:
    """V2-V5: fills, casts and rule predicates for the columns present.

    Returns the filled/cast frame and the ordered list of failure structs.
    """
    out = df
    failures: list[Column] = []
    for col, typ, policy, rng, allowed, default in rules:
        if col not in out.columns:
            continue
        c = F.col(col)
        if policy in ("required", "drop_row"):                        # V2
            failures.append(_failure(F.lit(f"Null value in required column '{col}'"),
                                     "Null", col, c.isNull()))
        elif policy == "default_value" and default is not None:
            out = out.withColumn(col, F.coalesce(c, F.lit(default)))
        elif policy == "fallback_to_historical_avg" and col == "material_price_per_kg":
            out = out.withColumn(col, F.coalesce(c, F.lit(HISTORICAL_AVG_PRICE_FILL)))
        if typ == "int":                                              # V3
            out = out.withColumn(col, F.coalesce(F.col(col).try_cast("double"), F.lit(0.0)).try_cast("int"))
        elif typ == "float":
            out = out.withColumn(col, F.col(col).try_cast("double"))
        v = F.col(col)
        if rng is not None and typ in ("int", "float"):               # V4
            lo, hi = float(rng[0]), float(rng[1])
            bad = v.isNotNull() & ~F.isnan(v.cast("double")) & ((v < lo) | (v > hi))
            text = F.format_string(f"Column '{col}' value %s out of range [{rng[0]}, {rng[1]}]",
                                   v.cast("string"))
            failures.append(_failure(text, f"Column '{col}'", col, bad))
        if allowed is not None:                                       # V5
            # text columns: NULL became the text 'None' upstream, which is never allowed
            bad = (~v.isin(allowed)) if typ != "string" else (v.isNull() | ~v.isin(allowed))
            bad = F.coalesce(bad, F.lit(False))
            text = F.format_string(f"Column '{col}' value '%s' not in allowed list",
                                   F.coalesce(v.cast("string"), F.lit("None")))
            failures.append(_failure(text, f"Column '{col}'", col, bad))
    return out, failures


def cast_failures(df: DataFrame, rules=VALIDATION_RULES) -> DataFrame:
    """V3: per numeric column the number of non-null values that are no numbers (they become NULL, or 0 for ints)."""
    cols = [r[0] for r in rules if r[1] in ("int", "float") and r[0] in df.columns]
    one = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in cols])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_failed")) for c in cols])).alias("r")).select("r.*")


def flag_duplicates(df: DataFrame, key=DUPLICATE_KEY, order=("completion_date", "order_id"),
                    out_col: str = "__dup", row_col: str = "__row") -> DataFrame:
    """Mark every row but the first per key (first = smallest ``order`` tuple, then row number).

    The rows are written with a number each (unless ``row_col`` has one already).  The first
    row's number per key is a grouped ``min`` of a narrow struct (partial aggregation, so a hot
    key never sits in one task); whatever is not the first is a duplicate.  The rows themselves are not shuffled
    (see ``marked``).
    """
    order = [c for c in order if c in df.columns]
    if row_col not in df.columns:
        df = materialize(df.withColumn(row_col, F.monotonically_increasing_id()), "numbered")
    first = df.groupBy(*key).agg(F.min(F.struct(*order, row_col)).alias("__first")).select(F.col(f"__first.{row_col}").alias("__first_row"))
    return marked(df, first, "__first_row", row_col, {out_col: F.lit(True)}).withColumn(out_col, ~F.col(out_col)).drop(row_col)


def annotate(df: DataFrame, rules=VALIDATION_RULES, dedupe: bool = True,
             dedupe_after_rules: bool = False, duplicate_col: str | None = None) -> DataFrame:
    """V2-V7: filled frame plus ``reject_bucket`` / ``reject_column`` / ``reject_reason``
    (NULL for clean rows) and ``reject_reasons`` (every failing rule's text).

    Order of work: fills, casts and every rule in one projection, written once with the failures
    and a number per row; the duplicate flag and the verdict columns are computed over that
    table, so later filters on the verdict never meet the large rule expression.  ``duplicate_col``
    names a column that tells the duplicates already (it is dropped).
    """
    check_required_columns(df, rules)
    filled, failures = apply_rules(df, rules)
    rows = materialize(filled.withColumn("__fails", failing(failures))
                       .withColumn("__row", F.monotonically_increasing_id()), "rules", None, "zstd")
    if duplicate_col is not None:
        rows = rows.withColumn("__dup", F.col(duplicate_col)).drop("__row", duplicate_col)
    elif dedupe and all(k in rows.columns for k in DUPLICATE_KEY):
        if dedupe_after_rules:
            good = flag_duplicates(rows.where(F.size("__fails") == 0))
            rest = rows.where(F.size("__fails") > 0).drop("__row").withColumn("__dup", F.lit(False))
            rows = good.unionByName(rest)
        else:
            rows = flag_duplicates(rows)
    else:
        rows = rows.drop("__row").withColumn("__dup", F.lit(False))
    dup = _failure(F.lit(DUPLICATE_REASON), DUPLICATE_REASON, None, F.col("__dup"))
    out = rows.withColumn("__fails", F.concat("__fails", F.array_compact(F.array(dup)))).drop("__dup")
    last = F.try_element_at("__fails", F.lit(-1))
    return (out.withColumn("reject_bucket", last["bucket"])
            .withColumn("reject_column", last["column"])
            .withColumn("reject_reason", last["text"])
            .withColumn("reject_reasons", F.transform("__fails", lambda s: s["text"]))
            .drop("__fails"))


REJECT_COLUMNS = ["reject_bucket", "reject_column", "reject_reason", "reject_reasons"]


def split_valid(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V8: (clean rows without annotation columns, rejected rows with them)."""
    clean = annotated.where(F.col("reject_bucket").isNull()).drop(*REJECT_COLUMNS)
    rejected = annotated.where(F.col("reject_bucket").isNotNull())
    return clean, rejected


def drop_summary(annotated: DataFrame) -> DataFrame:
    """Rows per reason bucket with the overall pass rate (1 dp)."""
    totals = annotated.agg(F.count(F.lit(1)).alias("total_rows"),
                           F.count_if(F.col("reject_bucket").isNull()).alias("kept_rows"))
    per = annotated.where(F.col("reject_bucket").isNotNull()).groupBy("reject_bucket") \
        .agg(F.count(F.lit(1)).alias("rows"))
    from forgeline.operators.common import attach_row
    return attach_row(per, totals).select(
        "reject_bucket", "rows", "total_rows", "kept_rows",
        F.round(F.col("kept_rows") / F.greatest(F.col("total_rows"), F.lit(1)) * 100.0, 1).alias("pass_rate_pct"))


# --- V9: feature-vector validation ------------------------------------------
def feature_vector_errors(df: DataFrame) -> DataFrame:
    """V9: first failing check per feature row (NULL = valid), in check order:
    required presence, registry ranges, thin-wall consistency, aspect >= 1,
    volume <= 1.05 x box volume."""
    checks: list[Column] = []
    for name in FEATURE_REQUIRED:
        if name in df.columns:
            c = F.col(name)
            checks.append(F.when(c.isNull() | F.isnan(c.cast("double")),
                                 F.lit(f"Required feature '{name}' is missing or NaN")))
    for name, lo, hi in FEATURE_RANGES:
        if name in df.columns:
            c = F.col(name).cast("double")
            bad = c.isNotNull() & ~F.isnan(c) & ((c < lo) | (c > hi))
            checks.append(F.when(bad, F.lit(f"Feature '{name}' is outside expected range [{lo}, {hi}]")))
    if "wall_thickness_min" in df.columns and "thin_wall_flag" in df.columns:
        w = F.col("wall_thickness_min")
        bad = (w.isNotNull() & ~F.isnan(w) & F.col("thin_wall_flag").isNotNull()
               & (F.col("thin_wall_flag").cast("int") != (w < THIN_WALL_MM).cast("int")))
        checks.append(F.when(bad, F.lit("Inconsistency: thin_wall_flag disagrees with wall_thickness_min")))
    if "aspect_ratio" in df.columns:
        checks.append(F.when(F.col("aspect_ratio") < 1.0, F.lit("aspect_ratio is less than 1.0")))
    if all(c in df.columns for c in ("volume", "bounding_box_x", "bounding_box_y", "bounding_box_z")):
        dims = [F.col(c) for c in ("volume", "bounding_box_x", "bounding_box_y", "bounding_box_z")]
        nonzero = F.lit(True)
        for d in dims:
            nonzero = nonzero & d.isNotNull() & (d != 0)
        box = F.col("bounding_box_x") * F.col("bounding_box_y") * F.col("bounding_box_z")
        checks.append(F.when(nonzero & (F.col("volume") > box * VOLUME_BOX_TOLERANCE),
                             F.lit("Part volume exceeds bounding box volume")))
    return df.withColumn("feature_error", F.coalesce(*checks) if checks else F.lit(None).cast("string"))


# --- V10: scoring-request validation ------------------------------------------
def request_errors(req: DataFrame) -> DataFrame:
    """Every failed request constraint as ``errors array<string>``."""
    g = F.col("geometry")
    r = F.col("requirements")
    box = g["bounding_box"]

    def chk(cond: Column, msg: str) -> Column:
        return F.when(F.coalesce(cond, F.lit(True)), F.lit(msg))

    conds = [
        chk(~((box["x"] > 0) & (box["x"] <= 3000)), "bounding_box.x must be in (0, 3000]"),
        chk(~((box["y"] > 0) & (box["y"] <= 3000)), "bounding_box.y must be in (0, 3000]"),
        chk(~((box["z"] > 0) & (box["z"] <= 1000)), "bounding_box.z must be in (0, 1000]"),
        chk(~(g["volume_mm3"] > 0), "volume_mm3 must be > 0"),
        chk(~(g["surface_area_mm2"] > 0), "surface_area_mm2 must be > 0"),
        chk(~F.forall(F.coalesce(g["wall_thicknesses"], F.array().cast("array<double>")), lambda x: x > 0),
            "all wall thicknesses must be positive"),
        chk(~F.forall(F.coalesce(g["curvature_samples"], F.array().cast("array<double>")),
                      lambda x: (x >= 0) & (x <= 1)), "curvature samples must be in [0, 1]"),
        chk(~F.forall(F.coalesce(g["holes"], F.array().cast("array<struct<diameter:double,depth:double>>")),
                      lambda h: (h["diameter"] > 0) & (h["diameter"] <= 500) & (h["depth"] > 0) & (h["depth"] <= 2000)),
            "holes must have a diameter in (0, 500] and a depth in (0, 2000]"),
        _optional(g["source_format"].isin(*REQUEST_SOURCE_FORMATS), g["source_format"], "unknown source_format"),
        F.when(r["material_code"].isNull(), F.lit("material_code is required")),
        _optional(r["surface_finish_preset"].isin(*REQUEST_FINISH_PRESETS), r["surface_finish_preset"], "unknown surface_finish_preset"),
        _optional(r["tolerance_band"].isin(*REQUEST_TOLERANCES), r["tolerance_band"], "unknown tolerance_band"),
        _optional(r["max_lead_time_days"] > 0, r["max_lead_time_days"], "max_lead_time_days must be > 0"),
        chk(~((r["quantity"] >= 1) & (r["quantity"] <= 1000000)), "quantity must be in [1, 1000000]"),
        F.when(r["surface_finish_spec"].isNotNull() & ~((r["surface_finish_spec"] > 0) & (r["surface_finish_spec"] <= 25)),
               F.lit("surface_finish_spec must be in (0, 25]")),
        F.when(r["batch_size"].isNotNull() & ~(r["batch_size"] > 0), F.lit("batch_size must be > 0")),
        F.when(~F.coalesce(F.col("top_k").between(1, 5), F.lit(True)), F.lit("top_k must be in [1, 5]")),
    ]
    return req.withColumn("errors", F.array_compact(F.array(*conds)))


def _optional(valid: Column, value: Column, message: str) -> Column:
    """The message where a value is given and not valid."""
    return F.when(value.isNotNull() & ~F.coalesce(valid, F.lit(False)), F.lit(message))
