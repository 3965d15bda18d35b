"""Process catalog (S15) and catalog feasibility.

The catalog file is ragged (most rows lack the geometry column) and mixes
numbers, ``any`` and ``>=N`` bounds.  It is parsed with ``from_csv`` on each
text line, realigned by field count and typed with ``try_cast``.  The result
is a reference table of a few dozen rows.  Feasibility checks use its bounds
as a literal array, so parts are filtered per row with no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.constants import PROCESS_CATALOG_BOUNDS

CATALOG_FIELDS = ["process_code", "display_name", "category", "wall_min_mm", "wall_max_mm", "hole_dia_min_mm",
                  "hole_dia_max_mm", "min_quantity", "geometry_constraint", "notes"]


def _bound(c: Column) -> Column:
    """'any' -> NULL, '>=N' -> N, number -> number."""
    t = F.trim(c)
    return F.when(F.lower(t) == "any", F.lit(None).cast("double")) \
        .otherwise(F.regexp_replace(t, "^>=", "").try_cast("double"))


def parse_process_catalog(lines: DataFrame) -> DataFrame:
    """Text lines (``value``) -> typed catalog rows."""
    schema = ", ".join(f"{f} string" for f in CATALOG_FIELDS)
    body = lines.where(~F.col("value").startswith("process_code,") & (F.trim("value") != ""))
    n = F.size(F.split(F.col("value"), ",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)"))
    p = body.select(F.from_csv("value", schema).alias("r"), n.alias("nf")).select("r.*", "nf")
    short = F.col("nf") < len(CATALOG_FIELDS)      # geometry column absent: shift notes
    return p.select(
        "process_code", "display_name", "category",
        _bound(F.col("wall_min_mm")).alias("wall_min_mm"), _bound(F.col("wall_max_mm")).alias("wall_max_mm"),
        _bound(F.col("hole_dia_min_mm")).alias("hole_dia_min_mm"),
        _bound(F.col("hole_dia_max_mm")).alias("hole_dia_max_mm"),
        _bound(F.col("min_quantity")).alias("min_quantity"),
        F.when(short, F.lit(None)).otherwise(F.col("geometry_constraint")).alias("geometry_constraint"),
        F.when(short, F.col("geometry_constraint")).otherwise(F.col("notes")).alias("notes"))


def catalog_feasible(parts: DataFrame, catalog: list[tuple] = PROCESS_CATALOG_BOUNDS, qty_col: str = "quantity") -> DataFrame:
    """Processes whose wall / hole / quantity bounds admit the part (a bound of None is no limit).

    The catalog is the fixed list of bounds, so it becomes a literal array: no join, nothing collected.
    """
    def num(v):
        return F.lit(v).cast("double")
    specs = F.array(*[F.struct(F.lit(p).alias("p"), num(wlo).alias("wlo"), num(whi).alias("whi"), num(hlo).alias("hlo"),
                               num(hhi).alias("hhi"), num(q).alias("qlo")) for p, wlo, whi, hlo, hhi, q in catalog])
    w = F.col("wall_thickness_min")
    h = F.col("hole_diameter_min")
    q = F.col(qty_col).cast("double") if qty_col in parts.columns else F.lit(None).cast("double")

    def ok(s):
        def inside(v, lo, hi):
            return v.isNull() | ((lo.isNull() | (v >= lo)) & (hi.isNull() | (v <= hi)))
        return inside(w, s["wlo"], s["whi"]) & inside(h, s["hlo"], s["hhi"]) & (q.isNull() | s["qlo"].isNull()
                                                                                  | (q >= s["qlo"]))
    return parts.withColumn("catalog_feasible", F.transform(F.filter(specs, ok), lambda s: s["p"]))
