"""Driver tables and the views derived from them.

The driver ships TPC-H-like parquet tables.  Each domain table (orders,
invoices, geometry, price archive, equipment log, class scores, cost
predictions, request log) is a projection of one driver table: Catalyst
prunes the parquet columns and pushes the filters into the scan.  Only the
scores shuffle, to drop repeated keys.  ``geometry`` lacks every tenth part
and ``invoices`` some orders, for the operators that look for gaps;
``all_geometry`` and ``all_invoices`` have every row.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.constants import PROCESS_CLASSES, TRACKED_MATERIALS, COST_COMPONENTS
from forgeline.operators.common import bound

# Test-data coding of process and material codes (index -> code).  Index 18 of
# the process list is an invalid code; 19 yields NULL.  Material 16 is a known
# non-tracked code, 17 an unknown one.
BINDING_PROCESSES = PROCESS_CLASSES + ["weaving_socks"]
BINDING_MATERIALS = TRACKED_MATERIALS + ["CARBON_FIBER", "UNOBTANIUM"]
PREDICTION_COMPONENTS = [c + "_cost" for c in COST_COMPONENTS]
DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _code_at(codes: list[str], index: Column) -> Column:
    """codes[index] (0-based) as a literal-array lookup; out of range -> NULL."""
    return F.try_element_at(F.array(*[F.lit(c) for c in codes]), (index + F.lit(1)).cast("int"))


def _txt(c: str) -> Column:
    return F.col(c).cast("string")


def order_id_col() -> Column:
    return F.concat_ws("-", _txt("l_orderkey"), _txt("l_linenumber"),
                       _txt("l_partkey"), _txt("l_suppkey"))


def _cost_total() -> Column:
    neg = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)
    return F.when(neg, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))


def orders_view(lineitem: DataFrame) -> DataFrame:
    """Orders with dirty process codes, text finishes and two dates."""
    pcode = _code_at(BINDING_PROCESSES, (F.col("l_suppkey") * 7 + F.col("l_linenumber")) % 20)
    ln = F.col("l_linenumber")
    order_date = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("l_orderkey") % 45).cast("int"))
    finish = (F.when(ln % 5 == 0, F.lit("as_machined"))
              .when(ln % 5 == 1, F.lit(" Fine"))
              .when(ln % 5 == 2, F.lit("1.6"))
              .when(ln % 5 == 3, F.lit("bogus")))
    qty = F.col("l_quantity").cast("int")
    return lineitem.select(
        order_id_col().alias("order_id"),
        F.concat(F.lit("PART-"), _txt("l_partkey")).alias("part_id"),
        F.when(ln % 2 == 0, F.concat(F.lit("  "), F.upper(pcode), F.lit(" "))).otherwise(pcode)
        .alias("process_code"),
        _code_at(BINDING_MATERIALS, F.col("l_suppkey") % 18).alias("material_code"),
        qty.alias("quantity"),
        F.when(ln % 3 == 0, F.lit(None).cast("int")).otherwise(qty).alias("batch_size"),
        finish.alias("surface_finish_ra"),
        F.concat(F.lit("it"), (F.lit(4) + F.col("l_suppkey") % 11).cast("string")).alias("tolerance_band"),
        order_date.alias("order_date"),
        F.date_add(order_date, ln).alias("completion_date"),
        F.concat(F.lit("FACILITY_0"), (F.lit(1) + F.col("l_suppkey") % 3).cast("string")).alias("facility_id"),
        F.when(F.col("l_linestatus") == "F", F.lit("completed")).otherwise(F.lit("pending")).alias("status"),
        _cost_total().alias("cost_total"),
    )


def invoices_view(lineitem: DataFrame) -> DataFrame:
    """An invoice per order; full, partial or lump-sum costs, some of them estimated."""
    exact = F.col("l_returnflag") == "A"
    px = F.col("l_extendedprice")

    def comp(ratio: float, extra_null: Column | None = None) -> Column:
        cond = exact if extra_null is None else exact & ~extra_null
        return F.when(cond, px * F.lit(ratio))

    return lineitem.select(
        order_id_col().alias("order_id"),
        _cost_total().alias("cost_total"),
        comp(0.40).alias("cost_machine_time"),
        comp(0.20).alias("cost_setup"),
        comp(0.10, F.col("l_linenumber") == 3).alias("cost_tooling"),
        comp(0.25).alias("cost_raw_material"),
        comp(0.05).alias("cost_finishing"),
        F.when(exact, F.lit("exact")).when(F.col("l_tax") >= 0.06, F.lit("estimated"))
        .otherwise(F.lit("decomposed")).alias("label_source"),
    )


def geometry_view(part: DataFrame) -> DataFrame:
    """Flat geometry features per part."""
    k = F.col("p_partkey")
    s = F.col("p_size")
    wall_null = k % 20 == 0
    wall_min = F.when(~wall_null, (k % 97 + 3) / F.lit(10.0))
    return part.select(
        F.concat(F.lit("PART-"), _txt("p_partkey")).alias("part_id"),
        F.when(k % 41 != 0, s * F.lit(13.0)).alias("bounding_box_x"),
        (s * F.lit(7.0) + F.lit(5.0)).alias("bounding_box_y"),
        (s * F.lit(3.0) + F.lit(2.0)).alias("bounding_box_z"),
        (s * s * s * F.lit(110.0)).alias("volume"),
        (F.col("p_retailprice") * F.lit(10.0)).alias("surface_area"),
        wall_min.alias("wall_thickness_min"),
        F.when(~wall_null, (k % 97 + 9) / F.lit(7.0)).alias("wall_thickness_avg"),
        (s * F.lit(13.0) / (s * F.lit(3.0) + F.lit(2.0))).alias("aspect_ratio"),
        F.when(k % 15 != 0, (k % 23).cast("int")).alias("hole_count"),
        F.when(k % 6 != 0, F.lit(0.5) + (k % 40) / F.lit(2.0)).alias("hole_diameter_min"),
        F.when(k % 25 == 1, F.lit(None).cast("int")).when(k % 5 == 0, F.lit(1)).otherwise(F.lit(0))
        .alias("undercut_flag"),
        (wall_min < F.lit(1.5)).cast("int").alias("thin_wall_flag"),
        F.when(k % 33 != 0, (k % 101) / F.lit(100.0)).alias("curvature_complexity"),
        F.when(k % 31 != 0, (k % 89) / F.lit(88.0)).alias("symmetry_score"),
    )


def nested_geometry_view(part: DataFrame) -> DataFrame:
    """Nested part geometry as a CAD export would deliver it (A1/A2 input).

    walls_i = (p_partkey % 97 + 3*i) / 10 for i = 1..(p_partkey % 5); holes
    and curvature samples follow the same rule; symmetry axes are a map.
    """
    k = F.col("p_partkey")
    s = F.col("p_size")
    n = (k % 5).cast("int")
    idx = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    walls = F.transform(idx, lambda i: (k % 97 + i * 3) / F.lit(10.0))
    holes = F.transform(idx, lambda i: F.struct(
        (F.lit(0.5) + ((k + i) % 40) / F.lit(2.0)).alias("diameter"),
        (F.lit(1.0) + i).alias("depth")))
    nh = (k % 3).cast("int")
    holes = F.slice(holes, 1, nh)
    curv = F.transform(idx, lambda i: ((k * i) % 101) / F.lit(100.0))
    axes = F.when(k % 4 == 0, F.create_map().cast("map<string,double>")).otherwise(
        F.create_map(F.lit("x"), (k % 89) / F.lit(88.0),
                     F.lit("y"), (k % 7) / F.lit(7.0),
                     F.lit("z"), (k % 13) / F.lit(13.0)))
    return part.select(
        F.concat(F.lit("PART-"), _txt("p_partkey")).alias("part_id"),
        F.struct((s * F.lit(13.0)).alias("x"), (s * F.lit(7.0) + F.lit(5.0)).alias("y"),
                 (s * F.lit(3.0) + F.lit(2.0)).alias("z")).alias("bounding_box"),
        (s * s * s * F.lit(110.0)).alias("volume_mm3"),
        (F.col("p_retailprice") * F.lit(10.0)).alias("surface_area_mm2"),
        walls.alias("wall_thicknesses"),
        holes.alias("holes"),
        (k % 5 == 0).alias("has_undercuts"),
        curv.alias("curvature_samples"),
        axes.alias("symmetry_axes"),
        F.lit("STEP").alias("source_format"),
    )


def prices_view(events: DataFrame) -> DataFrame:
    """Price archive of all purchases: several rows per day, gaps, and two untracked materials.

    Material m is only priced every m + 1 days: its rows are dated back to the last such day.
    """
    m = F.col("user_id") % 18
    day = F.col("ts").cast("date")
    back = (F.datediff(day, F.lit("1970-01-01").cast("date")) + m) % (m + 1)
    return events.where(F.col("event_type") == "purchase").select(
        F.date_sub(day, back.cast("int")).alias("date"),
        _code_at(BINDING_MATERIALS, m).alias("material_code"),
        (F.lit(1.0) + F.col("value")).alias("price_usd_per_kg"),
        F.lit("live").alias("source"),
        F.col("event_id").alias("seq"),
    )


def equipment_view(events: DataFrame) -> DataFrame:
    """Weekly equipment log rows per facility, machine and process."""
    pcode = _code_at(BINDING_PROCESSES, (F.col("user_id") * 7) % 20)
    return events.where(F.col("event_type") == "view").select(
        F.concat(F.lit("FACILITY_0"), (F.lit(1) + F.col("user_id") % 3).cast("string")).alias("facility_id"),
        F.concat(F.lit("M"), _txt("user_id")).alias("machine_id"),
        pcode.alias("process_code"),
        F.date_trunc("week", F.col("ts")).cast("date").alias("week_start"),
        (F.lit(30.0) + F.col("value")).alias("effective_hourly_rate_usd"),
        F.col("event_id").alias("seq"),
    ).where(F.col("process_code").isNotNull())


def score_weights(n_classes: int = 18, modulus: int = 101) -> Column:
    """Unnormalised class weights w_c = 1 + (pk*31 + sk*17 + c*97 + ln*13) % modulus."""
    base = F.col("l_partkey") * 31 + F.col("l_suppkey") * 17 + F.col("l_linenumber") * 13
    # by higher-order functions: 18 expressions in a row make a method too long for the JVM to compile
    steps = F.sequence(F.lit(0), F.lit(97 * (n_classes - 1)), F.lit(97))
    return bound(base, lambda b: F.transform(steps, lambda c: (F.lit(1) + (b + c) % modulus).cast("double")))


def scores_view(lineitem: DataFrame, modulus: int = 101, extra: dict[str, Column] | None = None) -> DataFrame:
    """Classifier output per order line: true class and an 18-wide probability array.

    The probability vector stays an array column (as MLlib's ``probability``
    would be after ``vector_to_array``), so ranking needs no shuffle.  ``extra`` names more
    columns of the same scan to carry along.
    """
    keys = (lineitem.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
            .agg(F.min("l_quantity").alias("l_quantity")))
    w = score_weights(len(PROCESS_CLASSES), modulus)
    return keys.select(
        order_id_col().alias("row_id"),
        ((F.col("l_partkey") + F.col("l_suppkey")) % 18).cast("int").alias("true_idx"),
        w.alias("_w"), *[c.alias(n) for n, c in (extra or {}).items()],
    ).select("row_id", "true_idx", *(extra or {}), F.aggregate(
        "_w", F.lit(0.0), lambda a, b: a + b, lambda total: F.transform("_w", lambda x: x / total)).alias("proba"))


def cost_predictions_view(lineitem: DataFrame) -> DataFrame:
    """Cost-model predictions next to invoice actuals (one component per line)."""
    px = F.col("l_extendedprice")
    pidx = (F.col("l_suppkey") * 7 + F.col("l_linenumber")) % 18
    return lineitem.select(
        order_id_col().alias("row_id"),
        pidx.cast("int").alias("process_idx"),
        _code_at(PROCESS_CLASSES, pidx).alias("process_code"),
        _code_at(PREDICTION_COMPONENTS, F.col("l_linenumber") % 5).alias("component"),
        px.alias("y_true"),
        (px * (F.lit(1.0) + ((F.col("l_suppkey") * 7 + F.col("l_partkey")) % 41 - 20) / F.lit(100.0)))
        .alias("y_pred"),
    )


def request_log_view(events: DataFrame) -> DataFrame:
    """Scoring-service request log: timestamp, latency and error flag."""
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id"),
        F.col("value").alias("latency_ms"),
        (F.col("event_type") == "error").alias("is_error"),
    )


class Domain:
    """Lazily built order and part views over one driver data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @property
    def orders(self) -> DataFrame:
        return orders_view(self.table("lineitem"))

    @property
    def all_invoices(self) -> DataFrame:
        return invoices_view(self.table("lineitem"))

    @property
    def invoices(self) -> DataFrame:
        return self.all_invoices

    @property
    def partial_invoices(self) -> DataFrame:
        """A second source that lacks some orders, for the operator that enriches what it finds."""
        return invoices_view(self.table("lineitem").where(F.col("l_tax") < 0.075))

    @property
    def all_geometry(self) -> DataFrame:
        return geometry_view(self.table("part"))

    @property
    def geometry(self) -> DataFrame:
        """Every part; some without a bounding box."""
        return self.all_geometry

    @property
    def partial_geometry(self) -> DataFrame:
        """A delivery without every tenth part, for the operators that report missing parts (J1 report, J4, W8, U2)."""
        return geometry_view(self.table("part").where(F.col("p_partkey") % 10 != 9))

    @property
    def nested_geometry(self) -> DataFrame:
        return nested_geometry_view(self.table("part"))

    @property
    def prices(self) -> DataFrame:
        return prices_view(self.table("events"))

    @property
    def equipment(self) -> DataFrame:
        return equipment_view(self.table("events"))

    @property
    def scores(self) -> DataFrame:
        return scores_view(self.table("lineitem"))

    @property
    def score_requests(self) -> DataFrame:
        """Scores with part, quantity, material, tolerance and wanted number of results, from one scan."""
        return scores_view(self.table("lineitem"), extra={
            "part_id": F.concat(F.lit("PART-"), _txt("l_partkey")),
            "quantity": F.col("l_quantity").cast("int"),
            "material_code": _code_at(BINDING_MATERIALS, F.col("l_suppkey") % 18),
            "tolerance_band": F.concat(F.lit("IT"), (F.lit(4) + F.col("l_suppkey") % 11).cast("string")),
            "top_k": (F.lit(1) + F.col("l_linenumber") % 6).cast("int"),
        })

    @property
    def cost_predictions(self) -> DataFrame:
        return cost_predictions_view(self.table("lineitem"))

    @property
    def request_log(self) -> DataFrame:
        return request_log_view(self.table("events"))
