"""Joins of the order tables.

Design rule: the order fact table is never joined on a low-cardinality key
alone.  Temporal lookups (J2 price at date, J3 machine rate as of date) are
turned into plain equi-joins on ``(code, date)`` by expanding the small,
per-day dimension over the dates it can answer for; the dimension's size is
bounded by (#codes x #days), never by the number of orders.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgeline.constants import MATERIAL_COMMODITY, PIPELINE_FALLBACK_PRICES, PRICE_WINDOW_DAYS
from forgeline.operators.common import join_null_safe, lookup
from forgeline.session import materialize


# --- J1 --------------------------------------------------------------------
def join_geometry(orders: DataFrame, geometry: DataFrame) -> DataFrame:
    """Orders LEFT JOIN geometry USING (part_id), keep rows with a bounding box.

    Catalyst turns the left join + ``IS NOT NULL`` on a right-side column into
    an inner join and pushes the predicate into the geometry scan.  Duplicate
    geometry rows multiply order rows, as in the reference.
    """
    return orders.join(geometry, "part_id", "left").where(F.col("bounding_box_x").isNotNull())


def missing_geometry(orders: DataFrame, geometry: DataFrame) -> DataFrame:
    """J1 report: order rows dropped per part (no geometry, or geometry without a box)."""
    usable = geometry.where(F.col("bounding_box_x").isNotNull()).select("part_id")
    return (orders.join(usable, "part_id", "left_anti")
            .groupBy("part_id").agg(F.count(F.lit(1)).alias("dropped_rows")))


def first_missing_parts(orders: DataFrame, geometry: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` missing part ids (the log line's sample; a top-n report)."""
    return missing_geometry(orders, geometry).select("part_id").orderBy("part_id").limit(n)


# --- J2 --------------------------------------------------------------------
def price_lookup_table(prices: DataFrame, window_days: int = PRICE_WINDOW_DAYS,
                       direction: str = "latest") -> DataFrame:
    """(material_code, target_date) -> archived price chosen by the lookup rule.

    Rule (direction='latest', the reference behaviour): an exact-date row wins
    (first archived row = lowest ``seq``); otherwise, among rows within
    +-``window_days`` the latest date wins (lowest ``seq`` on that date), even
    if it lies after the target date.  'nearest' picks the smallest distance
    (later date on ties); 'backward' only looks at earlier dates.
    """
    daily = (prices.where(F.col("material_code").isNotNull() & F.col("date").isNotNull())
             .groupBy("material_code", "date")
             .agg(F.min_by("price_usd_per_kg", "seq").alias("price")))
    lo = -window_days
    hi = 0 if direction == "backward" else window_days
    cand = daily.select(
        "material_code", F.col("date").alias("price_date"), "price",
        F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("offset"))
    cand = cand.withColumn("target_date", F.date_sub(F.col("price_date"), F.col("offset")))
    is_exact = (F.col("offset") == 0)
    if direction == "nearest":
        rank = F.struct(is_exact, -F.abs(F.col("offset")), F.col("price_date"))
    else:
        rank = F.struct(is_exact, F.col("price_date"))
    return (cand.groupBy("material_code", "target_date")
            .agg(F.max_by(F.struct("price", "price_date"), rank).alias("pick"))
            .select("material_code", "target_date", "pick.price", "pick.price_date"))


def price_at_date(df: DataFrame, prices: DataFrame | None, date_col: str = "order_date",
                  material_col: str = "material_code", out_col: str = "material_price_per_kg",
                  fallback: dict = PIPELINE_FALLBACK_PRICES, window_days: int = PRICE_WINDOW_DAYS,
                  direction: str = "latest", keep_source: bool = False,
                  keep_date: bool = False) -> DataFrame:
    """Price of the row's material at its date, archive first, then fallback table.

    Unknown materials get NULL (pipeline table).  Without an archive every row
    uses the fallback table.
    """
    fb = lookup(fallback, F.col(material_col))
    if prices is None:
        out = df.withColumn(out_col, fb)
        if keep_date:
            out = out.withColumn("price_date", F.lit(None).cast("date"))
        return out.withColumn("price_source", F.lit("fallback")) if keep_source else out
    # written first, so Spark joins against a size it has measured: broadcast below the
    # session's threshold, shuffled otherwise
    table = materialize(price_lookup_table(prices, window_days, direction), "price-lookup").withColumnRenamed("price", "__price")
    table = (table.withColumnRenamed("material_code", "__mat")
             .withColumnRenamed("target_date", "__tdate"))
    table = table.withColumnRenamed("price_date", "price_date") if keep_date else table.drop("price_date")
    j = df.join(table, (F.col(material_col) == F.col("__mat")) & (F.col(date_col) == F.col("__tdate")), "left")
    j = j.withColumn(out_col, F.coalesce(F.col("__price"), fb))
    if keep_source:
        j = j.withColumn("price_source", F.when(F.col("__price").isNotNull(), F.lit("archive"))
                         .when(fb.isNotNull(), F.lit("fallback")))
    return j.drop("__mat", "__tdate", "__price")


# --- J3 --------------------------------------------------------------------
def rate_intervals(equipment: DataFrame) -> DataFrame:
    """One row per (process, facility, week) -> [valid_from, valid_to) intervals.

    Several machines in one week: the latest logged row (highest ``seq``) wins.
    The window runs over the weekly aggregate (#keys x #weeks rows), never
    over raw log rows.
    """
    weekly = (equipment.groupBy("process_code", "facility_id", "week_start")
              .agg(F.max_by("effective_hourly_rate_usd", "seq").alias("rate")))
    w = Window.partitionBy("process_code", "facility_id").orderBy("week_start")
    return weekly.select("process_code", "facility_id", F.col("week_start").alias("valid_from"),
                         F.lead("week_start").over(w).alias("valid_to"), "rate")


def rate_calendar(equipment: DataFrame, bounds: DataFrame) -> DataFrame:
    """Expand the as-of intervals to one row per (process, facility, day) within ``bounds`` (one row: lo, hi)."""
    from forgeline.operators.common import attach_row
    iv = attach_row(rate_intervals(equipment), bounds)
    start = F.greatest(F.col("valid_from"), F.col("lo"))
    end = F.least(F.coalesce(F.date_sub(F.col("valid_to"), 1), F.col("hi")), F.col("hi"))
    return (iv.where(start <= end)
            .select("process_code", "facility_id", "rate",
                    F.explode(F.sequence(start, end)).alias("day")))


def rate_as_of(df: DataFrame, equipment: DataFrame, date_col: str = "order_date",
               process_col: str = "process_code", facility_col: str = "facility_id",
               out_col: str = "effective_hourly_rate", date_bounds: DataFrame | None = None) -> DataFrame:
    """Machine rate of the latest log week starting on or before the row's date.

    Same process and facility; no age limit; no earlier week -> NULL.  The
    lookup is an equi-join on (process, facility, day) against the calendar
    expansion of the log, restricted to the dates present in ``df`` (a
    scalar subquery; ``date_bounds`` may name a cheaper frame whose dates
    cover ``df``'s, e.g. the pruned source scan).  The calendar is written
    first, so its size is known when the join is planned.
    """
    src = date_bounds if date_bounds is not None else df
    bounds = src.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    cal = materialize(rate_calendar(equipment, bounds), "rate-calendar")
    cal = cal.select(F.col("process_code").alias("__p"), F.col("facility_id").alias("__f"),
                     F.col("day").alias("__d"), F.col("rate").alias(out_col))
    cond = ((F.col(process_col) == F.col("__p")) & (F.col(facility_col) == F.col("__f"))
            & (F.col(date_col) == F.col("__d")))
    return df.join(cal, cond, "left").drop("__p", "__f", "__d")


# --- J4 / U2 ---------------------------------------------------------------
def geometry_coverage(requested_parts: DataFrame, geometry: DataFrame) -> DataFrame:
    """Requested / covered / missing part counts and coverage percent (1 dp)."""
    req = requested_parts.select("part_id").where(F.col("part_id").isNotNull()).distinct()
    have = geometry.select(F.col("part_id").alias("__gp")).distinct()
    j = req.join(have, F.col("part_id") == F.col("__gp"), "left")
    return j.agg(
        F.count(F.lit(1)).alias("requested"),
        F.count("__gp").alias("covered"),
        F.count_if(F.col("__gp").isNull()).alias("missing"),
    ).select("requested", "covered", "missing",
             F.round(F.col("covered") / F.greatest(F.col("requested"), F.lit(1)) * 100.0, 1)
             .alias("coverage_pct"))


def part_set_ops(requested_parts: DataFrame, geometry: DataFrame) -> DataFrame:
    """Requested ∩ loaded and requested − loaded as one tagged table."""
    req = requested_parts.select("part_id").where(F.col("part_id").isNotNull()).distinct()
    have = geometry.select("part_id").where(F.col("part_id").isNotNull()).distinct()
    both = req.intersect(have).withColumn("status", F.lit("covered"))
    missing = req.exceptAll(have).withColumn("status", F.lit("missing"))
    return both.unionByName(missing)


# --- J5 --------------------------------------------------------------------
def share_comparison(base: DataFrame, new: DataFrame, key: str = "process_code") -> DataFrame:
    """Per-key share in base and new over the union of keys, absent = 0.0."""
    def shares(df: DataFrame, name: str) -> DataFrame:
        c = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
        tot = c.agg(F.sum("__n").alias("__t"))
        from forgeline.operators.common import attach_row
        return attach_row(c, tot).select(key, (F.col("__n") / F.col("__t")).alias(name))
    j = shares(base, "base_prop").join(shares(new, "new_prop"), key, "full_outer")
    return j.select(key, F.coalesce("base_prop", F.lit(0.0)).alias("base_prop"),
                    F.coalesce("new_prop", F.lit(0.0)).alias("new_prop")) \
        .withColumn("diff", F.abs(F.col("new_prop") - F.col("base_prop")))


# --- J11 / J12 --------------------------------------------------------
def enrich(df: DataFrame, source: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Attach an extra source by key (the documented extension recipe)."""
    return df.join(source, keys, how)


def with_commodity(prices: DataFrame, material_col: str = "material_code") -> DataFrame:
    """Commodity family of each priced material (a literal map of the fixed index), NULL where it is not listed."""
    return prices.withColumn("commodity_family", lookup(MATERIAL_COMMODITY, F.col(material_col)))


# --- S7 / J13 --------------------------------------------------------------
def upsert_prices(existing: DataFrame, batch: DataFrame, source: str | None = None) -> DataFrame:
    """Drop archived rows of the same (date, material) as the batch, append the batch."""
    new = batch if source is None else batch.withColumn("source", F.lit(source))
    keep = existing.join(new.select("date", "material_code").distinct(), ["date", "material_code"], "left_anti")
    return keep.unionByName(new, allowMissingColumns=True)
