"""Registered source / sink queries: file round trips, versioned catalog, request validation, price feed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from forgeline.functions import features as fx
from forgeline.operators import validate
from forgeline.plans.registry import register
from forgeline.schemas import GEOMETRY_COLUMNS
from forgeline.session import shared_path
from forgeline.sources import commits, readers, sinks
from forgeline.sources.tables import Domain

GEO_DOUBLES = ["bounding_box_x", "bounding_box_y", "bounding_box_z", "volume", "surface_area", "wall_thickness_min",
               "wall_thickness_avg", "aspect_ratio", "hole_diameter_min", "curvature_complexity", "symmetry_score"]


def _scratch(d: Domain, name: str) -> str:
    return shared_path(d.spark, name, uuid.uuid4().hex)


@register("s4_geometry_envelope_roundtrip", "SELECT * FROM m_geometry_all", GEO_DOUBLES, ["m_geometry_all"])
def s4_geometry_envelope_roundtrip(d: Domain):
    """Geometry written as bulk JSON envelopes {status, features:[...]} (<= 500 parts each),
    read back with a fixed schema and flattened with inline()."""
    path = _scratch(d, "geometry_json")
    g = d.all_geometry.withColumn("__batch", (F.split("part_id", "-").getItem(1).cast("long") / 500).cast("long"))
    env = g.groupBy("__batch").agg(F.collect_list(F.struct(*GEOMETRY_COLUMNS)).alias("features")) \
        .select(F.lit("ok").alias("status"), "features")
    env.write.mode("overwrite").json(path)
    rows, missing = readers.geometry_from_envelope(d.spark, path)
    assert not missing
    return rows.select(*GEOMETRY_COLUMNS)


@register("s5_equipment_csv_scan", """
SELECT facility_id, machine_id, process_code, week_start, effective_hourly_rate_usd FROM m_equipment
WHERE facility_id IN ('FACILITY_01', 'FACILITY_02')""", ["effective_hourly_rate_usd"], ["m_equipment"])
def s5_equipment_csv_scan(d: Domain):
    """equipment_log_*.csv files whose columns stand in different orders, read by header name;
    a file of another name is not read; facility filter."""
    path = _scratch(d, "equipment_csv")
    e = d.equipment.select("facility_id", "machine_id", "process_code", "week_start",
                           F.lit(None).cast("double").alias("availability_pct"), "effective_hourly_rate_usd",
                           F.lit(None).cast("double").alias("downtime_hours"),
                           F.lit(None).cast("string").alias("maintenance_notes"), "seq")
    swapped = ["effective_hourly_rate_usd", "machine_id", "week_start", "process_code", "facility_id"]
    for name, rows, columns in (("a", e.where("seq % 2 = 0"), e.columns[:-1]), ("b", e.where("seq % 2 = 1"), swapped)):
        _csv_named(rows.select(*columns), path, f"equipment_log_{name}")
    _csv_named(e.limit(5).drop("seq"), path, "other_log")
    df = readers.scan_equipment_logs(d.spark, path, ["FACILITY_01", "FACILITY_02"])
    return df.select("facility_id", "machine_id", "process_code", "week_start", "effective_hourly_rate_usd")


def _csv_named(df, folder: str, prefix: str) -> None:
    """Write CSV part files with headers and give them names that start with ``prefix``."""
    part = f"{folder}-{prefix}"
    df.write.mode("overwrite").option("header", True).csv(part)
    jvm, spark = df.sparkSession._jvm, df.sparkSession
    hadoop = jvm.org.apache.hadoop.fs.Path
    fs = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(folder))
    for i, f in enumerate(x for x in fs.listStatus(hadoop(part)) if x.getPath().getName().endswith(".csv")):
        fs.rename(f.getPath(), hadoop(f"{folder}/{prefix}_{i}.csv"))


@register("s11_versioned_catalog", """
SELECT 1 AS version, CAST(count(*) AS BIGINT) AS row_count, 13 AS column_count, false AS is_latest FROM m_orders
UNION ALL
SELECT 2, CAST(count(*) FILTER (WHERE status = 'completed') AS BIGINT), 13, true FROM m_orders""", [], ["m_orders"])
def s11_versioned_catalog(d: Domain):
    """Two dataset versions written with catalog entries; latest flag from the catalog."""
    base, cat = _scratch(d, "datasets"), _scratch(d, "catalog")
    o = d.orders
    v1 = sinks.write_version(o, base, cat, "orders", {"stage": "all"})
    sinks.write_version(o.where(F.col("status") == "completed"), base, cat, "orders", {"stage": "completed"})
    assert v1 == 1
    latest = sinks.read_latest(d.spark, base, cat)
    assert latest.select("version").distinct().count() == 1
    return sinks.catalog_entries(d.spark, cat).select("version", "row_count", "column_count", "is_latest")


@register("v10_request_validation", """
SELECT part_id, CAST(len(list_filter([
  CASE WHEN NOT (p_size * 13.0e0 > 0 AND p_size * 13.0e0 <= 3000) THEN 1 END,
  CASE WHEN p_partkey % 7 = 0 THEN 1 END,
  CASE WHEN p_partkey % 11 = 0 THEN 1 END,
  CASE WHEN NOT (p_partkey % 9 BETWEEN 1 AND 5) THEN 1 END,
  CASE WHEN p_partkey % 13 = 0 THEN 1 END, CASE WHEN p_partkey % 17 = 0 THEN 1 END, CASE WHEN p_partkey % 19 = 0 THEN 1 END,
  CASE WHEN p_partkey % 23 = 0 THEN 1 END, CASE WHEN p_partkey % 29 = 0 THEN 1 END,
  CASE WHEN p_partkey % 31 = 0 THEN 1 END], lambda x: x IS NOT NULL)) AS INTEGER) AS n_errors
FROM (SELECT 'PART-' || CAST(p_partkey AS VARCHAR) AS part_id, p_partkey, p_size FROM part) g""",
          [])
def v10_request_validation(d: Domain):
    """Scoring requests built as JSON text, parsed with from_json, validated into errors."""
    g = d.nested_geometry
    k = F.split("part_id", "-").getItem(1).cast("long")
    req = g.select("part_id", k.alias("k"), F.struct(*[c for c in g.columns if c != "part_id"]).alias("geometry"))
    req = req.select(
        "part_id",
        F.col("geometry").withField("wall_thicknesses", F.when(F.col("k") % 7 == 0, F.array(F.lit(-1.0)))
                                    .otherwise(F.col("geometry.wall_thicknesses")))
        .withField("source_format", F.when(F.col("k") % 13 == 0, "OBJ").otherwise("STL"))
        .withField("holes", F.when(F.col("k") % 17 == 0, F.array(F.struct(F.lit(9999.0).alias("diameter"), F.lit(1.0).alias("depth"))))
                   .otherwise(F.col("geometry.holes"))).alias("geometry"),
        F.struct(F.when(F.col("k") % 19 != 0, "AL6061").alias("material_code"),
                 F.when(F.col("k") % 11 == 0, F.lit(0)).otherwise(F.lit(10)).alias("quantity"),
                 F.lit(None).cast("double").alias("surface_finish_spec"),
                 F.when(F.col("k") % 23 == 0, "shiny").alias("surface_finish_preset"),
                 F.when(F.col("k") % 29 == 0, "IT99").otherwise("IT8").alias("tolerance_band"),
                 F.when(F.col("k") % 31 == 0, -1).cast("int").alias("max_lead_time_days"),
                 F.lit(None).cast("int").alias("batch_size")).alias("requirements"),
        (F.col("k") % 9).cast("int").alias("top_k"), F.lit(False).alias("include_debug"))
    as_json = fx.to_json_col(req, req.columns)
    parsed = fx.requests_from_json(as_json)
    return validate.request_errors(parsed).select("part_id", F.size("errors").alias("n_errors"))


@register("ts5_price_feed_stream", """
SELECT date, material_code, arg_min(price_usd_per_kg, seq) AS price_usd_per_kg FROM m_prices
GROUP BY date, material_code""", ["price_usd_per_kg"], ["m_prices"])
def ts5_price_feed_stream(d: Domain):
    """T-S5/S7: price rows streamed from files into a date-partitioned archive with idempotent upserts."""
    from forgeline.streaming.monitors import price_feed_stream, read_price_archive
    src, arch, ck = _scratch(d, "prices_in"), _scratch(d, "price_archive"), _scratch(d, "prices_ck")
    d.prices.repartitionByRange(3, "date").write.mode("overwrite").parquet(src)
    stream = d.spark.readStream.schema(d.prices.schema).option("maxFilesPerTrigger", 1).parquet(src)
    price_feed_stream(stream, arch, ck)
    return read_price_archive(d.spark, arch).select("date", "material_code", "price_usd_per_kg")


@register("j9_model_routing", """
SELECT process_code, CASE WHEN process_code IN ('cnc_milling', 'cnc_turning', 'sheet_metal_bending',
  'injection_molding', 'additive_slm', 'sand_casting') THEN process_code || '_v2.pkl' END AS model_file,
  process_code IN ('cnc_milling', 'cnc_turning', 'sheet_metal_bending', 'injection_molding', 'additive_slm',
  'sand_casting') AS routed, 80 AS high_min_n, 25 AS medium_min_n, CAST(count(*) AS BIGINT) AS n_rows
FROM m_costpred GROUP BY process_code""", [], ["m_costpred"])
def j9_model_routing(d: Domain):
    """Route each process of the prediction table to its model (literal routing map;
    unrouted processes fall back to the rough estimate), with the confidence thresholds."""
    from forgeline.constants import (COST_CONF_HIGH_MIN_N, COST_CONF_MEDIUM_MIN_N, ROUTED_PROCESSES,
                                     ROUTING_MODEL_SUFFIX)
    routed = F.col("process_code").isin(ROUTED_PROCESSES)
    c = d.cost_predictions.groupBy("process_code").agg(F.count(F.lit(1)).alias("n_rows"))
    return c.select("process_code",
                    F.when(routed, F.concat("process_code", F.lit(ROUTING_MODEL_SUFFIX))).alias("model_file"),
                    routed.alias("routed"), F.lit(COST_CONF_HIGH_MIN_N).alias("high_min_n"),
                    F.lit(COST_CONF_MEDIUM_MIN_N).alias("medium_min_n"), "n_rows")


@register("s6_price_archive_scan", """
SELECT date, material_code, price_usd_per_kg, source FROM m_prices""", ["price_usd_per_kg"], ["m_prices"])
def s6_price_archive_scan(d: Domain):
    """The price archive written as CSV and read once with a fixed schema (dates parsed)."""
    path = _scratch(d, "price_csv")
    d.prices.select("date", "material_code", "price_usd_per_kg", "source") \
        .write.mode("overwrite").option("header", True).csv(path)
    return readers.scan_price_archive(d.spark, path).select("date", "material_code", "price_usd_per_kg", "source")


@register("s16_validate_only_metrics", """
SELECT CAST((SELECT count(*) FROM ex) AS BIGINT) AS extracted_rows,
  CAST(count(*) AS BIGINT) AS joined_rows,
  CAST(count(*) FILTER (WHERE reject_bucket IS NULL) AS BIGINT) AS clean_rows,
  CAST(count(*) FILTER (WHERE reject_bucket IS NOT NULL) AS BIGINT) AS rejected_rows
FROM ann""", [], ["ex", "ann"])
def s16_validate_only_metrics(d: Domain):
    """Validate-only run: every stage computed, counts reported, nothing written."""
    from forgeline.plans import etl
    ex = readers.extract_completed(d.orders, d.invoices).agg(F.count(F.lit(1)).alias("extracted_rows"))
    a = etl.annotated_training_rows(d).agg(
        F.count(F.lit(1)).alias("joined_rows"),
        F.count_if(F.col("reject_bucket").isNull()).alias("clean_rows"),
        F.count_if(F.col("reject_bucket").isNotNull()).alias("rejected_rows"))
    from forgeline.operators.common import attach_row
    return attach_row(ex, a)


@register("a8_run_metrics", """
SELECT 'extract' AS stage, 'rows' AS key, CAST(count(*) AS DOUBLE) AS value FROM ex
UNION ALL SELECT 'join', 'rows', CAST(count(*) AS DOUBLE) FROM j1
UNION ALL SELECT 'validate', 'clean_rows', CAST(count(*) FILTER (WHERE reject_bucket IS NULL) AS DOUBLE) FROM ann
UNION ALL SELECT 'validate', 'pass_rate_pct', round(count(*) FILTER (WHERE reject_bucket IS NULL) * 100.0e0
  / greatest(count(*), 1), 1) FROM ann""", ["value"], ["ex", "j1", "ann"])
def a8_run_metrics(d: Domain):
    """Run metrics as a long (stage, key, value) table, exportable with to_json."""
    from forgeline.plans import etl
    from forgeline.operators.joins import join_geometry
    ex = readers.extract_completed(d.orders, d.invoices)
    j1 = join_geometry(ex, d.geometry)
    a = etl.annotated_training_rows(d)
    m1 = ex.agg(F.lit("extract").alias("stage"), F.lit("rows").alias("key"), F.count(F.lit(1)).cast("double").alias("value"))
    m2 = j1.agg(F.lit("join").alias("stage"), F.lit("rows").alias("key"), F.count(F.lit(1)).cast("double").alias("value"))
    c = a.agg(F.count_if(F.col("reject_bucket").isNull()).alias("k"), F.count(F.lit(1)).alias("n"))
    m3 = c.select(F.lit("validate").alias("stage"), F.lit("clean_rows").alias("key"), F.col("k").cast("double").alias("value"))
    m4 = c.select(F.lit("validate").alias("stage"), F.lit("pass_rate_pct").alias("key"),
                  F.round(F.col("k") * 100.0 / F.greatest(F.col("n"), F.lit(1)), 1).alias("value"))
    return m1.unionByName(m2).unionByName(m3).unionByName(m4)


@register("s13_fan_out", """
SELECT 1 AS copy, CAST(count(*) AS BIGINT) AS row_count FROM m_geometry_all
UNION ALL SELECT 2, CAST(count(*) AS BIGINT) FROM m_geometry_all""", [], ["m_geometry_all"])
def s13_fan_out(d: Domain):
    """One materialised dataset written to two consumer locations; rows read back per copy."""
    a, b = _scratch(d, "copy_a"), _scratch(d, "copy_b")
    ok = sinks.fan_out(d.all_geometry, [a, b])
    assert all(ok.values())
    return commits.read_published(d.spark, a).agg(F.lit(1).alias("copy"), F.count(F.lit(1)).alias("row_count")).unionByName(
        commits.read_published(d.spark, b).agg(F.lit(2).alias("copy"), F.count(F.lit(1)).alias("row_count")))


@register("s17_prediction_export", """
SELECT r.row_id, CAST(r.rnk AS INTEGER) AS rank, c.process AS process_code, a.process AS actual_process, 'v2' AS model_version
FROM m_ranked r JOIN classes c ON c.class_idx = r.class_idx JOIN classes a ON a.class_idx = r.true_idx WHERE r.rnk <= 3""",
          [], ["m_ranked", "classes"])
def s17_prediction_export(d: Domain):
    """Top-3 predictions next to the actual process, exported partitioned by model version and read back."""
    from forgeline.plans import scoring
    path = _scratch(d, "predictions")
    e = d.scores.select("row_id", F.element_at(scoring.class_array(), F.col("true_idx") + 1).alias("actual_process"),
                        F.explode(scoring.ranked_codes(F.col("proba"), 3)).alias("r"))
    sinks.export_predictions(e.select("row_id", "r.rank", "r.process_code", "actual_process"), path, "v2")
    return d.spark.read.parquet(path).select("row_id", "rank", "process_code", "actual_process", "model_version")


@register("m10_supported_processes", """
SELECT DISTINCT process_code FROM (
  SELECT process_code, count(*) AS n,
    greatest(count(*) FILTER (WHERE cost_machine_time > 0.01e0), count(*) FILTER (WHERE cost_setup > 0.01e0),
             count(*) FILTER (WHERE cost_tooling > 0.01e0), count(*) FILTER (WHERE cost_raw_material > 0.01e0),
             count(*) FILTER (WHERE cost_finishing > 0.01e0)) AS best
  FROM clean_rows WHERE cost_label_source <> 'estimated' OR cost_label_source IS NULL GROUP BY process_code) e
WHERE n >= 20 AND best >= 10""", [], ["clean_rows"])
def m10_supported_processes(d: Domain):
    """Processes with at least one trained cost model (from the eligibility table)."""
    from forgeline.plans import etl, ml
    el = ml.cost_eligibility(readers.training_rows_without_estimated(etl.clean_training_rows(d)))
    return el.where("trained").select("process_code").distinct()


@register("s8_price_batches", """
SELECT DATE '2024-01-15' AS date, material_code, arg_min(price_usd_per_kg, seq) AS price_usd_per_kg, 'live' AS source
FROM m_prices WHERE date = DATE '2024-01-15' GROUP BY material_code
UNION ALL
SELECT DATE '2024-03-01', fb_mat, fb_price, 'fallback' FROM fb_pipeline""", ["price_usd_per_kg"],
          ["m_prices", "fb_pipeline"])
def s8_price_batches(d: Domain):
    """The daily batch for a day with archived prices (live rows, first per material) and for a
    day without any (the whole fallback table)."""
    import datetime as _dt
    from forgeline.constants import PIPELINE_FALLBACK_PRICES
    out = None
    for day in (_dt.date(2024, 1, 15), _dt.date(2024, 3, 1)):
        live = d.prices.where(F.col("date") == F.lit(day)).groupBy("material_code") \
            .agg(F.min_by("price_usd_per_kg", "seq").alias("price_usd_per_kg"))
        has_live = live.limit(1).count() > 0        # one-row probe decides live vs fallback
        b = readers.price_batch(d.spark, live if has_live else None, PIPELINE_FALLBACK_PRICES, day)
        b = b.select("date", "material_code", "price_usd_per_kg", "source")
        out = b if out is None else out.unionByName(b)
    return out
