"""The batch ETL (extract -> join -> normalise -> label -> validate) as one lazy plan.

``annotated_training_rows`` is the single plan all ETL outputs derive from;
``run_pipeline`` materialises it once into the shared folder (cutting the
lineage, so a lost executor re-reads the written table instead of
re-running the joins) and derives the clean table, the rejects and the
metrics from that copy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.operators.joins import join_geometry, price_at_date, rate_as_of
from forgeline.operators.labels import build_labels
from forgeline.operators.normalize import normalize
from forgeline.operators.validate import annotate, split_valid
from forgeline.sources.readers import extract_completed
from forgeline.session import materialize, release, scratch_tables
from forgeline.sources.tables import Domain

# Output column order of the training table.
TRAINING_COLUMNS = [
    "order_id", "part_id", "process_code", "material_code", "quantity", "batch_size",
    "surface_finish_ra", "tolerance_band", "order_date", "completion_date", "facility_id",
    "cost_total", "cost_machine_time", "cost_setup", "cost_tooling", "cost_raw_material",
    "cost_finishing", "cost_label_source",
    "bounding_box_x", "bounding_box_y", "bounding_box_z", "volume", "surface_area",
    "wall_thickness_min", "wall_thickness_avg", "aspect_ratio", "hole_count", "hole_diameter_min",
    "undercut_flag", "thin_wall_flag", "curvature_complexity", "symmetry_score",
    "effective_hourly_rate", "material_price_per_kg",
    "wall_thickness_min_imputed", "wall_thickness_avg_imputed",
    "process_code_encoded", "material_code_encoded", "log_quantity", "volume_x_price",
    "tolerance_index",
]


def enriched_orders(d: Domain, start_date=None, end_date=None, facility_ids=None,
                    clean_codes_first: bool = False, barriers: bool = False) -> DataFrame:
    """S1 -> J1 -> J3 -> J2: completed orders with geometry, machine rate and price.

    As in the reference the lookups use the raw (un-normalised) codes unless
    ``clean_codes_first`` is set.  With ``barriers`` the extract is written before it meets the
    geometry, so that the two large joins do not hold their shuffles at once.
    """
    ex = extract_completed(d.orders, d.invoices, start_date, end_date, facility_ids)
    if barriers:
        ex = materialize(ex, "extract", None, "zstd")
    if clean_codes_first:
        from forgeline.operators.normalize import clean_codes
        ex = clean_codes(ex)
    j = join_geometry(ex, d.geometry)
    # date range for the rate calendar from a pruned scan of the orders (covers ex)
    j = rate_as_of(j, d.equipment, date_bounds=d.orders.select("order_date"))
    return price_at_date(j, d.prices)


def training_rows(d: Domain, barriers: bool = True, **kw) -> DataFrame:
    """Normalised and labelled rows before validation.

    With ``barriers`` the enriched orders are written to the shared folder (columnar, so
    each consumer reads its own columns) before normalising: the median and mean tables
    and the main projection all read that one copy instead of re-running the three joins.
    """
    if not barriers:
        return build_labels(normalize(enriched_orders(d, **kw)))
    with scratch_tables([]) as before:
        enriched = enriched_orders(d, barriers=True, **kw)
    enriched = materialize(enriched, "enriched", None, "zstd")
    release(*before)
    return build_labels(normalize(enriched))


def annotated_training_rows(d: Domain, barriers: bool = True, **kw) -> DataFrame:
    """Every row with its validation verdict (reject columns NULL when clean).

    ``annotate`` writes the rows, so the tables below them are deleted.
    """
    with scratch_tables([]) as before:
        rows = training_rows(d, barriers=barriers, **kw)
    annotated = annotate(rows)
    release(*before)
    return annotated


def annotate_enriched(enriched: DataFrame) -> DataFrame:
    """The rest of the ETL (normalise, label, validate) over a table of enriched orders."""
    return annotate(build_labels(normalize(enriched)))


def clean_training_rows(d: Domain, **kw) -> DataFrame:
    """The flagship output: validated, priced, labelled training rows."""
    clean, _ = split_valid(annotated_training_rows(d, **kw))
    return clean.select(*TRAINING_COLUMNS)


@dataclass
class PipelineResult:
    clean: DataFrame
    rejected: DataFrame
    annotated_path: str


def run_pipeline(d: Domain, out_dir: str | None = None, **kw) -> PipelineResult:
    """S16-style run: materialise the annotated frame once, return clean / rejected views.

    The annotated frame is written as parquet under the shared checkpoint
    folder (or ``out_dir``); later outputs read it back, so their lineage
    starts at that table.
    """
    from forgeline.session import shared_path
    import uuid
    path = out_dir or shared_path(d.spark, "etl", uuid.uuid4().hex)
    annotated_training_rows(d, **kw).write.mode("overwrite").parquet(path)
    a = d.spark.read.parquet(path)
    clean, rejected = split_valid(a)
    return PipelineResult(clean.select(*TRAINING_COLUMNS), rejected, path)


def rows_by_process(clean: DataFrame) -> DataFrame:
    """G3 over the clean rows: rows and mean total cost per process."""
    return clean.groupBy("process_code").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg("cost_total"), 6).alias("avg_cost_total"))


def enrich_order_batch(d: Domain, orders_batch: DataFrame) -> DataFrame:
    """T-S6 micro-batch body: invoices, geometry, rate and price of a batch of new orders."""
    from forgeline.sources.readers import extract_completed
    j = join_geometry(extract_completed(orders_batch, d.invoices), d.geometry)
    j = rate_as_of(j, d.equipment, date_bounds=orders_batch.select("order_date"))
    return price_at_date(j, d.prices)
