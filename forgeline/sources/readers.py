"""Sources (S1-S10, S14, S15): extracts, scans and lookups as DataFrames."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgeline.constants import TRACKED_MATERIALS
from forgeline.schemas import EQUIPMENT_LOG_SCHEMA, GEOMETRY_COLUMNS, PRICE_ARCHIVE_SCHEMA  # noqa: F401
from forgeline.session import materialize

ORDER_COLUMNS = ["order_id", "part_id", "process_code", "material_code", "quantity", "batch_size",
                 "surface_finish_ra", "tolerance_band", "order_date", "completion_date", "facility_id"]
INVOICE_COLUMNS = ["cost_total", "cost_machine_time", "cost_setup", "cost_tooling",
                   "cost_raw_material", "cost_finishing"]


def _date_filters(df: DataFrame, col: str, start, end) -> DataFrame:
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(col) <= F.lit(end).cast("date"))
    return df


def extract_completed(orders: DataFrame, invoices: DataFrame, start_date=None, end_date=None,
                      facility_ids: list[str] | None = None, sort: bool = False) -> DataFrame:
    """Completed orders LEFT JOIN invoices USING (order_id), optional bounds and facilities.

    Filters sit on the orders side so they reach the scan; no invoice -> NULL
    costs; several invoices repeat the order.  ``sort=True`` adds the
    reference's ORDER BY completion_date (a global sort: only for outputs).
    """
    o = orders.where(F.col("status") == "completed")
    o = _date_filters(o, "completion_date", start_date, end_date)
    if facility_ids:
        o = o.where(F.col("facility_id").isin(list(facility_ids)))
    inv = invoices.select("order_id", *INVOICE_COLUMNS, F.col("label_source").alias("cost_label_source"))
    out = o.select(*ORDER_COLUMNS).join(inv, "order_id", "left")
    out = out.select(*ORDER_COLUMNS, *INVOICE_COLUMNS, "cost_label_source")
    return out.orderBy("completion_date", "order_id") if sort else out


def extract_offline(df: DataFrame, start_date=None, end_date=None,
                    facility_ids: list[str] | None = None, today: _dt.date | None = None) -> DataFrame:
    """The offline extract: same filters, no status filter, no sort, defaults for absent columns.

    ``today`` is the date that an absent date column gets (the caller's, so that a run can be repeated).
    """
    day = F.lit(today).cast("date")
    out = df
    if "completion_date" in out.columns:
        out = _date_filters(out, "completion_date", start_date, end_date)
    if facility_ids and "facility_id" in out.columns:
        out = out.where(F.col("facility_id").isin(list(facility_ids)))
    cols = set(out.columns)
    defaults = {
        "quantity": F.lit(1),
        "batch_size": F.col("quantity") if "quantity" in cols else F.lit(1),
        "surface_finish_ra": F.lit("3.2"),
        "tolerance_band": F.lit("IT8"),
        "order_date": day,
        "completion_date": day,
        "facility_id": F.lit("FACILITY_01"),
        "cost_total": F.lit(0.0),
        "cost_label_source": F.lit("estimated"),
    }
    for name, expr in defaults.items():
        if name not in cols:
            out = out.withColumn(name, expr)
    for name in ("cost_machine_time", "cost_setup", "cost_tooling", "cost_raw_material", "cost_finishing"):
        if name not in cols:
            out = out.withColumn(name, F.lit(None).cast("double"))
    for name in ("order_id", "part_id", "process_code", "material_code"):
        if name not in cols:
            out = out.withColumn(name, F.lit(""))
    return out


def geometry_for_parts(geometry: DataFrame, part_ids: DataFrame) -> DataFrame:
    """S3: geometry rows of the requested part set (semi join; AQE may broadcast the ids)."""
    return geometry.join(part_ids.select("part_id").distinct(), "part_id", "left_semi")


def geometry_from_envelope(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Bulk JSON envelope ``{status, features:[...]}`` -> rows; returns missing columns."""
    from forgeline.schemas import GEOMETRY_ENVELOPE_SCHEMA
    env = spark.read.schema(GEOMETRY_ENVELOPE_SCHEMA).json(path)
    rows = env.select(F.inline("features"))
    missing = sorted(set(GEOMETRY_COLUMNS) - set(rows.columns))
    return rows, missing


def column_differences(df: DataFrame, expected: list[str]) -> DataFrame:
    """Expected against actual columns: column_name, expected, present and the rows with a value (null where absent).

    One aggregation over the rows; columns are listed in the order expected, unexpected ones last.
    """
    counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    at = {c: i for i, c in enumerate(df.columns)}
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(c in expected).alias("expected"), F.lit(c in at).alias("present"),
                              (F.col(f"n{at[c]}") if c in at else F.lit(None).cast("long")).alias("n_values"))
                     for c in [*expected, *[c for c in df.columns if c not in expected]]])
    return counted.select(F.inline(rows))


def csv_records(lines: DataFrame) -> DataFrame:
    """Lines (value, file, at = start of their file block, row) -> records (the same columns, those of its first line).

    A line break inside quotes does not end a record.  Whether a line starts inside quotes follows from
    the parity of the quotes before it: counted a block, summed over a file's blocks (a row each), and, only in
    blocks with a line of odd parity or that begin inside quotes, along the block's lines.
    The lines of a record that spans several are put together; all others pass through untouched.
    """
    odd = (F.char_length("value") - F.char_length(F.regexp_replace("value", '"', ""))) % 2
    lines = lines.withColumn("odd", odd)
    blocks = lines.groupBy("file", "at").agg(F.sum("odd").alias("odds"))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialize(blocks.withColumn("inside", F.coalesce(F.sum("odds").over(before), F.lit(0)) % 2)
                         .where("odds > 0 OR inside = 1").select("file", "at", "inside"), "quoted-blocks")
    whole = lines.join(blocks, ["file", "at"], "left_anti").select("value", "file", "at", "row")
    along = Window.partitionBy("file", "at").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    marked = lines.join(blocks, ["file", "at"]).withColumn("within", (F.col("inside") + F.coalesce(F.sum("odd").over(along), F.lit(0))) % 2)
    marked = materialize(marked.select("value", "file", "at", "row", "odd", "within"), "quoted-lines")
    alone = marked.where("within = 0 AND odd = 0").select("value", "file", "at", "row")
    # lines of longer records: each belongs to the last one before it that starts outside of quotes
    place = F.struct("at", "row")
    spanning = marked.where("within = 1 OR odd = 1")
    first = F.max(F.when(F.col("within") == 0, place)).over(Window.partitionBy("file", "at").orderBy("row"))
    last = spanning.where("within = 0").groupBy("file", "at").agg(F.max(place).alias("last"))
    running = F.max("last").over(Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    carried = blocks.select("file", "at").join(last, ["file", "at"], "left").withColumn("carried", running).select("file", "at", "carried")
    joined = (spanning.withColumn("first", first).join(carried, ["file", "at"], "left")
              .groupBy("file", F.coalesce("first", "carried").alias("start")).agg(F.sort_array(F.collect_list(F.struct("at", "row", "value"))).alias("parts"))
              .select(F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"), "file", "start.at", "start.row"))
    return whole.unionByName(alone).unionByName(joined)


def _csv_by_header(spark: SparkSession, path: str, schema: str, file_glob: str = "*") -> DataFrame:
    """CSV files read by the column names of their own headers, whatever their order; absent columns are NULL.

    ``seq`` numbers the rows by file name and then by place in the file.  All files are parsed in one
    pass, however many headers there are: a record becomes an array of fields, and a column is taken
    at its position in the header of the record's file.  Quoted fields may hold line breaks.
    """
    from pyspark.sql.types import StructType
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = (spark.read.option("pathGlobFilter", file_glob).option("ignoreCorruptFiles", True).text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                     F.monotonically_increasing_id().alias("row")))
    first = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "row").alias("header"))
    headers = materialize(first.withColumn("names", F.transform(
        F.split(F.ltrim(F.col("header"), F.lit("\ufeff")), ","), lambda c: F.btrim(F.trim(c), F.lit('"')))), "headers")
    width = headers.agg(F.max(F.size("names"))).first()[0] or 1
    fields = F.from_csv("value", ", ".join(f"c{i} string" for i in range(width)), {"escape": '"'})     # a quote in quotes is doubled
    rows = (csv_records(lines).join(headers, "file").where((F.col("value") != F.col("header")) & (F.trim("value") != ""))
            .select("file", "at", "row", "names", fields.alias("r")).select("file", "at", "row", "names", F.array(*[f"r.c{i}" for i in range(width)]).alias("v")))
    at = {f.name: F.array_position("names", f.name) for f in wanted.fields}
    return rows.select(*[F.when(at[f.name] > 0, F.try_element_at("v", at[f.name].cast("int"))).try_cast(f.dataType).alias(f.name) for f in wanted.fields],
                       F.struct("file", "at", "row").alias("seq"))


def scan_equipment_logs(spark: SparkSession, directory: str, facility_ids: list[str] | None = None) -> DataFrame:
    """Every ``equipment_log_*.csv`` in a directory, columns by header name, unreadable files skipped.

    Date arguments of the studied code are accepted there and ignored, so none
    exist here.  ``seq`` (file name, place in the file) breaks ties in file / row order.
    """
    df = _csv_by_header(spark, directory, EQUIPMENT_LOG_SCHEMA, "equipment_log_*.csv")
    return df.where(F.col("facility_id").isin(list(facility_ids))) if facility_ids else df


def scan_price_archive(spark: SparkSession, path: str) -> DataFrame:
    """Price archive read once with a fixed schema, columns by header name."""
    return _csv_by_header(spark, path, PRICE_ARCHIVE_SCHEMA)


def price_batch(spark: SparkSession, live: DataFrame | None, fallback: dict, as_of: _dt.date) -> DataFrame:
    """today's batch: live prices when a live batch exists, else the fallback table."""
    fb = spark.createDataFrame([(k, float(v)) for k, v in fallback.items()],
                               "material_code string, price_usd_per_kg double")
    if live is None:
        batch = fb.withColumn("source", F.lit("fallback"))
    else:
        batch = live.select("material_code", "price_usd_per_kg").withColumn("source", F.lit("live"))
    return batch.withColumn("date", F.lit(as_of).cast("date"))


def tracked_prices(prices: DataFrame) -> DataFrame:
    """P25: restrict prices to the 16 tracked materials."""
    return prices.where(F.col("material_code").isin(TRACKED_MATERIALS))


def training_rows_without_estimated(df: DataFrame) -> DataFrame:
    """Drop 'estimated' labels; NULL sources stay (pandas keeps them)."""
    return df.where((F.col("cost_label_source") != "estimated") | F.col("cost_label_source").isNull())


def read_process_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Ragged process catalog -> typed bounds (``any`` -> NULL, ``>=N`` -> N)."""
    from forgeline.functions.catalog import parse_process_catalog
    return parse_process_catalog(spark.read.text(path))
