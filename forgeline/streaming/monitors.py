"""Service monitoring as Structured Streaming jobs with batch twins (T-S1..T-S7).

The request log is a stream of ``(ts, latency_ms, is_error)`` rows.  The
streaming jobs use event-time windows with a watermark, so state is bounded
by the watermark and old windows are finalised and dropped.  Every streaming
job has a batch twin over the same rows (exact percentiles) that the tests
compare against and that the oracle restates in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forgeline.operators.quantiles import exact_percentiles
from forgeline.sources.commits import PartitionedTable

P95_LIMIT_MS = 150.0
ERROR_RATE_LIMIT_PCT = 1.0
REQUEST_LOG_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def as_request_log(events: DataFrame) -> DataFrame:
    """Request log view of an events frame (works on batch and streaming frames)."""
    return events.select(F.col("ts").cast("timestamp").alias("ts"), "event_id",
                         F.col("value").alias("latency_ms"), (F.col("event_type") == "error").alias("is_error"))


# --- batch twins ---------------------------------------------------------------
def latency_windows(log: DataFrame, window: str = "5 minutes") -> DataFrame:
    """T-S1 batch twin: exact P50/P95/P99 per tumbling window and the P95 alert."""
    w = log.withColumn("window_start", F.window("ts", window)["start"])
    pct = exact_percentiles(w, ["window_start"], "latency_ms", [0.5, 0.95, 0.99], ["p50_ms", "p95_ms", "p99_ms"])
    return pct.withColumn("p95_alert", F.col("p95_ms") > P95_LIMIT_MS)


def window_rates(log: DataFrame, window: str = "5 minutes", seconds: int = 300) -> DataFrame:
    """T-S2 / T-S7 batch twin: requests, error share (%) and throughput per tumbling window."""
    w = log.groupBy(F.window("ts", window)["start"].alias("window_start")).agg(
        F.count(F.lit(1)).alias("requests"),
        (F.avg(F.col("is_error").cast("double")) * 100).alias("error_pct"))
    return (w.withColumn("requests_per_s", F.col("requests") / F.lit(float(seconds)))
            .withColumn("error_alert", F.col("error_pct") > ERROR_RATE_LIMIT_PCT))


def held_alerts(metrics: DataFrame, flag_col: str, step_seconds: int, hold_seconds: int,
                time_col: str = "window_start") -> DataFrame:
    """T-S3 batch twin: runs of consecutive flagged windows (gaps and islands); an alert
    fires once a run has lasted ``hold_seconds``.  Runs over the per-window table only."""
    from forgeline.operators.quantiles import running_totals
    f = metrics.where(F.col(flag_col)).select(time_col)
    slot = (F.unix_timestamp(time_col) / step_seconds).cast("long")
    # rank of each flagged window in time order from distributed running counts
    # (no single-partition window); consecutive windows share slot - rank
    vc = f.select(time_col, slot.alias("__slot")).groupBy(time_col, "__slot").agg(F.count(F.lit(1)).alias("__one"))
    ranked = running_totals(vc, [], "__slot", ["__one"], total_suffix=None)
    runs = ranked.withColumn("__grp", F.col("__slot") - F.col("cum___one")) \
        .groupBy("__grp").agg(F.min(time_col).alias("run_start"), F.max(time_col).alias("run_last"),
                              F.count(F.lit(1)).alias("windows"))
    runs = runs.withColumn("duration_s", F.col("windows") * step_seconds)
    return runs.select("run_start", "run_last", "windows", "duration_s",
                       (F.col("duration_s") >= hold_seconds).alias("fires"),
                       F.when(F.col("duration_s") >= hold_seconds,
                              F.col("run_start") + F.make_interval(secs=F.lit(hold_seconds))).alias("fires_at"))


# --- streaming jobs -------------------------------------------------------------
def read_event_stream(spark: SparkSession, directory: str, file_glob: str = "events*.parquet",
                      max_files: int | None = None) -> DataFrame:
    """A file stream over parquet event files (new files are picked up incrementally)."""
    r = spark.readStream.schema(REQUEST_LOG_SCHEMA).option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(directory)


def latency_stream(events: DataFrame, window: str = "5 minutes", slide: str | None = None,
                   watermark: str = "10 minutes") -> DataFrame:
    """T-S1/T-S2/T-S7 streaming: watermark + event-time windows, approximate percentiles
    (bounded-memory sketch), error share and counts per window."""
    log = as_request_log(events).withWatermark("ts", watermark)
    win = F.window("ts", window, slide) if slide else F.window("ts", window)
    return log.groupBy(win.alias("w")).agg(
        F.percentile_approx("latency_ms", [0.5, 0.95, 0.99], 10000).alias("pct"),
        F.count(F.lit(1)).alias("requests"),
        (F.avg(F.col("is_error").cast("double")) * 100).alias("error_pct"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
             F.col("pct")[0].alias("p50_ms"), F.col("pct")[1].alias("p95_ms"), F.col("pct")[2].alias("p99_ms"),
             "requests", "error_pct", (F.col("pct")[1] > P95_LIMIT_MS).alias("p95_alert"),
             (F.col("error_pct") > ERROR_RATE_LIMIT_PCT).alias("error_alert"))


def finish(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait until a stream has processed what is available; no caller reads a part-written table.

    Without ``timeout_s`` it waits as long as the stream runs.  With one, a stream that is
    still running then is stopped and an error raised.  A failed stream raises its own error.
    """
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} was still running after {timeout_s} s")
    return query


def run_to_table(stream_df: DataFrame, out_path: str, checkpoint: str, mode: str = "append",
                 timeout_s: float | None = None) -> StreamingQuery:
    """Run a streaming frame to completion on what is available now, into parquet.

    ``append`` mode emits a window once the watermark has passed it, so the output is final
    and safe to re-run (the checkpoint records progress); windows the watermark has not passed
    by then come with later input.  ``run_to_upserts`` has them all.
    """
    q = (stream_df.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start())
    return finish(q, timeout_s)


def run_to_upserts(stream_df: DataFrame, out_path: str, checkpoint: str, key: str = "window_start",
                   timeout_s: float | None = None) -> DataFrame:
    """Run a windowed stream in update mode and return the newest row per ``key``.

    Each micro-batch writes the windows it changed into a partition of its own number, so a
    replayed batch replaces its first attempt; the newest batch of a window has its state up to
    the end of input, also for windows the watermark has not passed.
    """
    spark = stream_df.sparkSession

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={epoch_id}")

    finish(stream_df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
           .outputMode("update").trigger(availableNow=True).start(), timeout_s)
    rows = spark.read.schema(stream_df.schema.add("batch", "long")).parquet(out_path)
    value = F.struct(*stream_df.columns)
    return rows.groupBy(key).agg(F.max_by(value, "batch").alias("v")).select("v.*")


def feed_in_time_order(events: DataFrame, directory: str, run, parts: int = 3):
    """Append ``events`` to a stream's input folder one time range after another and ``run`` the stream on each;
    the result of the last run.  All files of a range come in one trigger, so a short watermark loses no row.
    """
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    part = F.floor((at - F.lit(low)) * F.lit(parts) / F.lit((high or 0) - (low or 0) + 1))
    out = None
    for k in range(parts):
        events.where(part == k).write.mode("append").parquet(directory)
        out = run()
    return out


PRICE_ARCHIVE_SCHEMA = "date date, material_code string, price_usd_per_kg double, source string, seq long"


def price_archive(spark: SparkSession, path: str) -> PartitionedTable:
    """The archive of daily prices: one partition a date, replaced by commits."""
    return PartitionedTable(spark, path, "date", PRICE_ARCHIVE_SCHEMA)


def read_price_archive(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the price archive."""
    return price_archive(spark, path).read()


def price_feed_stream(prices: DataFrame, archive_path: str, checkpoint: str,
                      timeout_s: float | None = None) -> StreamingQuery:
    """T-S5: daily price batches upserted into a date-partitioned archive (S7), a commit each.

    Each micro-batch keeps the first row per (date, material) (lowest ``seq``) and replaces those keys in
    the partitions of its dates; readers see all of a batch or nothing of it, a replayed batch gives the
    same archive and other writers' commits are merged with.  An archive that exists but cannot be
    read fails the batch; it is never taken for an empty one.
    """
    from forgeline.operators.joins import upsert_prices

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        first = batch.groupBy("date", "material_code").agg(
            F.min_by(F.struct("price_usd_per_kg", "source", "seq"), "seq").alias("r")) \
            .select("date", "material_code", "r.price_usd_per_kg", "r.source", "r.seq")
        price_archive(batch.sparkSession, archive_path).upsert(first, upsert_prices)

    q = (prices.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    return finish(q, timeout_s)


def drift_flag_alerts(drift_runs: DataFrame, hold_seconds: int = 3600, step_seconds: int = 3600) -> DataFrame:
    """T-S4: drift verdicts per run (``run_ts``, ``drift_detected``) held for an hour before alerting."""
    m = drift_runs.select(F.col("run_ts").alias("window_start"), F.col("drift_detected"))
    return held_alerts(m, "drift_detected", step_seconds, hold_seconds)


def order_intake_stream(orders: DataFrame, build_batch, accepted_path: str, checkpoint: str,
                        timeout_s: float | None = None) -> StreamingQuery:
    """T-S6: incremental order intake.

    Each micro-batch of new order rows is enriched (stream-static joins against geometry, prices
    and the equipment log happen inside ``build_batch``) and kept in a partition of its own
    number, so a replayed batch replaces its first attempt and no row is kept twice.
    What needs all rows, medians and the first row per key, is left to the reader of
    the table: ``etl.annotate_enriched`` over it equals the batch ETL at any number of triggers.
    """
    def process(batch: DataFrame, epoch_id: int) -> None:
        build_batch(batch).write.mode("overwrite").parquet(f"{accepted_path}/intake={epoch_id}")

    q = (orders.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    return finish(q, timeout_s)
