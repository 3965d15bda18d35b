"""Alerts that must hold (T-S3, T-S4) and latency percentiles from sketches (T-S1) as streams.

Hold alerts: a windowed stream emits each window once the watermark has passed it, in the order of
their ends from one batch to the next.  Every micro-batch joins its flagged windows to the run that was open before,
and commits the runs that are over together with the one that is still open (its first and last window, the
whole state) under the batch's number; a replayed batch finds its number taken and changes nothing.

Heartbeats (events of type ``heartbeat``) are not counted; they move the watermark on, so that the windows before
them become final while the service is silent.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forgeline.session import materialize, release
from forgeline.sources import commits
from forgeline.streaming.monitors import ERROR_RATE_LIMIT_PCT, P95_LIMIT_MS, REQUEST_LOG_SCHEMA, finish

HEARTBEAT = "heartbeat"
CLOSED_SCHEMA = "first long, last long"
SKETCH_K = 1000
# of the sketch in ranks: its authors' 99 % bound is 0.36 % for one quantile at this size
RANK_ERROR = 0.005


def heartbeat(spark: SparkSession, ts: str) -> DataFrame:
    """One heartbeat at a time (``YYYY-MM-DD hh:mm:ss``), in the columns of the event files."""
    return spark.createDataFrame([(ts,)], "ts string").select(
        *[F.col("ts").cast("timestamp_ntz") if c == "ts" else F.lit(HEARTBEAT).alias(c) if c == "event_type" else F.lit(None).cast(t).alias(c)
          for c, t in (x.split(" ") for x in REQUEST_LOG_SCHEMA.split(", "))])


def real_event() -> Column:
    return ~F.col("event_type").eqNullSafe(F.lit(HEARTBEAT))


def error_share_above(limit_pct: float = ERROR_RATE_LIMIT_PCT) -> Column:
    """Condition of a window: its error share in percent is above the limit."""
    return F.avg(F.when(real_event(), (F.col("event_type") == "error").cast("double"))) * 100 > limit_pct


def mean_value_above(limit: float) -> Column:
    """Condition of a window: the mean of the logged value is above the limit."""
    return F.avg(F.when(real_event(), F.col("value"))) > limit


def flagged_windows(events: DataFrame, step_seconds: int, condition: Column, watermark: str) -> DataFrame:
    """Final windows of a stream of events: window_start and whether the condition held; silent windows do not appear."""
    log = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    return (log.groupBy(F.window("ts", f"{step_seconds} seconds").alias("w"))
            .agg(F.count_if(real_event()).alias("events"), F.coalesce(condition, F.lit(False)).alias("flagged"))
            .where("events > 0").select(F.col("w.start").alias("window_start"), "flagged"))


def join_runs(windows: DataFrame, open_run: tuple[int, int] | None) -> DataFrame:
    """Runs (first, last slot) of adjacent flagged slots, an open run before them included."""
    spans = windows.select(F.col("slot").alias("first"), F.col("slot").alias("last"))
    if open_run is not None:
        spans = spans.unionByName(windows.sparkSession.createDataFrame([open_run], CLOSED_SCHEMA))
    # one span a flagged window of this batch
    order = Window.partitionBy(F.lit(0)).orderBy("first")
    begins = F.coalesce(F.col("first") > F.lag("last").over(order) + 1, F.lit(True))
    return (spans.withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(order))
            .groupBy("run").agg(F.min("first").alias("first"), F.max("last").alias("last")).select("first", "last"))


def run_hold_alerts(windows: DataFrame, step_seconds: int, out_path: str, checkpoint: str, timeout_s: float | None = None) -> StreamingQuery:
    """Run a stream of ``flagged_windows`` on what is available now and keep its runs below ``out_path`` (``alert_runs``).

    Manifest N + 1 belongs to micro-batch N: the run left open and the folder of those that ended.
    """
    log = f"{out_path}/{commits.LOG}"

    def advance(batch: DataFrame, epoch_id: int) -> None:
        spark, number = batch.sparkSession, epoch_id + 1
        slots = materialize(batch.where("flagged").select((F.unix_timestamp("window_start") / step_seconds).cast("long").alias("slot")), "flagged")
        if commits.is_committed(spark, log, number):              # the windows had to be read for the stream's own state
            release(slots)
            return
        earlier = [n for n in commits.numbers(spark, log) if n < number]
        before = commits.entry(spark, log, earlier[-1])["open"] if earlier else None
        runs = join_runs(slots, tuple(before) if before else None)
        newest = runs.orderBy(F.desc("last")).first()
        still = [newest["first"], newest["last"]] if newest else None
        folder = f"commit={uuid.uuid4().hex}"
        if newest:
            runs.where(F.col("last") < newest["last"]).write.parquet(f"{out_path}/{folder}")
        commits.commit(spark, log, lambda n, _: {"open": still, "folder": folder if newest else None}, number)
        release(slots)

    return finish(windows.writeStream.foreachBatch(advance).option("checkpointLocation", checkpoint)
                  .outputMode("append").trigger(availableNow=True).start(), timeout_s)


def alert_runs(spark: SparkSession, out_path: str, step_seconds: int, hold_seconds: int) -> DataFrame:
    """All runs so far in the columns of ``monitors.held_alerts``, the open one included."""
    log = f"{out_path}/{commits.LOG}"
    manifests = [commits.entry(spark, log, n) for n in commits.numbers(spark, log)]
    folders = [f"{out_path}/{m['folder']}" for m in manifests if m["folder"]]
    runs = spark.createDataFrame([tuple(manifests[-1]["open"])] if manifests and manifests[-1]["open"] else [], CLOSED_SCHEMA)
    if folders:
        runs = runs.unionByName(spark.read.schema(CLOSED_SCHEMA).parquet(*folders))
    windows = F.col("last") - F.col("first") + 1
    start = F.timestamp_seconds(F.col("first") * step_seconds)
    fires = windows * step_seconds >= hold_seconds
    return runs.select(start.alias("run_start"), F.timestamp_seconds(F.col("last") * step_seconds).alias("run_last"), windows.alias("windows"),
                       (windows * step_seconds).alias("duration_s"), fires.alias("fires"),
                       F.when(fires, F.timestamp_seconds(F.col("first") * step_seconds + hold_seconds)).alias("fires_at"))


# --- T-S1: sketches -------------------------------------------------------------------
def latency_panes(events: DataFrame, pane: str = "1 minute", watermark: str = "10 minutes", k: int = SKETCH_K) -> DataFrame:
    """One row a pane of a stream (or table): a KLL sketch of its latencies, requests and errors.

    An event is counted once, in its pane; windows are merged from panes (``windows_of_panes``).
    """
    log = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    return log.groupBy(F.window("ts", pane).alias("w")).agg(
        F.kll_sketch_agg_double(F.when(real_event(), F.col("value")), k).alias("sketch"),
        F.count_if(real_event()).alias("requests"), F.count_if(F.col("event_type") == "error").alias("errors")) \
        .select(F.col("w.start").alias("pane_start"), "sketch", "requests", "errors")


def windows_of_panes(panes: DataFrame, pane_seconds: int = 60, panes_a_window: int = 5, k: int = SKETCH_K) -> DataFrame:
    """Sliding windows of ``panes_a_window`` panes that step by one: percentiles, requests, error share and alerts.

    A window without a latency has null percentiles and no latency alert.
    """
    starts = F.transform(F.sequence(F.lit(0), F.lit(panes_a_window - 1)), lambda i: F.timestamp_seconds(F.unix_timestamp("pane_start") - i * pane_seconds))
    merged = (panes.where("requests > 0").withColumn("window_start", F.explode(starts)).groupBy("window_start")
              .agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("requests").alias("requests"), F.sum("errors").alias("errors")))
    q = F.when(F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99))))
    error_pct = F.col("errors") / F.col("requests") * 100
    return merged.withColumn("q", q).select(
        "window_start", F.col("q")[0].alias("p50_ms"), F.col("q")[1].alias("p95_ms"), F.col("q")[2].alias("p99_ms"), "requests", error_pct.alias("error_pct"),
        F.coalesce(F.col("q")[1] > P95_LIMIT_MS, F.lit(False)).alias("p95_alert"), (error_pct > ERROR_RATE_LIMIT_PCT).alias("error_alert"))


def rank_bounds(windows: DataFrame, events: DataFrame, pane_seconds: int = 60, panes_a_window: int = 5) -> DataFrame:
    """Whether each window's percentiles lie within ``RANK_ERROR`` of their rank among its events (window_start, p50_ok, p95_ok, p99_ok).

    The events are counted below and up to the estimates in one aggregation: a batch check of the sketches.
    """
    pane = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / pane_seconds) * pane_seconds
    starts = F.transform(F.sequence(F.lit(0), F.lit(panes_a_window - 1)), lambda i: F.timestamp_seconds(pane - i * pane_seconds))
    spread = events.where(real_event() & F.col("value").isNotNull()).select("value", F.explode(starts).alias("window_start"))
    both = spread.join(windows.select("window_start", "p50_ms", "p95_ms", "p99_ms"), "window_start")
    names = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    counted = both.groupBy("window_start").agg(F.count("*").alias("n"), *[
        F.count_if(F.col("value") < F.col(f"{p}_ms")).alias(f"{p}_below") for p in names], *[
        F.count_if(F.col("value") <= F.col(f"{p}_ms")).alias(f"{p}_to") for p in names])
    return counted.select("window_start", *[
        ((F.col(f"{p}_below") <= (at + RANK_ERROR) * F.col("n")) & (F.col(f"{p}_to") >= (at - RANK_ERROR) * F.col("n"))).alias(f"{p}_ok")
        for p, at in names.items()])
