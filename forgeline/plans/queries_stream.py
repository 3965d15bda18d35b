"""Registered monitoring queries: batch twins of the streaming monitors, and one real stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from forgeline.plans.registry import register
from forgeline.session import materialize, shared_path
from forgeline.sources.tables import Domain
from forgeline.streaming import alerts, monitors as mon
from forgeline.streaming.intake import Intake, order_intake


INTAKE_TRIGGERS = 4
INTAKE_FILE_ROWS = 1_000_000           # some 100 MB shuffled


def _ntz(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


@register("ts1_latency_windows", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, quantile_cont(value, 0.5) AS p50_ms,
  quantile_cont(value, 0.95) AS p95_ms, quantile_cont(value, 0.99) AS p99_ms,
  quantile_cont(value, 0.95) > 150.0e0 AS p95_alert
FROM events GROUP BY time_bucket(INTERVAL 5 MINUTE, ts)""", ["p50_ms", "p95_ms", "p99_ms"])
def ts1_latency_windows(d: Domain):
    """T-S1 batch twin: exact P50/P95/P99 latency per 5-minute window and the P95 > 150 ms alert."""
    return _ntz(mon.latency_windows(d.request_log), "window_start")


@register("ts2_error_rate_windows", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, CAST(count(*) AS BIGINT) AS requests,
  avg(CAST(event_type = 'error' AS DOUBLE)) * 100 AS error_pct, count(*) / 300.0e0 AS requests_per_s,
  avg(CAST(event_type = 'error' AS DOUBLE)) * 100 > 1.0e0 AS error_alert
FROM events GROUP BY time_bucket(INTERVAL 5 MINUTE, ts)""", ["error_pct", "requests_per_s"])
def ts2_error_rate_windows(d: Domain):
    """T-S2/T-S7 batch twin: error share and throughput per 5-minute window."""
    return _ntz(mon.window_rates(d.request_log), "window_start")


_TS3_SQL = """
WITH m AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start,
             avg(CAST(event_type = 'error' AS DOUBLE)) * 100 AS error_pct FROM events GROUP BY 1),
f AS (SELECT window_start, CAST(epoch(window_start) / 60 AS BIGINT) - row_number() OVER (ORDER BY window_start) AS grp
      FROM m WHERE error_pct > 1.0e0)
SELECT min(window_start) AS run_start, max(window_start) AS run_last, CAST(count(*) AS BIGINT) AS windows,
  CAST(count(*) * 60 AS BIGINT) AS duration_s, count(*) * 60 >= 120 AS fires,
  CASE WHEN count(*) * 60 >= 120 THEN min(window_start) + INTERVAL 120 SECOND END AS fires_at
FROM f GROUP BY grp"""


@register("ts3_held_error_alerts", _TS3_SQL)
def ts3_held_error_alerts(d: Domain):
    """T-S3 batch twin: error-rate alert held for 2 minutes over 1-minute windows (gaps and islands)."""
    rates = mon.window_rates(d.request_log, "1 minute", 60)
    out = mon.held_alerts(rates, "error_alert", 60, 120)
    return _ntz(out, "run_start", "run_last", "fires_at")


@register("ts1_latency_stream", """
SELECT window_start, CAST(count(*) AS BIGINT) AS requests, avg(CAST(event_type = 'error' AS DOUBLE)) * 100 AS error_pct
FROM (SELECT time_bucket(INTERVAL 1 MINUTE, ts) - to_minutes(i) AS window_start, event_type
      FROM events, (SELECT unnest(range(5)) AS i) m) w
GROUP BY window_start""", ["error_pct"])
def ts1_latency_stream(d: Domain):
    """T-S1/T-S2 streaming: file stream of events in several triggers in time order, watermark, 5-minute windows
    sliding 1 minute; every window up to the end of input, requests and error share of each."""
    base = shared_path(d.spark, "streams", uuid.uuid4().hex)

    def run():
        stream = mon.latency_stream(mon.read_event_stream(d.spark, base + "/in", "*.parquet"), "5 minutes", "1 minute", "10 minutes")
        return mon.run_to_upserts(stream, base + "/out", base + "/ckpt")

    out = mon.feed_in_time_order(d.table("events"), base + "/in", run)
    return _ntz(out.select("window_start", "requests", "error_pct"), "window_start")


_TS4_SQL = """
WITH h AS (SELECT date_trunc('hour', ts) AS run_ts, avg(value) > 60.0e0 AS drift_detected FROM events GROUP BY 1),
f AS (SELECT run_ts, CAST(epoch(run_ts) / 3600 AS BIGINT) - row_number() OVER (ORDER BY run_ts) AS grp
      FROM h WHERE drift_detected)
SELECT min(run_ts) AS run_start, max(run_ts) AS run_last, CAST(count(*) AS BIGINT) AS windows,
  CAST(count(*) * 3600 AS BIGINT) AS duration_s, count(*) * 3600 >= 7200 AS fires,
  CASE WHEN count(*) * 3600 >= 7200 THEN min(run_ts) + INTERVAL 7200 SECOND END AS fires_at
FROM f GROUP BY grp"""


@register("ts4_drift_flag_alerts", _TS4_SQL)
def ts4_drift_flag_alerts(d: Domain):
    """T-S4: hourly drift verdicts (mean of the logged value above a limit) held for two hours before alerting."""
    runs = d.request_log.groupBy(F.date_trunc("hour", "ts").alias("run_ts")).agg(
        (F.avg("latency_ms") > 60.0).alias("drift_detected"))
    return _ntz(mon.drift_flag_alerts(runs, hold_seconds=7200), "run_start", "run_last", "fires_at")


@register("ts6_incremental_intake", """
SELECT order_id, part_id, process_code, cost_total, wall_thickness_min, reject_bucket FROM ann""",
          ["cost_total", "wall_thickness_min"], ["ann"])
def ts6_incremental_intake(d: Domain):
    """T-S6: orders streamed in from many files over four triggers, with maintained state (order statistics, first
    rows); the rows taken in so far have the batch ETL's values and verdicts."""
    from forgeline.plans import etl
    base = shared_path(d.spark, "intake", uuid.uuid4().hex)
    # four triggers whatever the size; files of bounded rows, so that no task takes in a share of the whole
    files = max(1, -(-d.orders.count() // (INTAKE_TRIGGERS * INTAKE_FILE_ROWS)))
    d.orders.repartition(INTAKE_TRIGGERS * files).write.mode("overwrite").parquet(base + "/in")
    stream = d.spark.readStream.schema(d.orders.schema).option("maxFilesPerTrigger", files).parquet(base + "/in")
    order_intake(stream, lambda b: etl.enrich_order_batch(d, b), base + "/intake", base + "/ckpt")
    return Intake(d.spark, base + "/intake").training_rows().select(
        "order_id", "part_id", "process_code", "cost_total", "wall_thickness_min", "reject_bucket")


def _held_alert_stream(d: Domain, step_seconds: int, hold_seconds: int, condition, name: str):
    """The log fed in time order, a trigger each, then a heartbeat that closes its last windows."""
    base = shared_path(d.spark, name, uuid.uuid4().hex)
    events = d.table("events")

    def run():
        windows = alerts.flagged_windows(mon.read_event_stream(d.spark, base + "/in", "*.parquet"), step_seconds, condition, "10 minutes")
        return alerts.run_hold_alerts(windows, step_seconds, base + "/runs", base + "/ckpt")

    mon.feed_in_time_order(events, base + "/in", run)
    after = events.agg(F.date_format(F.max("ts") + F.make_dt_interval(secs=F.lit(step_seconds + 3600)), "yyyy-MM-dd HH:mm:ss")).first()[0]
    if after is not None:
        alerts.heartbeat(d.spark, after).write.mode("append").parquet(base + "/in")
        run()
    return _ntz(alerts.alert_runs(d.spark, base + "/runs", step_seconds, hold_seconds), "run_start", "run_last", "fires_at")


@register("ts3_held_error_stream", _TS3_SQL)
def ts3_held_error_stream(d: Domain):
    """T-S3 streaming: the error-rate alert held for 2 minutes, advanced a trigger at a time over final 1-minute windows."""
    return _held_alert_stream(d, 60, 120, alerts.error_share_above(), "held-errors")


@register("ts4_drift_flag_stream", _TS4_SQL)
def ts4_drift_flag_stream(d: Domain):
    """T-S4 streaming: hourly drift verdicts held for two hours, advanced a trigger at a time."""
    return _held_alert_stream(d, 3600, 7200, alerts.mean_value_above(60.0), "held-drift")


@register("ts1_latency_sketch_stream", """
WITH w AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) - to_minutes(i) AS window_start, event_type, value
  FROM events, (SELECT unnest(range(5)) AS i) m),
r AS (SELECT window_start, value, cume_dist() OVER (PARTITION BY window_start ORDER BY value) AS up_to FROM w WHERE value IS NOT NULL),
p AS (SELECT window_start, min(value) FILTER (WHERE up_to >= 0.95e0) AS p95 FROM r GROUP BY window_start)
SELECT window_start, CAST(count(*) AS BIGINT) AS requests, avg(CAST(event_type = 'error' AS DOUBLE)) * 100 AS error_pct,
  coalesce(any_value(p95) > 150.0e0, false) AS p95_alert, true AS p50_ok, true AS p95_ok, true AS p99_ok
FROM w LEFT JOIN p USING (window_start) GROUP BY window_start""", ["error_pct"])
def ts1_latency_sketch_stream(d: Domain):
    """T-S1 streaming: a KLL sketch a 1-minute pane, merged into 5-minute windows sliding 1 minute: the P95 alert, and whether
    P50 / P95 / P99 lie within the sketch's rank error among the window's events."""
    base = shared_path(d.spark, "panes", uuid.uuid4().hex)
    events = d.table("events")

    def run():
        panes = alerts.latency_panes(mon.read_event_stream(d.spark, base + "/in", "*.parquet"))
        return mon.run_to_upserts(panes, base + "/out", base + "/ckpt", "pane_start")

    windows = alerts.windows_of_panes(mon.feed_in_time_order(events, base + "/in", run))
    windows = materialize(windows, "windows")
    checked = windows.join(alerts.rank_bounds(windows, events), "window_start", "left")
    return _ntz(checked.select("window_start", "requests", "error_pct", "p95_alert", *[F.coalesce(c, F.lit(True)).alias(c) for c in ("p50_ok", "p95_ok", "p99_ok")]), "window_start")
