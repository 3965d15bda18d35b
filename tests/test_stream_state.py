"""Streams with kept state: hold alerts, sketches of panes and incremental validation against their batch twins."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SMALL
from forgeline.plans import etl
from forgeline.sources import commits
from forgeline.sources.tables import Domain
from forgeline.streaming import alerts, monitors as mon
from forgeline.streaming.intake import Intake, order_intake

T0 = dt.datetime(2024, 5, 1, 10, 0)


def events(spark, rows):
    """(minutes after T0, event type, value) as an event file's rows."""
    return spark.createDataFrame([(i, T0 + dt.timedelta(minutes=m), 1, t, v, None) for i, (m, t, v) in enumerate(rows)],
                                 "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def runs_of(df):
    return sorted((r.run_start, r.run_last, r.windows, r.duration_s, r.fires, r.fires_at) for r in df.collect())


def test_hold_alerts_over_three_triggers(spark, tmp_path):
    base = str(tmp_path)
    files = [[(0.1, "error", 1.0), (1.2, "error", 1.0), (1.4, "view", 1.0), (3.0, "view", 1.0), (4.5, "error", 2.0)],
             [(12.0, "view", 1.0), (13.0, "error", 1.0), (30.0, "error", 1.0)],
             # minute 22 and 23 come late, within the ten minutes, and minute 31 joins the run that was open
             [(23.1, "error", 1.0), (22.5, "error", 1.0), (31.0, "error", 1.0), (50.0, "view", 1.0)]]

    def run(ckpt="/ckpt"):
        w = alerts.flagged_windows(mon.read_event_stream(spark, base + "/in", "*.parquet"), 60, alerts.error_share_above(), "10 minutes")
        alerts.run_hold_alerts(w, 60, base + "/runs", base + ckpt)

    seen = []
    for f in files:
        events(spark, f).coalesce(1).write.mode("append").parquet(base + "/in")
        run()
        seen.append(runs_of(alerts.alert_runs(spark, base + "/runs", 60, 120)))
    assert [len(s) for s in seen] == sorted(len(s) for s in seen)
    alerts.heartbeat(spark, "2024-05-01 12:00:00").write.mode("append").parquet(base + "/in")
    run()
    got = runs_of(alerts.alert_runs(spark, base + "/runs", 60, 120))
    everything = events(spark, [r for f in files for r in f])
    want = runs_of(mon.held_alerts(mon.window_rates(mon.as_request_log(everything), "1 minute", 60), "error_alert", 60, 120))
    assert got == want and [(r[0].minute, r[2], r[4]) for r in got] == [(0, 2, True), (4, 1, False), (13, 1, False), (22, 2, True), (30, 2, True)]
    before = commits.numbers(spark, base + "/runs/_log")
    run("/ckpt-again")                                           # batches replayed from the start: their numbers are taken
    assert runs_of(alerts.alert_runs(spark, base + "/runs", 60, 120)) == want
    assert commits.numbers(spark, base + "/runs/_log")[:len(before)] == before


def test_runs_join_across_batches(spark):
    slots = lambda *s: spark.createDataFrame([(x,) for x in s], "slot long")
    assert sorted(map(tuple, alerts.join_runs(slots(5, 6, 9), (2, 4)).collect())) == [(2, 6), (9, 9)]
    assert sorted(map(tuple, alerts.join_runs(slots(6), (2, 4)).collect())) == [(2, 4), (6, 6)]
    assert alerts.join_runs(slots(), None).count() == 0 and alerts.join_runs(slots(), (2, 4)).count() == 1


def test_no_alerts_without_events(spark, tmp_path):
    assert alerts.alert_runs(spark, str(tmp_path / "none"), 60, 120).count() == 0


def test_windows_of_sketched_panes(spark, tmp_path):
    log = spark.range(60_000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-05-01 10:00:00' + make_dt_interval(0, 0, 0, cast(id * 0.01 AS decimal(18, 6))) AS ts", "1L AS user_id",
        "if(id % 50 = 0, 'error', 'view') AS event_type", "cast(pmod(hash(id), 200000) AS double) / 1000 AS value", "cast(null AS string) AS props")
    panes = alerts.latency_panes(log)
    windows = alerts.windows_of_panes(panes).cache()
    assert panes.count() == 10 and windows.agg(F.sum("requests")).first()[0] == 5 * 60_000
    ok = alerts.rank_bounds(windows, log).collect()
    assert len(ok) == windows.count() and all(r.p50_ok and r.p95_ok and r.p99_ok for r in ok)
    assert windows.where("p95_alert").count() == windows.count() and windows.where("error_alert").count() == windows.count()
    wrong = alerts.rank_bounds(windows.withColumn("p95_ms", F.col("p95_ms") * 0.9), log).collect()
    assert not any(r.p95_ok for r in wrong) and all(r.p50_ok for r in wrong)
    few = events(spark, [(0, "view", 10.0), (0.5, "view", None), (7, "error", None), (7.5, "heartbeat", None), (20, "heartbeat", None)])
    got = {r.window_start: r for r in alerts.windows_of_panes(alerts.latency_panes(few)).collect()}
    assert len(got) == 10 and got[T0].p99_ms == 10.0 and got[T0].requests == 2 and got[T0 + dt.timedelta(minutes=7)].p95_ms is None
    assert not got[T0 + dt.timedelta(minutes=7)].p95_alert and got[T0 + dt.timedelta(minutes=7)].error_alert


def test_intake_equals_the_batch_run_after_each_trigger(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("forgeline.streaming.intake.COMPACT_EVERY", 2)
    d = Domain(spark, SMALL)
    orders = d.orders.orderBy(F.desc("order_id")).limit(1500).repartition(3, "order_id")
    parts = [orders.where(F.pmod(F.hash("order_id"), F.lit(3)) == k) for k in range(3)]
    read = []

    def enrich(batch):
        read.append(batch.count())
        return etl.enrich_order_batch(d, batch)
    path = str(tmp_path / "intake")
    so_far, columns = None, ["order_id", "process_code", "wall_thickness_min", "wall_thickness_avg", "hole_diameter_min", "reject_bucket", "reject_reasons"]
    rounded = lambda df: df.select(*[F.round(c, 9).alias(c) if c.startswith(("wall", "hole")) else F.col(c) for c in columns])
    for part in parts:
        part.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(d.orders.schema).parquet(str(tmp_path / "in"))
        order_intake(stream, enrich, path, str(tmp_path / "ck"))
        so_far = part if so_far is None else so_far.unionByName(part)
        got = rounded(Intake(spark, path).training_rows())
        want = rounded(etl.annotate_enriched(etl.enrich_order_batch(d, so_far)))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert read == [p.count() for p in parts]                    # a trigger reads its new orders only
    manifests = Intake(spark, path).manifests()
    assert [m["compacted"] for m in manifests] == [False, True, False]
    assert spark.read.parquet(f"{path}/{manifests[-1]['demoted']}").count() > 0
    Intake(spark, path).take(parts[0], 0, enrich)                # a replayed trigger
    assert len(read) == 3 and Intake(spark, path).training_rows().count() == got.count()
    assert Intake(spark, path).training_rows(upto=1).count() < got.count()
