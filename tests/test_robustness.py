"""Cases that must fail loudly, hold at any size, or agree with a plain computation."""

import datetime as dt
import math
from unittest.mock import MagicMock

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SMALL
from forgeline.operators import joins, rules, validate
from forgeline.plans import analytics, etl, ml, quality
from forgeline.sources import readers, sinks
from forgeline.sources.tables import Domain
from forgeline.streaming import monitors as mon


@pytest.mark.parametrize("n,expected", [(1e6, 1.0), (1e8, 1.0), (50.0, None)])
def test_ks_pvalue_at_any_size(spark, n, expected):
    d = 1 / n if expected else 0.3
    p = spark.range(1).select(quality.ks_pvalue(F.lit(d), F.lit(n / 2)).alias("p")).first().p
    lam = math.sqrt(n / 2) * d
    exact = expected or 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 2000))
    assert abs(p - exact) < 1e-12


def test_ks_series_meet_at_the_switch(spark):
    lams = [0.02, 0.3, 1.0, 1.17999, 1.18001, 2.5]
    rows = spark.createDataFrame([(x,) for x in lams], "d double").select(quality.ks_pvalue(F.col("d"), F.lit(1.0)).alias("p")).collect()
    for lam, r in zip(lams, rows):
        exact = 1.0 if lam < 0.1 else 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 5000))
        assert abs(r.p - exact) < 1e-12


def test_stream_timeout_raises(spark, tmp_path):
    spark.range(50).write.parquet(str(tmp_path / "in"))
    slow = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))

    def body(batch, epoch):
        import time
        time.sleep(20)
    q = slow.writeStream.foreachBatch(body).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    with pytest.raises(TimeoutError):
        mon.finish(q, 0.5)
    assert not q.isActive


def test_unreadable_archive_and_catalog_raise(spark, tmp_path):
    for name in ("archive", "catalog"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.parquet").write_bytes(b"not parquet")
    rows = [(dt.date(2024, 1, 1), "AL6061", 2.0, "live", 1)]
    schema = "date date, material_code string, price_usd_per_kg double, source string, seq long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        mon.price_feed_stream(stream, str(tmp_path / "archive"), str(tmp_path / "ck"))
    assert [p.name for p in (tmp_path / "archive").iterdir() if not p.name.startswith(".")] == ["part-0.parquet"]
    with pytest.raises((PySparkException, Py4JJavaError)):
        sinks.next_version(spark, str(tmp_path / "catalog"))


def test_a_version_is_never_overwritten(spark, tmp_path):
    base, cat = str(tmp_path / "d"), str(tmp_path / "c")
    assert sinks.write_version(spark.range(3).toDF("x"), base, cat) == 1
    with pytest.raises((PySparkException, Py4JJavaError)):
        sinks.write_version(spark.range(9).toDF("x"), base, cat, version=1)
    assert sinks.read_latest(spark, base, cat).count() == 3
    age = dt.datetime.now() - sinks.read_catalog(spark, cat).first().created_at
    assert abs(age.total_seconds()) < 3 * 86400


def test_csv_columns_by_header_name(spark, tmp_path):
    (tmp_path / "equipment_log_b.csv").write_text("week_start,effective_hourly_rate_usd,facility_id,machine_id,process_code\n2024-01-08,55.5,F2,M2,cnc_milling\n2024-01-15,oops,F2,M2,forging\n")
    (tmp_path / "equipment_log_a.csv").write_text("facility_id,machine_id,process_code,week_start,availability_pct,effective_hourly_rate_usd\nF1,M1,edm,2024-01-01,97.5,40\n")
    (tmp_path / "notes.csv").write_text("facility_id\nF9\n")
    rows = readers.scan_equipment_logs(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r.facility_id, r.machine_id, r.process_code, r.week_start, r.availability_pct, r.effective_hourly_rate_usd) for r in rows] == [
        ("F1", "M1", "edm", dt.date(2024, 1, 1), 97.5, 40.0), ("F2", "M2", "cnc_milling", dt.date(2024, 1, 8), None, 55.5),
        ("F2", "M2", "forging", dt.date(2024, 1, 15), None, None)]
    assert readers.scan_equipment_logs(spark, str(tmp_path), ["F1"]).count() == 1


def test_offline_defaults(spark):
    day = dt.date(2024, 5, 1)
    r = readers.extract_offline(spark.createDataFrame([("O1", 7)], "order_id string, quantity int"), today=day).first()
    assert (r.batch_size, r.surface_finish_ra, r.tolerance_band, r.order_date, r.facility_id, r.cost_total, r.part_id) == (
        7, "3.2", "IT8", day, "FACILITY_01", 0.0, "")
    assert r.cost_machine_time is None and r.cost_label_source == "estimated"


def test_malformed_numbers_are_counted_not_raised(spark):
    df = spark.createDataFrame([("12", "1.5"), ("x", "y"), (None, "2")], "quantity string, volume string")
    failed = {r.column: r.n_failed for r in validate.cast_failures(df).collect()}
    assert failed["quantity"] == 1 and failed["volume"] == 1


def test_vif_of_dependent_and_constant_columns(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=200), rng.normal(size=200)
    rows = [(float(x), float(y), float(2 * x - y), float(z), 1.0) for x, y, z in zip(a, b, rng.normal(size=200))]
    df = spark.createDataFrame(rows + [(None, 1.0, 1.0, 1.0, 1.0)], "a double, b double, c double, d double, k double")
    v = dict(analytics.vif(df, ["a", "b", "c", "d", "k"]))
    assert v["a"] == v["b"] == v["c"] == math.inf and 1.0 <= v["d"] < 1.1 and v["k"] is None


def test_rank_is_total_for_repeated_keys(spark):
    rows = [("k1", 1), ("k1", 2), ("k1", 2), ("k2", 1), ("k3", None)]
    r = ml.stratified_rank(spark.createDataFrame(rows, "key string, v int"), [], "key").collect()
    assert sorted(x["__rank"] for x in r) == [0, 1, 2, 3, 4] and {x["__n"] for x in r} == {5}
    assert sorted((x.key, x.v or 0) for x in r) == sorted((k, v or 0) for k, v in rows)


def test_overrides_keep_every_rank(spark):
    codes = [f"p{i}" for i in range(150)]
    df = spark.createDataFrame([(codes, 0.9, 1.0, 5000.0)], "ranked array<string>, curvature_complexity double, wall_thickness_min double, volume double")
    out = df.select(rules.ranking_overrides(F.col("ranked"), enabled=True).alias("r")).first().r
    assert len(out) == 151 and out[2] == "investment_casting" and out[-1] == "p149"


def test_lookup_joins_do_not_shuffle_the_orders(spark):
    d = Domain(spark, SMALL)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")       # below the events table, above the lookups
        for df in (joins.price_at_date(d.orders, d.prices), joins.rate_as_of(d.orders, d.equipment, date_bounds=d.orders)):
            plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_intake_replayed_batch_and_many_triggers_equal_the_batch_run(spark, tmp_path):
    d = Domain(spark, SMALL)
    d.orders.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(d.orders.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = []

    def enrich(batch):
        seen.append(1)
        return etl.enrich_order_batch(d, batch)
    accepted = str(tmp_path / "accepted")
    mon.order_intake_stream(stream, enrich, accepted, str(tmp_path / "ck"))
    assert len(seen) >= 3
    first = spark.read.parquet(accepted).where("intake = 0").drop("intake").count()
    before = spark.read.parquet(accepted).count()
    mon.order_intake_stream(stream, enrich, accepted, str(tmp_path / "ck-again"))   # every batch replayed
    assert spark.read.parquet(accepted).count() == before > first > 0
    got = etl.annotate_enriched(spark.read.parquet(accepted).drop("intake")).select("order_id", "reject_bucket")
    want = etl.annotated_training_rows(d).select("order_id", "reject_bucket")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_emits_every_window(spark, tmp_path):
    src = spark.read.parquet(f"{SMALL}/events.parquet")
    src.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = mon.latency_stream(spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), "6 hours", None, "100 days")
    out = mon.run_to_upserts(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    twin = mon.window_rates(mon.as_request_log(src), "6 hours", 6 * 3600)
    a = out.select("window_start", "requests")
    b = twin.select("window_start", "requests")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_served_costs_follow_the_request(spark):
    import json

    from forgeline.constants import COST_FEATURE_COLUMNS, FETCHER_FALLBACK_PRICES, MODEL_COMPONENT_COLUMN, PROCESS_CLASSES
    from forgeline.plans import ml, scoring
    train = spark.range(80).selectExpr("'cnc_milling' AS process_code", *[
        {"volume": "(1 + id % 4) * 10000D", "quantity": "(1 + id % 7) * 10D"}.get(c, "1D") + f" AS {c}" for c in COST_FEATURE_COLUMNS], *[f"(1 + id % 4) * 10D + (1 + id % 7) AS {c}" for c in MODEL_COMPONENT_COLUMN.values() if c not in COST_FEATURE_COLUMNS])
    models = ml.train_cost_models(train, max_iter=3, max_depth=4)
    assert models

    def request(volume, quantity):
        box = {"x": 50.0, "y": 40.0, "z": 30.0}
        return json.dumps({"part_id": "p", "geometry": {"bounding_box": box, "volume_mm3": volume, "surface_area_mm2": 9000.0, "wall_thicknesses": [3.0]},
                           "requirements": {"material_code": "AL6061", "quantity": quantity, "tolerance_band": "IT8"}, "top_k": 5})

    asked = [("a", request(10000.0, 10)), ("b", request(40000.0, 10)), ("c", request(10000.0, 70)), ("d", request(10000.0, 10))]
    proba = [0.5 if p == "cnc_milling" else 0.5 / (len(PROCESS_CLASSES) - 1) for p in PROCESS_CLASSES]
    scores = spark.createDataFrame([(i, proba) for i, _ in asked], "row_id string, proba array<double>")
    out, bad = scoring.serve(spark.createDataFrame(asked, "row_id string, json string"), scores, ml.costs_by_models(models), FETCHER_FALLBACK_PRICES)
    assert [tuple(r) for r in bad.collect()] == []
    got = {(r.row_id, r.process_code): r.total_cost for r in scoring.flat_recommendations(out).collect()}
    a, b, c, d = [got[i, "cnc_milling"] for i in "abcd"]
    assert a == d and a < c and a < b
    assert len({got[k] for k in got if k[0] == "b" and k[1] != "cnc_milling"}) == 1      # no model: the rough estimate


def test_registered_fits_use_the_operators_settings(monkeypatch):
    from forgeline.constants import COST_MODEL_OVERRIDES
    from forgeline.plans.registry import load_all
    load_all()
    from forgeline.plans import queries_ml

    class Stop(Exception):
        pass

    def seen(query, name):
        def stop(*args, **kwargs):
            calls.append(kwargs)
            raise Stop
        calls = []
        with monkeypatch.context() as m:
            m.setattr(queries_ml, "_split_clean", lambda d: MagicMock())
            m.setattr(queries_ml, "F", MagicMock())
            m.setattr(queries_ml, "cost_features", MagicMock())
            m.setattr("forgeline.sources.readers.training_rows_without_estimated", MagicMock())
            m.setattr(ml, "prepare_classifier_rows", MagicMock())
            m.setattr(ml, "fit_platt", MagicMock())
            for other in ("out_of_fold_probabilities", "classifier_pipeline"):
                m.setattr(ml, other, MagicMock())
            m.setattr(ml, name, stop)
            with pytest.raises(Stop):
                query(MagicMock())
        return calls[0]

    fit = seen(queries_ml.m6_cost_models_holdout, "train_cost_models")
    assert fit == {"overrides": COST_MODEL_OVERRIDES, "max_iter": 300, "max_depth": 5}
    assert seen(queries_ml.m3_fold_scores, "fold_scores") == {}
    assert seen(queries_ml.m4_platt_brier, "out_of_fold_probabilities") == {"folds": 3}
    for query in (queries_ml.m4_platt_brier, queries_ml.m16_permutation_importance):
        assert seen(query, "classifier_pipeline") == {}
    assert seen(queries_ml.m16_permutation_importance, "permutation_importance") == {}


def test_stream_of_a_log_longer_than_any_watermark(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace

    from forgeline.plans.registry import load_all
    load_all()
    from forgeline.plans import queries_stream
    # 400 days, newest first and in files of mixed times
    log = spark.range(2000).selectExpr("id AS event_id", "timestamp_ntz'2021-01-01 00:00:00' + make_dt_interval(0, 0, cast((1999 - id) * 288 AS int)) AS ts",
                                       "id AS user_id", "if(id % 5 = 0, 'error', 'view') AS event_type", "cast(id AS double) AS value", "'' AS props")
    delays = []
    real = mon.latency_stream
    monkeypatch.setattr(mon, "latency_stream", lambda e, w, s, watermark: delays.append(watermark) or real(e, w, s, watermark))
    d = SimpleNamespace(spark=spark, table=lambda name: log.repartition(7, "event_type", "user_id"))
    out = queries_stream.ts1_latency_stream(d)
    assert out.agg(F.sum("requests")).first()[0] == 5 * 2000 and set(delays) == {"10 minutes"}
    empty = SimpleNamespace(spark=spark, table=lambda name: log.limit(0))
    assert queries_stream.ts1_latency_stream(empty).count() == 0
