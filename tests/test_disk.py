"""What the steps keep on disk: scratch tables and shuffles end with their use."""

import os
from urllib.parse import urlparse

from pyspark.sql import functions as F

from conftest import SMALL
from forgeline.operators import marks, validate
from forgeline.plans import etl
from forgeline.session import ensure_checkpoint_dir, materialize
from forgeline.sources.tables import Domain


def kept(spark, before=frozenset()):
    """Names of the scratch tables (Spark's own checkpoint folders are bare UUIDs)."""
    return {n for n in os.listdir(urlparse(ensure_checkpoint_dir(spark)).path) if n.count("-") < 4} - set(before)


def shuffled_bytes(spark):
    out = 0
    for root in spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString():
        out += sum(os.path.getsize(os.path.join(at, n)) for at, _, names in os.walk(root) for n in names if n.startswith("shuffle_"))
    return out


def test_etl_keeps_its_last_table_alone(spark):
    before = kept(spark)
    assert etl.annotated_training_rows(Domain(spark, SMALL)).count() > 0
    assert sorted(n.split("-")[0] for n in kept(spark, before)) == ["marks", "rules"]


def test_a_written_table_leaves_no_shuffle(spark):
    before = shuffled_bytes(spark)
    flag = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    table = materialize(spark.range(200_000).groupBy(F.xxhash64("id").alias("h")).agg(F.count("*").alias("n")), "counts")
    assert shuffled_bytes(spark) - before < 100_000 and table.count() == 200_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == flag


def test_duplicates_are_marked_without_shuffling_the_rows(spark, monkeypatch):
    rows = [(f"P{i % 40}", None if i % 7 == 0 else f"c{i % 3}", f"d{i % 11}", f"O{i:03d}", i) for i in range(600)]
    schema = "part_id string, process_code string, completion_date string, order_id string, v int"
    numbered = materialize(spark.createDataFrame(rows, schema).repartition(4).withColumn("__row", F.monotonically_increasing_id()), "numbered")
    first = {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        first.setdefault(r[:2], r)
    for at_once in (1024, 1):                                         # in one go, and a task's rows at a time
        monkeypatch.setattr(marks, "BUCKETS_AT_ONCE", at_once)
        out = validate.flag_duplicates(numbered)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
        assert plan.count("FileScan") >= (2 if at_once > 1 else 4)
        assert {tuple(r)[:5] for r in out.where("NOT __dup").collect()} == set(first.values()) and out.where("__dup").count() == 600 - len(first)


def test_no_rows_have_no_duplicates(spark):
    none = spark.createDataFrame([], "part_id string, process_code string, order_id string")
    assert validate.flag_duplicates(none).count() == 0


def test_served_requests_carry_their_costs_in_one_row(spark, monkeypatch):
    """a row for each request and process, with its five components, meets others once; its features are not written."""
    from forgeline.constants import COST_FEATURE_COLUMNS, FETCHER_FALLBACK_PRICES, MODEL_COMPONENT_COLUMN
    from forgeline.plans.registry import load_all
    load_all()
    from forgeline.plans import ml, queries_scoring, scoring
    train = spark.range(120).selectExpr("if(id % 2 = 0, 'cnc_milling', 'forging') AS process_code", *[f"(1 + id % {3 + i}) * 1.0D AS {c}" for i, c in enumerate(COST_FEATURE_COLUMNS)],
                                        *[f"if(id % 2 = 1 AND '{c}' = 'cost_setup', 0D, (1 + id % 4) * 10D) AS {c}" for c in MODEL_COMPONENT_COLUMN.values() if c not in COST_FEATURE_COLUMNS])
    models = ml.train_cost_models(train, max_iter=3, max_depth=3)
    assert len(models) == 9
    df = train.withColumn("row_id", F.monotonically_increasing_id().cast("string"))
    long, wide = ml.log_predictions(models, df, "row_id"), ml.wide_log_predictions(models, df, "row_id")
    assert wide.count() == 120 and long.count() == 60 * 9
    n = spark.createDataFrame([("cnc_milling", 60)], "process_code string, n_training long")
    assert sorted(map(str, scoring.predict_costs(long, n).collect())) == sorted(map(str, scoring.predict_costs(wide, n).collect()))
    written = []
    real = scoring.materialize
    monkeypatch.setattr(scoring, "materialize", lambda d, name: written.append(name) or real(d, name))
    d = Domain(spark, SMALL)
    served, _ = scoring.serve(queries_scoring._json_requests(d), d.scores, ml.costs_by_models(models), FETCHER_FALLBACK_PRICES, flat=True)
    assert served.count() > 0 and "cost-rows" not in written
