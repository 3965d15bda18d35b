"""Registered ML queries: splits, folds, imputation and scaling statistics, eligibility, fits."""

from __future__ import annotations

from pyspark.sql import functions as F

from forgeline.constants import COST_MODEL_OVERRIDES, FEATURE_COLUMNS, MODEL_COMPONENT_COLUMN
from forgeline.functions.features import cost_features
from forgeline.operators.normalize import clean_process
from forgeline.plans import etl, evaluate as ev, ml, scoring
from forgeline.plans.registry import register
from forgeline.session import materialize, release, scratch_tables
from forgeline.sources.tables import Domain

# fit settings of a process without overrides of its own
COST_MODEL_SETTINGS = {"max_iter": 300, "max_depth": 5}

_MD5 = "md5(CAST(order_id AS VARCHAR) || '42')"


@register("m11_stratified_split", f"""
SELECT order_id, process_code,
  CASE WHEN pr < 0.70e0 THEN 'train' WHEN pr < 0.85e0 THEN 'val' ELSE 'test' END AS split
FROM (SELECT order_id, lower(trim(process_code)) AS process_code,
        percent_rank() OVER (PARTITION BY lower(trim(process_code)) ORDER BY {_MD5}) AS pr FROM m_orders) x""",
          [], ["m_orders"])
def m11_stratified_split(d: Domain):
    """Stratified 70/15/15 split by process with md5(id||seed) order (bucketed ranks)."""
    o = d.orders.select("order_id", clean_process(F.col("process_code")).alias("process_code"))
    return ml.stratified_split(o, ["process_code"], "order_id").select("order_id", "process_code", "split")


@register("m3_stratified_folds", f"""
SELECT order_id, process_code,
  CAST((row_number() OVER (PARTITION BY process_code ORDER BY {_MD5}) - 1) % 5 AS INTEGER) AS fold
FROM (SELECT order_id, lower(trim(process_code)) AS process_code FROM m_orders) x""", [], ["m_orders"])
def m3_stratified_folds(d: Domain):
    """M3: stratified 5-fold assignment (fold = rank within class mod 5)."""
    o = d.orders.select("order_id", clean_process(F.col("process_code")).alias("process_code"))
    return ml.stratified_folds(o, ["process_code"], "order_id", 5).select("order_id", "process_code", "fold")


@register("m1_imputer_medians", "SELECT " + ", ".join(
    f"median(CAST({c} AS DOUBLE)) AS {c}" for c in FEATURE_COLUMNS) + " FROM m_geometry_all",
          FEATURE_COLUMNS, ["m_geometry_all"])
def m1_imputer_medians(d: Domain):
    """M1: exact per-feature medians of the geometry features (imputation values)."""
    return ml.median_imputation_values(d.all_geometry, FEATURE_COLUMNS)


@register("m12_scaler_stats", """
SELECT feature, avg(v) AS mean, stddev_samp(v) AS std FROM (
  UNPIVOT (SELECT """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS) + """ FROM (
    SELECT *, percent_rank() OVER (ORDER BY md5(part_id || '42')) AS pr FROM m_geometry_all) g WHERE pr < 0.70e0)
  ON """ + ", ".join(FEATURE_COLUMNS) + """ INTO NAME feature VALUE v) u
GROUP BY feature""", ["mean", "std"], ["m_geometry_all"])
def m12_scaler_stats(d: Domain):
    """Scaler statistics fitted on the training split only."""
    train = ml.stratified_split(d.all_geometry, [], "part_id").where(F.col("split") == "train")
    return ml.scaler_stats(train, FEATURE_COLUMNS)


@register("m6_cost_eligibility", """
SELECT process_code, CAST(n_process AS BIGINT) AS n_process, component, CAST(n_component AS BIGINT) AS n_component,
  n_process >= 20 AND n_component >= 10 AS trained
FROM (UNPIVOT (SELECT process_code, count(*) AS n_process,
    count(*) FILTER (WHERE cost_machine_time > 0.01e0) AS machine_time_cost,
    count(*) FILTER (WHERE cost_setup > 0.01e0) AS setup_cost,
    count(*) FILTER (WHERE cost_tooling > 0.01e0) AS tooling_cost,
    count(*) FILTER (WHERE cost_raw_material > 0.01e0) AS raw_material_cost,
    count(*) FILTER (WHERE cost_finishing > 0.01e0) AS finishing_cost
  FROM clean_rows WHERE cost_label_source <> 'estimated' OR cost_label_source IS NULL GROUP BY process_code)
  ON machine_time_cost, setup_cost, tooling_cost, raw_material_cost, finishing_cost
  INTO NAME component VALUE n_component) u""", [], ["clean_rows"])
def m6_cost_eligibility(d: Domain):
    """Which (process, component) cost models get trained (non-estimated labels only)."""
    from forgeline.sources.readers import training_rows_without_estimated
    return ml.cost_eligibility(training_rows_without_estimated(etl.clean_training_rows(d)))


def _split_clean(d: Domain):
    """The clean rows with their split; the ETL's tables end when these are written."""
    with scratch_tables([]) as before:
        clean = etl.clean_training_rows(d)
    split = ml.stratified_split(clean, ["process_code"], "order_id")
    release(*before)
    return split


@register("m2_classifier_holdout", None)
def m2_classifier_holdout(d: Domain):
    """Random forest on the train split, top-1/3/5 accuracy on the test split."""
    s = ml.prepare_classifier_rows(_split_clean(d))
    model = ml.classifier_pipeline().forest(s.where(F.col("split") == "train"))
    probs = ml.probabilities(model, s.where(F.col("split") == "test"), "order_id")
    return ev.top_k_accuracy(probs)


@register("m2_boosted_holdout", None)
def m2_boosted_holdout(d: Domain):
    """The 18-class boosted softmax classifier (400 rounds, depth 6, rate 0.05) on the train split,
    top-1/3/5 accuracy on the test split beside the forest's."""
    s = ml.prepare_classifier_rows(_split_clean(d))
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    boosted = ev.top_k_accuracy(ml.boosted_probabilities(ml.boosted_classifier(train), test, "order_id"))
    forest = ev.top_k_accuracy(ml.probabilities(ml.classifier_pipeline().forest(train), test, "order_id"))
    return boosted.withColumn("model", F.lit("boosted")).unionByName(forest.withColumn("model", F.lit("forest")))


@register("m20_feature_importance", None)
def m20_feature_importance(d: Domain):
    """Impurity feature importances of the fitted classifier."""
    s = ml.prepare_classifier_rows(_split_clean(d))
    model = ml.classifier_pipeline().forest(s.where(F.col("split") == "train"))
    return d.spark.createDataFrame(ml.feature_importance(model), "feature string, importance double")


@register("m6_cost_models_holdout", None)
def m6_cost_models_holdout(d: Domain):
    """Per-process x per-component boosted cost models on the train split (the required rounds and
    depths), per-component MAPE / MAE on the test split (non-estimated labels)."""
    from forgeline.sources.readers import training_rows_without_estimated
    rows = cost_features(training_rows_without_estimated(_split_clean(d))
                         .withColumn("surface_finish_spec", F.col("surface_finish_ra")))
    models = ml.train_cost_models(rows.where(F.col("split") == "train"), overrides=COST_MODEL_OVERRIDES, **COST_MODEL_SETTINGS)
    test = rows.where(F.col("split") == "test")
    lp = ml.log_predictions(models, test, "order_id")
    n = d.spark.createDataFrame([(m.process_code, m.n_training) for m in models],
                                "process_code string, n_training long").distinct()
    pred = scoring.predict_costs(lp, n)
    truth = test.select(F.col("order_id").alias("row_id"), *[F.col(c).alias(name) for name, c in
                                                              MODEL_COMPONENT_COLUMN.items()])
    comps = list(MODEL_COMPONENT_COLUMN)
    long = pred.join(truth, "row_id").select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("component"), truth[c].alias("y_true"), pred[c].alias("y_pred")) for c in comps]))
        .alias("r")).select("r.*")
    return ev.per_component_table(long)


@register("m14_served_by_models", None)
def m14_served_by_models(d: Domain):
    """JSON requests whose feasible routed processes are costed by the fitted models on each request's own
    geometry, material and quantity (the rough estimate elsewhere); one row per recommendation."""
    from forgeline.constants import FETCHER_FALLBACK_PRICES, ROUTED_PROCESSES
    from forgeline.plans.queries_scoring import _json_requests
    from forgeline.sources.readers import training_rows_without_estimated
    with scratch_tables([]) as before:
        clean = training_rows_without_estimated(etl.clean_training_rows(d)).where(F.col("process_code").isin(ROUTED_PROCESSES))
    rows = cost_features(clean.withColumn("surface_finish_spec", F.col("surface_finish_ra")))
    models = ml.train_cost_models(rows, overrides=COST_MODEL_OVERRIDES, **COST_MODEL_SETTINGS)
    release(*before)
    served, _ = scoring.serve(_json_requests(d), d.scores, ml.costs_by_models(models), FETCHER_FALLBACK_PRICES, flat=True)
    return scoring.flat_costs(served).select("row_id", "rank", "process_code", "probability", "total_cost", "setup_cost")


@register("m19_reference_parts", None)
def m19_reference_parts(d: Domain):
    """Parts with an expected process (the test split) against the fitted classifier: top-1 / top-3 hits, invalid vectors."""
    s = _split_clean(d)
    model = ml.classifier_pipeline().forest(ml.prepare_classifier_rows(s.where(F.col("split") == "train")))
    parts = s.where(F.col("split") == "test").select("part_id", F.col("process_code").alias("expected_process"), *FEATURE_COLUMNS)
    return ml.reference_part_check(model, parts)


@register("m21_unified_cost_model", None)
def m21_unified_cost_model(d: Domain):
    """One random-forest regressor for total cost over all processes; test MAPE."""
    rows = cost_features(_split_clean(d).withColumn("surface_finish_spec", F.col("surface_finish_ra")))
    model = ml.unified_cost_model(rows.where(F.col("split") == "train"))
    test = rows.where(F.col("split") == "test")
    scored = ml.forest_values(model, test, ["cost_total"])
    pred = scored.select(F.col("cost_total").alias("y_true"), F.expm1("prediction").alias("y_pred"))
    return ev.cost_metrics(pred, [])


@register("m4_platt_brier", None)
def m4_platt_brier(d: Domain):
    """Per-class Platt (sigmoid) calibration fitted on out-of-fold model output (cv = 3), applied to
    the test split; Brier score there before and after (rows-only: model fits)."""
    s = ml.prepare_classifier_rows(_split_clean(d))
    train = s.where(F.col("split") != "test")
    fitted = ml.fit_platt(ml.out_of_fold_probabilities(train, folds=3))
    model = ml.classifier_pipeline().forest(train)
    scores = materialize(ml.probabilities(model, s.where(F.col("split") == "test"), "order_id"), "test-scores")
    before = ev.brier_score(scores).withColumnRenamed("brier", "brier_raw")
    after = ev.brier_score(ml.apply_platt(scores, fitted)).withColumnRenamed("brier", "brier_calibrated")
    return before.select("brier_raw", after.select("brier_calibrated").scalar().alias("brier_calibrated"))


@register("m3_fold_scores", None)
def m3_fold_scores(d: Domain):
    """M3: top-1 / top-3 accuracy of each of five stratified folds, their mean and population std."""
    return ml.fold_scores(ml.prepare_classifier_rows(_split_clean(d)))


@register("m16_permutation_importance", None)
def m16_permutation_importance(d: Domain):
    """Mean drop in top-3 accuracy on the test split when one feature is shuffled (50 repeats)."""
    s = ml.prepare_classifier_rows(_split_clean(d))
    model = ml.classifier_pipeline().forest(s.where(F.col("split") == "train"))
    return ml.permutation_importance(model, s.where(F.col("split") == "test"), "order_id")


@register("m17_ablation", None)
def m17_ablation(d: Domain):
    """Top-3 accuracy of the classifier with all features vs without curvature_complexity."""
    s = ml.prepare_classifier_rows(_split_clean(d))
    return ml.ablation(s.where(F.col("split") == "train"), s.where(F.col("split") == "test"),
                       ["curvature_complexity"], "order_id")
