"""What a request's recommendations need is worked out once a row, and the parts join carries no probabilities."""

import pytest
from pyspark.sql import functions as F

from forgeline.operators.common import bound
from forgeline.plans import evaluate as ev, scoring
from forgeline.plans.registry import load_all
from forgeline.sources.tables import Domain, scores_view

LINES = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double"


@pytest.fixture()
def small(spark, tmp_path):
    lines = [(i, 1 + i % 7, 1 + i % 45, 1 + i % 9, float(1 + i)) for i in range(60)] + [(3, 4, 4, 4, 2.0), (3, 4, 4, 4, 9.0)]
    spark.createDataFrame(lines, LINES).write.parquet(str(tmp_path / "lineitem.parquet"))
    parts = [(i, 1 + i % 50, 900.0 + i) for i in range(1, 46)]
    spark.createDataFrame(parts, "p_partkey long, p_size int, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    return Domain(spark, str(tmp_path))


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["m14_recommendations", "p23_suppress_low_confidence_cost", "m14_recommend_counts"])
def test_ranked_once_and_before_the_join(small, name):
    plan = _optimized(load_all()[name].build(small))
    assert plan.count("sort_array(") == 1
    above, below = plan.split("Join Inner")
    assert "sort_array(" in below and "proba#" not in above


def test_explained_class_is_chosen_before_the_join(small):
    above, _ = _optimized(load_all()["m15_explanations"].build(small)).split("Join Inner")
    assert "proba#" not in above


def test_rows_equal_the_arrays(small):
    from forgeline.plans.queries_scoring import _best, _score_requests
    with_proba = _score_requests(small, proba=F.col("proba"))
    with_best = _score_requests(small, best=_best(6))
    want = sorted(map(tuple, scoring.flat_recommendations(scoring.recommend(with_proba, 3)).collect()))
    assert len(want) > 60
    assert sorted(map(tuple, scoring.flat_costs(scoring.recommendation_rows(with_best, 3)).collect())) == want
    for r in scoring.recommend(with_best, 3).collect():
        assert r.n_recommendations == len(r.recommendations) and all(x.process_code in r.feasible for x in r.recommendations)


def test_cost_of_a_process_else_the_rough_estimate(small):
    from forgeline.plans.queries_scoring import _best, _score_requests
    asked = _score_requests(small, best=_best(6))
    own = F.struct(*[F.lit("own" if c == "confidence" else 7.0).alias(c) for c in scoring.COST_FIELDS])
    rows = scoring.recommendation_rows(asked, 3, lambda code: F.when(code == "edm", own)).collect()
    assert {r.cost_estimate.total_cost == 7.0 for r in rows if r.process_code == "edm"} == {True}
    assert {r.cost_estimate.confidence for r in rows if r.process_code != "edm"} == {"low"}


def test_no_recommendation_gives_no_row(spark):
    one = spark.createDataFrame([("a", [(0.9, 6)])], "row_id string, best array<struct<p double, idx int>>").select(
        "*", F.lit(0.1).alias("wall_thickness_min"), F.lit(1.0).alias("wall_thickness_avg"), F.lit(0.0).alias("undercut_flag"),
        *[F.lit(1.0).alias(f"bounding_box_{a}") for a in "xyz"], F.lit(1.0).alias("volume"), F.lit(1).alias("quantity"))
    assert scoring.recommendation_rows(one, 3).count() == 0                    # sand casting needs walls of 2
    assert scoring.recommend(one, 3).select("n_recommendations", F.size("recommendations")).first()[:] == (0, 0)


def test_probabilities_and_first_class(spark):
    lines = spark.createDataFrame([(1, 2, 3, 4, 1.0), (1, 2, 3, 4, 0.5), (None, 2, None, 4, 1.0)], LINES)
    weights = [float(1 + (3 * 31 + 4 * 17 + c * 97 + 2 * 13) % 101) for c in range(18)]
    rows = {r.row_id: r for r in ev.with_ranks(scores_view(lines)).collect()}
    assert rows["1-2-3-4"].proba == [w / sum(weights) for w in weights]
    assert rows["2-4"].proba == [None] * 18
    assert rows["1-2-3-4"].pred_idx == max(range(18), key=lambda c: (weights[c], c))
    plan = _optimized(scores_view(lines))
    assert plan.count("aggregate(") == 1 and "/ aggregate(" not in plan      # the sum is not computed for each class


def test_bound_value_is_computed_once(spark):
    df = spark.range(3).select("id", (F.col("id") * 2).alias("twice"))
    out = df.select(bound(F.col("twice"), lambda t: F.transform(F.sequence(F.lit(1), F.lit(2)), lambda i: i + t)).alias("x"))
    assert [r.x for r in out.orderBy("x").collect()] == [[1, 2], [3, 4], [5, 6]]
