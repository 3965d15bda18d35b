"""Plan checks for every registered query: no Python UDF, no cartesian product."""

import pytest

from conftest import SMALL

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"]
SLOW = {"m2_classifier_holdout", "m20_feature_importance", "m6_cost_models_holdout", "m21_unified_cost_model",
        "ts6_incremental_intake", "g26_vif", "m4_platt_brier", "m17_ablation", "m3_fold_scores", "m16_permutation_importance",
        "m2_boosted_holdout", "m14_served_by_models", "m19_reference_parts"}


def _names():
    from forgeline.plans.registry import load_all
    return [n for n in load_all() if n not in SLOW]


@pytest.mark.parametrize("name", _names())
def test_plan_is_jvm_only(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, f"{name}: {bad}"
