import importlib

import pytest
from pyspark.sql import functions as F

from segscore.plans import catalog, recipes, training
from tests.conftest import SF


@pytest.mark.parametrize("name", ["risk_scores", "risk_gate", "metric_log", "stream_scores", "scored_ids", "thresholds_applied"])
def test_flow_queries_fit_the_full_budgets(spark, monkeypatch, name):
    seen = {}

    def fit_all(df, features, recipes, **more):
        seen.update(recipes=recipes, **more)
        raise InterruptedError

    monkeypatch.setattr(training, "fit_all", fit_all)
    monkeypatch.setattr(catalog, "_TRAINED", {})
    monkeypatch.setattr(catalog, "FLOW_BUDGET", "full")
    with pytest.raises(InterruptedError):
        catalog.Q[name](spark, SF)
    want = recipes.reference_recipes()
    for c, r in seen["recipes"].items():
        assert (r.search_space, r.n_iter, r.cv_folds, r.learner_params) == (
            want[c].search_space, want[c].n_iter, want[c].cv_folds, want[c].learner_params)
    assert [len(training.candidates(r.search_space, r.n_iter)) for r in seen["recipes"].values()] == [8, 1728, 20, 30, 1]
    assert seen["classifier_search"] == recipes.CLASSIFIER_SEARCH


def test_full_is_the_default():
    assert "FLOW_BUDGET = \"full\"" in open(importlib.import_module("segscore.plans.catalog").__file__).read()


def test_classifier_search(spark):
    df = spark.range(120).select("id", (F.col("id") % 3).cast("int").alias("cluster"), (F.col("id") % 3 + F.rand(1) / 9).alias("a"),
                                 F.rand(2).alias("b"))
    grid = {"rounds": [1, 2], "depth": [1, 2], "eta": [0.3], "subsample": [1.0]}
    clf, cvm = training.fit_segment_classifier(df, ["a", "b"], top_n=1, search=(grid, {**grid, "colsample": [1.0]}))
    assert clf.features == ["a"] and cvm.first()["recall_macro_mean"] > 0.6
    assert set(clf.params) == {"rounds", "depth", "eta", "subsample", "colsample"}


def test_shares_are_flagged_by_rank(spark):
    s = spark.createDataFrame([(i, int(i % 10 == 0), 1.0 if i < 60 else 0.0) for i in range(100)], "id long, label int, score double")
    flagged = training.flag_top(s, 0.2).filter("flag = 1")
    assert sorted(r["id"] for r in flagged.collect()) == list(range(20))
    cut, more = training.decide("top_share:0.2", s)
    assert (cut, more) == (1.0, {"precision_topk": 0.1, "recall_topk": 0.2})


@pytest.mark.parametrize("segment", [0, 1, 2, 3, 4])
def test_every_recipe_fits_scores_and_logs(spark, segment):
    """No segment falls back to its prior: every resampler and learner runs."""
    import numpy as np
    r = np.random.default_rng(segment)
    rows = [(i, int(i % 5 == 0), *(float(v) for v in r.normal(size=4) + 1.5 * (i % 5 == 0))) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, label int, a double, b double, c double, d double")
    m = training.fit_segment_model(df, recipes.small_recipes()[segment])
    assert not isinstance(m.model, training.ConstantModel) and m.tags["learner"] == m.recipe.learner
    assert m.metrics["average_precision_score"] > 0.4
    wanted = {0: "f1_score", 1: "optimal_threshold", 2: "precision_topk", 3: "f2_score", 4: "f2_score"}[segment]
    assert wanted in m.metrics and m.params
    x = m.prepare(df, ["a", "b", "c", "d"], ["id", "label"])
    s = training.scored_by(m.model, x).groupBy("label").avg("score").collect()
    by = {r["label"]: r["avg(score)"] for r in s}
    assert by[1] > by[0]
