"""Saved and loaded fitted state scores like the fitted one, without a fit."""

import pytest
from pyspark.sql import functions as F

from stayflow.operators import scoring as Sc
from stayflow.operators import training as Tr
from stayflow.operators.drift import DriftReference
from stayflow.plans.features import fitted
from stayflow.plans.scoring import COLS, MODEL
from stayflow.sources.accounts import ACCOUNT_FIELDS, faulty_accounts
from stayflow.sources.state import FittedState, load_state, save_state


@pytest.fixture(scope="module")
def fit(spark, sf_dir):
    return fitted(spark, sf_dir)


def test_scoring_from_loaded_state_fits_nothing(spark, sf_dir, fit, tmp_path):
    reference = DriftReference({"x": [1.0, 2.5], "y": []}, {"x": (9, 2), "y": (0, 0)})
    folder = str(tmp_path / "state")
    save_state(spark, folder, FittedState(fit.preprocessor, fit.medians, {"linear": MODEL}, reference), COLS.internet)
    state = load_state(spark, folder, COLS.internet)
    assert state.preprocessor == fit.preprocessor and state.medians == fit.medians
    assert state.reference == reference and state.models["linear"] == MODEL
    batch = faulty_accounts(spark, sf_dir, ACCOUNT_FIELDS).drop("customer_id")
    spark.sparkContext.setJobGroup("scoring", "building the scoring plan")
    scored = Sc.score_batch(batch, state.preprocessor, state.models["linear"], state.medians, 0.5, COLS)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("scoring")) == []
    want = Sc.score_batch(batch, fit.preprocessor, MODEL, fit.medians, 0.5, COLS)
    assert scored.exceptAll(want).count() == 0 and want.exceptAll(scored).count() == 0


def test_many_medians_stay_a_table(spark, fit, tmp_path):
    table = spark.range(25_000).select(F.col("id").cast("string").alias(COLS.internet), F.lit(1.5).alias("median"))
    folder = str(tmp_path / "state")
    save_state(spark, folder, FittedState(fit.preprocessor, table), COLS.internet)
    loaded = load_state(spark, folder, COLS.internet).medians
    assert loaded.columns == [COLS.internet, "median"] and loaded.count() == 25_000


def test_a_trained_model_scores_the_same_as_numbers(spark, fit, tmp_path):
    train = fit.preprocessor.transform(fit.rows.filter("split = 'train'"), ["account_id", F.col("y").alias("label")])
    model = Tr.fit(Tr.Candidate("lr", "logistic_regression", {"max_iter": 30}), train)
    names = fit.preprocessor.feature_names()
    linear = Sc.linear_from_ml(model, names)
    folder = str(tmp_path / "state")
    save_state(spark, folder, FittedState(fit.preprocessor, fit.medians, {"ml": model, "plain": linear}), COLS.internet)
    state = load_state(spark, folder, COLS.internet)
    rows = Sc.score_batch_with(fit.rows.drop("split", "y"), state.preprocessor, state.models, state.medians, 0.5, COLS)
    gap = rows.agg(F.max(F.abs(F.col("p_ml") - F.col("p_plain")))).first()[0]
    assert gap < 1e-9


@pytest.mark.parametrize(
    ("kind", "params"),
    [("random_forest", {"min_samples_split": 4}), ("gradient_boosting", {"reg_lambda": 1.0}), ("decision_tree", {"colsample": 0.5})],
)
def test_settings_without_a_counterpart_are_refused(kind, params):
    with pytest.raises(ValueError, match=next(iter(params))):
        Tr.estimator(Tr.Candidate("x", kind, params), 10)


def test_settings_reach_the_estimator():
    forest = Tr.estimator(
        Tr.Candidate("f", "random_forest", {"min_samples_leaf": 7, "max_features": "log2", "max_samples": 0.5, "n_estimators": 9}), 10
    )
    assert (forest.getMinInstancesPerNode(), forest.getFeatureSubsetStrategy(), forest.getSubsamplingRate(), forest.getNumTrees()) == (7, "log2", 0.5, 9)
