"""Searches over many models: one aggregation for all logistic fits, resumable tree trials."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stayflow.operators import evaluation as E
from stayflow.operators import logistic as L
from stayflow.operators import trials as Tr
from stayflow.operators.sizing import scratch_folder
from stayflow.operators.training import Candidate, grid_search_lr, refined_strengths

PENALTIES = [(0.02, 0.0), (0.0, 0.01), (0.01, 0.005)]


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(0)
    n = 900
    x = r.normal(size=(n, 6))
    x[:, 5] = x[:, 0] + 0.1 * x[:, 5]
    y = (x @ [1, -1, 0.5, 0, 0, 0.3] + r.normal(size=n) > 0.4).astype(float)
    lines = [(float(a), [float(v) for v in b], [1.0, 2.0 if a else 0.7], i % 3) for i, (a, b) in enumerate(zip(y, x))]
    df = spark.createDataFrame(lines, "label double, features array<double>, weights array<double>, fold int")
    return df.coalesce(2).persist()


def test_all_fits_equal_mllib(rows):
    problems = [L.Problem(l1, l2, i % 2, 1 if i else None) for i, (l1, l2) in enumerate(PENALTIES)]
    fitted = L.fit_many(rows, problems)
    for p, found in zip(problems, fitted):
        data = rows.select("label", array_to_vector("features").alias("v"), F.col("weights")[p.weighting].alias("w"), "fold")
        if p.left_out is not None:
            data = data.filter(F.col("fold") != p.left_out)
        whole = p.l1 + p.l2
        model = LogisticRegression(
            featuresCol="v", weightCol="w", maxIter=1000, tol=1e-12, regParam=whole,
            elasticNetParam=p.l1 / whole if whole else 0.0, standardization=False,
        ).fit(data)
        assert found.converged and found.passes < 30
        assert found.intercept == pytest.approx(model.intercept, abs=1e-4)
        assert found.coefficients == pytest.approx(model.coefficients.toArray(), abs=1e-4)


def test_lasso_least_fulfils_its_conditions():
    r = np.random.default_rng(1)
    for n in (2, 5, 12):
        for _ in range(40):
            a = r.normal(size=(n + 3, n))
            a[:, -1] = a[:, 0]  # two columns that cannot be told apart
            hessian = a.T @ a + 1e-10 * np.eye(n)
            start, l1 = r.normal(size=n) * (r.random(n) < 0.5), r.random() * 2
            slope = hessian @ r.normal(size=n) * 3
            b = L.lasso_least(start, slope, hessian, l1)
            rest = slope + hessian @ (b - start)
            assert abs(rest[0]) < 1e-4
            for j in range(1, n):
                assert abs(rest[j]) <= l1 + 1e-5 if b[j] == 0 else abs(rest[j] + l1 * np.sign(b[j])) < 1e-4


def test_fits_of_awkward_rows(spark, rows):
    empty = L.fit_many(rows.filter("label > 5"), [L.Problem(l2=0.1)])
    assert empty[0].passes == 0 and len(empty[0].coefficients) == 0
    one_class = L.fit_many(rows.filter("label = 1"), [L.Problem(l2=0.1)], max_iter=20)
    assert np.abs(one_class[0].coefficients).max() < 1e-3 and one_class[0].intercept > 5
    twin = rows.withColumn("features", F.concat("features", "features"))
    both = L.fit_many(twin, [L.Problem(l1=0.001), L.Problem(l2=0.01)])
    assert all(f.converged for f in both)


def test_grid_search_equals_fits_one_by_one(spark, rows):
    data = rows.select(F.monotonically_increasing_id().alias("id"), "label", "features").persist()
    settings = [{"C": c, "penalty": p, "class_weight": w} for c, p, w in ((0.05, "l1", None), (1.0, "l2", "balanced"))]
    found = {r["setting"]: r["cv_auc"] for r in grid_search_lr(data, settings, "id", folds=2).collect()}
    from stayflow.operators import training as T

    folded = T.stratified_folds(data, "id", "label", 2, 42).withColumn("w", T.balanced_weight(data)).persist()
    inside = folded.count() // 2
    for i, s in enumerate(settings):
        areas = []
        for k in range(2):
            model = LogisticRegression(
                featuresCol="v", weightCol="weight", maxIter=200, tol=1e-9, standardization=False,
                regParam=1 / (s["C"] * inside), elasticNetParam=float(s["penalty"] == "l1"),
            ).fit(
                folded.filter(F.col("fold") != k).select(
                    "label", array_to_vector("features").alias("v"),
                    (F.col("w") if s["class_weight"] else F.lit(1.0)).alias("weight"),
                )
            )
            scored = T.score_with_ml(model.setFeaturesCol("_vector"), folded.filter(F.col("fold") == k))
            areas.append(E.roc_auc(scored, "label").first()["roc_auc"])
        assert found[i] == pytest.approx(sum(areas) / 2, abs=1e-4)


def test_areas_by_group(spark, monkeypatch):
    from stayflow.operators import ordering

    r = np.random.default_rng(2)
    lines = [(int(g), float(np.round(r.random(), 2)), int(r.integers(0, 3)), int(r.integers(0, 3))) for g in range(4) for _ in range(80)]
    groups = spark.createDataFrame(lines, "problem int, score double, pos long, neg long")
    want = {}
    for g in range(4):
        own = [x for x in lines if x[0] == g]
        wins = sum(a[2] * b[3] * (1.0 if a[1] > b[1] else 0.5 if a[1] == b[1] else 0.0) for a in own for b in own)
        want[g] = wins / (sum(x[2] for x in own) * sum(x[3] for x in own))
    for bound in (10**6, 10):
        monkeypatch.setattr(ordering, "BUCKET_ROWS", bound)
        got = {r["problem"]: r["roc_auc"] for r in E.roc_auc_by(groups, "problem").collect()}
        assert got == pytest.approx(want)


def test_strengths_around_the_best():
    assert refined_strengths(0.01) == [0.001, 0.005, 0.01, 0.05, 0.1]
    assert refined_strengths(100.0) == [10.0, 50.0, 100.0, 500.0, 1000.0]
    assert refined_strengths(1000.0) == refined_strengths(100.0)
    assert refined_strengths(0.1) == pytest.approx([0.01, 0.05, 0.1, 0.2, 1.0])


def test_a_stopped_search_goes_on(spark, rows, monkeypatch):
    data = rows.select(F.monotonically_increasing_id().alias("id"), F.col("label").cast("int"), "features").limit(300).persist()
    trials = [Candidate("gradient_boosting", "gradient_boosting", {"n_estimators": 2, "max_depth": d}) for d in (1, 2, 3)]
    folder = scratch_folder(spark)
    fits, fit = [], Tr.fit

    def breaks(trial, train):
        if trial.params["max_depth"] == 2:
            raise RuntimeError("stopped")
        fits.append(trial.params["max_depth"])
        return fit(trial, train)

    monkeypatch.setattr(Tr, "fit", breaks)
    with pytest.raises(RuntimeError):
        Tr.run_trials(data, trials, folder, "id", folds=2, at_once=1)
    done = {r["settings"] for r in Tr.trial_table(spark, folder).collect()}
    assert done and not any('"max_depth": 2' in s for s in done)
    again: list[int] = []
    monkeypatch.setattr(Tr, "fit", lambda t, train: again.append(t.params["max_depth"]) or fit(t, train))
    found = Tr.run_trials(data, trials, folder, "id", folds=2).collect()
    # What had run was not run again.
    assert len(found) == 3 and set(again) == {1, 2, 3} - {1 if '"max_depth": 1' in s else 3 for s in done}
    assert [r["cv_auc"] for r in found] == sorted((r["cv_auc"] for r in found), reverse=True)
    assert all(len(r["fold_aucs"]) == 2 and r["cv_auc"] == pytest.approx(sum(r["fold_aucs"]) / 2) for r in found)
    best = Tr.best_trials(Tr.trial_table(spark, folder), 2).collect()
    assert [r["place"] for r in best] == [1, 2] and best[0]["cv_auc"] == found[0]["cv_auc"]


def test_tree_matrix_bins_and_places(spark):
    lines = [(i, "train" if i < 80 else "test", float(i) if i % 9 else None, "abc"[i % 3] if i < 95 else "z") for i in range(100)]
    df = spark.createDataFrame(lines, "id long, split string, x double, t string")
    out = {r["id"]: r["features"] for r in Tr.tree_matrix(df, ["x"], ["t"], ["id"], F.col("split") == "train", 4).collect()}
    bins = [out[i][0] for i, _, x, _ in lines if x is not None]
    assert bins == sorted(bins) and set(bins) == {0.0, 1.0, 2.0, 3.0}
    train = [out[i][0] for i, split, x, _ in lines if x is not None and split == "train"]
    assert all(0.15 < train.count(b) / len(train) < 0.35 for b in set(train))
    for i, _, x, t in lines:
        assert (out[i][0] == -1.0) == (x is None) and out[i][1] == float("abc".find(t))


def test_drawn_trials_are_distinct():
    drawn = Tr.draw_trials(Tr.SPACES, 10, scale_pos_weight=2.0)
    texts = {(t.type, Tr.settings_text(t.params)) for t in drawn}
    assert len(texts) == 20 and all("scale_pos_weight" in t.params for t in drawn[10:])
    assert math.prod(len(v) for v in Tr.FOREST_SPACE.values()) > 40
