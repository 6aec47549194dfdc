"""Encoding, scoring, training, explanation, sources and streaming."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.operators import explain as X
from stayflow.operators import preprocess as P
from stayflow.operators import scoring as Sc
from stayflow.operators import training as T
from stayflow.operators.features import engineer_features, fit_medians
from stayflow.operators.quality import DataValidationError
from stayflow.operators.sizing import materialize, scratch_folder
from stayflow.params import CustomerColumns
from stayflow.sources import readers, sinks

COLS = CustomerColumns()


def customers(spark, n=12):
    contracts = ["Month-to-month", "One year", "Two year"]
    services = ["Fiber optic", "DSL", "No"]
    payments = ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"]
    aids = ["No", "Yes", "No internet service"]
    rows = [
        (f"c{i:04d}", i % 2, i * 7 % 72, 20.0 + i * 3 % 80, str(float(i * 37 % 900)), contracts[i % 3], services[i % 3 if i % 5 else 0],
         payments[i % 4], aids[i % 3], aids[(i + 1) % 3], ["No", "Yes"][i % 2], ["No", "Yes"][i // 2 % 2], ["No", "Yes"][i % 3 == 0])
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "customerID string, SeniorCitizen int, tenure int, MonthlyCharges double, TotalCharges string, Contract string, "
        "InternetService string, PaymentMethod string, OnlineSecurity string, TechSupport string, Dependents string, "
        "PaperlessBilling string, Churn string",
    )


def test_encoder_matches_numpy(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (None, "b"), (4.0, None)], "x double, c string")
    pre = P.fit_preprocessor(df, ["x"], ["c"])
    assert pre.fill["x"] == 2.0 and pre.mode["c"] == "b" and pre.categories["c"] == ["a", "b"]
    filled = np.array([1, 2, 2, 4.0])
    got = [r["features"] for r in pre.transform(df).collect()]
    assert np.allclose([g[0] for g in got], (filled - filled.mean()) / filled.std())
    assert [g[1] for g in got] == [1, 0, 1, 1]
    unknown = spark.createDataFrame([(None, "zzz")], "x double, c string")
    assert pre.transform(unknown).first()["features"][1] == 0.0


def test_mode_tie_constant_column_and_errors(spark):
    df = spark.createDataFrame([(5.0, "b"), (5.0, "a")], "x double, c string")
    pre = P.fit_preprocessor(df, ["x"], ["c"])
    assert pre.mode["c"] == "a" and pre.std["x"] == 1.0
    with pytest.raises(DataValidationError):
        P.fit_preprocessor(df, ["x", "gone"], [])


def test_published_feature_names(spark):
    df = engineer_features(customers(spark, 48), {"DSL": 1.0})
    pre = P.fit_preprocessor(df, COLS.numeric_features, COLS.categorical_features)
    names = pre.feature_names()
    assert len(names) == 31 and names[:3] == ["num__tenure", "num__MonthlyCharges", "num__TotalCharges"]
    assert names[17:20] == ["num__SeniorCitizen", "cat__Contract_One year", "cat__Contract_Two year"]
    assert names[-1] == "cat__PaperlessBilling_Yes"
    assert "cat__PaymentMethod_Bank transfer (automatic)" not in names


def test_feature_sets():
    sets = P.feature_sets(COLS)
    assert [len(sets[k]) for k in "ABC"] == [21, 33, 25]


def test_contract_finds_bad_rows(spark):
    bad = spark.createDataFrame(
        [("train", 1, [1.0, float("nan")]), ("train", 0, [1.0, 2.0]), ("val", None, [float("inf"), 2.0])],
        "split string, label int, features array<double>",
    )
    rows = {r["split"]: r for r in P.dataset_contract(bad, 2).collect()}
    assert rows["train"]["rows_with_nan"] == 1 and rows["val"]["rows_with_inf"] == 1
    with pytest.raises(DataValidationError):
        P.require_contract(bad, 2)


def test_scored_rows_equal_input_rows(spark):
    df = customers(spark, 60)
    medians = fit_medians(df)
    pre = P.fit_preprocessor(engineer_features(df, medians), COLS.numeric_features, COLS.categorical_features)
    model = Sc.LinearModel(0.1, {n: 0.05 * i for i, n in enumerate(pre.feature_names())}, "m1")
    broken = df.withColumn("tenure", F.when(F.col("customerID") == "c0003", -1).otherwise(F.col("tenure")))
    rows = Sc.score_batch(broken, pre, model, medians, 0.5).collect()
    assert len(rows) == 60
    failed = [r for r in rows if r["prediction_status"] == "failed"]
    assert [r["customerID"] for r in failed] == ["c0003"]
    assert failed[0]["churn_probability"] is None and failed[0]["decision"] is None and failed[0]["expected_value"] is None
    for r in rows:
        if r["prediction_status"] == "ok":
            assert 0 <= r["churn_probability"] <= 1
            assert r["decision"] == ("contact" if r["churn_probability"] >= 0.5 else "no_contact")
            assert r["expected_value"] == pytest.approx(r["churn_probability"] * 600 - 50)


def matrix(spark, n=400):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 5))
    rows = [(i, int(v[0] + 0.3 * rng.normal() > 0), [float(a) for a in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, label int, features array<double>")


def test_training_and_selection(spark):
    train, val = matrix(spark).filter("id < 300"), matrix(spark).filter("id >= 300")
    tree = T.Candidate("tree", "decision_tree", {"max_depth": 3})
    off = T.Candidate("off", "decision_tree", {}, enabled=False)
    broken = T.Candidate("broken", "nothing")
    results = T.train_candidates(train, val, [T.DEFAULT_CANDIDATE, tree, off, broken])
    assert [r.candidate.name for r in results] == ["logistic_regression", "tree"]
    assert all(r.metrics["roc_auc"] > 0.85 for r in results)
    table = T.candidate_table(spark, results).collect()
    assert sum(r["selected"] for r in table) == 1
    importance = X.model_importance(spark, results[0].model, ["a", "b"]).collect()
    assert len(importance) == 2 and importance[0]["importance"] > importance[1]["importance"]
    numbered = X.model_importance(spark, results[1].model).collect()
    assert numbered[0]["feature"] == "feature_0"
    with pytest.raises(ValueError):
        T.train_candidates(train, val, [broken], strict=True)
    with pytest.raises(ValueError, match="No enabled"):
        T.train_candidates(train, val, [off])


def test_cross_validation_and_search(spark):
    data = matrix(spark, 300)
    cv = {r["metric"]: r for r in T.cross_validate(data, T.DEFAULT_CANDIDATE, "id", folds=3).collect()}
    assert cv["roc_auc"]["mean"] > 0.85 and cv["roc_auc"]["std"] < 0.1
    found = T.grid_search_lr(data, [{"C": c, "penalty": "l1", "class_weight": None} for c in (0.001, 1.0)], "id", folds=3, max_iter=30)
    assert found.first()["c"] == 1.0


def test_search_helpers():
    assert T.random_draws(T.LR_SPACE, 5, 1) == T.random_draws(T.LR_SPACE, 5, 1)
    assert len(T.random_draws(T.LR_SPACE, 1000)) == 24
    assert T.refined_strengths(1.0) == [0.1, 0.5, 1.0, 2.0, 10.0]
    assert T.refined_strengths(0.001)[0] == 0.001 and T.refined_strengths(100)[-1] == 1000
    assert T.regularisation(math.inf, 10) == 0.0 and T.regularisation(2.0, 50) == 0.01


def test_class_weights_and_ranking(spark):
    w = {r["label"]: r for r in T.class_weights(spark.createDataFrame([(0,), (0,), (0,), (1,)], "label int")).collect()}
    assert w[0]["weight"] == pytest.approx(4 / 6) and w[1]["weight"] == 2.0 and w[1]["positive_weight"] == 3.0
    table = spark.createDataFrame(
        [("deep", 0.86, 0.01, 0.84, 0.95), ("plain", 0.845, 0.01, 0.84, 0.85), ("weak", 0.80, 0.01, 0.8, 0.8)],
        "model string, cv_auc double, cv_auc_std double, val_auc double, train_auc double",
    )
    ranked = T.rank_models(table)
    assert ranked.first()["model"] == "deep"
    assert T.best_safe_model(ranked).first()["model"] == "plain"
    assert T.best_safe_model(ranked.filter("model = 'deep'")).first()["model"] == "deep"
    assert T.soft_voting_pays(ranked)


def test_stacking(spark):
    data = matrix(spark, 300)
    bases = [T.Candidate("lr", "logistic_regression", {"penalty": "l2"}), T.Candidate("t", "decision_tree", {"max_depth": 3})]
    out = T.stack(data.filter("id < 240"), data.filter("id >= 240"), bases, "id", folds=3)
    assert out.count() == 60 and T.metrics(out)["roc_auc"] > 0.85


def test_explain_tables(spark):
    coefs = X.coefficient_table(spark, [0.5, -0.3, 0.01, 0.02, -0.04], ["Contract_Two year", "tenure", "gender_Male", "TotalCharges", "x_y"])
    ranks = {r["feature"]: r["rank"] for r in X.rank_coefficients(coefs).collect()}
    assert ranks["Contract_Two year"] == 1 and ranks["gender_Male"] == 5
    groups = {r["feature_group"] for r in X.group_importance(coefs).collect()}
    assert groups == {"Contract", "tenure", "gender", "TotalCharges", "x"}
    why = {r["feature"]: (r["decision"], r["justification"]) for r in X.feature_decisions(coefs).collect()}
    assert why["tenure"][0] == "KEEP" and why["gender_Male"] == ("REVIEW", "Weak but business-relevant demographic")
    assert why["TotalCharges"][1] == "Redundant with tenure (corr=0.83)"
    assert X.coefficient_groups(coefs).filter("list = 'weak'").count() == 3
    assert X.coefficient_table(spark, [1, 2, 3], ["a", "b"]).count() == 2


def test_contributions_add_up(spark):
    df = customers(spark, 40)
    ready = engineer_features(df, fit_medians(df))
    pre = P.fit_preprocessor(ready, COLS.numeric_features, COLS.categorical_features)
    model = Sc.LinearModel(-0.2, {n: 0.1 * (i % 5 - 2) for i, n in enumerate(pre.feature_names())})
    means = X.feature_means(ready, pre)
    shares = {r["customerID"]: r for r in X.linear_contributions(ready, "customerID", pre, model, means).collect()}
    direct = ready.select("customerID", model.margin(pre.feature_columns(ready)).alias("m")).collect()
    for r in direct:
        assert shares[r["customerID"]]["margin"] == pytest.approx(r["m"])
    top = X.local_contributions(X.linear_contributions(ready, "customerID", pre, model, means), list(model.coefficients), F.col("customerID") == "c0001")
    sizes = [abs(r["contribution"]) for r in top.collect()]
    assert len(sizes) == len(model.coefficients) and sizes == sorted(sizes, reverse=True)


def test_csv_round_trip(spark):
    rows = [("a", " ", 1.5, 'say "hi", ok'), ("b", None, None, "NA"), ("c", "7", -2.0, "x")]
    df = spark.createDataFrame(rows, "id string, total string, x double, t string")
    path = scratch_folder(spark)
    sinks.write_csv(df, path)
    back = {r["id"]: r for r in readers.read_csv(spark, path, df.schema).collect()}
    assert back["a"]["total"] == " " and back["a"]["t"] == 'say "hi", ok' and back["a"]["x"] == 1.5
    assert back["b"]["total"] is None and back["b"]["x"] is None and back["b"]["t"] is None
    assert back["c"]["x"] == -2.0


def test_matrix_and_report_files(spark):
    path = scratch_folder(spark)
    data = matrix(spark, 20).withColumn("split", F.when(F.col("id") < 15, "train").otherwise("val"))
    sinks.write_matrix(data, path)
    assert readers.read_matrix(spark, path, ["val"]).count() == 5
    medians = scratch_folder(spark)
    sinks.write_json(spark.createDataFrame([("DSL", 45.0)], "group string, median double"), medians)
    assert readers.read_medians(spark, medians) == {"DSL": 45.0}
    assert readers.read_medians(spark, medians + "-gone") is None
    runs = scratch_folder(spark)
    sinks.append_run(spark, runs, {"step": "train", "auc": 0.8})
    sinks.append_run(spark, runs, {"step": "test", "auc": 0.7})
    assert spark.read.json(runs).count() == 2
    assert materialize(data).count() == 20


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, "b")], "x double, t string")
    assert readers.nan_to_null(df).filter("x is null").count() == 1


def test_training_queries_run_the_whole_job(monkeypatch):
    from stayflow.plans import training as plans

    given = {}

    class Seen(Exception):
        pass

    def see(name):
        def seen(*args, **options):
            given[name] = (args, options)
            raise Seen

        return seen

    monkeypatch.setattr(plans, "matrix", lambda *a: (None, []))
    monkeypatch.setattr(plans, "part", lambda rows, split: split)
    for name, operator in [
        ("tune_lr", "tune_lr"), ("model_comparison", "compare_models"), ("stacking", "stack"), ("candidate_selection", "train_candidates"),
    ]:
        monkeypatch.setattr(plans.T, operator, see(name))
        with pytest.raises(Seen):
            getattr(plans, name)(None, "")
    assert given["tune_lr"][1] == {}
    assert given["model_comparison"][0][2] == T.BASELINES
    assert given["stacking"][0][2] == T.BASELINES[1:]
    assert given["candidate_selection"][0][2][:-1] == T.BASELINES
