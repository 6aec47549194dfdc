"""No row is lost: missing keys, labels and scores, repeated keys, many groups."""

import hashlib

import pytest
from pyspark.sql import functions as F

from stayflow.operators import drift as D
from stayflow.operators import evaluation as E
from stayflow.operators import features as Fe
from stayflow.operators import lookups as L
from stayflow.operators.quantiles import exact_quantiles
from stayflow.operators.splits import seeded_sample, stratified_folds
from stayflow.params import CustomerColumns, DriftParams
from stayflow.sources import readers, sinks


def test_many_medians_come_back_as_a_table(spark, tmp_path):
    table = spark.range(30_000).select(F.concat(F.lit("g"), "id").alias("group"), F.col("id").cast("double").alias("median"))
    sinks.write_json(table, str(tmp_path / "m"))
    medians = readers.read_medians(spark, str(tmp_path / "m"), "InternetService")
    assert medians.count() == 30_000
    rows = spark.createDataFrame([("g29999", 7.0), ("none", 7.0), (None, 7.0)], "InternetService string, MonthlyCharges double")
    ready = Fe.engineer_features(rows, medians)
    assert sorted(r["overpay_indicator"] for r in ready.collect()) == [7.0 - 29_999, 7.0, 7.0]
    without = Fe.engineer_features(rows.drop("InternetService"), medians)
    assert [r["overpay_indicator"] for r in without.collect()] == [7.0] * 3


def test_a_repeated_key_does_not_shrink_the_sample(spark):
    values = spark.range(50_000).select(
        F.lit("c").alias("column"), F.lit(1).alias("id"), F.md5(F.lit("1")).alias("h"), (F.col("id") % 7).alias("value")
    )
    assert seeded_sample(values, "column", {"c": 50_000}, 2000, ["h", "id"]).count() == 2000


def test_values_without_a_key_are_in_the_drift_reference(spark):
    rows = [(None if i < 40 else i, float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, x double")
    got = D.reference_sample(df, ["x"], "id")
    assert sorted(r["value"] for r in got.collect()) == [float(i) for i in range(100)]
    capped = D.reference_sample(df, ["x"], "id", DriftParams(max_reference_samples=30)).collect()
    assert len(capped) == 30 and {r["original"] for r in capped} == {100}


def test_rows_without_a_label_get_a_fold(spark):
    rows = [(i, None if i % 3 == 0 else i % 2) for i in range(100)]
    folds = stratified_folds(spark.createDataFrame(rows, "id long, y int"), "id", "y").collect()
    assert len(folds) == 100
    unlabelled = sorted((r for r in folds if r["y"] is None), key=lambda r: hashlib.md5(f"{r['id']}|42".encode()).hexdigest())
    assert [r["fold"] for r in unlabelled] == [i % 5 for i in range(34)]


SCORED = [(1, 0.9), (0, 0.2), (1, None), (0, float("nan")), (1, 0.4), (0, None)]


def test_rows_without_a_score_are_not_flagged(spark):
    df = spark.createDataFrame(SCORED, "y int, p double")
    assert tuple(E.confusion(df, 0.3).first()) == (3, 0, 1, 2)
    rows = E.threshold_sweep(df, [0.3, 0.5]).collect()
    assert all(sum(r[n] for n in ("true_positives", "false_positives", "false_negatives", "true_negatives")) == 6 for r in rows)


def test_curves_with_missing_scores(spark):
    df = spark.createDataFrame(SCORED, "y int, p double")
    # Positives 0.9, 0.4, none; negatives 0.2, none, none: pairs won, ties half.
    assert E.roc_auc(df).first()["roc_auc"] == pytest.approx((3 + 3 + 2 * 0.5) / 9)
    points = sorted(tuple(r) for r in E.roc_points(df).collect())
    assert points == [(0.2, pytest.approx(1 / 3), pytest.approx(2 / 3)), (0.4, 0.0, pytest.approx(2 / 3)), (0.9, 0.0, pytest.approx(1 / 3))]
    assert E.pr_points(df).count() == 3


def test_a_missing_last_threshold_is_the_default(spark):
    history = spark.createDataFrame([("a", 0.3, 1), ("a", None, 2), ("b", 0.7, 3)], "model_id string, final_threshold double, seq int")
    rows = spark.createDataFrame([("a",), ("b",), ("new",)], "model_id string")
    got = {r["model_id"]: r["threshold"] for r in L.with_model_threshold(rows, history).collect()}
    # max_by ignores nothing: the last row of a has no threshold.
    assert got == {"a": 0.5, "b": 0.7, "new": 0.7}


def test_quantiles_of_a_large_column_and_groups(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 3).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("x")
    )
    whole = exact_quantiles(df, ["x"], [0.25, 0.5]).collect()
    want = df.agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5)))).first()[0]
    assert [r["value"] for r in sorted(whole, key=lambda r: r["prob"])] == pytest.approx(want)
    by = {r["g"]: r["value"] for r in exact_quantiles(df, ["x"], [0.5], ["g"]).collect()}
    for r in df.groupBy("g").agg(F.percentile("x", F.lit(0.5)).alias("m")).collect():
        assert by[r["g"]] == pytest.approx(r["m"])


def test_feature_sets_keep_their_order():
    from stayflow.operators.preprocess import feature_sets

    sets = feature_sets(CustomerColumns())
    assert sets["B"][:5] == ["gender", "SeniorCitizen", "Partner", "Dependents", "tenure"]
    assert sets["C"][:5] == ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen", "Dependents"]
    assert sets["A"][0] == "tenure" and len(sets["A"]) == 21 and len(sets["B"]) == 33 and len(sets["C"]) == 25
