"""Cleaning, features, quality checks and row validation: literal cases."""

import pytest
from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.operators import features as Fe
from stayflow.operators import quality as Q
from stayflow.operators import rows as R
from stayflow.params import ENGINEERED, ValidationRules


def test_total_charges(spark):
    df = spark.createDataFrame([("",), ("  ",), ("10.5",), (None,)], "TotalCharges string")
    assert [r[0] for r in Fe.clean_total_charges(df).collect()] == [0.0, 0.0, 10.5, 0.0]


def test_text_to_number(spark):
    texts = ["1d", "NaN", "inf", " ", " 7 ", ".5", "-3.", "1e3", "abc", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(C.text_to_number(F.col("t"))).collect()]
    assert got == [None, None, None, None, 7.0, 0.5, -3.0, 1000.0, None, None]


def test_bins_ordinals_rounding(spark):
    df = spark.createDataFrame([(float(x),) for x in (-1, 0, 6, 7, 72, 73)], "x double")
    assert [r[0] for r in df.select(Fe.tenure_group(F.col("x"))).collect()] == [None, 0, 0, 1, 4, None]
    v = C.right_closed_bins(F.col("x"), [0, 6, 72], ["a", "b"], include_lowest=False)
    assert [r[0] for r in df.select(v).collect()] == [None, None, "a", "b", "b", None]
    assert spark.range(1).select(C.round_even(F.lit(0.125), 2)).first()[0] == 0.12


def test_significance_and_status(spark):
    p = spark.createDataFrame([(0.0005,), (0.005,), (0.03,), (0.2,)], "p double")
    assert [r[0] for r in p.select(C.significance(F.col("p"), "ns")).collect()] == ["***", "**", "*", "ns"]
    row = spark.range(1).select(
        C.target_status(F.lit(0.8), F.lit(0.8), F.lit(0.7)), C.target_status(F.lit(0.69), F.lit(0.8), F.lit(0.7))
    ).first()
    assert tuple(row) == ("target", "below")


ENGINEERING = (
    "tenure int, MonthlyCharges double, TotalCharges double, Contract string, InternetService string, "
    "OnlineSecurity string, TechSupport string, OnlineBackup string, DeviceProtection string, "
    "StreamingTV string, StreamingMovies string, PaymentMethod string"
)


def two_customers(spark):
    rows = [
        (0, 60.0, 0.0, "Month-to-month", "Fiber optic", "No", "No", "No", "No", "Yes", "Yes", "Electronic check"),
        (24, 80.0, 1800.0, "Two year", "DSL", "Yes", "Yes", "No", "Yes", "No", "Yes", "Credit card (automatic)"),
    ]
    return spark.createDataFrame(rows, ENGINEERING)


def test_engineering(spark):
    a, b = Fe.engineer_features(two_customers(spark), {"Fiber optic": 65.0, "DSL": 45.0}).orderBy("tenure").collect()
    assert (a["overpay_indicator"], b["overpay_indicator"]) == (-5.0, 35.0)
    assert a["avg_monthly_spend"] == 0 and b["avg_monthly_spend"] == 75.0
    assert a["charge_tenure_ratio"] == 60.0 and b["charge_deviation"] == 5.0
    assert (a["num_support_services"], b["num_support_services"]) == (0, 3)
    assert (a["num_streaming_services"], b["num_streaming_services"]) == (2, 1)
    assert (a["is_mtm_fiber"], a["is_mtm_no_support"], a["is_echeck_mtm"], a["is_auto_pay"]) == (1, 1, 1, 0)
    assert (b["tenure_x_contract"], b["is_auto_pay"], b["tenure_group"]) == (48.0, 1, 2.0)


def test_engineering_absent_columns_and_unseen_groups(spark):
    bare = spark.createDataFrame([(5, 50.0, 250.0), (7, 70.0, 490.0), (9, 90.0, 810.0)], "tenure int, MonthlyCharges double, TotalCharges double")
    rows = Fe.engineer_features(bare).orderBy("tenure").collect()
    assert set(ENGINEERED) <= set(rows[0].asDict())
    assert [r["overpay_indicator"] for r in rows] == [-20.0, 0.0, 20.0]
    assert {r["has_internet"] for r in rows} == {0}
    unseen = Fe.engineer_features(two_customers(spark), {"No": 1.0}).collect()
    assert [r["overpay_indicator"] for r in unseen] == [r["MonthlyCharges"] for r in unseen]


def test_missing_service_counts_as_internet(spark):
    df = two_customers(spark).withColumn("InternetService", F.lit(None).cast("string"))
    assert {r["has_internet"] for r in Fe.engineer_features(df, {"DSL": 1.0}).collect()} == {1}


def test_medians_fit(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 9.0)], "InternetService string, MonthlyCharges double")
    assert Fe.fit_medians(df) == {"a": 2.0, "b": 5.0}
    assert Fe.fit_medians(df.drop("InternetService")) == {"__global__": 4.0}


def test_unknown_label_stops(spark):
    df = spark.createDataFrame([("Yes",), ("maybe",)], "Churn string")
    with pytest.raises(Exception, match="neither Yes nor No"):
        Fe.prepare_labels(df).collect()


RAW = "customerID string, tenure int, MonthlyCharges double, TotalCharges string, Contract string, InternetService string, PaymentMethod string, SeniorCitizen int, Churn string"


def raw(spark, tenure=(1, 2, 3, 4), total=("10", "20", "30", "40"), churn=("Yes", "No", "No", "Yes")):
    rows = [
        (f"c{i}", t, 50.0, c, "One year", "DSL", "Mailed check", 0, y)
        for i, (t, c, y) in enumerate(zip(tenure, total, churn))
    ]
    return spark.createDataFrame(rows, RAW)


def test_quality_passes(spark):
    r = Q.quality_report(raw(spark), ValidationRules()).first()
    assert r["passed"] and r["rows"] == 4 and r["target_rate"] == 0.5 and r["duplicate_count"] == 0
    assert r["missing_ratio_per_column"]["TotalCharges"] == 0.0


@pytest.mark.parametrize("value, passed", [(0, True), (100, True), (-1, False), (None, False)])
def test_tenure_rule(spark, value, passed):
    report = Q.quality_report(raw(spark, tenure=(value, 2, 3, 4)), ValidationRules()).first()
    assert report["passed"] is passed


def test_quality_failures(spark):
    rules = ValidationRules()
    assert not Q.quality_report(raw(spark, total=(" ",) * 4), rules).first()["passed"]
    report = Q.quality_report(raw(spark, total=("x", "1", "2", "3")), rules).first()
    assert any("TotalCharges: 1" in i for i in report["critical_issues"])
    absent = Q.quality_report(raw(spark).drop("Contract"), rules).first()
    assert any("Contract" in i for i in absent["critical_issues"])
    empty = Q.quality_report(raw(spark).limit(0), rules).first()
    assert "Input table is empty." in empty["critical_issues"]
    with pytest.raises(Q.DataValidationError):
        Q.require_quality(raw(spark, tenure=(-5, 1, 1, 1)), rules)


def test_quality_target(spark):
    rules = ValidationRules()
    lower = Q.target_stats(raw(spark, churn=("yes", "no", "?", "No")), "Churn").first()
    assert (lower["valid_rows"], lower["non_binary_rows"]) == (3, 0)
    numbers = Q.target_stats(raw(spark, churn=("1", "0", "2", "0")), "Churn").first()
    assert (numbers["valid_rows"], numbers["non_binary_rows"]) == (4, 1)
    none = Q.quality_report(raw(spark, churn=("?",) * 4), rules).first()
    assert any("no valid values" in i for i in none["critical_issues"])


def test_quality_warning_for_numeric_category(spark):
    df = raw(spark).withColumn("Contract", F.lit(1))
    assert "Contract" in Q.quality_report(df, ValidationRules()).first()["warnings"][0]


def test_duplicates_treat_blank_as_missing(spark):
    df = spark.createDataFrame([("a", " "), ("a", None), ("a", ""), ("b", "x")], "k string, v string")
    r = Q.duplicate_stats(df).first()
    assert (r["duplicate_count"], r["distinct_rows"], r["duplicate_ratio"]) == (2, 2, 0.5)


def test_row_validation(spark):
    df = spark.createDataFrame(
        [(10.0, 20.0, "DSL"), (-1.0, 0.0, "DSL"), (25.0, 40.0, "bad")],
        "MonthlyCharges double, TotalCharges double, InternetService string",
    )
    valid, issues = R.split_valid(df, required=["MonthlyCharges", "TotalCharges"])
    assert valid.count() == 1 and issues.count() == 2
    with pytest.raises(Q.DataValidationError, match="2 rows"):
        R.require_valid_rows(df)
    absent = R.with_row_errors(df, required=["tenure"]).collect()
    assert all("tenure" in r["errors"][0] for r in absent)
    with pytest.raises(Q.DataValidationError):
        R.require_valid_rows(df, required=["tenure"])


def test_row_error_order(spark):
    df = spark.createDataFrame(
        [(2, -1, "x", "bad", "bad"), (0, 1, "5", "bad", "bad"), (0, 1, "5", "DSL", None), (0, 1, " ", "DSL", "One year")],
        "SeniorCitizen int, tenure int, TotalCharges string, InternetService string, Contract string",
    )
    errors = [r["errors"] for r in R.with_row_errors(df, required=["Contract"]).collect()]
    assert len(errors[0]) == 3  # all field errors, no category error
    assert errors[1] == ["Invalid internet service: bad"]  # the first category only
    assert errors[2] == ["Null values in required columns: Contract"]
    assert len(errors[3]) == 1  # a lone space is neither missing nor a number


def test_row_whole_numbers(spark):
    df = spark.createDataFrame([(1.5,), (2.0,), (float("nan"),), (None,)], "tenure double")
    assert [len(r["errors"]) for r in R.with_row_errors(df).collect()] == [1, 0, 0, 0]


OUTPUT = "churn_probability double, churn_prediction int, decision string"


def test_output_checks(spark):
    good = spark.createDataFrame([(0.8, 1, "contact"), (0.1, 0, "no_contact")], OUTPUT)
    assert R.output_issues(good, 0.5) == []
    high = spark.createDataFrame([(1.2, 1, "contact")], OUTPUT)
    with pytest.raises(Q.DataValidationError):
        R.output_issues(high, 0.5)
    contradictory = spark.createDataFrame([(0.1, 0, "contact")], OUTPUT)
    assert R.output_issues(contradictory) == []
    assert len(R.output_issues(contradictory, 0.5, strict=False)) == 1
    failed = spark.createDataFrame([(None, None, None)], OUTPUT)
    assert len(R.output_issues(failed, 0.5, strict=False)) == 4
    assert len(R.output_issues(good.drop("churn_probability"), strict=False)) == 1
