import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.functions import pvalues as P
from stayflow.operators import batches as B
from stayflow.operators import drift as D
from stayflow.operators import lookups as L
from stayflow.operators import stats as St
from stayflow.params import DriftParams


def direct_ks(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(np.mean(np.array(a) <= x) - np.mean(np.array(b) <= x)) for x in points)


@pytest.mark.parametrize("seed", range(4))
def test_ks_matches_direct_definition(spark, seed):
    rng = np.random.default_rng(seed)
    ref = {c: list(map(float, rng.integers(0, 12, size=rng.integers(1, 40)))) for c in "xyz"}
    new = [tuple(map(float, rng.integers(-2, 14, size=3))) for _ in range(60)]
    df = spark.createDataFrame(new, "x double, y double, z double").repartition(3)
    got = {r["column"]: r for r in D.ks_against_reference(df, D.DriftReference(ref)).collect()}
    for i, c in enumerate("xyz"):
        assert got[c]["ks_statistic"] == pytest.approx(direct_ks(ref[c], [n[i] for n in new]))
        assert (got[c]["n_ref"], got[c]["n_new"]) == (len(ref[c]), 60)
        table = spark.createDataFrame([(v,) for v in ref[c]], f"{c} double")
        whole = D.ks_between(table, df, c).first()
        assert whole["ks_statistic"] == pytest.approx(got[c]["ks_statistic"])


def test_ks_of_neighbouring_doubles(spark):
    a = 1.0
    ref = [a, math.nextafter(a, 2)]
    df = spark.createDataFrame([(a,), (a,), (math.nextafter(math.nextafter(a, 2), 2),)], "x double")
    got = D.ks_against_reference(df, D.DriftReference({"x": ref})).first()["ks_statistic"]
    assert got == pytest.approx(direct_ks(ref, [r[0] for r in df.collect()]))


def test_ks_with_itself_is_zero(spark):
    df = spark.createDataFrame([(float(i),) for i in range(50)], "x double")
    reference = D.DriftReference({"x": [float(i) for i in range(50)]})
    assert D.ks_against_reference(df, reference).first()["ks_statistic"] == 0.0


def test_drift_statuses(spark):
    reference = D.DriftReference({"x": [1.0, 2, 3, 4, 5], "gone": [1.0], "text": [1.0], "moved": [float(i) for i in range(40)]})
    new = spark.createDataFrame([(x, "abc", 100.0 + x) for x in (1.1, 2.2, 3.0, 4.1, 5.2)], "x double, text string, moved double")
    report = D.drift_report(new, reference, DriftParams(p_value_bound=0.01))
    status = {r["column"]: r["status"] for r in report.collect()}
    assert status == {"x": "OK", "gone": "MISSING_IN_NEW_DATA", "text": "NO_VALID_VALUES", "moved": "DRIFT_DETECTED"}
    score = D.drift_score(report).first()
    assert score["drift_score"] == 0.75 and score["drift_columns"] == ["gone", "moved", "text"]


def test_reference_cap(spark):
    df = spark.range(200).select("id", F.col("id").cast("double").alias("x"))
    reference = D.fit_reference(df, ["x"], "id", DriftParams(max_reference_samples=25))
    assert len(reference.samples["x"]) == 25 and reference.counts["x"] == (200, 25)
    whole = D.fit_reference(df, ["x"], "id")
    assert whole.counts["x"] == (200, 200)


def test_drift_input_is_engineered_when_columns_lack(spark):
    raw = spark.createDataFrame([(1, 50.0, " "), (2, 60.0, "120")], "tenure int, MonthlyCharges double, TotalCharges string")
    reference = D.DriftReference({"avg_monthly_spend": [1.0]})
    assert "avg_monthly_spend" in D.prepare_drift_input(raw, reference).columns
    same = D.prepare_drift_input(raw, D.DriftReference({"tenure": [1.0]}))
    assert same.columns == raw.columns


def test_p_values():
    assert P.student_two_sided(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert P.student_two_sided(0.0, 5) == pytest.approx(1.0)
    assert P.chi_square_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert P.chi_square_tail(20.0, 10) == pytest.approx(0.0292527, abs=1e-6)
    assert P.ks_limit(1.358 / math.sqrt(50_000), 100_000, 100_000) == pytest.approx(0.05, abs=1e-3)


def test_ks_exact_by_enumeration():
    from itertools import combinations

    n, m = 5, 4
    for d in (0.25, 0.4, 0.55, 0.8, 1.0):
        hits = total = 0
        for picked in combinations(range(n + m), n):
            i = j = 0
            worst = 0.0
            for k in range(n + m):
                i, j = (i + 1, j) if k in picked else (i, j + 1)
                worst = max(worst, abs(i / n - j / m))
            total += 1
            hits += worst >= d - 1e-9
        assert P.ks_exact(d, n, m) == pytest.approx(hits / total)
    assert abs(P.ks_exact(0.05, 2000, 3000) - P.ks_limit(0.05, 2000, 3000)) < 2e-3


def test_t_test_and_chi_square(spark):
    rows = [("Yes", float(v)) for v in (1, 2, 3, 4)] + [("No", float(v)) for v in (3, 4, 5, 6, 7)]
    r = St.t_test(spark.createDataFrame(rows, "y string, x double"), ["x"], "y").first()
    assert r["t_stat"] == pytest.approx(-2.5 / math.sqrt(15 / 7 * (1 / 4 + 1 / 5)))
    assert r["dof"] == 7 and 0.01 < r["p_value"] < 0.05 and r["significance"] == "*"
    cells = [("a", "Yes", 10), ("a", "No", 20), ("b", "Yes", 30), ("b", "No", 15)]
    data = [(k, y) for k, y, n in cells for _ in range(n)]
    c = St.chi_square(spark.createDataFrame(data, "k string, y string"), ["k"], "y").first()
    expected = [40 * 30 / 75, 35 * 30 / 75, 40 * 45 / 75, 35 * 45 / 75]
    chi = sum((abs(o - e) - 0.5) ** 2 / e for o, e in zip((10, 20, 30, 15), expected))
    assert c["chi2"] == pytest.approx(chi) and c["dof"] == 1
    assert c["cramers_v"] == pytest.approx(math.sqrt(chi / 75))


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(5)], "a double, b double")
    got = {(r["a"], r["b"]): r["corr"] for r in St.corr_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "b")] is None and got[("b", "b")] == pytest.approx(1.0)


def test_histogram_matches_numpy(spark):
    values = [i * 0.1 for i in range(101)] + [10.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["count"] for r in St.histogram(df, "x", 30).orderBy("bin").collect()]
    assert got == list(np.histogram(values, bins=30)[0])


def test_density_sums_to_one(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([("a", float(round(v))) for v in rng.normal(50, 10, 500)], "g string, x double")
    rows = St.kde_curve(df, "x", "g").orderBy("x").collect()
    area = np.trapezoid([r["density"] for r in rows], [r["x"] for r in rows])
    assert area == pytest.approx(1.0, abs=0.02)


def test_batch_metrics(spark):
    log = spark.createDataFrame([(1, 10, 2, 5.0, 0.5), (2, 0, 0, 15.0, None)], "seq int, batch_size long, failed_rows long, latency_ms double, drift double")
    m = B.batch_metrics(log, "seq", "drift").first()
    assert (m["prediction_batches"], m["predictions_total"], m["prediction_failures"]) == (2, 10, 2)
    assert (m["failure_rate"], m["avg_latency_ms"], m["last_drift_score"]) == (0.2, 10.0, 0.5)
    assert B.batch_metrics(log.limit(0), "seq").first()["failure_rate"] == 0.0
    running = B.batch_metrics_running(log, "seq").orderBy("seq").collect()
    assert [r["avg_latency_ms"] for r in running] == [5.0, 10.0]
    long_log = spark.range(300).select(F.col("id").alias("seq"))
    kept = B.batch_history(long_log, "seq")
    assert kept.count() == 200 and kept.agg(F.min("seq")).first()[0] == 100


def test_threshold_history(spark):
    history = spark.createDataFrame([(1, "a", 0.42), (2, "b", 0.61), (3, "a", 0.55)], "seq int, model_id string, final_threshold double")
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "model_id string")
    got = {r["model_id"]: r["threshold"] for r in L.with_model_threshold(rows, history).collect()}
    assert got == {"a": 0.55, "b": 0.61, "c": 0.55}
    none = {r["threshold"] for r in L.with_model_threshold(rows, history.limit(0)).collect()}
    assert none == {0.5}


def test_threshold_history_with_many_models(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_MODELS", 1)
    history = spark.createDataFrame([(1, "a", 0.42), (2, "b", 0.61)], "seq int, model_id string, final_threshold double")
    rows = spark.createDataFrame([("a",), ("c",)], "model_id string")
    got = {r["model_id"]: r["threshold"] for r in L.with_model_threshold(rows, history).collect()}
    assert got == {"a": 0.42, "c": 0.61}


def test_drift_between_compares_whole_tables(spark):
    reference = spark.range(20_000).selectExpr("id", "CAST(id AS DOUBLE) AS a", "1.0D AS gone", "1.0D AS text")
    new = spark.range(20_000).selectExpr("id", "CAST(id + 300 AS DOUBLE) AS a", "'abc' AS text")
    got = {r["column"]: r for r in D.drift_between(reference, new, ["a", "gone", "text"]).collect()}
    assert (got["a"]["n_ref"], got["a"]["n_new"]) == (20_000, 20_000)
    assert got["a"]["ks_statistic"] == pytest.approx(0.015) and got["a"]["status"] == "DRIFT_DETECTED"
    assert got["gone"]["status"] == "MISSING_IN_NEW_DATA" and got["text"]["status"] == "NO_VALID_VALUES"


def test_engineered_drift_reads_all_train_rows(spark):
    from stayflow.plans import scoring

    rows = scoring.drift_engineered(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 3 and all(r["n_ref"] > 2000 for r in rows)
