import math

import pytest
from pyspark.sql import functions as F

from stayflow.functions.columns import threshold_grid
from stayflow.operators import evaluation as E
from stayflow.params import QualityGates

# Published validation sweep, fixed values: threshold, tp, fp, fn, tn, precision, recall, f1, net.
PUBLISHED = [
    (0.20, 334, 369, 40, 666, 0.4751, 0.8930, 0.6202, 165250.0),
    (0.25, 314, 285, 60, 750, 0.5242, 0.8396, 0.6454, 158450.0),
    (0.30, 293, 249, 81, 786, 0.5406, 0.7834, 0.6397, 148700.0),
    (0.35, 275, 198, 99, 837, 0.5814, 0.7353, 0.6494, 141350.0),
    (0.40, 255, 161, 119, 874, 0.6130, 0.6818, 0.6456, 132200.0),
    (0.45, 234, 131, 140, 904, 0.6411, 0.6257, 0.6333, 122150.0),
    (0.50, 203, 91, 171, 944, 0.6905, 0.5428, 0.6078, 107100.0),
    (0.55, 170, 68, 204, 967, 0.7143, 0.4545, 0.5556, 90100.0),
    (0.60, 137, 49, 237, 986, 0.7366, 0.3663, 0.4893, 72900.0),
    (0.65, 110, 27, 264, 1008, 0.8029, 0.2941, 0.4305, 59150.0),
    (0.70, 76, 14, 298, 1021, 0.8444, 0.2032, 0.3276, 41100.0),
    (0.75, 64, 10, 310, 1025, 0.8649, 0.1711, 0.2857, 34700.0),
    (0.80, 39, 6, 335, 1029, 0.8667, 0.1043, 0.1862, 21150.0),
    (0.85, 14, 2, 360, 1033, 0.8750, 0.0374, 0.0718, 7600.0),
]


def scored(spark, pairs):
    return spark.createDataFrame([(int(y), float(p)) for y, p in pairs], "y int, p double")


def published(spark):
    counts = spark.createDataFrame(
        [r[:5] for r in PUBLISHED],
        "threshold double, true_positives long, false_positives long, false_negatives long, true_negatives long",
    )
    return E.sweep_metrics(counts, 600, 50)


def test_published_sweep(spark):
    rows = {r["threshold"]: r for r in published(spark).collect()}
    for t, *_, precision, recall, f1, net in PUBLISHED:
        r = rows[t]
        assert round(r["precision"], 4) == precision
        assert round(r["recall"], 4) == recall
        assert round(r["f1_score"], 4) == f1
        assert r["net_value"] == net
    assert rows[0.25]["net_per_flagged"] == pytest.approx(264.52420701)


def test_published_selection(spark):
    row = E.select_threshold(published(spark), 0.70, "net_value", 0.50).first()
    assert row["threshold"] == 0.25
    assert "Net_Value" in row["reason"] and "Precision >= 0.50" in row["reason"]
    assert E.select_threshold(published(spark), 0.70, "net_value").first()["threshold"] == 0.20


def test_sweep_small(spark):
    rows = scored(spark, zip([1, 1, 0, 0, 0], [0.9, 0.7, 0.4, 0.2, 0.1]))
    r = E.threshold_sweep(rows, [0.5], 600, 50).first()
    assert (r["true_positives"], r["false_positives"], r["net_value"]) == (2, 0, 1100.0)


def test_sweep_nobody_flagged(spark):
    r = E.threshold_sweep(scored(spark, zip([1, 0, 0], [0.6, 0.3, 0.1])), [0.99], 600, 50).first()
    assert (r["total_flagged"], r["precision"], r["recall"], r["net_per_flagged"]) == (0, 0, 0, 0)


def test_sweep_without_money_and_empty(spark):
    out = E.threshold_sweep(scored(spark, [(1, 0.9), (0, 0.1)]), [0.5])
    assert "net_value" not in out.columns
    empty = E.threshold_sweep(scored(spark, []), [0.3, 0.5], 600, 50).collect()
    assert [r["true_negatives"] for r in empty] == [0, 0]


def test_sweep_counts_and_monotone(spark):
    rows = spark.range(2000).select(
        (F.col("id") * 7919 % 3 == 0).cast("int").alias("y"), (F.col("id") * 31 % 101 / 100).alias("p")
    )
    out = E.threshold_sweep(rows, threshold_grid(0.2, 0.85, 0.05)).orderBy("threshold").collect()
    assert len(out) == 14
    flagged = [r["total_flagged"] for r in out]
    assert flagged == sorted(flagged, reverse=True)
    for r in out:
        total = r["true_positives"] + r["false_positives"] + r["false_negatives"] + r["true_negatives"]
        assert total == 2000


def test_one_class(spark):
    r = E.confusion(scored(spark, zip([0] * 4, [0.2, 0.7, 0.1, 0.9])), 0.5).first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (2, 2, 0, 0)


def table(spark, rows, net=True):
    cols = "threshold double, recall double, precision double, f1_score double" + (", net_value double" if net else "")
    return spark.createDataFrame(rows, cols)


def test_select_by_precision(spark):
    t = table(spark, [(0.3, 0.95, 0.6, 0.7), (0.5, 0.8, 0.75, 0.7), (0.7, 0.5, 0.9, 0.6)], False)
    assert E.select_threshold(t, 0.7, "precision").first()["threshold"] == 0.5


def test_select_fallback_and_ties(spark):
    t = table(spark, [(0.3, 0.6, 0.6, 0.58), (0.5, 0.5, 0.7, 0.53), (0.7, 0.4, 0.9, 0.33)], False)
    row = E.select_threshold(t, 0.7, "net_value").first()
    assert row["threshold"] == 0.3 and "Best F1" in row["reason"]
    tie = table(spark, [(0.3, 0.9, 0.6, 0.6, 5.0), (0.5, 0.9, 0.6, 0.6, 5.0)])
    assert E.select_threshold(tie, 0.7).first()["threshold"] == 0.3


def test_select_without_net_column(spark):
    t = table(spark, [(0.3, 0.9, 0.6, 0.60), (0.5, 0.8, 0.6, 0.66), (0.7, 0.75, 0.6, 0.72)], False)
    assert E.select_threshold(t, 0.7, "net_value").first()["threshold"] == 0.7


def test_precision_bound(spark):
    rows = [(0.2, 0.9, 0.39, 0.5, 400.0), (0.35, 0.85, 0.44, 0.5, 300.0), (0.45, 0.8, 0.50, 0.5, 200.0), (0.6, 0.7, 0.58, 0.5, 100.0)]
    t = table(spark, rows)
    assert E.select_threshold(t, 0.7, min_precision=0.40).first()["threshold"] == 0.35
    assert E.select_threshold(t, 0.7).first()["threshold"] == 0.2


@pytest.mark.parametrize(
    "values, failed",
    [((0.83, 0.70, 0.50), []), ((0.70, 0.50, 0.30), ["roc_auc", "recall", "precision"]), ((0.8384, 0.8102, 0.5042), [])],
)
def test_gates(spark, values, failed):
    gates = QualityGates(0.83, 0.70, 0.50)
    row = spark.range(1).select(E.failed_gates(gates, *[F.lit(v) for v in values]).alias("f")).first()
    assert row["f"] == failed


def test_auc_by_pairs(spark):
    pairs = [(i * 7 % 3 == 0, (i * 13 % 17) / 17) for i in range(200)]
    pos = [p for y, p in pairs if y]
    neg = [p for y, p in pairs if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert E.roc_auc(scored(spark, pairs)).first()["roc_auc"] == pytest.approx(wins / len(pos) / len(neg))


def test_auc_one_score_and_one_class(spark):
    assert E.roc_auc(scored(spark, [(1, 0.5), (0, 0.5)])).first()["roc_auc"] == 0.5
    assert E.roc_auc(scored(spark, [(1, 0.5), (1, 0.7)])).first()["roc_auc"] is None


def test_curves_end_at_all_rows(spark):
    rows = scored(spark, [(i % 3 == 0, (i * 13 % 97) / 97) for i in range(300)])
    roc = E.roc_points(rows).orderBy("threshold").collect()
    assert (roc[0]["fpr"], roc[0]["tpr"]) == (1.0, 1.0)
    assert all(a["tpr"] >= b["tpr"] for a, b in zip(roc, roc[1:]))
    pr = E.pr_points(rows).orderBy("threshold").first()
    assert pr["recall"] == 1.0 and math.isclose(pr["precision"], pr["baseline"])


def test_grid():
    grid = threshold_grid(0.20, 0.85, 0.05)
    assert len(grid) == 14 and grid[0] == 0.2 and grid[-1] == 0.85 and 0.3 in grid
