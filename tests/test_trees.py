"""Trees of many models in shared passes, against MLlib's."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stayflow.operators import training as T
from stayflow.operators import trees as G
from stayflow.operators.scoring import score_with_ml


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(1500, 5))
    x[:, 3] = np.round(x[:, 3])
    y = (x[:, 0] * x[:, 1] + x[:, 3] + r.normal(size=1500) > 0.6).astype(int)
    lines = [(i, int(a), [float(v) for v in b], i % 3) for i, (a, b) in enumerate(zip(y, x))]
    return spark.createDataFrame(lines, "id long, label int, features array<double>, fold int").coalesce(2).persist()


def plain(rows):
    return rows.select(F.col("label").cast("double").alias("label"), array_to_vector("features").alias("v"))


def gap(rows, a, b):
    both = score_with_ml(b.setFeaturesCol("_vector"), score_with_ml(a, rows, "a"), "b")
    return both.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0]


def test_trees_and_boosting_equal_mllib(rows):
    tree = T.fit(T.Candidate("t", "decision_tree", {"max_depth": 5}), rows)
    assert gap(rows, tree, DecisionTreeClassifier(featuresCol="v", maxDepth=5).fit(plain(rows))) < 1e-9
    settings = {"n_estimators": 12, "max_depth": 3, "learning_rate": 0.2}
    boosted = T.fit(T.Candidate("b", "gradient_boosting", settings), rows)
    other = GBTClassifier(featuresCol="v", maxIter=12, maxDepth=3, stepSize=0.2).fit(plain(rows))
    assert gap(rows, boosted, other) < 1e-9


def test_a_left_out_fold_is_not_seen(rows):
    c = T.Candidate("t", "decision_tree", {"max_depth": 4})
    wrong = rows.withColumn("label", F.when(F.col("fold") == 1, 1 - F.col("label")).otherwise(F.col("label")))
    a, b = (T.fit_all(r, [(c, 1)])[0] for r in (rows, wrong))
    assert a == b and T.fit_all(rows, [(c, None)])[0] != a


def test_models_share_their_passes(rows, monkeypatch):
    works, search = [], G.search
    monkeypatch.setattr(G, "search", lambda *a: works.append(len(a[2])) or search(*a))
    forest = T.Candidate("f", "random_forest", {"n_estimators": 9, "max_depth": 4})
    models = T.fit_all(rows, [(forest, k) for k in (0, 1, 2, None)])
    # One pass a level for all trees of all folds, not one search a fold.
    assert len(works) == 4 and works[0] == 36
    assert T.metrics(score_with_ml(models[-1], rows))["roc_auc"] > 0.75
    assert [m.trees for m in T.fit_all(rows, [(forest, None)])] == [models[-1].trees]


def test_nodes_beyond_one_pass_wait(rows, monkeypatch):
    c = T.Candidate("t", "decision_tree", {"max_depth": 5})
    whole = T.fit(c, rows)
    monkeypatch.setattr(G, "CELLS", 1000)
    assert gap_of(rows, whole, T.fit(c, rows)) < 1e-12


def gap_of(rows, a, b):
    return score_with_ml(b, score_with_ml(a, rows, "a"), "b").agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0]


def test_bins_of_a_fold_are_its_own(rows):
    c = T.Candidate("t", "decision_tree", {"max_depth": 4, "class_weight": "balanced"})
    alone = T.fit(c, rows.filter("fold != 1"))
    among = T.fit_all(rows, [(c, 0), (c, 1), (c, None)])[1]
    assert gap_of(rows, alone, among) < 1e-12


def test_passes_leave_no_plans_behind(spark, rows):
    """The driver keeps the plan of each SQL execution: a pass must not be one."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty(30_000)
    before = store.executionsCount()
    T.fit(T.Candidate("b", "gradient_boosting", {"n_estimators": 15, "max_depth": 3}), rows)
    bus.waitUntilEmpty(30_000)
    assert store.executionsCount() - before < 15


def test_columns_in_one_code_keep_their_counts():
    r = np.random.default_rng(5)
    x = np.column_stack([r.normal(size=400), *r.integers(0, 2, (9, 400)), r.integers(0, 7, 400)]).astype(float)
    sets = [[G.marks_of(c, np.ones(len(c))) for c in part.T] for part in (x, x[:250])]
    layout = G.Layout.of(sets, G.CODES)
    assert len(layout.codes) < layout.place.size and max(layout.sizes) <= G.CODES
    codes, place, label = layout.coded(x), r.integers(0, 4, 400), r.integers(0, 2, 400).astype(np.uint8)
    for s, marks in enumerate(sets):
        work = G.Sums(G.TreeProblem("decision_tree"), s, np.tile(np.arange(x.shape[1]), (3, 1)), layout)
        work.add(codes.ravel(), 400, place, label, None, None, None)
        want = np.zeros((x.shape[1], 3, G.MAX_BINS, 2))
        for i in np.flatnonzero(place < 3):
            for f, m in enumerate(marks):
                want[f, place[i], np.searchsorted(m, x[i, f]), label[i]] += 1
        assert (work.found()[0] == want).all()


def test_models_are_measured_in_one_pass(rows):
    """All models and folds go through one histogram, with the figures of each alone."""
    tree = T.Candidate("t", "decision_tree", {"max_depth": 4})
    wanted = [(tree, 1), (T.DEFAULT_CANDIDATE, 2), (T.Candidate("b", "gradient_boosting", {"n_estimators": 3}), None)]
    models = T.fit_all(rows, wanted)
    groups = T.score_histograms(rows, {i: (m, k) for i, (m, (_, k)) in enumerate(zip(models, wanted))})
    seen = [rows if k is None else rows.filter(F.col("fold") == k) for _, k in wanted]
    # A number that no row has gets no area and no hits.
    *found, none = T.metrics_by(groups, 4)
    for got, model, part in zip(found, models, seen):
        assert got == pytest.approx(T.metrics(score_with_ml(model, part)), abs=1e-9)
    assert np.isnan(none["roc_auc"]) and none["recall"] == none["f1"] == 0


def test_blocks_are_dealt_evenly(spark, rows, monkeypatch):
    """The longest part decides the time of a pass: parts differ by a block at most."""
    monkeypatch.setattr(G, "BLOCK_ROWS", 50)
    most = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(most)
    spark.conf.set(most, "50")
    try:
        many = spark.createDataFrame(rows.rdd.repartition(6), rows.schema)
        layout = G.Layout.of([[np.array([0.0])] * 5], 1)
        blocks = G.binned_blocks(many, layout).rdd.map(G.dealt).collect()
    finally:
        spark.conf.set(most, before)
    assert sum(row[1] for _, row in blocks) == 1500
    parts = np.bincount([at % 4 for at, _ in blocks], minlength=4)
    assert len(blocks) > 20 and parts.max() - parts.min() <= 2
