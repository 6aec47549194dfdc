"""Quantiles, running totals, splits and samples against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.operators import quantiles as Q
from stayflow.operators import splits as Sp
from stayflow.operators.ordering import running_totals
from stayflow.operators.splits import hash_split, seeded_sample, stratified_folds, stratified_split
from stayflow.params import SplitParams

PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def frame(spark, values, group=None):
    rows = [(g, float(v)) for g, v in zip(group or ["a"] * len(values), values)]
    return spark.createDataFrame(rows, "g string, x double").repartition(5)


def samples():
    rng = np.random.default_rng(7)
    return {
        "one": [3.0],
        "two": [1.0, 2.0],
        "constant": [4.0] * 50,
        "hot value": [0.0] * 700 + list(rng.normal(size=300)),
        "normal": list(rng.normal(size=3001)),
        "heavy tail": list(rng.pareto(0.7, size=2000) * 1e6),
        "large": list(rng.normal(size=60_001)),
        "large with ties": list(np.round(rng.normal(size=50_000), 1)),
    }


@pytest.mark.parametrize("name", samples())
def test_quantiles_match_numpy(spark, name):
    values = samples()[name]
    got = {r["prob"]: r["value"] for r in Q.exact_quantiles(frame(spark, values), ["x"], PROBS).collect()}
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_quantiles_by_group_with_missing(spark):
    rng = np.random.default_rng(1)
    data = [(["a", "b", None][i % 3], None if i % 7 == 0 else float(v)) for i, v in enumerate(rng.normal(size=900))]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r["g"]: r["value"] for r in Q.exact_quantiles(df, ["x"], [0.5], ["g"]).collect()}
    assert set(got) == {"a", "b"}
    for g in got:
        assert got[g] == pytest.approx(np.median([x for k, x in data if k == g and x is not None]))


def test_quantiles_narrowing_and_many_groups(spark, monkeypatch):
    rng = np.random.default_rng(3)
    values = list(rng.normal(size=20_000))
    monkeypatch.setattr(Q, "BRACKET_ROWS", 4)
    monkeypatch.setattr(Q, "SMALL_ROWS", 10_000)
    got = {r["prob"]: r["value"] for r in Q.exact_quantiles(frame(spark, values), ["x"], [0.25, 0.5]).collect()}
    assert got[0.5] == pytest.approx(np.median(values)) and got[0.25] == pytest.approx(np.quantile(values, 0.25))
    monkeypatch.setattr(Q, "MAX_GROUPS", 2)
    monkeypatch.setattr(Q, "SMALL_ROWS", 20_000)
    groups = [str(i % 40) for i in range(len(values))]
    rows = Q.exact_quantiles(frame(spark, values, groups), ["x"], [0.5], ["g"]).collect()
    assert len(rows) == 40
    for r in rows:
        assert r["value"] == pytest.approx(np.median(values[int(r["g"]) :: 40]))


def test_quantiles_empty(spark):
    assert Q.exact_quantiles(frame(spark, []), ["x"], [0.5]).collect() == []


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rng = np.random.default_rng(5)
    values = sorted(set(rng.normal(size=700)), reverse=descending)
    df = spark.createDataFrame([(float(v), i % 5) for i, v in enumerate(values)], "x double, w long").repartition(4)
    order = F.desc("x") if descending else F.asc("x")
    got = [r["total"] for r in running_totals(df, "x", {"total": F.col("w")}, descending).orderBy(order).collect()]
    assert got == list(np.cumsum([i % 5 for i in range(len(values))]))


def place(key, seed=42):
    return hashlib.md5(f"{key}|{seed}".encode()).hexdigest()


def labelled(spark, n):
    return spark.range(n).select("id", (F.col("id") % 3 == 0).cast("int").alias("y")).repartition(3)


@pytest.mark.parametrize("n, ranked", [(1, 100), (2, 100), (5, 100), (7, 100), (1000, 100), (30_000, 2), (1000, 0)])
def test_split_is_exact(spark, monkeypatch, n, ranked):
    monkeypatch.setattr(Sp, "RANKED_ROWS", ranked)
    got = {r["id"]: r["split"] for r in stratified_split(labelled(spark, n), "id", "y").collect()}
    assert len(got) == n
    for label in (0, 1):
        keys = sorted((k for k in range(n) if (k % 3 == 0) == label), key=place)
        train, val = len(keys) * 6 // 10, len(keys) * 8 // 10
        expected = ["train"] * train + ["val"] * (val - train) + ["test"] * (len(keys) - val)
        assert [got[k] for k in keys] == expected


def test_hash_split_shares(spark):
    counts = Counter(r["split"] for r in hash_split(labelled(spark, 5000), "id").collect())
    assert abs(counts["train"] / 5000 - 0.6) < 0.05 and abs(counts["val"] / 5000 - 0.2) < 0.05


def test_other_shares(spark):
    params = SplitParams(test_share=0.25, val_share=0.25, seed=1)
    counts = Counter(r["split"] for r in stratified_split(labelled(spark, 400), "id", "y", params).collect())
    assert 198 <= counts["train"] <= 201


def test_split_keeps_equal_keys_together(spark):
    rows = spark.createDataFrame([(i if i > 300 else 0, 1) for i in range(1000)], "id long, y int")
    got = stratified_split(rows, "id", "y").collect()
    assert len(got) == 1000 and len({r["split"] for r in got if r["id"] == 0}) == 1


@pytest.mark.parametrize("ranked", [0, 100])
def test_folds(spark, monkeypatch, ranked):
    monkeypatch.setattr(Sp, "RANKED_ROWS", ranked)
    rows = stratified_folds(labelled(spark, 600), "id", "y").collect()
    assert len(rows) == 600
    for label in (0, 1):
        keys = sorted((r["id"] for r in rows if r["y"] == label), key=place)
        folds = {r["id"]: r["fold"] for r in rows}
        assert [folds[k] for k in keys] == [i % 5 for i in range(len(keys))]


def test_sample_takes_first_in_hash_order(spark):
    df = spark.range(5000).select(F.lit("c").alias("column"), "id").withColumn("h", F.md5(F.col("id").cast("string").cast("binary")))
    got = {r["id"] for r in seeded_sample(df, "column", {"c": 5000}, 300, ["h", "id"]).collect()}
    order = sorted(range(5000), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())
    assert got == set(order[:300])
