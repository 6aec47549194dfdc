"""Logistic fits of large tables start from a sample."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.operators import logistic as L


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(1500, 5))
    x[:, 3] = np.round(x[:, 3])
    y = (x[:, 0] * x[:, 1] + x[:, 3] + r.normal(size=1500) > 0.6).astype(int)
    lines = [(i, int(a), [float(v) for v in b], i % 3) for i, (a, b) in enumerate(zip(y, x))]
    return spark.createDataFrame(lines, "id long, label int, features array<double>, fold int").coalesce(2).persist()


def test_large_tables_start_from_a_sample(rows, monkeypatch):
    ready = rows.select(F.col("label").cast("double").alias("label"), "features", F.array(F.lit(1.0)).alias("weights"), "fold").persist()
    problems = [L.Problem(l1, l2, 0, k) for l1, l2 in ((0.0, 0.001), (0.01, 0.0)) for k in (0, None)]
    want = L.fit_many(ready, problems)
    grams, measured = [], L.measured

    def seen(r, p, b, curved=None):
        grams.append((r.count(), len(curved)))
        return measured(r, p, b, curved)

    monkeypatch.setattr(L, "measured", seen)
    monkeypatch.setattr(L, "START_ROWS", 500)
    got = L.fit_many(ready, problems)
    for a, b in zip(want, got):
        assert b.converged and b.coefficients == pytest.approx(a.coefficients, abs=1e-4)
    whole = [c for n, c in grams if n == 1500]
    # Passes over all rows make hardly a Gram matrix.
    assert sum(whole) < len(problems) * len(whole) / 2 and whole[0] == 0
