"""Many logistic regressions from one aggregation per iteration.

The driver keeps the coefficients of all models. A pass over the rows returns for each of them the
weighted Gram matrix, the gradient and the loss, a few numbers whatever the rows; from these the
driver takes a Newton step, by feature-sign search where there is an L1 penalty. A step that does not
lower the objective is halved and measured again in the next pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Numbers in the products of one block of rows: bounds a task's memory.
BLOCK_NUMBERS = 4_000_000
TOLERANCE, GAIN = 1e-9, 1e-11
#: Up to so many Gram matrices are made one by one, more from shared products of the features.
FEW_GRAMS = 12
#: Larger tables start from coefficients and Gram matrices of a sample of about so many rows.
START_ROWS = 200_000
#: A step on a sample's Gram matrix must be so much shorter than the one before.
SHRINK = 0.3


@dataclass(frozen=True)
class Problem:
    """One model: penalties on the mean loss, the place of its row weights, and the fold it must not
    see (None: it sees all)."""

    l1: float = 0.0
    l2: float = 0.0
    weighting: int = 0
    left_out: int | None = None


@dataclass
class Fitted:
    intercept: float
    coefficients: np.ndarray
    passes: int
    converged: bool


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(features with a leading 1, labels, weights, folds) of some rows at a time."""
    n = batch.num_rows
    if not n:
        return
    flat = [batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for c in ("features", "weights")]
    x = np.concatenate([np.ones((n, 1)), flat[0]], axis=1)
    y = batch.column("label").to_numpy(zero_copy_only=False)
    fold = batch.column("fold").to_numpy(zero_copy_only=False)
    width = x.shape[1]
    step = max(16, BLOCK_NUMBERS // (width * (width + 1) // 2))
    for at in range(0, n, step):
        yield x[at : at + step], y[at : at + step], flat[1][at : at + step], fold[at : at + step]


def measured(
    rows: DataFrame, problems: Sequence[Problem], betas: np.ndarray, curved: Sequence[int] | None = None
) -> dict[int, np.ndarray]:
    """For each problem the sums of weight, loss, gradient and the upper half of the Gram matrix.

    ``betas`` has a row per problem, the intercept first. The driver gets one row per problem. The Gram
    matrix costs most; it stays 0 for problems that are not ``curved`` (None: all are).
    """
    spark = rows.sparkSession
    curved = list(range(len(problems)) if curved is None else curved)
    sent = spark.sparkContext.broadcast((list(problems), betas))
    width = betas.shape[1]
    upper = np.triu_indices(width)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        problems, betas = sent.value
        weighting = np.array([p.weighting for p in problems])
        left_out = np.array([-1 if p.left_out is None else p.left_out for p in problems])
        total = np.zeros((2 + width + len(upper[0]), len(problems)))
        for batch in batches:
            for x, y, weights, fold in blocks(batch):
                w = weights[:, weighting] * (fold[:, None] != left_out)
                margin = x @ betas.T
                p = 0.5 * (1 + np.tanh(margin / 2))
                total[0] += w.sum(axis=0)
                total[1] += (w * (np.logaddexp(0, margin) - y[:, None] * margin)).sum(axis=0)
                total[2 : 2 + width] += x.T @ (w * (p - y[:, None]))
                if len(curved) > FEW_GRAMS:
                    total[2 + width :, curved] += (x[:, upper[0]] * x[:, upper[1]]).T @ (w * p * (1 - p))[:, curved]
                for i in curved if len(curved) <= FEW_GRAMS else ():
                    total[2 + width :, i] += (x.T @ (x * (w[:, i] * p[:, i] * (1 - p[:, i]))[:, None]))[upper]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(problems)), pa.int32()), pa.array([c.tobytes() for c in total.T], pa.binary())],
            ["problem", "sums"],
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One running sum per problem, however many tasks there were.
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for problem, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                new = np.frombuffer(part.as_py())
                total[problem] = total[problem] + new if problem in total else new
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
            ["problem", "sums"],
        )

    schema = "problem int, sums binary"
    parts = min(len(problems), int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = rows.select("features", "label", "weights", "fold").mapInArrow(sums, schema)
    return {
        r["problem"]: np.frombuffer(bytes(r["sums"]))
        for r in found.repartition(parts, "problem").mapInArrow(added, schema).collect()
    }


def newton_steps(
    betas: np.ndarray, gradients: np.ndarray, grams: np.ndarray, l1: np.ndarray, l2: np.ndarray
) -> np.ndarray:
    """The least of each problem's quadratic model with its penalties; the intercept has none."""
    n, width = betas.shape
    penal = np.ones(width)
    penal[0] = 0
    hessian = grams + l2[:, None, None] * np.diag(penal)
    # A trace of ridge holds directions that the data leave open.
    hessian += 1e-12 * np.trace(hessian, axis1=1, axis2=2)[:, None, None] * np.eye(width)
    slope = gradients + l2[:, None] * penal * betas
    out = betas - np.linalg.solve(hessian, slope[:, :, None])[:, :, 0]
    for p in np.flatnonzero(l1 > 0):
        out[p] = lasso_least(betas[p], slope[p], hessian[p], l1[p])
    return out


def lasso_least(start: np.ndarray, slope: np.ndarray, hessian: np.ndarray, l1: float) -> np.ndarray:
    """The least of slope·(b - start) + (b - start)·H(b - start)/2 + l1 |b|, the first free.

    Feature-sign search: solve for the coefficients that are not 0, go to the best point on the way
    where one of them changes its sign; once none does, let the one in that lowers the sum most.
    """
    b, residual = start.copy(), slope
    sign = np.sign(b)
    held = b != 0
    held[0], sign[0] = True, 0
    for _ in range(20 * len(b)):
        at = np.flatnonzero(held)
        inside = hessian[np.ix_(at, at)]
        move = -np.linalg.solve(inside, residual[at] + l1 * sign[at])
        with np.errstate(divide="ignore", invalid="ignore"):
            turns = -b[at] / move
        turns = turns[(at > 0) & (turns > 0) & (turns < 1)]
        steps = np.append(turns, 1.0)
        ways = b[at] + steps[:, None] * move
        value = steps * (residual[at] @ move) + steps**2 / 2 * (move @ inside @ move)
        value = value + l1 * np.abs(ways[:, at > 0]).sum(axis=1)
        best = int(np.argmin(value))
        settled = not len(turns)
        way = ways[best]
        way[(at > 0) & (np.abs(way) <= 1e-14 * np.abs(steps[best] * move))] = 0.0
        b[at] = way
        residual = slope + hessian @ (b - start)
        held = b != 0
        held[0] = True
        sign = np.sign(b)
        sign[0] = 0
        if settled:
            over = np.where(held, -np.inf, np.abs(residual) - l1)
            j = int(np.argmax(over))
            if over[j] <= 1e-12 + 1e-10 * l1:
                break
            held[j], sign[j] = True, -np.sign(residual[j])
    return b if np.isfinite(b).all() else start


def fit_many(rows: DataFrame, problems: Sequence[Problem], max_iter: int = 100) -> list[Fitted]:
    """Fit every problem on (features array<double>, label, weights array<double>, fold).

    Each minimises its weighted mean log loss + l1 |b| + l2/2 |b|^2 with a free intercept, as MLlib
    does without standardisation. Rows are read once per iteration for all models together; models
    that have converged leave. The rows must not hold NULL. Without rows all coefficients are 0.

    A large table starts where a sample of it ends. Loss and gradient, which decide what the result is, come
    from all rows; the sample's Gram matrix only shapes the steps, as long as they shrink fast.
    """
    first = rows.select("features").first()
    width = 1 + (len(first["features"]) if first else 0)
    if first is None:
        return [Fitted(0.0, np.zeros(0), 0, False) for _ in problems]
    total = rows.count()
    if total <= 2 * START_ROWS:
        return _descend(rows, problems, np.zeros((len(problems), width)), None, max_iter)[0]
    some = rows.sample(fraction=START_ROWS / total, seed=42).persist()
    try:
        begun, grams = _descend(some, problems, np.zeros((len(problems), width)), None, max_iter)
    finally:
        some.unpersist()
    betas = np.array([[f.intercept, *f.coefficients] for f in begun])
    return _descend(rows, problems, betas, grams, max_iter)[0]


def _descend(
    rows: DataFrame, problems: Sequence[Problem], betas: np.ndarray, shapes: np.ndarray | None, max_iter: int
) -> tuple[list[Fitted], np.ndarray]:
    """The fits from ``betas`` on, and their last Gram matrices. ``shapes`` stand in for the rows' own."""
    betas, width = betas.copy(), betas.shape[1]
    l1, l2 = np.array([p.l1 for p in problems]), np.array([p.l2 for p in problems])
    tried = betas.copy()
    objective = np.full(len(problems), np.inf)
    passes, converged = np.zeros(len(problems), int), np.zeros(len(problems), bool)
    upper = np.triu_indices(width)
    active = np.arange(len(problems))
    own = np.full(len(problems), shapes is None)
    last = np.full(len(problems), np.inf)
    grams = np.zeros((len(problems), width, width)) if shapes is None else shapes.copy()
    for _ in range(max_iter):
        curved = np.flatnonzero(own[active])
        found = measured(rows, [problems[i] for i in active], tried[active], curved)
        sums = np.stack([found[i] for i in range(len(active))])
        passes[active] += 1
        weight = np.maximum(sums[:, 0], 1e-300)
        size = np.abs(tried[active, 1:])
        value = sums[:, 1] / weight + l1[active] * size.sum(axis=1) + l2[active] / 2 * (size**2).sum(axis=1)
        better = value <= objective[active] * (1 + 1e-14)
        gain = objective[active] - value
        moved = np.abs(tried[active] - betas[active]).max(axis=1)
        worse = active[~better]
        good, g = active[better], np.flatnonzero(better)
        started = np.isfinite(objective[good])
        betas[good], objective[good] = tried[good], value[g]
        small = started & ((moved[g] <= TOLERANCE) | (gain[g] <= GAIN * np.abs(value[g])))
        converged[good[small]] = True
        # Halving has come to an end where the step is nothing any more.
        converged[worse[moved[~better] <= TOLERANCE]] = True
        tried[worse] = (tried[worse] + betas[worse]) / 2
        for i, at in zip(active[curved], curved):
            if better[at]:
                grams[i][upper] = sums[at, 2 + width :] / weight[at]
                grams[i].T[upper] = grams[i][upper]
        go, g = good[~small], g[~small]
        if len(go):
            tried[go] = newton_steps(betas[go], sums[g, 2 : 2 + width] / weight[g, None], grams[go], l1[go], l2[go])
            # Where steps shrink slowly or fail, the rows' own Gram matrix shapes the next ones.
            length = np.abs(tried[go] - betas[go]).max(axis=1)
            own[go[length > SHRINK * last[go]]] = True
            last[go] = length
        own[worse] = True
        active = active[~converged[active]]
        if not len(active):
            break
    fits = [Fitted(float(b[0]), b[1:].copy(), int(n), bool(c)) for b, n, c in zip(betas, passes, converged)]
    return fits, grams


def held_out_scores(rows: DataFrame, problems: Sequence[Problem], fitted: Sequence[Fitted]) -> DataFrame:
    """(problem, score, pos, neg): each row scored by the models that did not see its fold. Equal
    scores of a block are merged."""
    spark = rows.sparkSession
    folds: dict[int, list[int]] = {}
    for i, p in enumerate(problems):
        if p.left_out is not None:
            folds.setdefault(p.left_out, []).append(i)
    betas = np.array([[f.intercept, *f.coefficients] for f in fitted])
    sent = spark.sparkContext.broadcast((folds, betas))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folds, betas = sent.value
        for batch in batches:
            for x, y, _, fold in blocks(batch):
                for k, chosen in folds.items():
                    here = fold == k
                    if not here.any():
                        continue
                    positive = y[here] == 1
                    scores = 0.5 * (1 + np.tanh(x[here] @ betas[chosen].T / 2))
                    for problem, score in zip(chosen, scores.T):
                        value, at = np.unique(score, return_inverse=True)
                        pos = np.bincount(at, positive, len(value)).astype(np.int64)
                        neg = np.bincount(at, minlength=len(value)) - pos
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(value), problem, np.int32)), pa.array(value), pa.array(pos), pa.array(neg)],
                            ["problem", "score", "pos", "neg"],
                        )

    return rows.select("features", "label", "weights", "fold").mapInArrow(
        scored, "problem int, score double, pos long, neg long"
    )
