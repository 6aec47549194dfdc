"""Train, cross-validate, tune and compare classifiers.

Input is a matrix (key, label, features array<double>) from the preprocessor. A fit
reads its matrix many times, so it is persisted for the duration of the fits.
"""

from __future__ import annotations

import itertools
import logging
import math
import random
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayflow.operators.evaluation import classification_metrics, confusion, roc_auc, roc_auc_by
from stayflow.operators.logistic import Problem, fit_many, held_out_scores
from stayflow.operators.scoring import LogisticModel, score_with_ml
from stayflow.operators.splits import stratified_folds
from stayflow.operators.trees import TreeModel, TreeProblem, grow_many

log = logging.getLogger(__name__)
METRICS = ["roc_auc", "precision", "recall", "f1"]
MAX_OVERFIT_GAP = 0.05


@dataclass(frozen=True)
class Candidate:
    """A model to try: type logistic_regression, decision_tree, random_forest or gradient_boosting."""

    name: str
    type: str
    params: Mapping[str, Any] = field(default_factory=dict)
    enabled: bool = True


DEFAULT_CANDIDATE = Candidate(
    "logistic_regression", "logistic_regression", {"C": 1.0, "penalty": "l1", "max_iter": 1000}
)
BASELINES = [
    Candidate(
        "Logistic Regression",
        "logistic_regression",
        {"C": 1.0, "penalty": "l2", "max_iter": 1000, "class_weight": "balanced"},
    ),
    Candidate("Decision Tree", "decision_tree", {"max_depth": 6, "class_weight": "balanced"}),
    Candidate(
        "Random Forest",
        "random_forest",
        {"n_estimators": 100, "max_depth": 8, "class_weight": "balanced"},
    ),
    Candidate(
        "Gradient Boosting",
        "gradient_boosting",
        {"n_estimators": 100, "max_depth": 4, "learning_rate": 0.1},
    ),
]


@contextmanager
def kept(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Persist for the duration of several passes; lost blocks are recomputed."""
    held = [f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames]
    try:
        yield tuple(held)
    finally:
        for f in held:
            f.unpersist()


def side_by_side(spark: SparkSession, job, places: Sequence, at_once: int = 4) -> list:
    """Results of independent fits, a few of them at a time: small fits leave executors idle."""
    with ThreadPool(at_once) as pool:
        return pool.map(inheritable_thread_target(spark)(job), list(places))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, rows, weight = n / (2 n_c)); positive_weight = negatives per positive."""
    sizes = df.agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
    )
    n0, n1 = F.col("n0"), F.col("n1")
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("label"),
                n.alias("rows"),
                F.try_divide((n0 + n1).cast("double"), 2 * n).alias("weight"),
                F.try_divide(n0.cast("double"), n1).alias("positive_weight"),
            )
            for c, n in ((0, n0), (1, n1))
        ]
    )
    return sizes.select(F.inline(lines))


def balanced_weight(df: DataFrame, label: str = "label") -> Column:
    weights = {r["label"]: r["weight"] for r in class_weights(df, label).collect()}
    return F.when(F.col(label) == 1, F.lit(weights[1])).otherwise(F.lit(weights[0]))


def regularisation(c: float, rows: int) -> float:
    """MLlib's penalty on the mean loss for an inverse strength ``c`` on the summed loss."""
    return 0.0 if c == float("inf") else 1.0 / (c * max(rows, 1))


#: Settings of each kind that have a counterpart; any other is refused.
SETTINGS = {
    "logistic_regression": {"C", "penalty", "l1_ratio", "max_iter"},
    "decision_tree": {"max_depth", "min_samples_leaf", "random_state"},
    "random_forest": {
        "n_estimators", "max_depth", "min_samples_leaf", "max_features", "max_samples", "random_state",
    },
    "gradient_boosting": {
        "n_estimators", "max_depth", "learning_rate", "subsample", "min_samples_leaf", "max_features",
        "scale_pos_weight", "random_state",
    },
}


def check_settings(candidate: Candidate) -> None:
    unknown = set(candidate.params) - SETTINGS.get(candidate.type, set()) - {"class_weight"}
    if candidate.type in SETTINGS and unknown:
        raise ValueError(f"{candidate.type} takes no {', '.join(sorted(unknown))}")


def feature_subset(value) -> str:
    """Features tried at a split: all for None, a named rule, or a share or number as text."""
    return "all" if value is None else str(value)


def estimator(
    candidate: Candidate, rows: int, balance: tuple[float, float] = (1.0, 1.0), left_out: int | None = None
) -> Problem | TreeProblem:
    """What the trainers solve for a candidate on ``rows`` rows; ``balance`` weighs the two classes."""
    check_settings(candidate)
    p = dict(candidate.params)
    if candidate.type == "logistic_regression":
        penalty = str(p.get("penalty") or "none").lower()
        strength = float("inf") if penalty == "none" else float(p.get("C", 1.0))
        share = float(p.get("l1_ratio", 1.0 if penalty == "l1" else 0.0))
        whole = regularisation(strength, rows)
        return Problem(whole * share, whole * (1 - share), 0, left_out)
    positive = float(p.get("scale_pos_weight", 1.0))
    common = {
        "least": int(p.get("min_samples_leaf", 1)),
        "weights": (balance[0], balance[1] * positive),
        "seed": p.get("random_state", 42),
        "left_out": left_out,
    }
    if candidate.type == "decision_tree":
        return TreeProblem(candidate.type, 1, int(p.get("max_depth", 5)), **common)
    if candidate.type == "random_forest":
        return TreeProblem(
            candidate.type,
            int(p.get("n_estimators", 100)),
            int(p.get("max_depth", 8)),
            features=feature_subset(p.get("max_features", "sqrt")),
            sampled=float(p.get("max_samples", 1.0)),
            **common,
        )
    if candidate.type == "gradient_boosting":
        return TreeProblem(
            candidate.type,
            int(p.get("n_estimators", 100)),
            int(p.get("max_depth", 4)),
            features=feature_subset(p.get("max_features")),
            sampled=float(p.get("subsample", 1.0)),
            step=float(p.get("learning_rate", 0.1)),
            **common,
        )
    raise ValueError(f"no such kind of model: {candidate.type}")


def fit_all(rows: DataFrame, wanted: Sequence[tuple[Candidate, int | None]]) -> list[LogisticModel | TreeModel]:
    """Fit candidates on (label, features, fold), each without the fold beside it (None: on all rows).

    The logistic models share their passes over the rows, and so do the trees of all kinds.
    """
    sizes = {(r["fold"], int(r["label"])): r["count"] for r in rows.groupBy("fold", "label").count().collect()}

    def counts(left_out: int | None) -> tuple[int, int]:
        return tuple(sum(n for (k, y), n in sizes.items() if y == label and k != left_out) for label in (0, 1))

    problems, weights = [], []
    for c, left_out in wanted:
        n = counts(left_out)
        balanced = c.params.get("class_weight") == "balanced"
        balance = tuple(sum(n) / (2 * max(m, 1)) for m in n) if balanced else (1.0, 1.0)
        problem = estimator(c, sum(n), balance, left_out)
        if isinstance(problem, Problem):
            if balance not in weights:
                weights.append(balance)
            problem = replace(problem, weighting=weights.index(balance))
        problems.append((problem, int(c.params.get("max_iter", 100))))
    found: dict[int, Any] = {}
    linear = [i for i, (p, _) in enumerate(problems) if isinstance(p, Problem)]
    trees = [i for i, (p, _) in enumerate(problems) if isinstance(p, TreeProblem)]
    if linear:
        by_label = [F.when(F.col("label") == 1, F.lit(w[1])).otherwise(F.lit(w[0])) for w in weights]
        ready = rows.select(F.col("label").cast("double").alias("label"), "features", F.array(*by_label).alias("weights"), "fold")
        fits = fit_many(ready, [problems[i][0] for i in linear], max(problems[i][1] for i in linear))
        found |= {i: LogisticModel(f.intercept, Vectors.dense(f.coefficients)) for i, f in zip(linear, fits)}
    if trees:
        found |= dict(zip(trees, grow_many(rows, [problems[i][0] for i in trees], sum(sizes.values()))))
    return [found[i] for i in range(len(wanted))]


def fit(candidate: Candidate, train: DataFrame) -> LogisticModel | TreeModel:
    """Fit one candidate on (label, features)."""
    return fit_all(train.select("label", "features", F.lit(0).alias("fold")), [(candidate, None)])[0]


def metrics(scored: DataFrame, label: str = "label", score: str = "p") -> dict[str, float]:
    """AUC, and precision, recall, F1 at 0.5."""
    area = roc_auc(scored, label, score).select("roc_auc").scalar()
    counts = classification_metrics(confusion(scored, 0.5, label, score))
    row = counts.withColumn("roc_auc", area).first()
    return {m: float(row[m]) if row[m] is not None else float("nan") for m in METRICS}


def score_histograms(rows: DataFrame, models: Mapping[int, tuple[Any, int | None]]) -> DataFrame:
    """(model, score, pos, neg) of many models from one pass over (label, features, fold): each scores the
    fold beside it (None: all rows). Equal scores of a block are merged; NaN stands at -infinity."""
    sent = rows.sparkSession.sparkContext.broadcast(dict(models))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            label, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold"))
            for number, (model, k) in sent.value.items():
                here = slice(None) if k is None else np.flatnonzero(fold == k)
                scores, positive = model.scores(x[here]), label[here] == 1
                value, at = np.unique(np.where(np.isnan(scores), -np.inf, scores), return_inverse=True)
                pos = np.bincount(at, positive, len(value)).astype(np.int64)
                neg = np.bincount(at, minlength=len(value)) - pos
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(value), number, np.int32)), pa.array(value), pa.array(pos), pa.array(neg)],
                    ["model", "score", "pos", "neg"],
                )

    return rows.select("features", "label", "fold").mapInArrow(scored, "model int, score double, pos long, neg long")


def metrics_by(groups: DataFrame, models: int) -> list[dict[str, float]]:
    """``metrics`` of the models numbered from 0, from their score histograms."""
    found = classification_metrics(roc_auc_by(groups, "model", 0.5)).collect()
    none = {m: 0.0 for m in METRICS} | {"roc_auc": float("nan")}
    by_model = {r["model"]: {m: float(r[m]) if r[m] is not None else float("nan") for m in METRICS} for r in found}
    return [by_model.get(i, none) for i in range(models)]


@dataclass
class Trained:
    candidate: Candidate
    model: Any
    metrics: dict[str, float]


def train_candidates(
    train: DataFrame, val: DataFrame, candidates: Sequence[Candidate], strict: bool = False
) -> list[Trained]:
    """Fit every enabled candidate and measure it on validation; one that cannot be built is
    skipped unless strict, and none at all is an error."""
    chosen = []
    for c in candidates:
        if not c.enabled:
            continue
        try:
            estimator(c, 1)
        except ValueError:
            # Only a candidate that cannot be built is skipped; a failing job is an error.
            if strict:
                raise
            log.exception("candidate %s cannot be built and was skipped", c.name)
            continue
        chosen.append(c)
    if not chosen:
        raise ValueError("No enabled candidate could be trained")
    with kept(train.select("label", "features", F.lit(0).alias("fold"))) as (rows,):
        models = fit_all(rows, [(c, None) for c in chosen])
    groups = score_histograms(val.withColumn("fold", F.lit(0)), {i: (m, None) for i, m in enumerate(models)})
    found = metrics_by(groups, len(models))
    return [Trained(c, m, f) for c, m, f in zip(chosen, models, found)]


def candidate_table(spark: SparkSession, results: Sequence[Trained], metric: str = "roc_auc") -> DataFrame:
    """(candidate, type, metrics..., selected): the first best by the metric is selected."""
    best = max(results, key=lambda r: r.metrics[metric])
    return spark.createDataFrame(
        [
            (r.candidate.name, r.candidate.type, *[r.metrics[m] for m in METRICS], r is best)
            for r in results
        ],
        "candidate string, type string, roc_auc double, precision double, recall double, "
        "f1 double, selected boolean",
    )


# ---- cross-validation -----------------------------------------------------


def cross_validate(
    matrix: DataFrame, candidate: Candidate, key: str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """(metric, mean, std): stratified folds, population deviation over the folds."""
    spark = matrix.sparkSession
    with kept(stratified_folds(matrix, key, "label", folds, seed)) as (rows,):
        models = fit_all(rows, [(candidate, k) for k in range(folds)])
        found = metrics_by(score_histograms(rows, {k: (m, k) for k, m in enumerate(models)}), folds)
    return _spread(spark, found)


def _spread(spark: SparkSession, found: Sequence[Mapping[str, float]]) -> DataFrame:
    """(metric, mean, std) over the folds."""
    values = [(m, float(f[m])) for f in found for m in METRICS]
    return (
        spark.createDataFrame(values, "metric string, value double")
        .groupBy("metric")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    )


# ---- tuning ---------------------------------------------------------------

LR_SPACE = {
    "C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0],
    "penalty": ["l1", "l2"],
    "class_weight": [None, "balanced"],
}


def random_draws(space: Mapping[str, Sequence], n: int, seed: int = 42) -> list[dict[str, Any]]:
    """n distinct settings of the space (all of it when it is smaller)."""
    every = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return random.Random(seed).sample(every, min(n, len(every)))


# Strengths to try around the best one, as multiples of it, and those around an end
# of the range, beyond which the middle of the grid does not go.
AROUND = (0.1, 0.5, 1.0, 2.0, 10.0)
AROUND_END = (0.1, 0.5, 1.0, 5.0, 10.0)
LEAST_MIDDLE, MOST_MIDDLE = 0.01, 100.0


def refined_strengths(best: float) -> list[float]:
    """Inverse strengths to try around the best one found."""
    middle = min(max(best, LEAST_MIDDLE), MOST_MIDDLE)
    factors = AROUND_END if middle in (LEAST_MIDDLE, MOST_MIDDLE) else AROUND
    return [round(middle * f, 12) for f in factors]


def grid_search_lr(
    matrix: DataFrame,
    settings: Sequence[Mapping[str, Any]],
    key: str,
    folds: int = 5,
    seed: int = 42,
    max_iter: int = 1000,
) -> DataFrame:
    """(setting, c, penalty, class_weight, cv_auc), best first.

    All settings are fitted on all folds at once (``logistic.fit_many``): one pass over the rows
    per iteration. A setting's score is the mean of the exact areas on its folds.
    """
    spark = matrix.sparkSession
    folded = stratified_folds(matrix, key, "label", folds, seed).select(
        F.col("label").cast("double").alias("label"),
        "features",
        F.array(F.lit(1.0), balanced_weight(matrix)).alias("weights"),
        "fold",
    )
    with kept(folded) as (rows,):
        inside = rows.count() * (folds - 1) // folds
        problems = []
        for s in settings:
            strength = regularisation(s["C"], inside)
            lasso, weighting = s["penalty"] == "l1", int(s["class_weight"] == "balanced")
            penalties = (strength, 0.0) if lasso else (0.0, strength)
            problems += [Problem(*penalties, weighting, k) for k in range(folds)]
        fitted = fit_many(rows, problems, max_iter)
        areas = roc_auc_by(held_out_scores(rows, problems, fitted), "problem")
        setting = F.floor(F.col("problem") / folds).cast("int").alias("setting")
        found = {r["setting"]: r["cv_auc"] for r in areas.groupBy(setting).agg(F.avg("roc_auc").alias("cv_auc")).collect()}
    lines = [
        (i, float(s["C"]), s["penalty"], s["class_weight"] or "none", found.get(i))
        for i, s in enumerate(settings)
    ]
    return spark.createDataFrame(
        lines, "setting int, c double, penalty string, class_weight string, cv_auc double"
    ).orderBy(F.desc("cv_auc"), "setting")


def tune_lr(
    matrix: DataFrame, key: str, draws: int = 30, folds: int = 5, seed: int = 42, max_iter: int = 1000
) -> DataFrame:
    """Random search, then a grid around the best strength; (stage, setting, ..., cv_auc)."""
    with kept(matrix) as (rows,):
        broad = grid_search_lr(rows, random_draws(LR_SPACE, draws, seed), key, folds, seed, max_iter)
        best = broad.first()
        weight = None if best["class_weight"] == "none" else best["class_weight"]
        fine = [
            {"C": c, "penalty": best["penalty"], "class_weight": weight}
            for c in refined_strengths(best["c"])
        ]
        narrow = grid_search_lr(rows, fine, key, folds, seed, max_iter)
    return broad.select(F.lit("random").alias("stage"), "*").unionByName(
        narrow.select(F.lit("refined").alias("stage"), "*")
    )


# ---- comparison and ensembles ---------------------------------------------


def compare_models(
    train: DataFrame,
    val: DataFrame,
    candidates: Sequence[Candidate],
    key: str,
    baseline_auc: float = 0.828,
    folds: int = 5,
) -> DataFrame:
    """(model, cv_auc, cv_auc_std, cv_recall, cv_precision, cv_f1, val_auc, train_auc, overfit_gap,
    gain_points), best CV first."""
    spark = train.sparkSession
    places = [(i, k) for i in range(len(candidates)) for k in [*range(folds), None]]
    with kept(stratified_folds(train, key, "label", folds), val) as (rows, val_rows):
        models = fit_all(rows, [(candidates[i], k) for i, k in places])
        whole = {len(places) + i: (models[at], None) for at, (i, k) in enumerate(places) if k is None}
        groups = score_histograms(rows, {at: (models[at], k) for at, (_, k) in enumerate(places)})
        groups = groups.unionByName(score_histograms(val_rows.withColumn("fold", F.lit(0)), whole))
        found = metrics_by(groups, len(places) + len(candidates))
    on_train = dict(zip(places, found))
    lines = []
    for i, c in enumerate(candidates):
        cv = {r["metric"]: r for r in _spread(spark, [on_train[i, k] for k in range(folds)]).collect()}
        scores = [cv[m]["mean"] for m in ("recall", "precision", "f1")]
        # An area without rows of both classes is missing.
        sides = [f["roc_auc"] for f in (found[len(places) + i], on_train[i, None])]
        sides = [None if math.isnan(a) else a for a in sides]
        lines.append((c.name, cv["roc_auc"]["mean"], cv["roc_auc"]["std"], *scores, *sides))
    table = spark.createDataFrame(
        lines,
        "model string, cv_auc double, cv_auc_std double, cv_recall double, cv_precision double, "
        "cv_f1 double, val_auc double, train_auc double",
    )
    return rank_models(table, baseline_auc)


def rank_models(table: DataFrame, baseline_auc: float = 0.828) -> DataFrame:
    return table.withColumns(
        {
            "overfit_gap": F.col("train_auc") - F.col("val_auc"),
            "gain_points": (F.col("cv_auc") - baseline_auc) * 100,
        }
    ).orderBy(F.desc("cv_auc"), "model")


def best_safe_model(ranked: DataFrame) -> DataFrame:
    """Best CV score among the models without overfit, or among all when none is safe."""
    safe = F.col("overfit_gap") < MAX_OVERFIT_GAP
    return ranked.orderBy(safe.desc(), F.desc("cv_auc"), "model").limit(1)


def top_settings(searched: DataFrame, k: int = 5) -> DataFrame:
    """The k best settings of a search, ranked from 1; equal scores by their number."""
    line = Window.orderBy(F.desc("cv_auc"), "setting")
    # A search has as many rows as settings.
    return searched.withColumn("rank", F.row_number().over(line)).filter(F.col("rank") <= k)


def soft_voting_pays(ranked: DataFrame, least: int = 2) -> bool:
    """Whether enough models beat the baseline for an ensemble."""
    return ranked.filter(F.col("gain_points") > 0).count() >= least


def base_scores(models: Mapping[str, Any], matrix: DataFrame) -> DataFrame:
    """One score column per model, side by side on the same rows."""
    for name, model in models.items():
        matrix = score_with_ml(model, matrix, name)
    return matrix


def stack(
    train: DataFrame,
    val: DataFrame,
    bases: Sequence[Candidate],
    key: str,
    folds: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Stacked scores of the validation rows: (key, label, base scores..., p).

    The final logistic regression learns from out-of-fold base scores: each fold is
    scored by models that did not see it, and the folds are put back together by union.
    """
    names = [f"p{i}" for i in range(len(bases))]
    final = replace(
        DEFAULT_CANDIDATE, params={"C": 1.0, "penalty": "l2", "max_iter": 1000, "class_weight": "balanced"}
    )
    with kept(stratified_folds(train, key, "label", folds, seed)) as (rows,):
        places = [(k, i) for k in [*range(folds), None] for i in range(len(bases))]
        fitted = dict(zip(places, fit_all(rows, [(bases[i], k) for k, i in places])))
        parts = [
            base_scores({n: fitted[k, i] for i, n in enumerate(names)}, rows.filter(F.col("fold") == k))
            for k in range(folds)
        ]
        out_of_fold = parts[0]
        for part in parts[1:]:
            out_of_fold = out_of_fold.unionByName(part)
        # The weights, the count and the fit read the out-of-fold scores: they are kept too.
        with kept(out_of_fold.select("label", F.array(*names).alias("features"))) as (meta,):
            combiner = fit(final, meta)
        models = {n: fitted[None, i] for i, n in enumerate(names)}
    scored = base_scores(models, val)
    return score_with_ml(
        combiner, scored.select(key, "label", *names, F.array(*names).alias("features"))
    ).drop("features")


def retrain_and_test(
    train: DataFrame, val: DataFrame, test: DataFrame, candidate: Candidate
) -> dict[str, float]:
    """Fit on train and validation rows together, measure once on test."""
    both = train.unionByName(val)
    with kept(both) as (rows,):
        return metrics(score_with_ml(fit(candidate, rows), test))
