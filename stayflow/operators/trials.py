"""Search the settings of tree models with a table of trials that survives an interruption.

A trial is a kind of model with its settings. Its scores are appended to the table as soon as it has
run, so a search that was stopped goes on where it was, and a wider search reuses what has run.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.operators.evaluation import roc_auc
from stayflow.operators.preprocess import fit_categories, ordinal_encode
from stayflow.operators.scoring import score_with_ml
from stayflow.operators.splits import stratified_folds
from stayflow.operators.training import Candidate, class_weights, fit, kept, random_draws, side_by_side

# The settings tried, as far as MLlib has them. A depth of 30 is its greatest.
FOREST_SPACE: dict[str, list[Any]] = {
    "n_estimators": [200, 300, 500, 700],
    "max_depth": [6, 8, 10, 12, 30],
    "min_samples_leaf": [3, 5, 8, 10],
    "max_features": ["sqrt", "log2", 0.3, 0.5],
    "max_samples": [0.7, 0.8, 0.9, 1.0],
    "class_weight": ["balanced"],
}
BOOSTING_SPACE: dict[str, list[Any]] = {
    "n_estimators": [100, 200, 300, 500],
    "max_depth": [3, 4, 5, 6],
    "learning_rate": [0.01, 0.03, 0.05, 0.1],
    "subsample": [0.7, 0.8, 0.9, 1.0],
    "min_samples_leaf": [5, 8, 10],
    "max_features": ["sqrt", 0.3, 0.5],
}
SPACES = {"random_forest": FOREST_SPACE, "gradient_boosting": BOOSTING_SPACE}
TRIALS = "type string, settings string, folds int, seed int, fold_aucs array<double>, cv_auc double"


def binned(values: Column, marks: Sequence[float]) -> Column:
    """How many of the ascending marks lie below a value; a missing value gets -1."""
    below = F.size(F.filter(F.array(*[F.lit(float(m)) for m in marks]), lambda m: m < values)) if marks else F.lit(0)
    return F.when(values.isNull(), -1).otherwise(below).cast("double")


def tree_matrix(
    rows: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    keep: Sequence[str],
    fit_on: Column,
    bins: int = 32,
) -> DataFrame:
    """(keep..., features): numbers as quantile bins, texts as their place among the sorted values.

    Marks and categories come from the rows where ``fit_on`` holds; unknown and missing values get
    -1. A split of a tree only asks on which side of a mark a value lies, so bins are enough for it.
    """
    train = rows.filter(fit_on)
    marks: dict[str, list[float]] = {c: [] for c in numeric}
    if numeric:
        # Bins need not be exactly equal: one approximate pass for all columns.
        shares = [i / bins for i in range(1, bins)]
        wide = train.select(*[C.number(train, c).alias(c) for c in numeric])
        marks = dict(zip(numeric, wide.approxQuantile(list(numeric), shares, 1 / (10 * bins))))
    _, categories = fit_categories(train, list(categorical))
    places = ordinal_encode(rows, categories)
    features = [binned(C.number(rows, c), sorted(set(marks[c]))) for c in numeric]
    features += [places[c].cast("double") for c in categorical]
    return rows.select(*keep, F.array(*features).alias("features"))


def draw_trials(
    spaces: Mapping[str, Mapping[str, Sequence]], draws: int, seed: int = 42, **settings: Any
) -> list[Candidate]:
    """``draws`` distinct settings of each kind from its space (``SPACES`` has the whole ones);
    ``settings`` hold for boosting."""
    out = []
    for kind, space in spaces.items():
        for drawn in random_draws(space, draws, seed):
            own = settings if kind == "gradient_boosting" else {}
            out.append(Candidate(kind, kind, {**drawn, **own}))
    return out


def settings_text(settings: Mapping[str, Any]) -> str:
    return json.dumps(dict(settings), sort_keys=True)


def trial_table(spark: SparkSession, folder: str) -> DataFrame:
    """What has run so far; empty where the folder does not exist yet."""
    try:
        # Each trial has a folder of its own, so searches side by side do not meet.
        return spark.read.schema(TRIALS).parquet(folder).drop("trial")
    except AnalysisException:
        return spark.createDataFrame([], TRIALS)


def run_trials(
    matrix: DataFrame,
    trials: Sequence[Candidate],
    folder: str,
    key: str,
    folds: int = 5,
    seed: int = 42,
    at_once: int = 4,
) -> DataFrame:
    """Cross-validate the trials that are not in the table yet and return the table's rows for all of
    them, best first: (type, settings, folds, seed, fold_aucs, cv_auc).

    ``folder`` lies in shared storage. Each finished trial is one row, written as a whole or not at
    all. ``matrix`` is (key, label, features); with its folds it is kept for all fits. An
    error of one trial is raised once the others have run.
    """
    spark = matrix.sparkSession
    done = {
        (r["type"], r["settings"])
        for r in trial_table(spark, folder).filter((F.col("folds") == folds) & (F.col("seed") == seed)).collect()
    }
    wanted = {(t.type, settings_text(t.params)): t for t in trials}
    left = [t for name, t in wanted.items() if name not in done]
    if left:
        with kept(stratified_folds(matrix, key, "label", folds, seed)) as (rows,):
            side_by_side(spark, lambda t: _run(t, rows, folder, folds, seed), left, at_once)
    asked = spark.createDataFrame(list(wanted), "type string, settings string")
    found = trial_table(spark, folder).filter((F.col("folds") == folds) & (F.col("seed") == seed))
    return found.join(F.broadcast(asked), ["type", "settings"]).orderBy(F.desc("cv_auc"), "type", "settings")


def _run(trial: Candidate, rows: DataFrame, folder: str, folds: int, seed: int) -> None:
    """Fit and score a trial on each fold, and append its line."""
    areas = []
    for k in range(folds):
        model = fit(trial, rows.filter(F.col("fold") != k))
        scored = score_with_ml(model, rows.filter(F.col("fold") == k))
        areas.append(roc_auc(scored, "label").first()["roc_auc"])
    line = (trial.type, settings_text(trial.params), folds, seed, areas, sum(areas) / folds)
    spark = rows.sparkSession
    name = hashlib.md5(repr(line[:4]).encode()).hexdigest()
    spark.createDataFrame([line], TRIALS).coalesce(1).write.mode("overwrite").parquet(f"{folder}/trial={name}")


def positive_weight(matrix: DataFrame) -> float:
    """Negatives for each positive: the weight that evens the classes in boosting."""
    return next(r["positive_weight"] for r in class_weights(matrix).collect() if r["label"] == 1)


def best_trials(table: DataFrame, k: int = 5) -> DataFrame:
    """The k best of each kind with their place: (type, place, settings, cv_auc)."""
    line = Window.partitionBy("type").orderBy(F.desc("cv_auc"), "settings")
    return (
        table.withColumn("place", F.row_number().over(line)).filter(F.col("place") <= k)
        .select("type", "place", "settings", "cv_auc")
    )
