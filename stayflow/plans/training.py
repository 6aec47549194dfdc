"""Training, cross-validation, tuning and ensembles over the processed accounts."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.operators import explain as X
from stayflow.operators import preprocess as P
from stayflow.operators import training as T
from stayflow.operators import trials as Tr
from stayflow.operators.sizing import materialize, scratch_folder
from stayflow.plans.features import engineered, fitted, set_columns
from stayflow.plans.registry import query

#: The compared models with their whole settings: logistic regression, tree, forest, boosting.
LOGISTIC, *TREES = T.BASELINES
KEY = "account_id"


def matrix(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    """(account_id, split, label, features), written once: every fit reads it many times."""
    fit = fitted(spark, sf_dir)
    pre = fit.preprocessor
    built = pre.transform(fit.rows, [KEY, "split", F.col("y").alias("label")])
    return materialize(built), pre.feature_names()


def set_matrices(spark, sf_dir) -> dict[str, DataFrame]:
    """(account_id, split, label, features) for each of the feature sets A, B and C."""
    rows, _ = engineered(spark, sf_dir)
    keep = [KEY, "split", F.col("y").alias("label")]
    out = {}
    for name in "ABC":
        numeric, text = set_columns(rows, name)
        pre = P.fit_preprocessor(rows.filter("split = 'train'"), numeric, text)
        out[name] = materialize(pre.transform(rows, keep))
    return out


def part(rows: DataFrame, split: str) -> DataFrame:
    return rows.filter(F.col("split") == split).drop("split")


@query("train_lr")
def train_lr(spark, sf_dir):
    """L1 logistic regression: importances of the fitted model, with its validation AUC."""
    rows, names = matrix(spark, sf_dir)
    result = T.train_candidates(part(rows, "train"), part(rows, "val"), [T.DEFAULT_CANDIDATE], strict=True)[0]
    table = X.model_importance(spark, result.model, names)
    return table.withColumn("val_roc_auc", F.lit(result.metrics["roc_auc"]))


@query("train_trees")
def train_trees(spark, sf_dir):
    rows, _ = matrix(spark, sf_dir)
    results = T.train_candidates(part(rows, "train"), part(rows, "val"), TREES, strict=True)
    return T.candidate_table(spark, results)


@query("candidate_selection")
def candidate_selection(spark, sf_dir):
    """All enabled candidates, one of a kind that cannot be built: it is skipped."""
    rows, _ = matrix(spark, sf_dir)
    candidates = [LOGISTIC, *TREES, T.Candidate("unknown", "no_such_type")]
    results = T.train_candidates(part(rows, "train"), part(rows, "val"), candidates)
    return T.candidate_table(spark, results)


@query("cv_metrics")
def cv_metrics(spark, sf_dir):
    rows, _ = matrix(spark, sf_dir)
    return T.cross_validate(part(rows, "train"), TREES[0], KEY)


@query("tune_lr")
def tune_lr(spark, sf_dir):
    rows, _ = matrix(spark, sf_dir)
    return T.tune_lr(part(rows, "train"), KEY)


@query("model_comparison")
def model_comparison(spark, sf_dir):
    rows, _ = matrix(spark, sf_dir)
    ranked = T.compare_models(part(rows, "train"), part(rows, "val"), [LOGISTIC, *TREES], KEY)
    best = T.best_safe_model(ranked).select("model").first()["model"]
    return ranked.withColumn("selected", F.col("model") == best)


@query("feature_set_comparison")
def feature_set_comparison(spark, sf_dir):
    """Logistic regression on each of the feature sets A, B and C, a tree on B."""
    tables = []
    for name, rows in set_matrices(spark, sf_dir).items():
        models = [LOGISTIC, TREES[0]] if name == "B" else [LOGISTIC]
        models = [replace(m, name=f"{m.name} ({name})") for m in models]
        tables.append(T.compare_models(part(rows, "train"), part(rows, "val"), models, KEY))
    return reduce(DataFrame.unionByName, tables)


@query("top_settings")
def top_settings(spark, sf_dir):
    """The five best settings of the random search for logistic regression."""
    rows, _ = matrix(spark, sf_dir)
    train = part(rows, "train")
    settings = T.random_draws(T.LR_SPACE, 30)
    return T.top_settings(T.grid_search_lr(train, settings, KEY))


#: The registered search has few trees, draws and folds: one trial of the whole spaces (``Tr.SPACES``),
#: hundreds of trees on five folds, takes minutes. The operator takes any space, draws and folds.
FEW_TREES = {
    "random_forest": Tr.FOREST_SPACE | {"n_estimators": [10, 20], "max_depth": [4, 6]},
    "gradient_boosting": Tr.BOOSTING_SPACE | {"n_estimators": [5, 10], "max_depth": [3, 4]},
}
TREE_DRAWS, TREE_FOLDS = 2, 3


@query("tune_trees")
def tune_trees(spark, sf_dir):
    """Forests and boosting on feature set B: binned once, trials kept in a table."""
    rows, _ = engineered(spark, sf_dir)
    numeric, text = set_columns(rows, "B")
    train = rows.filter("split = 'train'")
    keep = [KEY, F.col("y").alias("label")]
    binned = materialize(Tr.tree_matrix(train, numeric, text, keep, F.lit(True)))
    trials = Tr.draw_trials(FEW_TREES, TREE_DRAWS, scale_pos_weight=Tr.positive_weight(binned))
    return Tr.run_trials(binned, trials, scratch_folder(spark), KEY, TREE_FOLDS)


@query("stacking")
def stacking(spark, sf_dir):
    rows, _ = matrix(spark, sf_dir)
    return T.stack(part(rows, "train"), part(rows, "val"), TREES, KEY)


@query("retrain_test")
def retrain_test(spark, sf_dir):
    """Fit on train and validation rows, measured once on test."""
    rows, _ = matrix(spark, sf_dir)
    found = T.retrain_and_test(part(rows, "train"), part(rows, "val"), part(rows, "test"), LOGISTIC)
    return spark.createDataFrame(list(found.items()), "metric string, value double")
