"""Feature importance, feature decisions and linear contributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.operators.preprocess import Preprocessor
from stayflow.operators.scoring import LinearModel

WEAK = 0.05
STRONG = 0.2
DEMOGRAPHIC = ["gender", "SeniorCitizen", "Partner", "Dependents"]


def coefficient_table(
    spark: SparkSession, values: Sequence[float], names: Sequence[str] = ()
) -> DataFrame:
    """(feature, coefficient): names and values paired by position up to the shorter list.

    As long as the model is wide; without names the features are numbered.
    """
    names = list(names) or [f"feature_{i}" for i in range(len(values))]
    pairs = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(pairs, "feature string, coefficient double")


def model_importance(spark: SparkSession, model, names: Sequence[str] = ()) -> DataFrame:
    """(feature, importance) of a fitted MLlib model: |coefficient| or tree importance."""
    if hasattr(model, "coefficients"):
        values = [abs(v) for v in model.coefficients.toArray()]
    elif hasattr(model, "featureImportances"):
        values = list(model.featureImportances.toArray())
    else:
        values = []
    return coefficient_table(spark, values, names).withColumnRenamed("coefficient", "importance")


def rank_coefficients(coefs: DataFrame) -> DataFrame:
    """Add the absolute value and its rank from 1. One row per feature, so one window will do."""
    size = F.abs("coefficient")
    place = Window.orderBy(size.desc(), F.col("feature"))
    return coefs.select("feature", "coefficient", size.alias("abs_coefficient")).withColumn(
        "rank", F.row_number().over(place)
    )


def coefficient_groups(coefs: DataFrame) -> DataFrame:
    """(list, feature, coefficient): drivers, preventers and weak features."""
    c = F.col("coefficient")
    lists = F.array_compact(
        F.array(
            F.when(c > 0, "driver"),
            F.when(c < 0, "preventer"),
            F.when(F.abs(c) < WEAK, "weak"),
        )
    )
    return coefs.select(F.explode(lists).alias("list"), "feature", "coefficient")


def top_features(coefs: DataFrame, k: int = 20) -> DataFrame:
    """The k features of the largest absolute coefficient, with their direction."""
    direction = F.when(F.col("coefficient") > 0, "driver").when(F.col("coefficient") < 0, "preventer")
    return rank_coefficients(coefs).filter(F.col("rank") <= k).withColumn("direction", direction)


def coefficient_summary(coefs: DataFrame) -> DataFrame:
    c = "coefficient"
    return coefs.agg(
        F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max")
    )


def group_importance(coefs: DataFrame, keep_prefix: str = "TotalCharges") -> DataFrame:
    """(feature_group, total, max, categories), rounded to 4, most important first."""
    size = F.abs("coefficient")
    return (
        coefs.groupBy(C.feature_group(F.col("feature"), keep_prefix).alias("feature_group"))
        .agg(
            C.round_even(F.sum(size), 4).alias("total_importance"),
            C.round_even(F.max(size), 4).alias("max_importance"),
            F.count("*").alias("n_categories"),
        )
        .orderBy(F.desc("total_importance"), "feature_group")
    )


def feature_decisions(
    coefs: DataFrame, demographic: Sequence[str] = DEMOGRAPHIC, total: str = "TotalCharges"
) -> DataFrame:
    """(feature, decision, justification)."""
    size, name = F.abs("coefficient"), F.col("feature")
    # Bounds and texts are fixed values of the result.
    why = (
        F.when(size >= STRONG, "Strong predictive power")
        .when(size >= WEAK, "Moderate predictive power")
        .when(C.contains_any(name, demographic), "Weak but business-relevant demographic")
        .when(F.contains(name, F.lit(total)), "Redundant with tenure (corr=0.83)")
        .otherwise("Weak coefficient - candidate for removal")
    )
    return coefs.select(
        "feature",
        F.when(size >= WEAK, "KEEP").otherwise("REVIEW").alias("decision"),
        why.alias("justification"),
    )


# ---- linear contributions -------------------------------------------------


def contribution_columns(
    df: DataFrame, preprocessor: Preprocessor, model: LinearModel, means: dict[str, float]
) -> dict[str, Column]:
    """Feature -> coefficient x (value - mean): the additive shares of a linear score."""
    values = preprocessor.feature_columns(df)
    return {
        n: (values[n] - F.lit(float(means[n]))) * F.lit(float(w))
        for n, w in model.coefficients.items()
    }


def feature_means(train: DataFrame, preprocessor: Preprocessor) -> dict[str, float]:
    """Mean of every encoded feature over the background rows, one aggregation."""
    values = preprocessor.feature_columns(train)
    one = train.agg(*[F.avg(v).alias(str(i)) for i, v in enumerate(values.values())]).first()
    return {n: one[i] for i, n in enumerate(values)}


def base_value(model: LinearModel, means: dict[str, float]) -> float:
    return model.intercept + sum(w * means[n] for n, w in model.coefficients.items())


def linear_contributions(
    df: DataFrame,
    key: str,
    preprocessor: Preprocessor,
    model: LinearModel,
    means: dict[str, float],
) -> DataFrame:
    """(key, base_value, margin, features, contributions): shares stay in one array per row."""
    parts = contribution_columns(df, preprocessor, model, means)
    rows = df.select(
        key,
        F.lit(base_value(model, means)).alias("base_value"),
        F.array(*parts.values()).alias("contributions"),
    )
    total = F.aggregate("contributions", F.col("base_value"), lambda acc, x: acc + x)
    return rows.select(key, "base_value", total.alias("margin"), "contributions")


def global_contributions(
    df: DataFrame, preprocessor: Preprocessor, model: LinearModel, means: dict[str, float]
) -> DataFrame:
    """(feature, mean_abs_contribution): one aggregation, nothing exploded per row."""
    parts = contribution_columns(df, preprocessor, model, means)
    means_of = F.array(
        *[
            F.struct(
                F.lit(n).alias("feature"), F.avg(F.abs(c)).alias("mean_abs_contribution")
            )
            for n, c in parts.items()
        ]
    )
    return df.agg(means_of.alias("m")).select(F.inline("m"))


def local_contributions(contributions: DataFrame, names: Sequence[str], row: Column) -> DataFrame:
    """(feature, contribution) of the rows that match, largest first."""
    pairs = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), "contributions")
    return (
        contributions.filter(row)
        .select(F.inline(pairs))
        .toDF("feature", "contribution")
        .orderBy(F.abs("contribution").desc(), "feature")
    )
