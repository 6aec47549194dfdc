"""Score a batch: validate, engineer, encode, predict, decide. One lazy plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.operators.features import Medians, clean_total_charges, engineer_features
from stayflow.operators.preprocess import Preprocessor
from stayflow.operators.rows import with_row_errors
from stayflow.operators.trees import TreeModel
from stayflow.params import BusinessParams, CustomerColumns


@dataclass(frozen=True)
class LinearModel:
    """Logistic model as plain numbers: scoring is a column expression."""

    intercept: float
    coefficients: Mapping[str, float]
    model_id: str | None = None

    def margin(self, features: Mapping[str, Column]) -> Column:
        terms = [features[n] * F.lit(float(w)) for n, w in self.coefficients.items()]
        return reduce(lambda a, b: a + b, terms, F.lit(float(self.intercept)))

    def probability(self, features: Mapping[str, Column]) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin(features)))


@dataclass(frozen=True)
class LogisticModel:
    """Logistic regression over a features array."""

    intercept: float
    coefficients: DenseVector

    def scores(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), float(self.intercept))
        for i, w in enumerate(self.coefficients):
            if w:
                margin += x[:, i] * float(w)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-margin))

    def probability(self, features: Column) -> Column:
        terms = [F.get(features, F.lit(i)) * F.lit(float(w)) for i, w in enumerate(self.coefficients) if w]
        margin = reduce(lambda a, b: a + b, terms, F.lit(float(self.intercept)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def decide(
    df: DataFrame, threshold: float | Column, business: BusinessParams = BusinessParams()
) -> DataFrame:
    """Add prediction, decision and expected value; failed rows keep NULL in each."""
    p = F.when(F.col("prediction_status") == "ok", F.col("churn_probability"))
    bound = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.withColumns(
        {
            "churn_probability": p,
            "churn_prediction": (p >= bound).cast("int"),
            "decision": F.when(p >= bound, "contact").when(p < bound, "no_contact"),
            "expected_value": p * F.lit(business.retained_value) - F.lit(business.contact_cost),
        }
    )


def score_batch(
    df: DataFrame,
    preprocessor: Preprocessor,
    model: LinearModel,
    medians: Medians,
    threshold: float | Column,
    cols: CustomerColumns = CustomerColumns(),
    business: BusinessParams = BusinessParams(),
    required: Sequence[str] = (),
) -> DataFrame:
    """(id, churn_probability, prediction_status, churn_prediction, decision, expected_value,
    model_id) for every input row; invalid rows stay, marked ``failed``."""
    ready, kept = _ready(df, preprocessor, medians, cols, required)
    scored = ready.select(
        *kept, model.probability(preprocessor.feature_columns(ready)).alias("churn_probability")
    )
    return decide(scored, threshold, business).withColumn("model_id", F.lit(model.model_id))


def _ready(
    df: DataFrame,
    preprocessor: Preprocessor,
    medians: Medians,
    cols: CustomerColumns,
    required: Sequence[str],
) -> tuple[DataFrame, list]:
    """Checked and engineered rows, and the columns of the result that need no model."""
    body = df.drop(cols.label)
    checked = with_row_errors(body, cols, required)
    cleaned = clean_total_charges(checked, cols) if cols.total in body.columns else checked
    ready = engineer_features(cleaned, medians, cols)
    preprocessor.require_columns(ready)
    status = F.when(F.size("errors") == 0, "ok").otherwise("failed").alias("prediction_status")
    return ready, [*([cols.id] if cols.id in df.columns else []), status]


def linear_from_ml(model, names: Sequence[str], model_id: str | None = None) -> LinearModel:
    """A fitted logistic regression as plain numbers."""
    return LinearModel(
        float(model.intercept), dict(zip(names, map(float, model.coefficients))), model_id
    )


def score_batch_with(
    df: DataFrame,
    preprocessor: Preprocessor,
    models: Mapping[str, object],
    medians: Medians,
    threshold: float | Column,
    cols: CustomerColumns = CustomerColumns(),
    business: BusinessParams = BusinessParams(),
    required: Sequence[str] = (),
    model_id: str | None = None,
) -> DataFrame:
    """``score_batch`` with trained models: LinearModel or fitted MLlib classifiers. The
    probability is the mean of theirs; ``p_<name>`` has each."""
    ready, kept = _ready(df, preprocessor, medians, cols, required)
    rows = ready.select(*kept, F.array(*preprocessor.feature_columns(ready).values()).alias("features"))
    places = {n: F.element_at("features", i + 1) for i, n in enumerate(preprocessor.feature_names())}
    for name, model in models.items():
        if isinstance(model, LinearModel):
            rows = rows.withColumn(f"p_{name}", model.probability(places))
        else:
            rows = score_with_ml(model, rows, f"p_{name}")
    voted = rows.drop("features").withColumn("churn_probability", soft_vote([f"p_{n}" for n in models]))
    return decide(voted, threshold, business).withColumn("model_id", F.lit(model_id or "+".join(models)))


def score_with_ml(model, matrix: DataFrame, name: str = "p") -> DataFrame:
    """Add the positive-class probability of a fitted model to (…, features array)."""
    if isinstance(model, LogisticModel | TreeModel):
        return matrix.select("*", model.probability(F.col("features")).alias(name))
    vectors = matrix.withColumn("_vector", array_to_vector("features"))
    scored = model.transform(vectors)
    return scored.select(
        *matrix.columns, F.element_at(vector_to_array("probability"), 2).alias(name)
    )


def soft_vote(scores: Sequence[str]) -> Column:
    """Mean of the model probabilities."""
    return reduce(lambda a, b: a + b, [F.col(s) for s in scores]) / F.lit(float(len(scores)))


def contact_list(scored: DataFrame, key: str, capacity: int = 500) -> DataFrame:
    """The ``capacity`` highest scores with risk level and action."""
    p = F.col("p")
    high, medium = p >= 0.7, p >= 0.4
    risk = F.when(high, "High").when(medium, "Medium").otherwise("Low")
    action = F.when(high, "Urgent Retention").when(medium, "Targeted Offer").otherwise("Monitor")
    return (
        scored.select(key, "p")
        .orderBy(F.desc("p"), key)
        .limit(capacity)
        .select(key, "p", risk.alias("risk_level"), action.alias("recommended_action"))
    )
