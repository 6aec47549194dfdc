"""Fitted state in a folder: fit once, score any batch or stream later without fitting.

Medians, preprocessor, drift reference and models are written by Spark's writers, so any
storage will do that executors share.
"""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.ml import classification
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.operators.drift import DriftReference
from stayflow.operators.features import Medians
from stayflow.operators.preprocess import Preprocessor
from stayflow.operators.quantiles import MAX_GROUPS
from stayflow.operators.scoring import LinearModel, LogisticModel
from stayflow.operators.sizing import collect_small
from stayflow.operators.trees import TreeModel


@dataclass(frozen=True)
class FittedState:
    """What scoring needs; ``models`` are LinearModel, LogisticModel, TreeModel or fitted MLlib models, by name."""

    preprocessor: Preprocessor
    medians: Medians
    models: Mapping[str, Any] = dataclasses.field(default_factory=dict)
    reference: DriftReference | None = None


def _write_text(spark: SparkSession, path: str, content: Any) -> None:
    spark.createDataFrame([(json.dumps(content),)], "content string").coalesce(1).write.mode("overwrite").text(path)


def _read_text(spark: SparkSession, path: str) -> Any:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def save_state(spark: SparkSession, folder: str, state: FittedState, group: str) -> None:
    """Write all parts; ``group`` is the group column of a table of medians."""
    _write_text(spark, f"{folder}/preprocessor", dataclasses.asdict(state.preprocessor))
    medians = state.medians
    if not isinstance(medians, DataFrame):
        medians = spark.createDataFrame([(k, float(v)) for k, v in medians.items()], f"`{group}` string, median double")
    medians.select(F.col(group).cast("string").alias("group"), "median").write.mode("overwrite").parquet(f"{folder}/medians")
    if state.reference is not None:
        values = [(c, float(v)) for c, vs in state.reference.samples.items() for v in vs]
        spark.createDataFrame(values, "column string, value double").write.mode("overwrite").parquet(f"{folder}/reference")
        counts = {c: list(n) for c, n in state.reference.counts.items()}
        _write_text(spark, f"{folder}/reference_counts", {"columns": list(state.reference.samples), "counts": counts})
    kinds = {}
    for name, model in state.models.items():
        kinds[name] = type(model).__name__
        if isinstance(model, LinearModel):
            _write_text(spark, f"{folder}/models/{name}", {**dataclasses.asdict(model), "coefficients": dict(model.coefficients)})
        elif isinstance(model, LogisticModel):
            _write_text(spark, f"{folder}/models/{name}", [model.intercept, [float(v) for v in model.coefficients]])
        elif isinstance(model, TreeModel):
            _write_text(spark, f"{folder}/models/{name}", dataclasses.asdict(model))
        else:
            model.write().overwrite().save(f"{folder}/models/{name}")
    _write_text(spark, f"{folder}/contents", {"models": kinds, "reference": state.reference is not None})


def load_state(spark: SparkSession, folder: str, group: str) -> FittedState:
    """Read what ``save_state`` wrote; many medians stay a table with the group column ``group``."""
    contents = _read_text(spark, f"{folder}/contents")
    table = spark.read.parquet(f"{folder}/medians").withColumnRenamed("group", group)
    few = collect_small(table, MAX_GROUPS)
    reference = None
    if contents["reference"]:
        about = _read_text(spark, f"{folder}/reference_counts")
        samples: dict[str, list[float]] = {c: [] for c in about["columns"]}
        for r in spark.read.parquet(f"{folder}/reference").collect():
            samples[r["column"]].append(r["value"])
        counts = {c: tuple(n) for c, n in about["counts"].items()}
        reference = DriftReference({c: sorted(v) for c, v in samples.items()}, counts)
    models = {}
    for name, kind in contents["models"].items():
        path = f"{folder}/models/{name}"
        if kind == LinearModel.__name__:
            models[name] = LinearModel(**_read_text(spark, path))
        elif kind == LogisticModel.__name__:
            intercept, coefficients = _read_text(spark, path)
            models[name] = LogisticModel(intercept, Vectors.dense(coefficients))
        elif kind == TreeModel.__name__:
            models[name] = TreeModel(**_read_text(spark, path))
        else:
            models[name] = getattr(classification, kind).load(path)
    return FittedState(
        Preprocessor(**_read_text(spark, f"{folder}/preprocessor")),
        table if few is None else {r[group]: r["median"] for r in few},
        models,
        reference,
    )
