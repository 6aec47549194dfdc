"""Lookups against results history and other small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.operators.sizing import collect_small

DEFAULT_THRESHOLD = 0.5
MAX_MODELS = 10_000


def last_per_key(history: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """The value of the last row of each key in arrival order; partial aggregation only."""
    return history.groupBy(key).agg(
        F.max_by(value, seq).alias(value), F.max(seq).alias("last_seq")
    )


def with_model_threshold(
    df: DataFrame, history: DataFrame, model: str = "model_id", value: str = "final_threshold", seq: str = "seq"
) -> DataFrame:
    """Add ``threshold``: the last of the row's model, or of all for an unknown model; 0.5 where
    that one is missing."""
    latest = last_per_key(history, model, value, seq)
    few = collect_small(latest, MAX_MODELS)
    if few is None:
        overall = history.agg(F.max_by(value, seq)).scalar()
        known = latest.select(model, F.col(value).alias("_known"), F.lit(True).alias("_listed"))
    else:
        newest = max(few, key=lambda r: r["last_seq"], default=None)
        overall = F.lit(newest[value] if newest else None).cast("double")
        kind = history.schema[model].dataType.simpleString()
        known = F.broadcast(
            df.sparkSession.createDataFrame(
                [(r[model], r[value], True) for r in few], f"{model} {kind}, _known double, _listed boolean"
            )
        )
    return (
        df.join(known, model, "left")
        .withColumn(
            "threshold",
            F.coalesce(F.when(F.col("_listed"), F.col("_known")).otherwise(overall), F.lit(DEFAULT_THRESHOLD)),
        )
        .drop("_known", "_listed")
    )


def attach_scores(rows: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """Write separately computed scores back; rows without one keep NULL."""
    return rows.join(scores, key, "left")
