"""Running health of scoring batches, from an append-only batch log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.operators.ordering import running_totals

HISTORY = 200


def batch_row(scored: DataFrame) -> DataFrame:
    """The log row of one scored batch: size and failed rows."""
    return scored.agg(
        F.count("*").alias("batch_size"),
        F.count_if(F.col("prediction_status") == "failed").alias("failed_rows"),
    )


def batch_metrics(log: DataFrame, seq: str, drift: str | None = None) -> DataFrame:
    """One row over all batches: totals, failure rate, mean latency, last drift score."""
    last = F.max_by(drift, F.when(F.col(drift).isNotNull(), F.col(seq))) if drift else F.lit(None).cast("double")
    return log.agg(
        F.count("*").alias("prediction_batches"),
        F.coalesce(F.sum("batch_size"), F.lit(0)).alias("predictions_total"),
        F.coalesce(F.sum("failed_rows"), F.lit(0)).alias("prediction_failures"),
        F.coalesce(F.avg("latency_ms"), F.lit(0.0)).alias("avg_latency_ms"),
        last.alias("last_drift_score"),
    ).withColumn(
        "failure_rate",
        C.safe_ratio(
            F.col("prediction_failures"), F.greatest("predictions_total", F.lit(1))
        ),
    )


def batch_metrics_running(log: DataFrame, seq: str) -> DataFrame:
    """The same metrics as they stood after each batch; ``seq`` is a distinct number.

    Latencies are added up in millionths, so the mean does not depend on the order of the sums.
    """
    placed = running_totals(
        log.withColumn("_seq", F.col(seq).cast("double")),
        "_seq",
        {
            "prediction_batches": F.lit(1).cast("long"),
            "predictions_total": F.col("batch_size"),
            "prediction_failures": F.col("failed_rows"),
            "latency_total": F.col("latency_ms").cast("decimal(28,6)"),
        },
    )
    return placed.select(
        *log.columns,
        "prediction_batches",
        "predictions_total",
        "prediction_failures",
        C.safe_ratio(
            F.col("prediction_failures"), F.greatest("predictions_total", F.lit(1))
        ).alias("failure_rate"),
        (F.col("latency_total").cast("double") / F.col("prediction_batches")).alias("avg_latency_ms"),
    )


def batch_history(log: DataFrame, seq: str, keep: int = HISTORY) -> DataFrame:
    """The latest ``keep`` log rows."""
    return log.orderBy(F.desc(seq)).limit(keep)
