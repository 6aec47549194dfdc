"""Streaming runs drained over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayflow.operators.scoring import score_batch
from stayflow.operators.sizing import scratch_folder
from stayflow.params import ACCOUNT_COLUMNS
from stayflow.plans import check_sql as S
from stayflow.plans.features import MODEL_FIELDS, fitted
from stayflow.plans.registry import query, rounded
from stayflow.plans.scoring import MODEL, SCORED_COLUMNS, scored_sql
from stayflow.sources.accounts import accounts, line_prices
from stayflow.streaming import jobs as J
from stayflow.streaming.store import KeyedSums


@query("stream_score", f"{scored_sql('accounts')} SELECT {SCORED_COLUMNS} FROM batch")
def stream_score(spark, sf_dir):
    """Orders arrive as a stream and leave as contact decisions, with order totals that a stream of
    line items maintains."""
    fit = fitted(spark, sf_dir)
    lines = J.stream_table(spark, sf_dir, "lineitem.parquet")
    orders = J.stream_table(spark, sf_dir, "orders.parquet")
    scored = score_orders(spark, sf_dir, lines, orders, fit, scratch_folder(spark))
    return rounded(scored, 6, expected_value=3)


def score_orders(spark, sf_dir, lines, orders, fit, folder):
    """Run both streams over what is available and return all decisions so far.

    ``folder`` keeps the totals, the decisions and the progress of both streams: run again, only new
    line items and new orders are read. A micro-batch of orders opens the buckets of its keys alone.
    """
    totals = KeyedSums(spark, f"{folder}/totals", ("o_orderkey", "long"), {"line_total": "decimal(22,2)"})
    J.each_batch(line_prices(lines), totals.merge, f"{folder}/checkpoint/lines")

    def score(batch, number):
        known = totals.join(batch.select("o_orderkey")).dropDuplicates(["o_orderkey"])
        arriving = accounts(spark, sf_dir, MODEL_FIELDS, batch, known)
        scored = score_batch(arriving, fit.preprocessor, MODEL, fit.medians, 0.5, ACCOUNT_COLUMNS)
        scored.write.mode("overwrite").parquet(f"{folder}/decisions/batch={number}")

    J.each_batch(orders, score, f"{folder}/checkpoint/orders")
    return spark.read.parquet(f"{folder}/decisions").drop("batch")


@query(
    "stream_metrics",
    f"""WITH {S.BATCH_LOG} SELECT batch_day, batch_size, failed_rows,
  round(CAST(failed_rows AS DOUBLE) / batch_size, 6) AS failure_rate FROM batch_log
WHERE batch_day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def stream_metrics(spark, sf_dir):
    """Daily windows that the watermark has closed."""
    events = J.stream_table(spark, sf_dir, "events.parquet")
    found = J.drained(J.stream_metrics(events, "1 day", "1 hour"))
    return rounded(
        found.select(
            J.utc_day(F.col("window_start")).alias("batch_day"), "batch_size", "failed_rows", "failure_rate"
        )
    )
