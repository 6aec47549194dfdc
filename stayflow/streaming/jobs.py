"""Streaming scoring and windowed batch metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.operators.sizing import scratch_folder


def stream_table(spark: SparkSession, folder: str, file: str, files_each: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream, the schema being that of the batch table; at most
    ``files_each`` files in a micro-batch."""
    schema = spark.read.option("pathGlobFilter", file).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file)
    if files_each is not None:
        reader = reader.option("maxFilesPerTrigger", files_each)
    return reader.parquet(folder)


def as_instant(ts: Column) -> Column:
    """A time without zone read as UTC, whatever the zone of the session."""
    return F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone())


def utc_day(instant: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def stream_metrics(events: DataFrame, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Rows and failure rate per tumbling window; rows later than the delay are dropped."""
    failed = F.count_if(F.col("event_type") == "error")
    return (
        events.withColumn("ts", as_instant(F.col("ts")))
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", window).alias("w"))
        .agg(F.count("*").alias("batch_size"), failed.alias("failed_rows"))
        .select(
            F.col("w.start").alias("window_start"),
            "batch_size",
            "failed_rows",
            C.safe_ratio(F.col("failed_rows"), F.col("batch_size")).alias("failure_rate"),
        )
    )


def each_batch(stream: DataFrame, job: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run ``job(rows, number)`` on each micro-batch of what is available. A batch that failed comes
    again with its number: ``job`` must replace what it wrote for that number."""
    query = (
        stream.writeStream.foreachBatch(job)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_to_table(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Process all that is available into a Parquet folder, exactly once per checkpoint."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination()


def drained(stream: DataFrame) -> DataFrame:
    """Run the stream over what is available into the shared folder and read the result."""
    spark = stream.sparkSession
    base = scratch_folder(spark)
    run_to_table(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{base}/out")
