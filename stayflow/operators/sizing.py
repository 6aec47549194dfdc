"""Bounded driver reads and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Row, SparkSession

MAX_SMALL_ROWS = 100_000


def collect_small(df: DataFrame, limit: int = MAX_SMALL_ROWS) -> list[Row] | None:
    """All rows when there are at most ``limit`` of them, else None (caller falls back)."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, the storage all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stayflow-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back, so later passes do not recompute."""
    spark = df.sparkSession
    path = scratch_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder, so that later passes and lost executors reread it.

    For small results: Spark's cleaner deletes the files when nothing refers to them any more
    (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_folder(df.sparkSession))
    return df.checkpoint()
