"""Writers: CSV, partitioned matrix, JSON reports and run records."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; white space is kept, so a lone space survives the round trip."""
    (
        df.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .csv(path)
    )


def write_matrix(matrix: DataFrame, path: str) -> None:
    """Processed rows, one partition folder per split."""
    matrix.write.partitionBy("split").parquet(path)


def write_json(report: DataFrame, path: str) -> None:
    report.write.json(path)


def append_run(spark: SparkSession, path: str, record: dict[str, Any]) -> None:
    """Append one run record as a JSON line."""
    spark.createDataFrame([record]).write.mode("append").json(path)


def append_results(results: DataFrame, path: str) -> None:
    results.write.mode("append").parquet(path)
