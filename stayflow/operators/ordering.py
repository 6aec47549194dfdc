"""Ranks and running totals over a whole table without a one-task sort.

Equal values are merged and stored once. The stored rows go to ordered buckets, bucket totals (a table
no longer than the number of buckets) give each bucket its offset, and only the inside of a
bucket is sorted.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.operators.sizing import checkpointed

#: Rows that one task may sort; a longer table is cut into buckets.
BUCKET_ROWS = 100_000


def range_splits(df: DataFrame, column: str, parts: int | None = None) -> list[float]:
    """Cut points that divide the column into about ``parts`` equal shares."""
    if parts is None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(max(parts, 8), 5000)
    marks = df.approxQuantile(column, [i / parts for i in range(1, parts)], 1 / (4 * parts))
    return sorted({m for m in marks if math.isfinite(m)})


def range_bucket(df: DataFrame, column: str, splits: list[float], name: str = "bucket") -> DataFrame:
    """Add the ordered bucket number of a double column without missing values."""
    if not splits:
        return df.withColumn(name, F.lit(0.0))
    return Bucketizer(
        splits=[-math.inf, *splits, math.inf], inputCol=column, outputCol=name
    ).transform(df)


def running_totals(
    df: DataFrame,
    column: str,
    sums: Mapping[str, Column],
    descending: bool = False,
    by: str | None = None,
    stored: bool = False,
) -> DataFrame:
    """Add, for each name in ``sums``, its total over all rows up to this one.

    ``column`` is a double and distinct per row (group equal values first). ``by`` is a whole number
    from 0 on, in which case totals are those of the row's group and ``column`` is distinct there.
    The rows are computed once and stored, unless ``stored`` says that they are; cuts, totals and
    order come from the stored ones.
    """
    held = df if stored else checkpointed(df)
    if held.count() <= BUCKET_ROWS:
        bucketed = held.withColumn("bucket", F.lit(0.0))
    else:
        # Groups lie one after the other; the curve keeps the order of the values, infinite ones too.
        place = F.col(column) if by is None else 2 * F.col(by) + F.atan(column) / math.pi
        placed = held.withColumn("_place", place)
        bucketed = range_bucket(placed, "_place", range_splits(placed, "_place")).drop("_place")
    keys = ["bucket"] if by is None else [by, "bucket"]
    order = F.col("bucket").desc() if descending else F.col("bucket").asc()
    totals = bucketed.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    # A row per bucket, and one more for each group: small enough for one window and a broadcast.
    line = Window.orderBy(order) if by is None else Window.partitionBy(by).orderBy(order)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in sums]
    )
    inner = F.col(column).desc() if descending else F.col(column).asc()
    so_far = Window.partitionBy(*keys).orderBy(inner).rowsBetween(Window.unboundedPreceding, 0)
    placed = bucketed.join(F.broadcast(offsets), keys).withColumns(
        {n: F.col(f"{n}_before") + F.sum(c).over(so_far) for n, c in sums.items()}
    )
    return placed.drop("bucket", *[f"{n}_before" for n in sums])
