"""Running totals over whole tables without a one-task sort, and the order of ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from stayflow.llm.store import checkpointed


def total_before(
    df: DataFrame,
    value: Column,
    by: Sequence[str],
    bucket: str,
    order: Sequence[str | Column],
    name: str,
) -> DataFrame:
    """Add the sum of ``value`` over the rows before each row of its ``by`` group.

    Rows are in the order of ``bucket``, then ``order`` (NULL first, like Spark's ascending
    sort). ``bucket`` must divide each group into parts that one task can sort; the table of
    part totals gives every part its offset, so no task holds a whole group. Rows that are
    equal in ``order`` come in any order. ``value`` is a long without NULL.
    """
    own, part, offset = f"{name}__value", f"{name}__part", f"{name}__offset"
    df = df.withColumn(own, value)
    keys = [*by, bucket]
    totals = df.groupBy(*keys).agg(F.sum(own).alias(part))
    ahead = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"{k}__of") for k in keys],
        F.coalesce(F.sum(part).over(ahead), F.lit(0)).alias(offset),
    )
    same = [df[k].eqNullSafe(offsets[f"{k}__of"]) for k in keys]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = df.join(offsets, same).drop(*[f"{k}__of" for k in keys])
    return placed.withColumn(
        name, F.col(offset) + F.coalesce(F.sum(own).over(inside), F.lit(0))
    ).drop(own, offset)


def numbered(rows: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """The rows, and a column of numbers in the order of the ids: the ids themselves where they are
    numbers, else their ranks in a new column ``place``."""
    if isinstance(rows.schema[id_col].dataType, NumericType):
        return rows, id_col
    return ordered_ids(rows, id_col), "place"


def id_part(df: DataFrame, id_col: str, parts: int) -> tuple[Column, int]:
    """A column with the number of the row's range of ids, ascending, NULL in a range of its own
    after the others; and how many ranges there are. Ranges lie between approximate quantiles, so
    they are about equal; the driver gets one number for each.
    """
    shares = [i / parts for i in range(1, parts)]
    ids = df.select(F.col(id_col).cast("double").alias("id"))
    cuts = sorted(set(ids.approxQuantile("id", shares, 1 / (4 * parts)))) if shares else []
    below = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<double>")
    part = F.when(F.col(id_col).isNull(), F.lit(len(cuts) + 1)).otherwise(
        F.size(F.filter(below, lambda c: c < F.col(id_col)))
    )
    return part, len(cuts) + 2


def ordered_ids(docs: DataFrame, id_col: str) -> DataFrame:
    """Add ``place``: a long in the order of the ids, NULL last. Whole numbers are their own place;
    other ids get the rank of their value."""
    last = F.lit(2**63 - 1)
    if docs.schema[id_col].dataType.typeName() in {"byte", "short", "integer", "long"}:
        return docs.withColumn("place", F.coalesce(F.col(id_col).cast("long"), last))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col(id_col).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    dealt = checkpointed(ids.repartitionByRange(parts, "_id").withColumn("range", F.spark_partition_id()))
    ranked = total_before(dealt, F.lit(1), [], "range", ["_id"], "place").select("_id", "place")
    joined = docs.join(ranked, docs[id_col] == ranked["_id"], "left").drop("_id")
    return joined.withColumn("place", F.coalesce("place", last))
