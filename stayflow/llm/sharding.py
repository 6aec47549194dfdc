"""Balanced label propagation: linked documents move to their neighbours' shards, sizes stay even."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.running import total_before
from stayflow.llm.store import checkpointed

#: Bits of a hash that choose the part in which rows are ordered.
PART_BITS = 12
#: A group is small if so many of its size fit into a shard.
UNIT = 16


def _part(column: str) -> Column:
    """The upper bits of an unsigned order of a hash column."""
    return F.shiftright(column, 64 - PART_BITS)


def even(n: int, sizes: np.ndarray) -> np.ndarray:
    """Row counts at most one apart; the larger ones where most rows are now."""
    shards = len(sizes)
    wanted = np.full(shards, n // shards, np.int64)
    wanted[np.argsort(-sizes, kind="stable")[: n % shards]] += 1
    return wanted


def _held(rows: DataFrame) -> DataFrame:
    """Rows of each group by shard: (links, shard, n)."""
    return rows.where(F.col("links").isNotNull()).groupBy("links", "shard").agg(F.count(F.lit(1)).alias("n"))


def _moved(rows: DataFrame, quota: int) -> DataFrame:
    """Every linked row in the shard that its group wants, whatever room there is; adds ``rank``: 0
    for rows without links, 1 for those of groups that a shard holds many of, 2 for the others.

    A group wants as many of the shards where most of its members are as it needs at the quota, one
    for all but very large groups. Members outside them choose one by their hash.
    """
    held = _held(rows)
    # At most one row per shard and group: these windows are as small as the number of shards.
    by = Window.partitionBy("links")
    total = F.sum("n").over(by)
    best = F.row_number().over(by.orderBy(F.col("n").desc(), "shard"))
    ranked = held.withColumns({"total": total, "best": best})
    # Stored first, so that the join below is a plain one whose hot keys Spark can split.
    targets = checkpointed(
        ranked.where(F.col("best") <= F.ceil(F.col("total") / F.lit(max(1, quota))))
        .groupBy(F.col("links").alias("of"))
        .agg(
            F.array_sort(F.collect_list("shard")).alias("targets"),
            F.when(F.max("total") * UNIT <= quota, 1).otherwise(2).alias("large"),
        )
    )
    chosen = F.element_at("targets", (F.pmod(F.xxhash64("order"), F.size("targets")) + 1).cast("int"))
    stays = F.col("of").isNull() | F.array_contains("targets", F.col("shard"))
    return (
        rows.join(targets, rows["links"] == targets["of"], "left")
        .withColumn("rank", F.coalesce("large", F.lit(0)))
        .withColumn("shard", F.when(stays, F.col("shard")).otherwise(chosen))
        .drop("of", "targets", "large")
    )


def _cut(held: DataFrame) -> int:
    """Pairs of linked rows in different shards."""
    pairs = held.groupBy("links").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("own"))
    return int(pairs.agg(F.coalesce(F.sum((F.col("all") * F.col("all") - F.col("own")) / 2), F.lit(0.0))).first()[0])


def _settled(moved: DataFrame, shards: int) -> DataFrame:
    """Hold every shard to its quota: exactly the rows that are too many go where rows are missing.

    Rows without links go first, then small groups one after the other, so that few are cut, then
    rows of large groups. Shards' sizes are all that comes to the driver.
    """
    sizes = np.zeros(shards, np.int64)
    for r in moved.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["shard"]] = r["n"]
    wanted = even(int(sizes.sum()), sizes)
    excess, missing = np.maximum(sizes - wanted, 0), np.maximum(wanted - sizes, 0)
    # Parts to sort in: small groups whole, large ones and rows without links by their own hashes.
    part = F.struct(
        "rank",
        F.when(F.col("rank") > 0, _part("links")).alias("group"),
        F.when(F.col("rank") != 1, _part("order")).alias("row"),
    )
    placed = total_before(
        moved.withColumn("bucket", part), F.lit(1), ["shard"], "bucket", ["links", "order", "doc_id"], "before"
    )
    at = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("shard") + 1)
    number = F.col("before") + at(np.cumsum(excess) - excess)
    ends = F.array(*[F.lit(int(x)) for x in np.cumsum(missing)])
    target = F.size(F.filter(ends, lambda x: x <= number))
    shard = F.when(F.col("before") < at(excess), target).otherwise(F.col("shard")).cast("int")
    return placed.withColumn("shard", shard).drop("before", "bucket", "rank")


def shard(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    links: Column | None = None,
    rounds: int = 6,
) -> DataFrame:
    """Put every row into a shard: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows``: counts are at most one apart. Rows with the same value of ``links`` (the
    text by default; NULL links nothing) are linked. They start where their hash puts them, evenly.
    Each round every group of linked rows takes the shard where most of it is as its label (a group
    larger than a shard as many as it needs), its other members move there, and quotas are restored:
    from a shard with too many rows the rows without links move on, then small groups as a whole, then
    rows of large groups. Rounds end when one saves less than a hundredth of the cut links, or after
    ``rounds``. ``slot`` numbers the rows of a shard from 0 without a gap; ``size`` is the UTF-8 length of
    the text (NULL: none) plus 8; ``grown_shard`` is NULL under this law.

    A group may be of any size: it takes part as counts by shard, and its rows are spread over tasks
    by their own hashes. Rows that repeat an id or have none are rows of their own. An empty table
    gives an empty table; NULL texts are linked with nothing.
    """
    text = F.col(text_col)
    linked = F.xxhash64(text_col, F.length(text)) if links is None else F.xxhash64(links)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.when((text if links is None else links).isNotNull(), linked).alias("links"),
    )
    # A link of one row links nothing, so the row can make room.
    rows = checkpointed(rows.withColumn("order", F.xxhash64("doc_id", "size", "text_crc32")))
    alone = checkpointed(
        rows.where(F.col("links").isNotNull())
        .groupBy(F.col("links").alias("of")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("of")
    )
    rows = rows.join(alone, rows["links"] == alone["of"], "left").withColumn("links", F.col("of")).drop("of")
    rows = rows.withColumn("bucket", _part("order"))
    start = total_before(rows, F.lit(1), [], "bucket", ["order", "doc_id"], "number")
    rows = checkpointed(start.withColumn("shard", (F.col("number") % shards).cast("int")).drop("number", "bucket"))
    quota = rows.count() // shards
    cut = _cut(_held(rows))
    for _ in range(rounds):
        if not cut:
            break
        moved = checkpointed(_settled(checkpointed(_moved(rows, quota)), shards))
        left = _cut(_held(moved))
        enough = left > 0.99 * cut
        rows, cut = (moved, left) if left < cut else (rows, cut)
        if enough:
            break
    placed = total_before(
        rows.withColumn("bucket", _part("order")), F.lit(1), ["shard"], "bucket", ["order", "doc_id"], "slot"
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
