"""Exact top-k inner products by block-at-a-time pruning."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.running import id_part
from stayflow.llm.store import checkpointed

#: Vectors of a block, blocks of a row of the index, and queries that are answered together.
BLOCK, BLOCKS, QUERIES = 256, 16, 256
#: The greatest score; the least long is kept for "none".
LIMIT = 2**63 - 2


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as long; NULL for a vector that is NULL or empty or holds
    a NULL or non-finite component, or one whose result does not fit a long."""
    values = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fit = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(2.0**62 / scale)))
    return F.when(fit & (F.size(vector) > 0), values)


def packed(rows: DataFrame, parts: int, rows_each: int, name: str) -> DataFrame:
    """Rows of up to ``rows_each`` vectors of one length, in order of id: dims, ids (8 bytes each),
    values (of ``width`` bytes each), and ``name``, a number of the row."""
    part, _ = id_part(rows, "id", parts)
    dealt = rows.withColumn("dims", F.size("vector")).withColumn("part", part)
    dealt = dealt.repartition("dims", "part").sortWithinPartitions("dims", "part", "id")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def row(frame: pd.DataFrame) -> pd.DataFrame:
            values = np.stack(frame["vector"].to_list()).astype(np.int64)
            most = max(int(values.max()), -int(values.min()))
            width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
            return pd.DataFrame(
                {"dims": [int(frame["dims"].iloc[0])], "part": [int(frame["part"].iloc[0])], "width": [width],
                 "ids": [frame["id"].to_numpy(np.int64).tobytes()], "values": [values.astype(f"i{width}").tobytes()]}
            )

        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if not len(pdf):
                continue
            place = pdf[["dims", "part"]].to_numpy()
            starts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1), len(pdf)]
            done = 0
            for a, b in zip(starts[:-1], starts[1:]):
                while b - a >= rows_each or (b < len(pdf) and b > a):
                    yield row(pdf.iloc[a : min(b, a + rows_each)])
                    a = min(b, a + rows_each)
                done = a
            rest = pdf.iloc[done:]
        if rest is not None and len(rest):
            yield row(rest)

    blocks = dealt.mapInPandas(pack, "dims int, part int, width int, ids binary, values binary")
    return checkpointed(blocks.withColumn(name, F.xxhash64("dims", "part", "ids")).drop("part"))


def unpacked(ids: bytes, values: bytes, width: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(values, f"i{width}").reshape(-1, dims).astype(np.int64)


class Best:
    """The k best (score, id) of each of some queries; ties go to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), np.iinfo(np.int64).min)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def kth(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[1]
        score = np.concatenate([self.score[rows], score], axis=1)
        ids = np.concatenate([self.id[rows], ids], axis=1)
        order = np.lexsort((ids, ~score), axis=1)[:, :k]
        self.score[rows] = np.take_along_axis(score, order, 1)
        self.id[rows] = np.take_along_axis(ids, order, 1)


def product(queries: np.ndarray, vectors: np.ndarray, bound: bool = False) -> np.ndarray:
    """Exact integer inner products: in doubles where all sums are under 2**53, in Python's integers
    where they may pass a long. A score that does not fit a long is an error, a bound is cut to it."""
    most = queries.shape[1] * float(np.abs(queries).max()) * float(np.abs(vectors).max())
    if most < 2.0**53:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    if most < 2.0**62:
        return queries @ vectors.T
    exact = queries.astype(object) @ vectors.T.astype(object)
    if bound:
        exact = np.clip(exact, -LIMIT, LIMIT)
    elif (np.abs(exact) > LIMIT).any():
        raise OverflowError("an inner product does not fit a long")
    return exact.astype(np.int64)


def search_blocks(best: Best, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> int:
    """Offer the vectors to the queries, block by block; returns the pairs that were scored.

    For each query the blocks come in order of their bound: the sum over the components of the
    largest product with the block's greatest or least value there. A query leaves once the bound
    of its next block is below its k-th score.
    """
    edges = list(range(0, len(ids), BLOCK))
    most = np.maximum.reduceat(vectors, edges, axis=0)
    least = np.minimum.reduceat(vectors, edges, axis=0)
    # Two parts of at most LIMIT each are added without passing a long.
    bound = product(np.maximum(queries, 0), most, True) // 2 + product(np.minimum(queries, 0), least, True) // 2
    bound = np.minimum(bound, LIMIT // 2 - 1) * 2 + 2
    order = np.argsort(~bound, axis=1, kind="stable")
    active, scored = np.arange(len(queries)), 0
    for turn in range(len(edges)):
        block = order[active, turn]
        stays = bound[active, block] >= best.kth()[active]
        active, block = active[stays], block[stays]
        if not len(active):
            break
        for b in np.unique(block):
            rows = active[block == b]
            part = slice(edges[b], edges[b] + BLOCK)
            score = product(queries[rows], vectors[part])
            candidate = np.broadcast_to(ids[part], score.shape)
            own = candidate == query_ids[rows, None]
            scored += score.size
            best.add(
                rows,
                np.where(own, np.iinfo(np.int64).min, score),
                np.where(own, np.iinfo(np.int64).max, candidate),
            )
    return scored


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """The k highest integer inner products of each query with all other vectors:
    (query_id, rank from 1, vec_id, score), all if there are fewer, ties to the smaller id.

    Components become floor(scale * x). Vectors that are NULL, empty, or hold a NULL, non-finite or
    huge component (2**62 or more when scaled) take no part, nor rows with a NULL id; products are
    taken between vectors of one length. A score that does not fit a long is an error. A query's candidates are the rows with another id; rows that repeat an id are
    candidates each, and a repeated query row gives its answer once.

    The index has rows of ``BLOCKS`` blocks in order of id, each with its vectors (forward index).
    Groups of queries and index rows meet in the cells of a grid, each pair once: a group is sent to
    the cells of its line, an index row to those of its column. A task keeps the best k of a query
    while it goes through index rows, so its k-th score prunes the later ones. What tasks found for
    a query is merged by rank; Spark cuts each task's part to k rows before the shuffle.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), scale).alias("vector"),
        is_query.alias("asks"),
    ).where(F.col("id").isNotNull() & F.col("vector").isNotNull())
    index = packed(rows.select("id", "vector"), parts, BLOCK * BLOCKS, "place")
    asked = rows.where("asks").select("id", "vector").distinct()
    groups = packed(asked, max(1, parts // 4), QUERIES, "group")
    lines = max(1, round(math.sqrt(parts * groups.count() / max(1, index.count()))))
    columns = math.ceil(parts / lines)
    queries_at = groups.select(
        "dims", "group", F.col("ids").alias("query_ids"), F.col("values").alias("query_values"),
        F.col("width").alias("query_width"),
        F.pmod("group", F.lit(lines)).alias("line"),
        F.explode(F.sequence(F.lit(0), F.lit(columns - 1)).cast("array<long>")).alias("column"),
    )
    vectors_at = index.select(
        "dims", "ids", "values", "width",
        F.pmod("place", F.lit(columns)).alias("column"),
        F.explode(F.sequence(F.lit(0), F.lit(lines - 1)).cast("array<long>")).alias("line"),
    )
    units = queries_at.join(vectors_at, ["dims", "line", "column"]).sortWithinPartitions("group")

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, best, queries, query_ids = None, None, None, None

        def found() -> pd.DataFrame:
            n, at = np.nonzero(best.id != np.iinfo(np.int64).max)
            return pd.DataFrame(
                {"group": group, "row": n, "query_id": query_ids[n], "vec_id": best.id[n, at], "score": best.score[n, at]}
            )

        for pdf in batches:
            for unit in pdf.itertuples(index=False):
                if group != unit.group:
                    if best is not None:
                        yield found()
                    group = unit.group
                    query_ids, queries = unpacked(unit.query_ids, unit.query_values, unit.query_width, unit.dims)
                    best = Best(len(query_ids), k)
                ids, values = unpacked(unit.ids, unit.values, unit.width, unit.dims)
                search_blocks(best, query_ids, queries, ids, values)
        if best is not None:
            yield found()

    found = units.mapInPandas(searched, "group long, row int, query_id long, vec_id long, score long")
    place = Window.partitionBy("group", "row").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
