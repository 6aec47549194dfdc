"""Exact ranked lexical search by two trees, one over items and one over documents.

Each node holds for every term the greatest value below it: of a term's weight in items, of its
frequency part in documents. The inner product of two nodes bounds the scores of all their pairs, so
a pair of nodes whose bound is under the weakest k-th score of its items is left with all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.running import ordered_ids, total_before
from stayflow.llm.store import checkpointed
from stayflow.llm.topk import Best

#: Documents of a tree, of a leaf, and nodes below a node.
TREE_DOCS, LEAF_DOCS, FAN = 4096, 32, 8
#: Items of a leaf of the other tree.
LEAF_ITEMS = 8
#: Characters of the items that are searched for at a time, and terms kept of a tree at most.
BLOCK_CHARS, TREE_TERMS = 400_000, 600_000
#: One of so many trees is searched first, for the floor of the k-th scores in the others.
FIRST = 16
#: Letters of terms as they are, ASCII capitals as small ones, everything else white space.
FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII; only A-Z are folded."""
    return text.encode().translate(FOLD).split() if text else []


@dataclass
class Documents:
    """Documents that hold a term of the items: their places, sizes, and (row, term, frequency)."""

    places: np.ndarray
    sizes: np.ndarray
    row: np.ndarray
    term: np.ndarray
    tf: np.ndarray

    COLUMNS = ["places", "sizes", "row", "term", "tf"]
    KINDS = [np.int64, np.int64, np.int32, np.int32, np.int64]

    def packed(self) -> list[pa.Array]:
        columns = (getattr(self, c).astype(k).tobytes() for c, k in zip(self.COLUMNS, self.KINDS))
        return [pa.array([c], pa.binary()) for c in columns]

    @classmethod
    def unpacked(cls, batch: pa.RecordBatch, n: int) -> Documents:
        return cls(*(np.frombuffer(batch.column(c)[n].as_py(), k) for c, k in zip(cls.COLUMNS, cls.KINDS)))


PACKED = ", ".join(f"{c} binary" for c in Documents.COLUMNS) + ", n_docs long, n_terms long"


def indexed(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Trees' worth of documents in packed rows, with the number of all documents with a term and of
    all their terms. ``vocabulary`` is that of one block of items, bounded by its characters."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, n_known = known.value.get, len(known.value)
        places, sizes, ids, counts, n_docs, n_terms = [], [], [], [], 0, 0

        def row() -> pa.RecordBatch:
            keys = np.repeat(np.arange(len(places)), counts) * n_known + np.array(ids, np.int64)
            keys, tf = np.unique(keys, return_counts=True)
            found = Documents(np.array(places), np.array(sizes), keys // max(1, n_known), keys % max(1, n_known), tf)
            totals = [pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64())]
            return pa.RecordBatch.from_arrays([*found.packed(), *totals], [*Documents.COLUMNS, "n_docs", "n_terms"])

        for batch in batches:
            for place, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + len(terms)
                met = [i for i in map(get, terms) if i is not None]
                if met:
                    places.append(place)
                    sizes.append(len(terms))
                    counts.append(len(met))
                    ids += met
                    if len(places) >= TREE_DOCS or len(ids) >= TREE_TERMS:
                        yield row()
                        places, sizes, ids, counts, n_docs, n_terms = [], [], [], [], 0, 0
        if n_docs:
            yield row()

    return checkpointed(docs.select("place", "text").mapInArrow(pack, PACKED))


def document_frequencies(index: DataFrame, n_known: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_known, np.int64)
        for batch in batches:
            for term in batch.column(0):
                total += np.bincount(np.frombuffer(term.as_py(), np.int32), minlength=n_known)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["term", "df"])

    found = index.select("term").mapInArrow(counted, "term long, df long")
    sums = found.groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(n_known, np.int64)
    df[sums["term"].to_numpy(np.int64)] = sums["df"]
    return df


@dataclass
class ItemNode:
    """Items (numbers in the block), the terms of any of them, and each term's weight (0 where the
    node holds no item with it: weights do not depend on the item)."""

    items: np.ndarray
    terms: np.ndarray
    below: list[ItemNode] = field(default_factory=list)


def item_tree(terms: list[np.ndarray], weight: np.ndarray) -> ItemNode | None:
    """Items in the order of their rarest terms, so that neighbours share them; leaves of
    ``LEAF_ITEMS``, ``FAN`` nodes below a node. Items without a term of positive weight are left out."""
    terms = [t[weight[t] > 0] for t in terms]
    order = sorted((i for i, t in enumerate(terms) if len(t)), key=lambda i: sorted(-weight[terms[i]])[:4])
    level = []
    for at in range(0, len(order), LEAF_ITEMS):
        items = np.array(order[at : at + LEAF_ITEMS])
        level.append(ItemNode(items, np.unique(np.concatenate([terms[i] for i in items]))))
    while len(level) > 1:
        groups = [level[at : at + FAN] for at in range(0, len(level), FAN)]
        level = [
            ItemNode(np.concatenate([n.items for n in g]), np.unique(np.concatenate([n.terms for n in g])), g)
            for g in groups
        ]
    return level[0] if level else None


class DocumentTree:
    """Documents of a packed row with their frequency parts; dense maxima of each level's nodes."""

    def __init__(self, docs: Documents, n_all: int, n_terms: int):
        m = 10 + 90 * docs.sizes * n_all // n_terms
        part = 1_000_000_000 * docs.tf // (1000 * docs.tf + 8 * m[docs.row])
        self.known, column = np.unique(docs.term, return_inverse=True)
        # Documents with the same strong terms stand together: near copies share leaves.
        strong = np.lexsort((-part, docs.row))
        heads = np.searchsorted(docs.row[strong], np.arange(len(docs.places)))
        order = np.lexsort((docs.sizes, docs.term[strong][heads]))
        line = np.empty(len(order), np.int64)
        line[order] = np.arange(len(order))
        self.places = docs.places[order]
        by_line = np.argsort(line[docs.row], kind="stable")
        self.row, self.column, self.part = line[docs.row][by_line], column[by_line], part[by_line]
        self.first = np.searchsorted(self.row, np.arange(0, len(order) + LEAF_DOCS, LEAF_DOCS))
        n = -(-len(order) // LEAF_DOCS)
        leaves = np.zeros((n, len(self.known)))
        # Entries are put in ascending order, so the greatest of a place is the one that stays.
        upward = np.argsort(self.part, kind="stable")
        leaves[self.row[upward] // LEAF_DOCS, self.column[upward]] = self.part[upward]
        self.levels = [leaves]
        while len(self.levels[0]) > 1:
            edges = np.arange(0, len(self.levels[0]), FAN)
            self.levels.insert(0, np.maximum.reduceat(self.levels[0], edges, axis=0))
        self.leaf = -1
        self.values = np.zeros((LEAF_DOCS, len(self.known)))

    def columns(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the terms occur in the tree, and their columns."""
        at = np.minimum(np.searchsorted(self.known, terms), len(self.known) - 1)
        met = self.known[at] == terms
        return met, at[met]

    def documents(self, leaf: int) -> np.ndarray:
        """Frequency parts of the documents of a leaf, dense."""
        if leaf != self.leaf:
            self.values[:] = 0
            at = slice(self.first[leaf], self.first[leaf + 1])
            self.values[self.row[at] - leaf * LEAF_DOCS, self.column[at]] = self.part[at]
            self.leaf = leaf
        return self.values[: len(self.places) - leaf * LEAF_DOCS]


def inner(parts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while all sums stay under 2**53."""
    if parts.shape[1] * parts.max(initial=0) * weights.max(initial=0) < 2.0**53:
        return parts @ weights
    return parts.astype(np.int64) @ weights.astype(np.int64)


class Search:
    """The best documents of a block of items, over any number of document trees."""

    def __init__(self, root: ItemNode, terms: list[np.ndarray], weight: np.ndarray, k: int, floor: np.ndarray):
        self.root, self.terms, self.weight, self.floor = root, terms, weight.astype(np.float64), floor
        self.best = Best(len(terms), k)
        self.scored = 0

    def least(self, items: np.ndarray) -> int:
        """The weakest k-th score of some items; a score of 0 is none."""
        return int(np.maximum(np.maximum(self.best.kth()[items], self.floor[items]), 1).min())

    def run(self, tree: DocumentTree) -> None:
        self.visit(self.root, tree, 0, np.array([0]))

    def visit(self, node: ItemNode, tree: DocumentTree, level: int, nodes: np.ndarray) -> None:
        """Go down with a node of items and those nodes of a level of documents that may matter."""
        met, columns = tree.columns(node.terms)
        weights = self.weight[node.terms[met]]
        bound = inner(tree.levels[level][np.ix_(nodes, columns)], weights)
        order = np.argsort(-bound, kind="stable")
        nodes, bound = nodes[order], bound[order]
        leaf = level + 1 == len(tree.levels)
        if leaf and not node.below:
            # One column of weights for each item: a term counts where the item has it.
            own = np.stack([np.isin(node.terms[met], self.terms[i]) for i in node.items], axis=1) * weights[:, None]
            for n, most in zip(nodes.tolist(), bound.tolist()):
                if most < self.least(node.items):
                    break
                self.score(node, tree, n, columns, own)
            return
        stays = nodes[bound >= self.least(node.items)]
        if not len(stays):
            return
        if not leaf:
            stays = (stays[:, None] * FAN + np.arange(FAN)).ravel()
            stays = stays[stays < len(tree.levels[level + 1])]
        for child in node.below or [node]:
            self.visit(child, tree, level if leaf else level + 1, stays)

    def score(self, node: ItemNode, tree: DocumentTree, leaf: int, columns: np.ndarray, own: np.ndarray) -> None:
        values = tree.documents(leaf)
        scores = inner(values[:, columns], own).astype(np.int64).T
        self.scored += scores.size
        none = np.iinfo(np.int64)
        places = np.broadcast_to(tree.places[leaf * LEAF_DOCS : leaf * LEAF_DOCS + len(values)], scores.shape)
        self.best.add(node.items, np.where(scores > 0, scores, none.min), np.where(scores > 0, places, none.max))


FOUND = "number long, place long, score long"


def search_block(index: DataFrame, numbers: np.ndarray, terms: list[np.ndarray], n_known: int, k: int) -> DataFrame | None:
    """(number, place, score): at least the k best documents of each item of a block."""
    totals = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_all, n_terms = totals
    if not n_all:
        return None
    spark = index.sparkSession
    df = document_frequencies(index, n_known)
    weight = np.array([math.floor(1000 * math.log((2 * n_all + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    root = item_tree(terms, weight)
    if root is None:
        return None
    sides = spark.sparkContext.broadcast((root, terms, weight, numbers))

    def searched(floor: np.ndarray):
        floors = spark.sparkContext.broadcast(floor)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            root, terms, weight, numbers = sides.value
            found = Search(root, terms, weight, k, floors.value)
            for batch in batches:
                for n in range(batch.num_rows):
                    docs = Documents.unpacked(batch, n)
                    if len(docs.places):
                        found.run(DocumentTree(docs, n_all, n_terms))
            # Under the floor nothing can be among the best.
            at = np.nonzero(found.best.score >= np.maximum(found.floor, 1)[:, None])
            columns = [numbers[at[0]], found.best.id[at], found.best.score[at]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["number", "place", "score"])

        return search

    # A few trees are searched first: their k-th scores are floors for the others.
    turn = F.pmod(F.xxhash64("places", "term"), F.lit(FIRST))
    none = np.zeros(len(terms), np.int64)
    first = checkpointed(best_of(index.where(turn == 0).mapInArrow(searched(none), FOUND), k))
    kth = first.where(F.col("rank") == k).select("number", "score").toPandas()
    floor = none.copy()
    floor[np.searchsorted(numbers, kth["number"].to_numpy(np.int64))] = kth["score"]
    rest = index.where(turn != 0).mapInArrow(searched(floor), FOUND)
    return first.select("number", "place", "score").unionByName(rest)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of each number, ranked from 1; ties go to the smaller place."""
    line = Window.partitionBy("number").orderBy(F.col("score").desc(), "place")
    return found.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents with the highest scores above 0 of each
    item, all if there are fewer; ties go to the smaller doc_id, NULL last.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, in whole texts; A-Z
    count as a-z. With N documents that hold a term, L terms in them and df documents that hold a
    term, its weight is floor(1000 ln((2N + 2) / (2df + 1))); a document of n terms has
    m = 10 + 90 n N div L, and scores the sum of weight * (10^9 tf div (1000 tf + 8 m)) over the
    item's distinct terms, in 64-bit integers. NULL and empty texts have no terms, count nowhere and
    find nothing. Rows that repeat an id are documents, or items, each. Empty tables give no rows;
    other columns are not looked at.

    Items are taken in blocks of ``BLOCK_CHARS`` characters, whose terms and tree are broadcast; for
    each block the documents are read once. No task holds more than one tree of documents.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = ordered_ids(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id")
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).where(F.length("text") > 0)
    asked = checkpointed(
        asked.withColumn("number", F.monotonically_increasing_id()).withColumn("deal", F.pmod("number", F.lit(parts)))
    )
    placed = total_before(asked, F.length("text").cast("long"), [], "deal", ["number"], "before")
    asked = checkpointed(placed.withColumn("block", F.floor(F.col("before") / BLOCK_CHARS)))
    found = None
    for block in range((asked.agg(F.max("block")).first()[0] or 0) + 1):
        # One block: its size is bounded by BLOCK_CHARS and one item more.
        part = asked.where(F.col("block") == block).select("number", "text").orderBy("number").toPandas()
        own = [set(terms_of(t)) for t in part["text"]]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*own)))}
        if not vocabulary:
            continue
        terms = [np.array(sorted(map(vocabulary.__getitem__, t)), np.int64) for t in own]
        index = indexed(rows, vocabulary)
        result = search_block(index, part["number"].to_numpy(np.int64), terms, len(vocabulary), k)
        if result is not None:
            found = result if found is None else found.unionByName(result)
    kind = rows.schema["doc_id"].dataType
    if found is None:
        found = spark.createDataFrame([], FOUND)
    ranked = best_of(found, k).join(asked.select("number", "item_id"), "number")
    if kind.typeName() in {"byte", "short", "integer", "long"}:
        doc_id = F.when(F.col("place") < 2**63 - 1, F.col("place")).cast(kind).alias("doc_id")
    else:
        # A rank stands for one value of the id.
        ids = rows.select("place", "doc_id").distinct()
        ranked, doc_id = ranked.join(ids, "place"), F.col("doc_id")
    return ranked.select("item_id", "rank", doc_id, "score")
