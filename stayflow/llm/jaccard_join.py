"""Documents with similar word shingles: a MinHash LSH forest with exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.mixing import WORD
from stayflow.llm.shingles import mixed, shingle_set
from stayflow.llm.store import checkpointed

#: Trees whose buckets decide early that a bucket of a later tree has nothing of its own.
GUARD_TREES = 4
#: Documents, and shingles, of a block; a larger bucket is compared block by block.
BLOCK_ROWS, BLOCK_SHINGLES = 256, 2_000_000
PART_ROWS = 1024
#: Rows that a Python worker makes something of at a time.
HANDED_ROWS = 256


def signature(shingles: np.ndarray, hashes: int, seed: int) -> np.ndarray:
    """Minimum hashes (uint32) of a set that is not empty."""
    rng = np.random.Generator(np.random.PCG64(seed))
    flip = rng.integers(0, 2**32, hashes, dtype=np.uint32)
    factor = rng.integers(0, 2**31, hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(hashes, 2**32 - 1, np.uint32)
    for at in range(0, len(x), PART_ROWS):
        part = (x[at : at + PART_ROWS, None] ^ flip) * factor
        np.minimum(least, (part ^ (part >> np.uint32(15))).min(axis=0), out=least)
    return least


def prefix_keys(signatures: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """64-bit keys of the first ``depth`` labels in each tree, as (rows, trees)."""
    labels = signatures.reshape(len(signatures), trees, -1)[:, :, :depth].astype(np.uint64)
    key = np.broadcast_to(np.arange(1, trees + 1, dtype=np.uint64), labels.shape[:2]).copy()
    for i in range(depth):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + labels[:, :, i])
    return key.view(np.int64)


def found_share(similarity: np.ndarray | float, trees: int, depth: int):
    """Chance that a pair of this similarity shares a prefix of this length in some tree."""
    return 1 - (1 - np.asarray(similarity) ** depth) ** trees


def handed_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A few rows at a time, so that what is made of them stays small."""
    for pdf in batches:
        for at in range(0, len(pdf), HANDED_ROWS):
            yield pdf.iloc[at : at + HANDED_ROWS]


def digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def sketches(docs: DataFrame, size: int, trees: int, depths: Sequence[int], seed: int) -> DataFrame:
    """doc_id, text_hash, content, shingles (their number), keys (of the shortest prefix in each
    tree) of every row."""

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in handed_on(batches):
            out = []
            for text in pdf["text"]:
                s = shingle_set(text, size)
                keys = None
                if len(s):
                    labels = signature(s, trees * max(depths), seed)
                    keys = prefix_keys(labels[None, :], trees, min(depths))[0]
                out.append((digest(s), len(s), keys))
            new = pd.DataFrame(out, columns=["content", "shingles", "keys"])
            yield pd.concat([pdf[["doc_id", "text_hash"]].reset_index(drop=True), new], axis=1)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInPandas(
        sketched, f"doc_id {kind}, text_hash long, content binary, shingles long, keys array<long>"
    )


def forest(members: DataFrame, trees: int, depths: Sequence[int]) -> DataFrame:
    """One row per member and tree: content, shingles, tree, and its keys, one array per depth
    that holds the keys of this tree and of the guard trees."""

    def planted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in handed_on(batches):
            labels = np.stack([np.frombuffer(x, np.uint32) for x in pdf["labels"]])
            n = len(pdf)
            out = {
                "content": np.repeat(pdf["content"].to_numpy(), trees),
                "shingles": np.repeat(pdf["shingles"].to_numpy(), trees),
                "tree": np.tile(np.arange(trees, dtype=np.int32), n),
            }
            for d in depths:
                keys = prefix_keys(labels, trees, d)
                guard = np.repeat(keys[:, :GUARD_TREES], trees, axis=0)
                out[f"keys{d}"] = list(np.concatenate([keys.reshape(-1, 1), guard], axis=1))
            yield pd.DataFrame(out)

    columns = ", ".join(f"keys{d} array<long>" for d in depths)
    return members.mapInPandas(planted, f"content binary, shingles long, tree int, {columns}")


def open_buckets(rows: DataFrame, depth: int, deeper: int | None) -> DataFrame:
    """Buckets (key, rows, shingles) at a depth that may hold pairs not compared before.

    A bucket has none if all its members also share a bucket of an earlier guard tree, or a
    prefix that was compared at the deeper level in this or a guard tree. Counted with
    map-side aggregation, so a hot bucket is one row per task.
    """
    own = F.col(f"keys{depth}")
    same = []
    for g in range(GUARD_TREES):
        earlier = F.when(F.col("tree") > g, own[g + 1])
        same.append(F.coalesce(F.min(earlier) == F.max(earlier), F.lit(False)))
    if deeper is not None:
        for g in range(GUARD_TREES + 1):
            key = F.col(f"keys{deeper}")[g]
            same.append(F.min(key) == F.max(key))
    held = same[0]
    for s in same[1:]:
        held = held | s
    return (
        rows.groupBy(own[0].alias("key"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("shingles").alias("total"), held.alias("held"))
        .where((F.col("n") > 1) & ~F.col("held"))
        .select("key", "n", "total")
    )


def block_pairs(rows: DataFrame, buckets: DataFrame, depth: int) -> DataFrame:
    """Members (key, low, high, block, tree, content) of every pair of blocks of a bucket.

    Small buckets are one block. A bucket of b blocks has b(b+1)/2 pairs, each its own group, so
    a bucket of any size is spread; each member comes b times.
    """
    blocks = F.greatest(
        F.ceil(F.col("n") / BLOCK_ROWS), F.least(F.ceil(F.col("total") / BLOCK_SHINGLES), F.col("n"))
    ).cast("int")
    placed = (
        rows.select("content", "tree", F.col(f"keys{depth}")[0].alias("key"))
        .join(buckets.withColumn("blocks", blocks), "key")
        .withColumn("block", F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int"))
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return placed.withColumn("other", other).select(
        "key",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block", "tree", "content",
    )


def overlaps(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the given pairs (rows of two indices) of sorted sets."""
    if len(pairs) * 8 <= len(sets) ** 2 or len(sets) < 16:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in pairs], np.int64)
    items = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, item, times = np.unique(items, return_inverse=True, return_counts=True)
    shared = times[item] > 1
    item, owner = item[shared], owner[shared]
    place = np.cumsum(times > 1) - 1
    column = place[item]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    step = 4096
    for at in range(0, int(place[-1]) + 1, step):
        a, b = np.searchsorted(column, [at, at + step])
        held = np.zeros((len(sets), step), np.float32)
        held[owner[a:b], column[a:b] - at] = 1
        total += held @ held.T
    return total[pairs[:, 0], pairs[:, 1]].astype(np.int64)


def verified(
    group: pd.DataFrame, trees: int, depth: int, deeper: int | None, threshold: float
) -> tuple[np.ndarray, np.ndarray] | None:
    """Links inside one pair of blocks: two index arrays.

    A pair is compared in its first common tree at this depth alone, and not if it shared a
    prefix of the deeper level in any tree, so over all groups every pair is compared once.
    """
    low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
    labels = np.stack([np.frombuffer(x, np.uint32) for x in group["labels"]])
    tree = int(group["tree"].iloc[0])
    block = group["block"].to_numpy()
    n = len(group)
    if low == high:
        wanted = np.triu(np.ones((n, n), bool), 1)
    else:
        wanted = (block == low)[:, None] & (block == high)[None, :]
    keys = prefix_keys(labels, trees, depth)
    for t in range(tree):
        wanted &= keys[:, None, t] != keys[None, :, t]
    if deeper is not None:
        keys = prefix_keys(labels, trees, deeper)
        for t in range(trees):
            wanted &= keys[:, None, t] != keys[None, :, t]
    sizes = group["shingles"].to_numpy()
    wanted &= np.minimum(sizes[:, None], sizes[None, :]) >= threshold * np.maximum(sizes[:, None], sizes[None, :]) - 1e-9
    pairs = np.argwhere(wanted)
    if not len(pairs):
        return None
    sets = [np.frombuffer(x, np.uint64) for x in group["items"]]
    both = overlaps(sets, pairs)
    similarity = both / (sizes[pairs[:, 0]] + sizes[pairs[:, 1]] - both)
    linked = similarity >= threshold
    if not linked.any():
        return None
    return pairs[linked, 0], pairs[linked, 1]


def compare_blocks(
    groups: DataFrame, trees: int, depth: int, deeper: int | None, threshold: float
) -> DataFrame:
    """Rows (content, root, links): for each document of a group that has links, how many documents
    it is linked with there and the root of its local component."""

    def summary(group: pd.DataFrame) -> pd.DataFrame | None:
        found = verified(group, trees, depth, deeper, threshold)
        if found is None:
            return None
        a, b = found
        copies = group["copies"].to_numpy()
        links = np.bincount(a, copies[b], len(group)) + np.bincount(b, copies[a], len(group))
        root = np.arange(len(group))
        while True:
            before = root.copy()
            np.minimum.at(root, a, root[b])
            np.minimum.at(root, b, root[a])
            root = root[root]
            if (root == before).all():
                break
        use = np.flatnonzero(links)
        content = group["content"].to_numpy()
        return pd.DataFrame(
            {"content": content[use], "root": content[root[use]], "links": links[use].astype(np.int64)}
        )

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by group; the last group of a batch may go on in the next.
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if not len(pdf):
                continue
            ids = pdf[["key", "low", "high"]].to_numpy()
            cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            edges = [0, *cuts, len(pdf)]
            out = [summary(pdf.iloc[a:b].reset_index(drop=True)) for a, b in zip(edges[:-2], edges[1:-1])]
            out = [x for x in out if x is not None]
            if out:
                yield pd.concat(out, ignore_index=True)
            rest = pdf.iloc[edges[-2] :].reset_index(drop=True)
        if rest is not None and len(rest):
            out = summary(rest)
            if out is not None:
                yield out

    dealt = groups.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInPandas(compared, "content binary, root binary, links long")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): (node, label), the label the least node.

    Each round every node takes the least label next to it and then its label's label, so paths
    are halved. Aggregations combine on the map side and joins carry no group requirement above
    them, so a node with very many edges is spread. One checkpoint a round.
    """
    both = checkpointed(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy("a").agg(F.min("label").alias("near"))
            .withColumnRenamed("a", "node")
        )
        step = labels.join(near, "node").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("old")
        )
        heads = labels.select(F.col("node").alias("label"), F.col("label").alias("head"))
        moved = checkpointed(
            step.join(heads, "label").select("node", F.least("label", "head").alias("label"), "old")
        )
        changed = moved.where(F.col("label") != F.col("old")).limit(1).count()
        labels = moved.drop("old")
        if not changed:
            return labels


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    trees: int = 20,
    depths: Sequence[int] = (8, 5),
    target_recall: float = 0.999,
    seed: int = 11,
) -> DataFrame:
    """Links between documents whose sets of word shingles have a Jaccard similarity of at least
    ``threshold``: one row per input row with

    - ``doc_id``, ``content`` (16 bytes, equal for equal shingle sets),
    - ``class_id``: the least id of its connected component of links, copies included,
    - ``class_content``: the least ``content`` of that component, which names it even where ids repeat
      or are missing; NULL without words,
    - ``n_links``: the number of other rows it is linked with, copies included,
    - ``copies``: the rows with the same shingle set, itself included,
    - ``text_hash``: 64 bits of its text, which with the id tell its row from others.

    Words are what stands between ASCII white space, as written; a text of fewer words is one
    shingle. Rows with NULL or blank text have no shingles: they are linked with nothing, and
    their class is their own id. NULL ids take part; a class has a NULL id only if all its rows
    have. Rows that repeat an id are rows of their own. Other columns are not looked at.

    Method: equal sets become one member with a count. A member's minimum hashes are its labels in
    ``trees`` prefix tries; members that share the first ``depths[0]`` labels in some tree are
    compared first, and prefixes are shortened to the next depth until a pair at ``threshold`` itself
    is found with a chance of ``target_recall``, or no bucket of the next depth may hold a pair that
    was not compared. So what is found of one group does not depend on other groups. At the last
    depth, 5 of 20 trees, a pair at 0.8 is found with 0.9996. Every candidate is verified on its
    whole shingle set. Buckets of any size are compared in blocks; pairs are counted inside
    the tasks and never become rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    sketched = checkpointed(sketches(rows, size, trees, depths, seed))
    # A member's text is found again by its id and the hash of its text, so that rows without an id
    # or with one id meet their own member only.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash"))
    members = checkpointed(
        sketched.where(F.col("content").isNotNull())
        .groupBy("content")
        .agg(
            first["doc_id"].alias("first_id"),
            first["text_hash"].alias("first_hash"),
            F.count(F.lit(1)).alias("copies"),
            F.first("shingles").alias("shingles"),
            F.first("keys").alias("keys"),
        )
    )
    depths = sorted(depths, reverse=True)
    links = _links(rows, members, size, threshold, trees, depths, target_recall, seed)
    found = links.groupBy("content").agg(F.sum("links").alias("links"))
    edges = links.where(F.col("content") != F.col("root")).select(
        F.col("content").alias("a"), F.col("root").alias("b")
    )
    labels = components(edges)
    placed = (
        members.select("content", "first_id", "copies")
        .join(labels.withColumnRenamed("node", "content"), "content", "left")
        .join(found, "content", "left")
        .withColumn("label", F.coalesce("label", "content"))
    )
    heads = placed.groupBy("label").agg(F.min("first_id").alias("class_id"))
    classes = placed.join(heads, "label").select(
        F.col("content").alias("of"), "label", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links")
    )
    return sketched.join(classes, sketched["content"] == classes["of"], "left").select(
        "doc_id",
        "content",
        F.when(F.col("content").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.col("label").alias("class_content"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
        "text_hash",
    )


def _links(rows, members, size, threshold, trees, depths, target_recall, seed) -> DataFrame:
    """Rows (content, root, links) of all levels that were needed."""
    # Two numbers a row decide which members share a bucket of the shortest prefix at all.
    keys = members.select(F.explode("keys").alias("key"), F.xxhash64("content").alias("member"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("key")
    near = keys.join(shared, "key").select("member").distinct()
    wanted = members.drop("keys").withColumn("member", F.xxhash64("content")).join(near, "member").drop("member")
    items = checkpointed(_items(rows, checkpointed(wanted), size, trees * max(depths), seed))
    planted = forest(items.select("content", "shingles", "labels"), trees, depths)
    levels = []
    for i, depth in enumerate(depths):
        deeper = depths[i - 1] if i else None
        buckets = checkpointed(open_buckets(planted, depth, deeper))
        if levels and buckets.isEmpty():
            continue
        groups = block_pairs(planted, buckets, depth).join(items, "content")
        levels.append(checkpointed(compare_blocks(groups, trees, depth, deeper, threshold)))
        if found_share(threshold, trees, depth) >= target_recall:
            break
    done = levels[0]
    for level in levels[1:]:
        done = done.union(level)
    return done


def _items(rows: DataFrame, wanted: DataFrame, size: int, hashes: int, seed: int) -> DataFrame:
    """The wanted members with their labels and whole shingle sets: content, copies, shingles,
    labels, items."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in handed_on(batches):
            out = []
            for content, text in zip(pdf["content"], pdf["text"]):
                s = shingle_set(text, size)
                if digest(s) == content:
                    out.append((content, signature(s, hashes, seed).tobytes(), s.tobytes()))
            yield pd.DataFrame(out, columns=["content", "labels", "items"])

    texts = rows.join(
        wanted.select("content", "first_id", "first_hash"),
        F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash")),
    ).select("content", "text")
    # Equal rows may repeat: one of them counts, and only with this content.
    items = texts.mapInPandas(listed, "content binary, labels binary, items binary")
    return wanted.drop("first_id", "first_hash").join(items.dropDuplicates(["content"]), "content")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the row with the least id.

    Rows without words stay. Of rows that repeat an id and a shingle set one stays. NULL ids
    come last. The columns are those of ``docs``.
    """
    joined = checkpointed(jaccard_join(docs, id_col, text_col, **options)).where(F.col("content").isNotNull())
    first = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "content", "text_hash")
    chosen = joined.groupBy("class_content").agg(F.min(first).alias("first")).select("first.*")
    same_rows = joined.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times"))
    kept = chosen.join(
        same_rows,
        (chosen["text_hash"] == same_rows["text_hash"]) & chosen["doc_id"].eqNullSafe(same_rows["doc_id"]),
    ).select(chosen["doc_id"].alias("kept_id"), chosen["text_hash"].alias("kept_hash"), "times")
    has_words = F.coalesce(F.col(text_col).rlike(WORD), F.lit(False))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    whole = docs.where(has_words).select(row, F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"))
    worded = whole.join(
        kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    )
    # Only rows that repeat id and text need an order; the others pass without a shuffle.
    again = F.row_number().over(Window.partitionBy("text_hash", "id").orderBy(F.lit(1)))
    repeated = worded.where("times > 1").withColumn("again", again).where("again = 1")
    stay = worded.where("times = 1").select("row").union(repeated.select("row"))
    stay = stay.union(docs.where(~has_words).select(row))
    return stay.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
