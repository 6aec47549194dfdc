"""Decision trees, forests and boosting of many models, a level of all of them in one pass.

The rules are MLlib's: quantile bins, Gini or variance gains, leaves of one class merged, boosting of
the log loss on labels -1 and 1. The rows are binned once into kept blocks. A pass returns sums per node,
feature and bin; a second step adds them and keeps each node's best split, so the driver gets a
few numbers a node. Models may leave out a fold, so a cross-validation is one search.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property, lru_cache, partial
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import RDD, Broadcast, StorageLevel, inheritable_thread_target
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins of a feature, and the rows that its marks are learned from (MLlib's numbers).
MAX_BINS, MARK_ROWS = 32, 10_000
#: Rows of a block, sums of one pass, and boosting rounds after which margins are stored.
BLOCK_ROWS, CELLS, REFRESH = 16_384, 8_000_000, 2
#: Values of a code that holds several columns, and bytes of sums that the driver may add up itself.
CODES, DRIVER_BYTES = 256, 16 << 20
#: Rows for which each core gets one more part of the blocks.
PART_ROWS = 10_000_000
LEAST_GAIN = 1e-12
BLOCKS = "block long, n int, codes binary, label binary, fold binary"


@dataclass(frozen=True)
class TreeProblem:
    """One model; ``features`` is the number tried at a split, ``sampled`` the share of rows a tree sees."""

    kind: str
    trees: int = 1
    depth: int = 5
    least: int = 1
    features: str = "all"
    sampled: float = 1.0
    step: float = 0.1
    weights: tuple[float, float] = (1.0, 1.0)
    seed: int = 42
    left_out: int | None = None

    @property
    def boosted(self) -> bool:
        return self.kind == "gradient_boosting"

    # The settings by MLlib's names, as callers of ``training.estimator`` read them.

    def getNumTrees(self) -> int:  # noqa: N802
        return self.trees

    def getMinInstancesPerNode(self) -> int:  # noqa: N802
        return self.least

    def getFeatureSubsetStrategy(self) -> str:  # noqa: N802
        return self.features

    def getSubsamplingRate(self) -> float:  # noqa: N802
        return self.sampled


@dataclass
class Tree:
    """Nodes as parallel lists; a leaf is its own left child, a right child follows the left one."""

    feature: list = field(default_factory=list)
    mark: list = field(default_factory=list)
    left: list = field(default_factory=list)
    sums: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    depth: int = 0

    def add(self, sums) -> int:
        at = len(self.feature)
        for held, value in zip(
            (self.feature, self.mark, self.left, self.sums, self.gain), (0, 0, at, sums, 0.0)
        ):
            held.append(value)
        return at

    def arrays(self) -> tuple[np.ndarray, ...]:
        """(feature, mark, left) to walk by; no bin lies above the mark of a leaf."""
        left = np.array(self.left, np.int64)
        mark = np.where(left == np.arange(len(left)), MAX_BINS, np.array(self.mark, np.int64))
        return np.array(self.feature, np.int64), mark, left


@dataclass
class TreeModel:
    """A fitted model: per tree (feature, cut, left, value, depth); leaves hold the probability of the
    positive class, or a step of the margin in boosting."""

    kind: str
    width: int
    trees: list
    importances: list

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 (as in MLlib)
        return Vectors.dense(self.importances)

    def scores(self, x: np.ndarray) -> np.ndarray:
        flat, at = x.ravel(), np.arange(len(x)) * x.shape[1]
        total = np.zeros(len(x))
        for feature, cut, left, value, depth in self.trees:
            feature, cut, left, value = map(np.asarray, (feature, cut, left, value))
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = left.take(node) + (flat.take(feature.take(node) + at) > cut.take(node))
            total += value[node]
        return 1 / (1 + np.exp(-2 * total)) if self.kind == "gradient_boosting" else total / len(self.trees)

    def probability(self, features: Column) -> Column:
        model, width = self, self.width

        @F.arrow_udf("double")
        def scored(values: pa.Array) -> pa.Array:
            x = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            return pa.array(model.scores(x))

        return scored(features)


# ---- bins -------------------------------------------------------------------


def marks_of(values: np.ndarray, weights: np.ndarray, bins: int = MAX_BINS) -> np.ndarray:
    """Ascending cuts between the values: between all of few, at equal shares of the weight of many."""
    distinct, place = np.unique(values, return_inverse=True)
    counts = np.bincount(place, weights, len(distinct))
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) < bins:
        return middles
    stride = counts.sum() / bins
    out, target, covered = [], stride, counts[0]
    for i in range(1, len(distinct)):
        before, covered = covered, covered + counts[i]
        if abs(before - target) < abs(covered - target):
            out.append(middles[i - 1])
            target += stride
    return np.array(out)


def bin_marks(some: DataFrame, weightings: Sequence[tuple[float, float]], total: int) -> list[list[np.ndarray]]:
    """For each weighting the marks of each feature, from (features, label) rows that stand for ``total``."""
    held = some.toArrow()
    if not held.num_rows:
        return [[] for _ in weightings]
    x = held.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(held.num_rows, -1)
    label = held.column("label").to_numpy().astype(int)
    return [[marks_of(c, np.array(w)[label], max(2, min(MAX_BINS, total))) for c in x.T] for w in weightings]


def all_marks(rows: DataFrame, kinds: Sequence[tuple], total: int) -> list[list[np.ndarray]]:
    """Marks of each (fold left out, weights, seed), from all its rows or a seeded sample of about
    MARK_ROWS (as MLlib does). Kinds that differ in their weights share the sample."""
    samples: dict[tuple, list[int]] = {}
    for i, (left_out, _, seed) in enumerate(kinds):
        samples.setdefault((left_out, seed), []).append(i)
    sizes = {}
    if any(k is not None for k, _ in samples):
        sizes = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}

    def learned(left_out: int | None, seed: int) -> list[list[np.ndarray]]:
        some, n = rows.select("features", "label"), total
        if left_out is not None:
            some = rows.filter(F.col("fold") != left_out).select("features", "label")
            n = sum(c for f, c in sizes.items() if f is not None and f != left_out)
        if n > MARK_ROWS:
            some = some.sample(fraction=MARK_ROWS / n, seed=seed)
        return bin_marks(some, [kinds[i][1] for i in samples[left_out, seed]], n)

    with ThreadPool(min(4, len(samples))) as pool:
        found = pool.starmap(inheritable_thread_target(rows.sparkSession)(learned), list(samples))
    by_kind = {i: marks for places, sets in zip(samples.values(), found) for i, marks in zip(places, sets)}
    return [by_kind[i] for i in range(len(kinds))]


@dataclass(frozen=True)
class Layout:
    """Where a block holds the bins: a code of one byte for one or more columns.

    A column is a feature with its marks; sets of marks that agree on a feature share it. Columns with
    few bins lie together in a code, so that one count of its values has the counts of them all.
    """

    columns: list[tuple[int, np.ndarray]]
    codes: list[list[int]]
    sizes: list[int]
    #: Per set and feature: the code, and what its value is divided by and then taken modulo.
    place: np.ndarray
    radix: np.ndarray
    bins: np.ndarray

    @staticmethod
    def of(sets: Sequence[Sequence[np.ndarray]], together: int) -> Layout:
        """Columns lie together as long as their code has at most ``together`` values."""
        columns: dict[tuple, int] = {}
        found, users = [], []
        at = np.zeros((len(sets), len(sets[0])), np.int64)
        for s, marks in enumerate(sets):
            for f, m in enumerate(marks):
                c = at[s, f] = columns.setdefault((f, m.tobytes()), len(columns))
                if c == len(found):
                    found.append((f, m))
                    users.append([])
                users[c].append(s)
        codes, sizes, who = [], [], []
        column_code, column_radix = np.zeros((2, len(found)), np.int64)
        for c, (_, m) in enumerate(found):
            fits = [k for k in range(len(codes)) if who[k] == users[c] and sizes[k] * (len(m) + 1) <= together]
            if not fits:
                fits = [len(codes)]
                codes.append([])
                sizes.append(1)
                who.append(users[c])
            k = fits[0]
            column_code[c], column_radix[c] = k, sizes[k]
            codes[k].append(c)
            sizes[k] *= len(m) + 1
        bins = np.array([len(m) + 1 for _, m in found], np.int64)
        return Layout(found, codes, sizes, column_code[at], column_radix[at], bins[at])

    def coded(self, x: np.ndarray) -> np.ndarray:
        """The codes of rows, a line a code."""
        out = np.zeros((len(self.codes), len(x)), np.uint8)
        for line, columns in zip(out, self.codes):
            radix = 1
            for f, marks in (self.columns[c] for c in columns):
                line += (np.searchsorted(marks, x[:, f], side="left") * radix).astype(np.uint8)
                radix *= len(marks) + 1
        return out

    def walker(self, tree: tuple, s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code, left, whether each value of the code goes right) of each node of a tree, to walk by."""
        feature, mark, left = tree[:3]
        values = np.arange(max(self.sizes))
        bins = values // self.radix[s, feature][:, None] % self.bins[s, feature][:, None]
        return self.place[s, feature], left, (bins > mark[:, None]).view(np.uint8)

    @cached_property
    def parts(self) -> list[tuple[np.ndarray, list[tuple[int, int, int]]]]:
        """Per code which value counts for which bin (0 or 1), and (feature, first, last) of its columns."""
        out = []
        for size, columns in zip(self.sizes, self.codes):
            radix, lines, places = 1, [], []
            for f, marks in (self.columns[c] for c in columns):
                bins = np.arange(len(marks) + 1)
                lines.append(np.arange(size)[:, None] // radix % len(bins) == bins)
                at = places[-1][2] if places else 0
                places.append((f, at, at + len(bins)))
                radix *= len(bins)
            out.append((np.concatenate(lines, axis=1).astype(float), places))
        return out

    def by_feature(self, counts: dict[int, np.ndarray], nodes: int) -> np.ndarray:
        """Sums of each (feature, node, bin, class) from those of each code's (node, class, value)."""
        out = np.zeros((self.place.shape[1], nodes, MAX_BINS, 2))
        for k, own in counts.items():
            matrix, places = self.parts[k]
            bins = (own.reshape(nodes * 2, -1) @ matrix).reshape(nodes, 2, -1)
            for f, first, last in places:
                out[f, :, : last - first] = bins[:, :, first:last].transpose(0, 2, 1)
        return out


def binned_blocks(rows: DataFrame, layout: Layout) -> DataFrame:
    """Blocks of rows: codes of their bins, labels and folds as bytes."""

    def block(at: int, x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> pa.RecordBatch:
        values = [at, len(y), layout.coded(x).tobytes(), y.astype(np.uint8).tobytes(), fold.astype(np.int16).tobytes()]
        kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 3
        names = ["block", "n", "codes", "label", "fold"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            held.append((x, b.column("label").to_numpy(zero_copy_only=False), b.column("fold").to_numpy(zero_copy_only=False)))
            if sum(len(h[1]) for h in held) >= BLOCK_ROWS:
                yield block(at, *map(np.concatenate, zip(*held)))
                at, held = at + 1, []
        if held:
            yield block(at, *map(np.concatenate, zip(*held)))

    return rows.select("features", F.col("label").cast("int").alias("label"), F.col("fold").cast("int").alias("fold")).mapInArrow(made, BLOCKS)


# ---- one pass -----------------------------------------------------------------


def reached(walker: tuple, depth: int, flat: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The node of each row ``at`` of a block whose codes are ``flat``."""
    code, left, right = walker
    if not depth:
        return np.zeros(len(at), np.int64)
    start, values, right = code * n, right.shape[1], right.ravel()
    # All rows are at the root first.
    node = left[0] + right.take(flat[at + start[0]])
    for _ in range(depth - 1):
        value = flat.take(start.take(node) + at)
        node = left.take(node) + right.take(node * values + value)
    return node


def read_block(row: tuple) -> tuple:
    """(block, rows, codes, labels, folds, stored margins or None)."""
    at, n, codes, label, fold, margins = row
    stored = np.frombuffer(margins).reshape(-1, n) if margins else None
    return at, n, np.frombuffer(codes, np.uint8), np.frombuffer(label, np.uint8), np.frombuffer(fold, np.int16), stored


@lru_cache(8)
def poisson_counts(mean: float) -> np.ndarray:
    """Poisson counts by the inverse of their distribution, for 65,536 even draws."""
    k = np.arange(1, 16)
    below = np.cumsum(np.exp(-mean) * np.concatenate([[1.0], np.cumprod(mean / k)]))
    return np.searchsorted(below, np.arange(65_536) / 65_536, side="right").astype(np.uint8)


def seen_times(p: TreeProblem, tree: int, block: int, n: int) -> np.ndarray | None:
    """How often a tree sees each row of a block; None: once."""
    bootstrap = not p.boosted and p.trees > 1
    if not bootstrap and p.sampled >= 1:
        return None
    draws = np.random.default_rng([p.seed, block, tree]).integers(0, 65_536, n, dtype=np.uint16)
    if not bootstrap:
        return (draws < p.sampled * 65_536).astype(np.uint8)
    return poisson_counts(p.sampled).take(draws)


def margin_of(stored, row: int, recent: Sequence[tuple], flat: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    margin = np.zeros(n) if stored is None else stored[row].copy()
    for walker, value, depth in recent:
        margin += value.take(reached(walker, depth, flat, at, n))
    return margin


def walkers(layout: Layout, recent, sets_of) -> dict[int, list[tuple]]:
    return {i: [(layout.walker(tree, sets_of[i]), value, depth) for *tree, value, depth in r] for i, r in recent.items()}


def gains(counts: np.ndarray, sums: np.ndarray | None, weights, least: int) -> np.ndarray:
    """Gain of each (feature, node, bin), -inf where a side has too few rows."""
    w = np.array(weights)
    left_rows = counts.sum(axis=3).cumsum(axis=2)
    right_rows = left_rows[:, :, -1:] - left_rows
    left = (counts * w).cumsum(axis=2)
    whole = left[:, :, -1:, :]
    right = whole - left
    n, nl, nr = whole.sum(axis=3), left.sum(axis=3), right.sum(axis=3)
    with np.errstate(divide="ignore", invalid="ignore"):
        if sums is None:
            # 1 - sum of squared shares, weighted by the sides' shares of the node.
            gain = ((left**2).sum(axis=3) / nl + (right**2).sum(axis=3) / nr - (whole**2).sum(axis=3) / n) / n
        else:
            sl = (sums * w).sum(axis=3).cumsum(axis=2)
            s = sl[:, :, -1:]
            gain = (sl**2 / nl + (s - sl) ** 2 / nr - s**2 / n) / n
    return np.where((left_rows >= least) & (right_rows >= least), gain, -np.inf)


def best_splits(counts: np.ndarray, sums: np.ndarray | None, p: TreeProblem) -> np.ndarray:
    """A line per node: gain, place of the feature, mark, then counts and sums left and right."""
    nodes = counts.shape[1]
    gain = gains(counts, sums, p.weights, p.least).transpose(1, 0, 2).reshape(nodes, -1)
    best = gain.argmax(axis=1)
    at, node, mark = best // MAX_BINS, np.arange(nodes), best % MAX_BINS
    out = np.zeros((nodes, 11))
    out[:, 0], out[:, 1], out[:, 2] = gain[node, best], at, mark
    for i, part in enumerate([counts] if sums is None else [counts, sums]):
        mine = part[at, node]
        left = mine.cumsum(axis=1)[node, mark]
        out[:, 3 + 4 * i : 5 + 4 * i], out[:, 5 + 4 * i : 7 + 4 * i] = left, mine.sum(axis=1) - left
    return out


@dataclass(frozen=True)
class Work:
    """Nodes of one tree that look for a split, each with the features it may use."""

    problem: int
    tree: int
    nodes: tuple[int, ...]
    features: np.ndarray


class Sums:
    """Counts, and in boosting sums, of one work over the blocks of a task."""

    def __init__(self, p: TreeProblem, s: int, tried: np.ndarray, layout: Layout):
        self.boosted, self.set, self.tried, self.layout = p.boosted, s, tried, layout
        self.every = tried.shape[1] == layout.place.shape[1]
        self.total: list[dict[int, np.ndarray]] = [{}, {}]

    def add(self, flat: np.ndarray, n: int, place: np.ndarray, label: np.ndarray, at: np.ndarray | None, weight, value) -> None:
        """Rows ``at`` (None: all) of a block, at their node's ``place``; the one behind the last is for none."""
        nodes, width = self.tried.shape
        codes = flat.reshape(-1, n)
        node_class = 2 * place + label
        bases: dict[int, np.ndarray] = {}
        for j in dict.fromkeys(self.layout.place[self.set].tolist()) if self.every else range(width):
            values = self.layout.sizes[j] if self.every else MAX_BINS
            if values not in bases:
                bases[values] = node_class * values
            if self.every:
                key = bases[values] + (codes[j] if at is None else codes[j].take(at))
            else:
                start = self.layout.place[self.set].take(self.tried[:, j]) * n
                key = bases[values] + flat.take(start.take(place) + at)
            size = (nodes + 1) * 2 * values
            for total, w in zip(self.total, (weight, value) if self.boosted else (weight,)):
                new = np.bincount(key, w, size)[: nodes * 2 * values]
                if j in total:
                    total[j] += new
                else:
                    total[j] = new.astype(float)

    def found(self) -> tuple[np.ndarray, np.ndarray | None]:
        """(feature, node, bin, class) counts and sums."""
        nodes, width = self.tried.shape
        out = []
        for total in self.total[: 1 + self.boosted]:
            if self.every:
                out.append(self.layout.by_feature(total, nodes))
            else:
                out.append(np.stack([total[j].reshape(nodes, 2, MAX_BINS).transpose(0, 2, 1) for j in range(width)]))
        return out[0].astype(np.uint32), out[1] if self.boosted else None


def search(blocks: RDD, problems, works: Sequence[Work], grown, recent, sent: Broadcast, sets_of) -> list[np.ndarray]:
    """The best split of every node of the works, from one pass over the blocks; ``sent`` is their layout."""
    plan = []
    for w in works:
        tree = grown[w.problem][w.tree]
        slot = np.full(len(tree.feature), len(w.nodes), np.int64)
        slot[list(w.nodes)] = np.arange(len(w.nodes))
        plan.append((problems[w.problem], w.problem, w.tree, w.features, tree.arrays(), tree.depth, slot))
    rows_of = {i: row for row, i in enumerate(recent)}

    def sums(rows: Iterator[tuple]) -> Iterator[tuple]:
        total: list[Sums | None] = [None] * len(plan)
        layout = sent.value
        steps = walkers(layout, recent, sets_of)
        ways = [layout.walker(tree, sets_of[problem]) for _, problem, _, _, tree, _, _ in plan]
        for block, n, flat, label, fold, stored in map(read_block, rows):
            every = np.arange(n)
            targets: dict[int, np.ndarray] = {}
            times: dict[tuple, np.ndarray | None] = {}
            for i, (p, problem, number, tried, _, depth, slot) in enumerate(plan):
                drawn = (p.seed, p.kind, p.trees > 1, p.sampled, number)
                if drawn not in times:
                    times[drawn] = seen_times(p, number, block, n)
                often = times[drawn]
                if p.boosted and problem not in targets:
                    sign = label * 2.0 - 1
                    if number:
                        margin = margin_of(stored, rows_of[problem], steps[problem], flat, every, n)
                        sign = 4 * sign / (1 + np.exp(2 * sign * margin))
                    targets[problem] = sign
                if often is None and tried.shape[1] == layout.place.shape[1]:
                    # Most rows are looked at: the others go to a place of their own.
                    place = slot.take(reached(ways[i], depth, flat, every, n))
                    if p.left_out is not None:
                        place[fold == p.left_out] = len(tried)
                    at, weight, value, mine = None, None, targets.get(problem), label
                else:
                    held = True if p.left_out is None else fold != p.left_out
                    at = np.flatnonzero(held & (every >= 0 if often is None else often > 0))
                    place = slot.take(reached(ways[i], depth, flat, at, n))
                    looking = np.flatnonzero(place < len(tried))
                    if len(looking) < len(at):
                        at, place = at.take(looking), place.take(looking)
                    weight = None if often is None else often.take(at).astype(float)
                    value, mine = targets[problem].take(at) if p.boosted else None, label.take(at)
                    if value is not None and weight is not None:
                        value = value * weight
                    if not len(at):
                        continue
                if total[i] is None:
                    total[i] = Sums(p, sets_of[problem], tried, layout)
                total[i].add(flat, n, place, mine, at, weight, value)
        for i, t in enumerate(total):
            if t is not None:
                yield i, t.found()
                total[i] = None

    def best(found: Iterator[tuple]) -> Iterator[tuple]:
        total: dict[int, list] = {}
        for i, (counts, values) in found:
            if i in total:
                total[i][0] += counts
                if values is not None:
                    total[i][1] += values
            else:
                total[i] = [counts.astype(float), None if values is None else values.copy()]
        for i, (counts, values) in total.items():
            yield i, best_splits(counts, values, plan[i][0])

    parts = blocks.getNumPartitions()
    cells = sum(w.features.size * MAX_BINS * 2 * (3 if problems[w.problem].boosted else 1) for w in works)
    found = blocks.mapPartitions(sums)
    if 4 * cells * parts <= DRIVER_BYTES:
        lines = dict(best(iter(found.collect())))
    else:
        lines = dict(found.partitionBy(min(len(plan), parts)).mapPartitions(best).collect())
    return [lines.get(i, np.full((len(w.nodes), 11), -np.inf)) for i, w in enumerate(works)]


def with_margins(sent: Broadcast, steps: Broadcast, rows: Iterator[tuple]) -> Iterator[tuple]:
    """The blocks with the steps of the recent trees added to the stored margins."""
    recent, sets_of = steps.value
    ways = walkers(sent.value, recent, sets_of)
    for row in rows:
        _, n, flat, _, _, stored = read_block(row)
        every = np.arange(n)
        new = [margin_of(stored, i, ways[p], flat, every, n) for i, p in enumerate(recent)]
        yield (*row[:5], np.stack(new).tobytes())


def dealt(row: tuple) -> tuple[int, tuple]:
    """A block with the part it goes to: those of a task follow each other, each task begins one further on."""
    return (row[0] >> 32) + (row[0] & 0xFFFFFFFF), (*row, b"")


# ---- growing --------------------------------------------------------------------


def tried_features(rule: str, width: int) -> int:
    """Features tried at a split by MLlib's names: all, sqrt, log2, a share with a point, a number."""
    if rule == "all":
        return width
    if rule == "sqrt":
        return int(np.ceil(np.sqrt(width)))
    if rule == "log2":
        return max(1, int(np.ceil(np.log2(width))))
    if rule == "onethird":
        return int(np.ceil(width / 3))
    return max(1, min(width, int(np.ceil(float(rule) * width)) if "." in rule else int(rule)))


def values_of(tree: Tree, p: TreeProblem, first: bool) -> np.ndarray:
    """The value of each node; in classification leaves of one class have been merged."""
    sums = np.array(tree.sums)
    weighted = sums[:, :2] * np.array(p.weights)
    whole = np.maximum(weighted.sum(axis=1), 1e-300)
    if not p.boosted:
        return weighted[:, 1] / whole
    return (sums[:, 2:] * np.array(p.weights)).sum(axis=1) / whole * (1.0 if first else p.step)


def merged(tree: Tree, weights) -> None:
    """Two leaves that predict the same class become one, from the ends up."""
    w = np.array(tree.sums)[:, :2] * np.array(weights)
    positive = w[:, 1] > w[:, 0]
    for i in range(len(tree.left) - 1, -1, -1):
        a, b = tree.left[i], tree.left[i] + 1
        if a != i and tree.left[a] == a and tree.left[b] == b and positive[a] == positive[b]:
            tree.left[i] = i
            tree.gain[i] = 0.0


def grow_many(rows: DataFrame, problems: Sequence[TreeProblem], total: int) -> list[TreeModel]:
    """Fit every problem on (label, features array<double>, fold) of ``total`` rows.

    Models that leave out the same fold, and weigh the classes alike, share their bins. Boosting, which takes
    many short passes, has blocks of its own.
    """
    kinds = list(dict.fromkeys((p.left_out, p.weights, p.seed) for p in problems))
    sets = dict(zip(kinds, all_marks(rows, kinds, total)))
    found: dict[int, TreeModel] = {}
    for boosted in (False, True):
        mine = [i for i, p in enumerate(problems) if p.boosted == boosted]
        if mine:
            found |= dict(zip(mine, _grow(rows, [problems[i] for i in mine], total, sets)))
    return [found[i] for i in range(len(problems))]


def _grow(rows: DataFrame, problems: Sequence[TreeProblem], total: int, marks: dict[tuple, list]) -> list[TreeModel]:
    kinds = list(dict.fromkeys((p.left_out, p.weights, p.seed) for p in problems))
    sets_of = [kinds.index((p.left_out, p.weights, p.seed)) for p in problems]
    sets = [marks[k] for k in kinds]
    width = len(sets[0])
    # A node that tries some of the features looks at them one by one.
    whole = all(tried_features(p.features, width) == width for p in problems)
    layout = Layout.of(sets, CODES if whole else 1)
    # Parts of equal size: the longest one decides the time of each of the many passes.
    context = rows.sparkSession.sparkContext
    parts = context.defaultParallelism * (1 + total // PART_ROWS)
    blocks = binned_blocks(rows, layout).rdd.map(dealt).partitionBy(parts, int).values()
    kept = blocks.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    old: list[RDD] = []
    sent, steps = context.broadcast(layout), []
    rng = [np.random.default_rng([p.seed, 1]) for p in problems]
    grown: list[list[Tree]] = [[] for _ in problems]
    waiting: list[dict[int, list[int]]] = [{} for _ in problems]
    recent: dict[int, list] = {i: [] for i, p in enumerate(problems) if p.boosted}

    def start(i: int) -> None:
        tree = Tree()
        tree.add([0.0] * 4)
        grown[i].append(tree)
        waiting[i][len(grown[i]) - 1] = [0]

    for i, p in enumerate(problems):
        for _ in range(1 if p.boosted else p.trees):
            start(i)
    try:
        while any(waiting):
            works, cells = [], 0
            for i, p in enumerate(problems):
                m = tried_features(p.features, width)
                of_node = m * MAX_BINS * 2 * (2 if p.boosted else 1)
                for t, nodes in waiting[i].items():
                    room = max((CELLS - cells) // of_node, 0 if works else 1)
                    some = nodes[:room]
                    if not some:
                        break
                    cells += len(some) * of_node
                    if m == width:
                        chosen = np.tile(np.arange(width), (len(some), 1))
                    else:
                        chosen = np.stack([np.sort(rng[i].permutation(width)[:m]) for _ in some])
                    works.append(Work(i, t, tuple(some), chosen))
            found = search(kept, problems, works, grown, recent, sent, sets_of)
            while old:
                old.pop().unpersist()
            for w, lines in zip(works, found):
                _split(grown[w.problem][w.tree], problems[w.problem], w, lines, waiting[w.problem])
                if not waiting[w.problem].get(w.tree):
                    waiting[w.problem].pop(w.tree, None)
                    _finished(w, problems, grown, recent)
                    if problems[w.problem].boosted and len(grown[w.problem]) < problems[w.problem].trees:
                        start(w.problem)
            if any(len(r) >= REFRESH for r in recent.values()) and any(waiting[i] for i in recent):
                old.append(kept)
                # The blocks stand on those before: what they are made with is sent aside, and stays to the end.
                steps.append(context.broadcast((recent, sets_of)))
                kept = kept.mapPartitions(partial(with_margins, sent, steps[-1])).persist(StorageLevel.MEMORY_AND_DISK_DESER)
                recent = {i: [] for i in recent}
    finally:
        for f in [kept, *old]:
            f.unpersist()
        for b in [sent, *steps]:
            b.destroy()
    return [_model(p, trees, sets[s]) for p, trees, s in zip(problems, grown, sets_of)]


def _split(tree: Tree, p: TreeProblem, work: Work, lines: np.ndarray, waiting: dict[int, list[int]]) -> None:
    """Put the best splits into the tree; children that may split wait."""
    searched = set(work.nodes)
    later = waiting[work.tree] = [n for n in waiting[work.tree] if n not in searched]
    level = {0: 0}
    for n in range(len(tree.left)):
        if tree.left[n] != n:
            level[tree.left[n]] = level[tree.left[n] + 1] = level[n] + 1
    for node, chosen, found in zip(work.nodes, work.features, lines):
        sides = [np.concatenate([found[3:5], found[7:9]]), np.concatenate([found[5:7], found[9:11]])]
        if node == 0 and np.isfinite(found[3:]).all():
            tree.sums[0] = list(sides[0] + sides[1])
        if not found[0] > LEAST_GAIN:
            continue
        tree.gain[node] = float(found[0])
        tree.feature[node], tree.mark[node] = int(chosen[int(found[1])]), int(found[2])
        ends = [tree.add(list(s)) for s in sides]
        tree.left[node] = ends[0]
        depth = level[node] + 1
        tree.depth = max(tree.depth, depth)
        for end, side in zip(ends, sides):
            if depth < p.depth and (p.boosted or (side[:2] > 0).all()):
                later.append(end)


def _finished(w: Work, problems, grown, recent) -> None:
    p, tree = problems[w.problem], grown[w.problem][w.tree]
    if p.boosted:
        recent[w.problem].append((*tree.arrays(), values_of(tree, p, w.tree == 0), tree.depth))
    else:
        merged(tree, p.weights)


def _model(p: TreeProblem, trees: Sequence[Tree], marks: Sequence[np.ndarray]) -> TreeModel:
    lines, importance = [], np.zeros(len(marks))
    for t, tree in enumerate(trees):
        inner = [i for i in range(len(tree.left)) if tree.left[i] != i]
        cuts = [float(marks[tree.feature[i]][tree.mark[i]]) if tree.left[i] != i else float("inf") for i in range(len(tree.left))]
        own = np.zeros(len(marks))
        for i in inner:
            own[tree.feature[i]] += tree.gain[i] * float(np.dot(tree.sums[i][:2], p.weights))
        importance += own / own.sum() if own.sum() else own
        values = values_of(tree, p, t == 0)
        lines.append([list(tree.feature), cuts, list(tree.left), values.tolist(), tree.depth])
    whole = importance.sum()
    return TreeModel(p.kind, len(marks), lines, (importance / whole if whole else importance).tolist())
