"""Seeded stratified splits, folds and samples.

The order of rows is that of ``md5(key|seed)``: reproducible in any engine and
evenly spread, so its first hex digits are ready-made ordered buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.operators.sizing import checkpointed, collect_small
from stayflow.params import SplitParams

BUCKET_DIGITS, MAX_DIGITS = 3, 6
# More strata than this are cut by a join with a table instead of by literals of the plan.
MAX_STRATA = 64
# A hash bucket with more rows is divided further before its rows are ordered.
RANKED_ROWS = 1_000_000


def hash_order(key: str, seed: int, *parts: str) -> Column:
    texts = [F.col(key).cast("string"), *[F.lit(p) for p in parts], F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *texts).cast("binary"))


@dataclass(frozen=True)
class SplitCuts:
    """Per stratum: for each split boundary the last (hash, key) before it."""

    key: str
    label: str
    seed: int
    cuts: dict[object, list[tuple[str, tuple[str, object] | None]]]

    def apply(self, df: DataFrame) -> DataFrame:
        """Add ``split``: one hash and comparisons with a few literals per row, no shuffle."""
        h, key = F.col("_h"), F.col(self.key)
        kind = df.schema[self.key].dataType
        result = F.lit(None).cast("string")
        for stratum, bounds in self.cuts.items():
            inside = F.lit("test")
            for name, last in reversed(bounds):
                if last is not None:
                    # One struct comparison, so a pushed-down filter hashes once per boundary.
                    place = F.struct(h.alias("h"), key.alias("k"))
                    end = F.struct(F.lit(last[0]).alias("h"), F.lit(last[1]).cast(kind).alias("k"))
                    inside = F.when(place <= end, name).otherwise(inside)
            result = F.when(F.col(self.label).eqNullSafe(F.lit(stratum)), inside).otherwise(result)
        hashed = df.withColumn("_h", hash_order(self.key, self.seed))
        return hashed.withColumn("split", result).drop("_h")


@dataclass(frozen=True)
class TableCuts:
    """The cuts of many strata as a table (stratum, name, h, k)."""

    key: str
    label: str
    seed: int
    table: DataFrame
    names: tuple[str, ...]

    def apply(self, df: DataFrame) -> DataFrame:
        """Add ``split``: one join on the label, unhinted, so a frequent label can be split."""
        wide = self.table.groupBy(F.col("stratum").alias("_stratum")).agg(
            *[
                F.max(F.when(F.col("name") == n, F.struct("h", "k"))).alias(f"_{n}")
                for n in self.names
            ]
        )
        place = F.struct(F.col("_h").alias("h"), F.col(self.key).alias("k"))
        result = F.lit("test")
        for n in reversed(self.names):
            result = F.when(F.col(f"_{n}").isNotNull() & (place <= F.col(f"_{n}")), n).otherwise(result)
        hashed = df.withColumn("_h", hash_order(self.key, self.seed))
        joined = hashed.join(wide, F.col(self.label).eqNullSafe(F.col("_stratum")))
        return joined.withColumn("split", result).select(*df.columns, "split")


def _buckets(hashed: DataFrame, label: str, digits: int, depth: int) -> DataFrame:
    """(label, bucket, n, before): rows per first hash digits, and those before them in the stratum."""
    counts = hashed.groupBy(label, F.substring("h", 1, digits).alias("bucket")).agg(F.count("*").alias("n"))
    # Buckets of one stratum under one prefix: at most 16 ** BUCKET_DIGITS rows of a window.
    line = Window.partitionBy(label, F.substring("bucket", 1, depth)).orderBy("bucket")
    return counts.withColumn(
        "before", F.coalesce(F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )


def _same(label: str) -> Column:
    """Rows and strata meet on the label, a missing one included."""
    return F.col(label).eqNullSafe(F.col("stratum"))


def cut_table(df: DataFrame, key: str, label: str, shares: dict[str, float], seed: int) -> DataFrame:
    """(stratum, name, h, k): the last (hash, key) of each share of each stratum, missing where a
    share has no row. Exact: floor(share * rows) rows of a stratum lie up to its cut.

    Counts per hash bucket and prefix sums lead to the bucket that holds a cut; a large bucket is
    divided by further digits, and only rows of these buckets are ordered. All of it is tables, so
    there may be any number of strata.
    """
    hashed = df.select(F.col(label).alias("_label"), F.col(key).alias("k"), hash_order(key, seed).alias("h"))
    label, digits = "_label", BUCKET_DIGITS
    counts = _buckets(hashed, label, digits, 0)
    sizes = counts.groupBy(F.col(label).alias("stratum")).agg(F.sum("n").alias("rows"))
    names = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(s)).alias("share")) for n, s in shares.items()])
    targets = sizes.select("stratum", "rows", F.inline(names)).select(
        "stratum", "name", F.floor(F.col("rows") * F.col("share") + 1e-9).alias("rank"), F.lit("").alias("prefix")
    )
    targets = checkpointed(targets)
    found = _held(targets, counts, label)
    while digits < 15 and not found.filter(F.col("n") > RANKED_ROWS).isEmpty():
        # Only buckets with a cut are divided.
        prefixes = found.select("stratum", "prefix").distinct()
        near = hashed.join(
            prefixes, _same(label) & (F.substring("h", 1, digits) == F.col("prefix"))
        ).drop("stratum", "prefix")
        found = _held(found.drop("n"), _buckets(near, label, digits + BUCKET_DIGITS, digits), label)
        digits += BUCKET_DIGITS
    buckets = found.select("stratum", "prefix").distinct()
    # Equal keys are merged before they are ordered.
    near = (
        hashed.join(buckets, _same(label) & (F.substring("h", 1, digits) == F.col("prefix")))
        .groupBy("stratum", "prefix", "h", "k").agg(F.count("*").alias("times"))
    )
    line = Window.partitionBy("stratum", "prefix").orderBy("h", "k").rowsBetween(Window.unboundedPreceding, 0)
    ranked = near.withColumn("upto", F.sum("times").over(line))
    wanted = found.select(F.col("stratum").alias("of"), F.col("prefix").alias("under"), "name", "rank")
    cuts = ranked.join(
        wanted,
        F.col("stratum").eqNullSafe(F.col("of"))
        & (F.col("prefix") == F.col("under"))
        & (F.col("rank") <= F.col("upto"))
        & (F.col("rank") > F.col("upto") - F.col("times")),
    ).select(F.col("of").alias("held"), F.col("name").alias("share"), "h", "k")
    every = targets.select("stratum", "name")
    return every.join(
        cuts, F.col("stratum").eqNullSafe(F.col("held")) & (F.col("name") == F.col("share")), "left"
    ).select("stratum", "name", "h", "k")


def _held(targets: DataFrame, counts: DataFrame, label: str) -> DataFrame:
    """Targets of a rank above 0 with the longer prefix that holds it, and its rank there."""
    bucket = F.col("bucket").startswith(F.col("prefix"))
    inside = (F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("n"))
    return checkpointed(
        targets.filter(F.col("rank") > 0).join(counts, _same(label) & bucket & inside).select(
            "stratum", "name", (F.col("rank") - F.col("before")).alias("rank"),
            F.col("bucket").alias("prefix"), "n",
        )
    )


def stratified_cuts(
    df: DataFrame, key: str, label: str, params: SplitParams = SplitParams()
) -> SplitCuts | TableCuts:
    """Find the exact cut points: floor(train share), floor(train + val share) rows per label.

    Up to MAX_STRATA labels the cuts are literals of the plan, beyond that a table that is joined.
    """
    train_share = 1 - params.test_share - params.val_share
    shares = {"train": train_share, "val": train_share + params.val_share}
    table = checkpointed(cut_table(df, key, label, shares, params.seed))
    rows = collect_small(table, MAX_STRATA * len(shares))
    if rows is None:
        return TableCuts(key, label, params.seed, table, tuple(shares))
    cuts: dict[object, dict[str, tuple[str, object] | None]] = {}
    for r in rows:
        cuts.setdefault(r["stratum"], {})[r["name"]] = None if r["h"] is None else (r["h"], r["k"])
    return SplitCuts(key, label, params.seed, {s: [(n, found[n]) for n in shares] for s, found in cuts.items()})


def stratified_split(
    df: DataFrame, key: str, label: str, params: SplitParams = SplitParams()
) -> DataFrame:
    """Add ``split`` (train / val / test), exact per label."""
    return stratified_cuts(df, key, label, params).apply(df)


def hash_split(df: DataFrame, key: str, params: SplitParams = SplitParams()) -> DataFrame:
    """Add ``split`` by hash alone: one pass, shares right on average."""
    place = F.conv(F.substring(hash_order(key, params.seed), 1, 12), 16, 10).cast("double") / 16**12
    train = 1 - params.test_share - params.val_share
    return df.withColumn(
        "split",
        F.when(place < train, "train").when(place < train + params.val_share, "val").otherwise("test"),
    )


def stratified_folds(
    df: DataFrame, key: str, label: str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold``: (rank by hash inside the label - 1) modulo ``folds``; one key per row.

    Rows without a label are a stratum of their own. Hash buckets are divided until each is small.
    """
    digits = BUCKET_DIGITS
    hashed = df.withColumn("h", hash_order(key, seed))
    narrow = hashed.select(label, "h")
    while True:
        bucket = F.substring("h", 1, digits).alias("bucket")
        counts = checkpointed(narrow.groupBy(label, bucket).agg(F.count("*").alias("n")))
        largest = counts.agg(F.max("n")).first()[0]
        if largest is None:
            return df.withColumn("fold", F.lit(None).cast("int"))
        if largest <= RANKED_ROWS or digits >= MAX_DIGITS:
            break
        digits += 1
    # Prefix sums in two steps: buckets under the same first digits, and the totals of these.
    upper = F.substring("bucket", 1, BUCKET_DIGITS)
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    group = counts.groupBy(F.col(label).alias("of"), upper.alias("upper")).agg(F.sum("n").alias("n"))
    group = group.select(
        "of", "upper", F.coalesce(F.sum("n").over(before("of").orderBy("upper")), F.lit(0)).alias("ahead")
    )
    own = F.sum("n").over(before(label, upper).orderBy("bucket"))
    offsets = (
        counts.withColumn("own", F.coalesce(own, F.lit(0)))
        .join(group, F.col(label).eqNullSafe(F.col("of")) & (upper == F.col("upper")))
        .select("of", F.col("bucket").alias("prefix"), (F.col("ahead") + F.col("own")).alias("before"))
    )
    inside = Window.partitionBy("of", "prefix").orderBy("h", key)
    return (
        hashed.withColumn("bucket", F.substring("h", 1, digits))
        .join(offsets, F.col(label).eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("prefix")))
        .withColumn("fold", ((F.col("before") + F.row_number().over(inside) - 1) % folds).cast("int"))
        .select(*df.columns, "fold")
    )


def seeded_sample(
    values: DataFrame, by: str, sizes: dict[str, int], cap: int | None, order: Sequence[str]
) -> DataFrame:
    """Per ``by`` group exactly min(size, cap) rows, the first in hash order.

    ``order`` is [hash column, tie-break...]. The hash is uniform, so rows beyond a
    share slightly above cap / size are dropped before the sort. The share is widened for
    a group that comes out short.
    """
    if cap is None:
        return values
    expected = {name: min(size, cap) for name, size in sizes.items()}
    shares = {n: min(1.0, (cap + 10 * cap**0.5 + 100) / max(size, 1)) for n, size in sizes.items()}
    place = F.conv(F.substring(F.col(order[0]), 1, 12), 16, 10).cast("double") / 16**12
    while True:
        share = F.lit(1.0)
        for name, kept in shares.items():
            if kept < 1:
                share = F.when(F.col(by) == name, F.lit(kept)).otherwise(share)
        near = values.filter(place <= share)
        # One count per group; a group that came out short, as with repeated keys, is widened.
        found = {r[by]: r["count"] for r in near.groupBy(by).count().collect()}
        short = [n for n, kept in shares.items() if kept < 1 and found.get(n, 0) < expected[n]]
        if not short:
            break
        shares |= {n: min(1.0, 4 * shares[n]) for n in short}
    # Equal rows are merged before they are ordered, so a repeated key is one row of the window.
    rest = [c for c in values.columns if c not in {by, *order}]
    line = Window.partitionBy(by).orderBy(*order, *rest)
    merged = near.groupBy(*values.columns).agg(F.count("*").alias("times"))
    ranked = merged.withColumn(
        "before", F.sum("times").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("times")
    ).filter(F.col("before") < cap)
    taken = F.array_repeat(F.lit(0), F.least("times", F.lit(cap) - F.col("before")).cast("int"))
    return ranked.withColumn("one", F.explode(taken)).select(*values.columns)
