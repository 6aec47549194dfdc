"""Exact quantiles without holding a column's values in one task.

``percentile`` and ``median`` keep a value -> count map per group, which grows
with the distinct values. Here one approximate pass over all columns brackets every
quantile between two values a few ten-thousandths of the ranks apart. Where the two
agree, as in columns of few values, that value is the answer. For the rest an exact
pass counts what lies below the bracket and sorts only the values inside it; a
bracket that still holds too many rows is narrowed again first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.functions.columns import number
from stayflow.operators.sizing import checkpointed, collect_small

ACCURACY = 10_000
MARGIN = 4 / ACCURACY
# Below this many values a margin of ranks is too thin to hold both neighbours of a
# quantile; such a group is small enough to be ordered whole.
SMALL_ROWS = 20_000
NARROW_STEPS = 2_000
BRACKET_ROWS = 2_000_000
MAX_GROUPS = 20_000
# A group with more than one part in HOT_SHARE of a partition's rows is not left to one task.
HOT_SHARE = 4


def long_form(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), keep_missing_keys: bool = False
) -> DataFrame:
    """(by..., column, value) without missing values; missing keys are dropped unless kept."""
    wide = _numbers(df, columns, by, keep_missing_keys)
    if len(columns) == 1:
        rows = wide.select(*by, F.lit(columns[0]).alias("column"), F.col(columns[0]).alias("value"))
    else:
        rows = wide.unpivot(list(by), list(columns), "column", "value")
    return rows.filter(F.col("value").isNotNull())


def _numbers(
    df: DataFrame, columns: Sequence[str], by: Sequence[str], keep_missing_keys: bool = False
) -> DataFrame:
    wide = df.select(*by, *[number(df, c).alias(c) for c in columns])
    return wide.dropna(subset=list(by)) if by and not keep_missing_keys else wide


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Linear-interpolated quantiles as rows (by..., column, prob, value)."""
    wide = _numbers(df, columns, by)
    edges = F.array(
        *[F.lit(min(max(p + d, 0.0), 1.0)) for p in probs for d in (-MARGIN, MARGIN)]
    )
    summary = wide.groupBy(*by).agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(c, edges, ACCURACY).alias(f"e{i}") for i, c in enumerate(columns)],
    )
    groups = collect_small(summary, max(MAX_GROUPS // len(columns), 1))
    if groups is None:
        return _many_groups(df, columns, probs, by)

    brackets = []
    for r in groups:
        for i, c in enumerate(columns):
            if not r[f"n{i}"]:
                continue
            for k, p in enumerate(probs):
                small = r[f"n{i}"] < SMALL_ROWS
                low = -math.inf if small or p <= MARGIN else r[f"e{i}"][2 * k]
                high = math.inf if small or p >= 1 - MARGIN else r[f"e{i}"][2 * k + 1]
                key = tuple(r[b] for b in by)
                brackets.append((*key, c, float(p), r[f"n{i}"], low, high))
    inside = 2 * MARGIN
    while True:
        wide_ones = [
            b
            for b in brackets
            if b[-1] > b[-2] and b[-3] >= SMALL_ROWS and inside * b[-3] > BRACKET_ROWS
        ]
        if not wide_ones:
            break
        narrowed = _narrow(wide, wide_ones, by)
        if set(narrowed) == set(wide_ones):
            break
        brackets = [b for b in brackets if b not in wide_ones] + narrowed
        inside *= 2 * MARGIN

    schema = T.StructType(
        [wide.schema[b] for b in by]
        + [
            T.StructField("column", T.StringType()),
            T.StructField("prob", T.DoubleType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    known = [(*b[:-3], b[-1]) for b in brackets if b[-1] == b[-2]]
    found = df.sparkSession.createDataFrame(known, schema)
    pending = [b for b in brackets if b[-1] > b[-2]]
    if not pending:
        return found
    pairs = _pairs(pending)
    source, limits = _bounded(wide, pending, by)
    if len(columns) == 1:
        # One column: its values below a bracket are counted in the same scan.
        picked = _pick(_entries(source, limits, pairs, by), [*by, "pair"], _prob_of(pairs))
    else:
        inside = _entries(source, limits, pairs, by, inside_only=True)
        below = _below(source, limits, pairs, by)
        picked = _pick(inside, [*by, "pair"], _prob_of(pairs), below)
    names = F.array(*[F.lit(c) for c, _ in pairs])
    exact = picked.select(*by, names[F.col("pair")].alias("column"), "prob", "value")
    return found.unionByName(exact) if known else exact


def _pairs(brackets: list[tuple]) -> list[tuple[str, float]]:
    """The (column, prob) pairs in order; rows carry the place of theirs as an integer key."""
    return sorted({(b[-5], b[-4]) for b in brackets})


def _prob_of(pairs: list[tuple[str, float]]) -> Column:
    return F.array(*[F.lit(p) for _, p in pairs])[F.col("pair")]


def _bounded(
    wide: DataFrame, brackets: list[tuple], by: Sequence[str]
) -> tuple[DataFrame, dict[int, list[Column]]]:
    """The rows with the brackets of their group, and (n, low, high) of each pair as columns."""
    pairs = _pairs(brackets)
    names = {pair: i for i, pair in enumerate(pairs)}
    if by:
        # One row per group, at most MAX_GROUPS, so the broadcast is bounded.
        rows: dict[tuple, list] = {}
        for *key, c, p, n, low, high in brackets:
            row = rows.setdefault(tuple(key), [None] * (3 * len(pairs)))
            at = 3 * names[(c, p)]
            row[at : at + 3] = [n, low, high]
        kinds = [("n", T.LongType()), ("low", T.DoubleType()), ("high", T.DoubleType())]
        schema = T.StructType(
            [wide.schema[b] for b in by]
            + [T.StructField(f"_{k}{i}", t) for i in range(len(pairs)) for k, t in kinds]
        )
        table = wide.sparkSession.createDataFrame([(*k, *v) for k, v in rows.items()], schema)
        source = wide.join(F.broadcast(table), list(by))
        limits = {i: [F.col(f"_{k}{i}") for k, _ in kinds] for i in range(len(pairs))}
    else:
        source = wide
        limits = {names[(b[-5], b[-4])]: [F.lit(x) for x in b[-3:]] for b in brackets}
    return source, limits


def _entries(
    source: DataFrame,
    limits: dict[int, list[Column]],
    pairs: list[tuple[str, float]],
    by: Sequence[str],
    inside_only: bool = False,
) -> DataFrame:
    """(by..., pair, n, low, high, value) of every value not above its bracket, or only inside it."""
    entries = []
    for i, (c, _) in enumerate(pairs):
        n, low, high = limits[i]
        held = F.col(c) <= high
        entries.append(
            F.when(
                held & (F.col(c) >= low) if inside_only else held,
                F.struct(
                    F.lit(i).alias("pair"),
                    n.cast("long").alias("n"),
                    low.alias("low"),
                    high.alias("high"),
                    F.col(c).alias("value"),
                ),
            )
        )
    return source.select(*by, F.inline(F.array_compact(F.array(*entries))))


def _below(
    source: DataFrame, limits: dict[int, list[Column]], pairs: list[tuple[str, float]], by: Sequence[str]
) -> DataFrame:
    """(by..., pair, n, slot NULL, rows): the values below each bracket, counted in one wide pass."""
    counts = source.groupBy(*by).agg(
        *[F.count_if(F.col(c) < limits[i][1]).alias(f"c{i}") for i, (c, _) in enumerate(pairs)],
        *[F.max(limits[i][0]).cast("long").alias(f"n{i}") for i in range(len(pairs))],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(i).alias("pair"),
                F.col(f"n{i}").alias("n"),
                F.lit(None).cast("double").alias("slot"),
                F.col(f"c{i}").alias("rows"),
            )
            for i in range(len(pairs))
        ]
    )
    return counts.select(*by, F.inline(lines)).filter("rows > 0")


def _narrow(wide: DataFrame, brackets: list[tuple], by: Sequence[str]) -> list[tuple]:
    """One more approximate pass inside each bracket, on a fixed grid of ranks."""
    inside = F.col("value") >= F.col("low")
    grid = F.array(*[F.lit(i / NARROW_STEPS) for i in range(NARROW_STEPS + 1)])
    keys = [*by, "pair", "n", "low", "high"]
    source, limits = _bounded(wide, brackets, by)
    stats = _entries(source, limits, _pairs(brackets), by).groupBy(*keys).agg(
        F.count_if(~inside).alias("below"),
        F.count_if(inside).alias("inside"),
        F.percentile_approx(F.when(inside, F.col("value")), grid, ACCURACY).alias("marks"),
    )
    pairs, out = _pairs(brackets), []
    for r in stats.collect():
        column, prob = pairs[r["pair"]]
        rank = (r["n"] - 1) * prob - r["below"]
        place = rank / max(r["inside"] - 1, 1)
        margin = MARGIN + 2 / max(r["inside"], 1)
        lower = math.floor((place - margin) * NARROW_STEPS)
        upper = math.ceil((place + margin) * NARROW_STEPS)
        low = r["low"] if lower <= 0 else r["marks"][lower]
        high = r["high"] if upper >= NARROW_STEPS else r["marks"][upper]
        out.append((*[r[b] for b in by], column, prob, r["n"], low, high))
    return out


def _pick(
    entries: DataFrame, keys: list[str], prob: Column, below: DataFrame | None = None
) -> DataFrame:
    """Exact pass: count below each bracket, order the values inside, take the two ranks.

    ``below`` has the counts below when the entries are only those inside.
    """
    slot = F.when(F.col("value") >= F.col("low"), F.col("value"))
    counted = entries.groupBy(*keys, "n", slot.alias("slot")).agg(F.count("*").alias("rows"))
    if below is not None:
        counted = counted.unionByName(below)
    ordered = Window.partitionBy(*keys).orderBy(F.col("slot").asc_nulls_first())
    place = (F.col("n") - 1) * prob
    covered = F.sum("rows").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    picked = (
        counted.withColumn("covered", covered)
        .groupBy(*keys)
        .agg(
            F.max("n").alias("n"),
            F.min(F.when(F.col("covered") > F.floor(place), F.col("slot"))).alias("a"),
            F.min(F.when(F.col("covered") > F.ceil(place), F.col("slot"))).alias("b"),
            F.max(F.when(F.col("slot").isNull(), F.col("covered"))).alias("below"),
        )
    )
    held = (F.coalesce("below", F.lit(0)) <= F.floor(place)) & F.col("b").isNotNull()
    value = F.col("a") + (F.col("b") - F.col("a")) * (place - F.floor(place))
    return picked.select(
        *keys,
        prob.alias("prob"),
        F.when(held, value)
        .otherwise(F.raise_error(F.lit("quantile rank outside its bracket")))
        .alias("value"),
    )


def _many_groups(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str]
) -> DataFrame:
    """The same passes with the brackets as a table, for more groups than a driver should hold.

    A bracket that still holds many rows is narrowed by joins, its bounds never leave the table.
    Values of the few groups with a large share of all rows meet their brackets by broadcast, so
    such a group is not one task.
    """
    values = long_form(df, columns, by)
    keys = [*by, "column"]
    edges = F.array(
        *[F.lit(min(max(p + d, 0.0), 1.0)) for p in probs for d in (-MARGIN, MARGIN)]
    )
    entries = []
    for k, p in enumerate(probs):
        low = F.when(F.lit(p > MARGIN) & (F.col("n") >= SMALL_ROWS), F.col("edges")[2 * k])
        high = F.when(F.lit(p < 1 - MARGIN) & (F.col("n") >= SMALL_ROWS), F.col("edges")[2 * k + 1])
        low = F.coalesce(low, F.lit(-math.inf))
        high = F.coalesce(high, F.lit(math.inf))
        entries.append(F.struct(F.lit(k).alias("pair"), low.alias("low"), high.alias("high")))
    brackets = checkpointed(
        values.groupBy(*keys)
        .agg(F.count("*").alias("n"), F.percentile_approx("value", edges, ACCURACY).alias("edges"))
        .select(*keys, "n", F.inline(F.array(*entries)))
        .withColumn("narrow", F.lit(False))
    )
    prob = F.array(*[F.lit(float(p)) for p in probs])[F.col("pair")]
    share = 2 * MARGIN
    while True:
        wide = (
            (F.col("n") >= SMALL_ROWS) & (F.col("n") * share > BRACKET_ROWS)
            & (F.col("high") > F.col("low")) & ~F.col("narrow")
        )
        if brackets.filter(wide).isEmpty():
            break
        narrowed = _narrow_table(values, brackets.filter(wide), keys, prob)
        brackets = checkpointed(brackets.filter(~wide).unionByName(narrowed))
        share *= 2 * MARGIN
    total = brackets.filter(F.col("pair") == 0).agg(F.sum("n")).first()[0] or 0
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # At most HOT_SHARE groups for each partition can be this large: their brackets are broadcast.
    hot = F.col("n") > max(SMALL_ROWS, total / (HOT_SHARE * parts))
    brackets = brackets.drop("narrow")
    inside = _at_brackets(values, F.broadcast(brackets.filter(hot)), keys).unionByName(
        _at_brackets(values, brackets.filter(~hot), keys)
    )
    return _pick(inside, [*keys, "pair"], prob).drop("pair")


def _at_brackets(values: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    return values.join(brackets, keys).filter(F.col("value") <= F.col("high"))


def _narrow_table(values: DataFrame, brackets: DataFrame, keys: list[str], prob: Column) -> DataFrame:
    """Brackets cut to the ranks around their quantile, on a fixed grid inside them.

    Each holds BRACKET_ROWS rows or more, so there are few of them and they are broadcast.
    """
    inside = F.col("value") >= F.col("low")
    grid = F.array(*[F.lit(i / NARROW_STEPS) for i in range(NARROW_STEPS + 1)])
    stats = (
        _at_brackets(values, F.broadcast(brackets), keys)
        .groupBy(*keys, "pair", "n", "low", "high")
        .agg(
            F.count_if(~inside).alias("below"),
            F.count_if(inside).alias("inside"),
            F.percentile_approx(F.when(inside, F.col("value")), grid, ACCURACY).alias("marks"),
        )
    )
    rank = (F.col("n") - 1) * prob - F.col("below")
    place = rank / F.greatest(F.col("inside") - 1, F.lit(1))
    margin = F.lit(MARGIN) + F.lit(2.0) / F.greatest(F.col("inside"), F.lit(1))
    lower = F.floor((place - margin) * NARROW_STEPS).cast("int")
    upper = F.ceil((place + margin) * NARROW_STEPS).cast("int")
    low = F.when(lower <= 0, F.col("low")).otherwise(F.get("marks", lower))
    high = F.when(upper >= NARROW_STEPS, F.col("high")).otherwise(F.get("marks", upper))
    cut = stats.withColumns({"new_low": low, "new_high": high})
    return cut.select(
        *keys, "n", "pair", F.col("new_low").alias("low"), F.col("new_high").alias("high"),
        # A bracket that cannot be cut further is as narrow as it gets.
        ((F.col("new_low") == F.col("low")) & (F.col("new_high") == F.col("high"))).alias("narrow"),
    )


def quantiles_wide(
    df: DataFrame, columns: Sequence[str], named: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per (by..., column) with a column per named quantile."""
    rows = exact_quantiles(df, columns, list(named.values()), by)
    return rows.groupBy(*by, "column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(k) for k, p in named.items()]
    )
