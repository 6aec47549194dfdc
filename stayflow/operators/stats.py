"""Exploratory statistics: profiles, segment rates, association, distributions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.functions.pvalues import chi_square_p_value, t_p_value
from stayflow.operators.quantiles import exact_quantiles, long_form, quantiles_wide
from stayflow.operators.sizing import collect_small

# Density: width of a cell in bandwidths, moments of a cell, bandwidths beyond which a kernel is nothing.
KDE_CELL, KDE_TERMS, KDE_REACH = 0.5, 14, 9.0
# A variance under this share of the mean square around the shift is a constant column.
CONSTANT = 1e-14


def column_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value as text), missing values included."""
    texts = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns if c not in keep])
    return texts.unpivot(list(keep), list(columns), "column", "value")


# ---- profiles -------------------------------------------------------------


def column_profile(df: DataFrame) -> DataFrame:
    """(column, dtype, missing_count, missing_pct, blank_count, unique_values).

    Rows are counted by (column, value), each value in the one slot of its type and not as text, and
    every figure is a sum over these counts. Equal values are merged before the shuffle and after it,
    so the counts are exact, no task holds all values of a column, and an entry in a task's memory is
    as wide as the types of the table, not as its columns. Types that cannot be grouped go as JSON.
    """
    held = [f"c{i}" for i in range(len(df.columns))]
    kinds = [f.dataType for f in df.schema]
    rows = df.toDF(*held) if held else df
    plain = rows.select(
        *[F.to_json(c).alias(c) if "map<" in kind.simpleString() else F.col(c) for c, kind in zip(held, kinds)]
    )
    types = list(dict.fromkeys(f.dataType for f in plain.schema))
    slots = [f"v{i}" for i in range(len(types))]
    entries = []
    for i, f in enumerate(plain.schema):
        values = [F.col(f.name) if f.dataType == t else F.lit(None).cast(t) for t in types]
        entries += [F.lit(i), *values]
    counts = (
        plain.select(F.stack(F.lit(len(held)), *entries).alias("place", *slots))
        .groupBy("place", *slots)
        .agg(F.count("*").alias("n"))
    )
    present = reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in slots])
    texts = [i for i, kind in enumerate(kinds) if kind.typeName() in {"string", "char", "varchar"}]
    blanks = [C.is_blank(F.col(v)) for v, t in zip(slots, types) if t.typeName() in {"string", "char", "varchar"}]
    blank = F.col("place").isin(texts) & F.coalesce(*blanks, F.lit(False)) if texts else F.lit(False)
    # One row per column.
    sums = counts.groupBy("place").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(present, F.lit(0)).otherwise(F.col("n"))).alias("missing_count"),
        F.sum(F.when(blank, F.col("n")).otherwise(F.lit(0))).alias("blank_count"),
        F.count_if(present).alias("unique_values"),
    )
    named = lambda names: F.array(*[F.lit(n) for n in names])[F.col("place")]
    return sums.orderBy("place").select(
        named(df.columns).alias("column"),
        named([kind for _, kind in df.dtypes]).alias("dtype"),
        "missing_count",
        C.round_even(C.safe_ratio(F.col("missing_count"), F.col("rows")) * 100, 2).alias("missing_pct"),
        "blank_count",
        "unique_values",
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, median, q75, max), exact."""
    moments = (
        long_form(df, columns)
        .groupBy("column")
        .agg(
            F.count("*").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    marks = quantiles_wide(df, columns, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    # Both sides have one row per column.
    return moments.join(F.broadcast(marks), "column").select(
        "column", "count", "mean", "std", "min", "q25", "median", "q75", "max"
    )


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, min, max, mean, nulls) of each feature, one pass."""
    stats = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.min(C.number(df, c)).alias("min"),
                F.max(C.number(df, c)).alias("max"),
                F.avg(C.number(df, c)).alias("mean"),
                (F.count("*") - F.count(C.number(df, c))).alias("nulls"),
            )
            for c in columns
        ]
    )
    return df.agg(stats.alias("s")).select(F.inline("s"))


# ---- segment tables -------------------------------------------------------


def rate_by_category(df: DataFrame, column: str, label: str) -> DataFrame:
    """Rows, positives and positive rate in % per value, highest rate first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(
            F.count(label).alias("count"),
            F.count_if(F.col(label) == "Yes").alias("churn_count"),
            C.round_even(F.avg((F.col(label) == "Yes").cast("double")) * 100, 2).alias("churn_rate"),
        )
        .orderBy(F.desc("churn_rate"), column)
    )


def rate_by_all_categories(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """The segment table of many columns from one grouping."""
    return (
        column_values(df, columns, [label])
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(
            F.count(label).alias("count"),
            F.count_if(F.col(label) == "Yes").alias("churn_count"),
            C.round_even(F.avg((F.col(label) == "Yes").cast("double")) * 100, 2).alias("churn_rate"),
        )
    )


def rate_by_flag(df: DataFrame, flags: Sequence[str], label: str) -> DataFrame:
    """(feature, flag, rate, count) of 0/1 (or binned) features; label is 0/1."""
    rows = df.select(label, *[F.col(f).cast("int").alias(f) for f in flags])
    return (
        rows.unpivot([label], list(flags), "feature", "flag")
        .filter(F.col("flag").isNotNull())
        .groupBy("feature", "flag")
        .agg(F.avg(F.col(label).cast("double")).alias("rate"), F.count("*").alias("count"))
    )


def mean_by_label(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(column, mean_no, mean_yes, difference, pct_difference)."""
    means = (
        long_form(df.select(label, *columns), columns, [label])
        .groupBy("column")
        .agg(
            F.avg(F.when(F.col(label) == "No", F.col("value"))).alias("mean_no"),
            F.avg(F.when(F.col(label) == "Yes", F.col("value"))).alias("mean_yes"),
        )
    )
    yes, no = F.col("mean_yes"), F.col("mean_no")
    return means.select(
        "column",
        no,
        yes,
        (yes - no).alias("difference"),
        C.percent_difference(yes, no).alias("pct_difference"),
    )


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Contingency table with one count column per value."""
    return df.groupBy(rows).agg(
        *[F.count_if(F.col(columns) == v).alias(v) for v in values]
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, count, share), missing values left out."""
    counts = (
        column_values(df, columns)
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("count"))
    )
    totals = counts.groupBy("column").agg(F.sum("count").alias("total"))
    # One total per column.
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "count", (F.col("count") / F.col("total")).alias("share")
    )


def split_summary(df: DataFrame, label: str) -> DataFrame:
    """(split, rows, share_pct, label_rate); label is 0/1."""
    sizes = df.groupBy("split").agg(
        F.count("*").alias("rows"), F.avg(F.col(label).cast("double")).alias("label_rate")
    )
    total = sizes.agg(F.sum("rows")).scalar()
    return sizes.withColumn("total", total).select(
        "split", "rows", (F.col("rows") / F.col("total") * 100).alias("share_pct"), "label_rate"
    )


# ---- distributions --------------------------------------------------------


def iqr_fences(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quartiles and the fences 1.5 interquartile ranges beyond them."""
    width = 1.5 * (F.col("q3") - F.col("q1"))
    return quantiles_wide(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by).withColumns(
        {"lower": F.col("q1") - width, "upper": F.col("q3") + width}
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, lower, upper, outliers, outlier_pct)."""
    fences = iqr_fences(df, columns)
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    # One fence row per column.
    return (
        long_form(df, columns)
        .join(F.broadcast(fences), "column")
        .groupBy("column", "lower", "upper")
        .agg(F.count_if(outside).alias("outliers"), F.count("*").alias("n"))
        .select(
            "column",
            "lower",
            "upper",
            "outliers",
            (F.col("outliers") / F.col("n") * 100).alias("outlier_pct"),
        )
    )


def box_stats(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Box plot data per group and column: quartiles, whiskers inside the fences, outliers."""
    fences = iqr_fences(df, columns, [by])
    few = collect_small(fences)
    small = fences if few is None else F.broadcast(df.sparkSession.createDataFrame(few, fences.schema))
    inside = F.col("value").between(F.col("lower"), F.col("upper"))
    return (
        long_form(df, columns, [by])
        .join(small, [by, "column"])
        .groupBy(by, "column", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin, low, high, count): equal widths, the last bin closed, empty bins kept."""
    value = C.number(df, column)
    ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    spark = df.sparkSession
    if ends["low"] is None:
        return spark.createDataFrame([], "bin int, low double, high double, count long")
    low, high = ends["low"], ends["high"]
    if low == high:
        low, high = low - 0.5, high + 0.5
    edges = [low + (high - low) * i / bins for i in range(bins)] + [high]
    marks = F.array(*[F.lit(e) for e in edges])
    guess = F.least(F.floor((value - low) * (bins / (high - low))), F.lit(bins - 1)).cast("int")
    # The edges decide where the division rounds across one.
    place = (
        F.when(value < marks[guess], guess - 1)
        .when((guess < bins - 1) & (value >= marks[guess + 1]), guess + 1)
        .otherwise(guess)
    )
    counts = (
        df.select(place.alias("bin")).filter("bin is not null").groupBy("bin").agg(
            F.count("*").alias("count")
        )
    )
    frame = spark.createDataFrame(
        [(i, edges[i], edges[i + 1]) for i in range(bins)], "bin int, low double, high double"
    )
    return frame.join(counts, "bin", "left").select(
        "bin", "low", "high", F.coalesce("count", F.lit(0)).alias("count")
    )


def kde_curve(df: DataFrame, column: str, by: str, points: int = 1000) -> DataFrame:
    """(by, point, x, density): Gaussian kernel density per group on an even grid, Scott's bandwidth.

    Values are grouped once, to cells of half a bandwidth, each with the first moments of its values
    around its middle; a cell's share of a grid point is the Hermite series of the kernel in these.
    With KDE_TERMS moments a density differs from the direct sum by less than ``kde_error`` of the
    kernel's peak. Any number of groups; one with fewer than two values, or equal ones, has none.
    """
    values = long_form(df, [column], [by]).select(by, "value")
    shape = values.groupBy(F.col(by).alias("_by")).agg(
        F.count("*").alias("n"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )
    width = F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    shape = shape.filter((F.col("n") > 1) & (F.col("std") > 0)).withColumn("width", width)
    # Equal values are merged, so a group is no more rows than its distinct values.
    weights = values.groupBy(by, "value").agg(F.count("*").cast("double").alias("w"))
    cell = F.floor((F.col("value") - F.col("low")) / (F.col("width") * KDE_CELL))
    offset = (F.col("value") - F.col("low")) / F.col("width") - (F.col("cell") + 0.5) * KDE_CELL
    placed = (
        weights.join(shape, F.col(by) == F.col("_by"))
        .withColumn("cell", cell)
        .withColumn("t", offset)
    )
    cells = placed.groupBy(by, "cell", "n", "width", "low", "high").agg(
        F.array(
            *[
                F.sum(F.col("w") * F.pow("t", F.lit(float(k))) / math.factorial(k))
                for k in range(KDE_TERMS)
            ]
        ).alias("moments")
    )
    span = 2 * (F.col("high") - F.col("low"))
    start = F.col("low") - 0.5 * (F.col("high") - F.col("low"))
    middle = F.col("low") + (F.col("cell") + 0.5) * KDE_CELL * F.col("width")
    reach = KDE_REACH * F.col("width")
    place = lambda x: (x - start) * (points - 1) / span
    near = F.sequence(
        F.greatest(F.floor(place(middle - reach)), F.lit(0)).cast("int"),
        F.least(F.ceil(place(middle + reach)), F.lit(points - 1)).cast("int"),
    )
    x = start + span * F.col("point") / (points - 1)
    u = (F.col("x") - F.col("middle")) / F.col("width")
    zero = F.lit(0.0)
    # Hermite polynomials from the two before: next = u * now - order * last.
    series = F.aggregate(
        "moments",
        F.struct(
            zero.alias("last"), F.lit(1.0).alias("now"), zero.alias("order"), zero.alias("total")
        ),
        lambda s, m: F.struct(
            s["now"].alias("last"),
            (F.col("u") * s["now"] - s["order"] * s["last"]).alias("now"),
            (s["order"] + 1.0).alias("order"),
            (s["total"] + s["now"] * m).alias("total"),
        ),
        lambda s: s["total"],
    )
    shares = (
        cells.withColumn("middle", middle)
        .withColumn("point", F.explode(near))
        .withColumn("x", x)
        .withColumn("u", u)
        .select(
            by, "point", "x",
            (F.exp(-F.col("u") * F.col("u") / 2) * series / (F.col("n") * F.col("width") * math.sqrt(2 * math.pi))).alias("d"),
        )
    )
    sums = shares.groupBy(by, "point").agg(F.sum("d").alias("d"))
    grid = shape.select(
        F.col("_by").alias(by), "low", "high", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    ).withColumn("x", x)
    # Points beyond the reach of every value have no share.
    return grid.join(sums, [by, "point"], "left").select(
        by, "point", "x", F.greatest(F.coalesce("d", F.lit(0.0)), F.lit(0.0)).alias("density")
    )


def kde_error(terms: int) -> float:
    """Bound of the series' rest, as a share of the kernel's peak: |He_k(u)| exp(-u^2 / 2) is at most
    1.09 sqrt(k!), and a value lies at most half a cell from the middle."""
    t = KDE_CELL / 2
    return sum(1.09 * t**k / math.sqrt(math.factorial(k)) for k in range(terms, terms + 40))


# ---- association ----------------------------------------------------------


def pearson(a: str, b: str) -> Column:
    """Correlation over the rows that have both values; NULL when one of them is constant.

    The built-in ``corr`` raises on a constant column in ANSI mode.
    """
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y))


def gram_sums(rows: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, ...]:
    """Sums over the rows that hold both columns, for every pair: rows, x, x^2 and x y, each a matrix,
    of the columns' numbers less a value of their own (which keeps the digits).

    A task returns these matrices whatever its rows; they are added up by line.
    """
    spark = rows.sparkSession
    some = rows.limit(1000).toPandas()
    shift = np.array([float(v.iloc[len(v) // 2]) if len(v := some[c].dropna()) else 0.0 for c in columns])
    n = len(columns)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, n, n))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float) - shift
            held = ~np.isnan(x)
            x, m = np.where(held, x, 0.0), held.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        lines = np.ascontiguousarray(total.transpose(1, 0, 2))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(n), pa.int32()), pa.array([a.tobytes() for a in lines], pa.binary())], ["line", "sums"]
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for line, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                new = np.frombuffer(part.as_py())
                total[line] = total[line] + new if line in total else new
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([a.tobytes() for a in total.values()], pa.binary())],
            ["line", "sums"],
        )

    schema = "line int, sums binary"
    parts = min(n, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = rows.select(*columns).mapInArrow(summed, schema).repartition(parts, "line").mapInArrow(added, schema)
    whole = np.zeros((n, 4, n))
    for r in found.collect():
        whole[r["line"]] = np.frombuffer(bytes(r["sums"])).reshape(4, n)
    return tuple(whole.transpose(1, 0, 2))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, corr) for all ordered pairs: pairwise complete, NULL for a constant column.

    One pass over the rows for any number of columns.
    """
    columns = list(columns)
    rows = df.select(*[C.number(df, c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    n, sx, sxx, sxy = gram_sums(rows, rows.columns)
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = sxx / n - (sx / n) ** 2
        spread = np.where(spread > CONSTANT * sxx / n, spread, np.nan)
        corr = (sxy / n - (sx / n) * (sx / n).T) / np.sqrt(spread * spread.T)
    np.fill_diagonal(corr, np.where(np.isnan(np.diag(spread)), np.nan, 1.0))
    lines = [
        (a, b, None if np.isnan(corr[i, j]) else float(corr[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(lines, "a string, b string, corr double")


def target_corr(df: DataFrame, columns: Sequence[str], target: Column, bound: float = 0.7) -> DataFrame:
    """(column, corr, high) with the target, strongest first.

    The columns are rows of one grouping: an aggregation as wide as the table is a method too long for
    the compiler of the JVM, which then interprets it for every row.
    """
    numbers = F.array(*[C.number(df, c) for c in columns])
    rows = df.select(target.cast("double").alias("_t"), F.posexplode(numbers).alias("place", "_x"))
    corrs = rows.groupBy("place").agg(pearson("_x", "_t").alias("corr"))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "place int, column string")
    # One row per column; a table without rows has them too.
    found = names.join(F.broadcast(corrs), "place", "left").select("column", "corr")
    return found.withColumn("high", F.abs("corr") > bound).orderBy(
        F.abs("corr").desc_nulls_last(), "column"
    )


def t_test(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Student's two-sample test (pooled variance) of Yes against No per column."""
    yes, no = F.col(label) == "Yes", F.col(label) == "No"
    value = F.col("value")
    sides = (
        long_form(df, columns, [label])
        .groupBy("column")
        .agg(
            *[
                agg(F.when(side, value)).alias(f"{name}_{tag}")
                for tag, side in (("1", yes), ("0", no))
                for name, agg in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))
            ]
        )
    )
    dof = F.col("n_1") + F.col("n_0") - 2
    pooled = ((F.col("n_1") - 1) * F.col("var_1") + (F.col("n_0") - 1) * F.col("var_0")) / dof
    t = F.try_divide(
        F.col("mean_1") - F.col("mean_0"),
        F.sqrt(pooled * (F.lit(1.0) / F.col("n_1") + F.lit(1.0) / F.col("n_0"))),
    )
    tested = sides.select("column", dof.alias("dof"), t.alias("t_stat")).withColumn(
        "p_value", t_p_value("t_stat", "dof")
    )
    return tested.withColumn("significance", C.significance(F.col("p_value")))


def chi_square(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Independence of each column from a Yes/No label.

    (column, chi2, dof, cramers_v, importance, p_value, significance); the continuity
    correction applies when there is one degree of freedom.
    """
    cells = (
        column_values(df, columns, [label])
        .filter(F.col("value").isNotNull() & F.col(label).isNotNull())
        .groupBy("column", "value")
        .agg(
            F.count_if(F.col(label) == "Yes").cast("double").alias("yes"),
            F.count_if(F.col(label) == "No").cast("double").alias("no"),
        )
    )
    margins = cells.groupBy("column").agg(
        F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"), F.count("*").alias("values")
    )
    n = F.col("all_yes") + F.col("all_no")
    row = F.col("yes") + F.col("no")
    classes = (F.col("all_yes") > 0).cast("int") + (F.col("all_no") > 0).cast("int")
    dof = (F.col("values") - 1) * (classes - 1)

    def part(seen: Column, side: Column) -> Column:
        expected = row * side / n
        gap = F.abs(seen - expected)
        gap = F.when(dof == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.coalesce(F.try_divide(gap * gap, expected), F.lit(0.0))

    statistic = part(F.col("yes"), F.col("all_yes")) + part(F.col("no"), F.col("all_no"))
    # One row of margins per column.
    found = (
        cells.join(F.broadcast(margins), "column")
        .groupBy("column")
        .agg(
            F.sum(statistic).alias("chi2"),
            F.first(dof).alias("dof"),
            F.first(n).alias("n"),
        )
        .withColumn("p_value", chi_square_p_value("chi2", "dof"))
    )
    v = F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * F.least(F.col("dof"), F.lit(1))))
    return found.select(
        "column",
        "chi2",
        "dof",
        v.alias("cramers_v"),
        C.right_closed_bins(
            v, [0.0, 0.1, 0.2, 0.3, 1.0], ["Low", "Medium", "High", "Very High"], include_lowest=False
        ).alias("importance"),
        "p_value",
        C.significance(F.col("p_value"), "ns").alias("significance"),
    ).orderBy(F.desc("cramers_v"), "column")


__all__ = [
    "box_stats",
    "chi_square",
    "column_profile",
    "corr_matrix",
    "crosstab",
    "describe",
    "exact_quantiles",
    "histogram",
    "iqr_outliers",
    "kde_curve",
    "mean_by_label",
    "rate_by_all_categories",
    "rate_by_category",
    "rate_by_flag",
    "split_summary",
    "t_test",
    "target_corr",
    "value_counts",
    "value_ranges",
]
