"""Two-sample Kolmogorov-Smirnov drift checks.

``ks_tables`` and ``drift_between`` compare whole tables. A stored reference is a bounded sample
per column: each new value falls into a cell of
that sample (equal to one of its values, or between two), so one counting pass
over the new data gives the exact statistic without sorting it.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.functions.pvalues import ks_p_value
from stayflow.operators.features import Medians, clean_total_charges, engineer_features
from stayflow.operators.ordering import running_totals
from stayflow.operators.quantiles import long_form
from stayflow.operators.sizing import checkpointed
from stayflow.operators.splits import seeded_sample
from stayflow.params import CustomerColumns, DriftParams

#: A stored reference holds a bounded sample; whole tables are compared by ``drift_between``.
STORED = DriftParams(max_reference_samples=2000)
PROBLEMS = ["DRIFT_DETECTED", "MISSING_IN_NEW_DATA", "NO_VALID_VALUES"]


@dataclass(frozen=True)
class DriftReference:
    samples: dict[str, list[float]]
    counts: dict[str, tuple[int, int]] = field(default_factory=dict)


def reference_sample(
    df: DataFrame, columns: Sequence[str], key: str, params: DriftParams = STORED
) -> DataFrame:
    """(column, value, original): a seeded sample of exactly min(n, cap) values per column.

    Values are drawn by the hash of their key; a row without a key by the hash of the value.
    """
    values = long_form(df, columns, [key], keep_missing_keys=True)
    sizes = {
        r["column"]: r["n"] for r in values.groupBy("column").agg(F.count("*").alias("n")).collect()
    }
    if not sizes:
        return values.select("column", "value", F.lit(0).cast("long").alias("original"))
    hashed = values.withColumn(
        "h",
        F.md5(
            F.concat_ws(
                "|",
                F.coalesce(F.col(key).cast("string"), F.concat(F.lit("no key "), F.col("value").cast("string"))),
                "column",
                F.lit(str(params.seed)),
            ).cast("binary")
        ),
    )
    sample = seeded_sample(hashed, "column", sizes, params.max_reference_samples, ["h", key])
    original = F.create_map(*[F.lit(x) for c, n in sizes.items() for x in (c, n)])
    return sample.select(
        "column", "value", original[F.col("column")].cast("long").alias("original")
    )


def fit_reference(
    df: DataFrame, columns: Sequence[str], key: str, params: DriftParams = STORED
) -> DriftReference:
    """Keep the bounded sample (cap values per column) for later checks."""
    if params.max_reference_samples is None:
        raise ValueError("an uncapped reference stays a table: use drift_between")
    samples: dict[str, list[float]] = {c: [] for c in columns}
    counts: dict[str, tuple[int, int]] = {c: (0, 0) for c in columns}
    for r in reference_sample(df, columns, key, params).collect():
        samples[r["column"]].append(r["value"])
        counts[r["column"]] = (r["original"], len(samples[r["column"]]))
    return DriftReference({c: sorted(v) for c, v in samples.items()}, counts)


def ks_against_reference(df: DataFrame, reference: DriftReference) -> DataFrame:
    """(column, n_ref, n_new, ks_statistic) of every reference column the table has."""
    spark = df.sparkSession
    tested = [c for c, v in reference.samples.items() if c in df.columns and v]
    schema = "column string, n_ref long, n_new long, ks_statistic double"
    if not tested:
        return spark.createDataFrame([], schema)

    wide = df.select(*[C.number(df, c).alias(f"v{i}") for i, c in enumerate(tested)])
    cells, steps = [], []
    for i, c in enumerate(tested):
        values = sorted(reference.samples[c])
        splits, known_values = _cell_splits(values), set(values)
        wide = Bucketizer(
            splits=[-math.inf, *splits, math.inf],
            inputCol=f"v{i}",
            outputCol=f"b{i}",
            handleInvalid="keep",
        ).transform(wide)
        cells.append(
            F.when(
                F.col(f"v{i}").isNotNull(),
                F.struct(F.lit(i).alias("place"), F.col(f"b{i}").cast("int").alias("cell")),
            )
        )
        # Cell 0 lies below every reference value; cell k starts at the k-th split.
        upto = [0.0, *[bisect_right(values, s) / len(values) for s in splits]]
        single = [False, *[s in known_values for s in splits]]
        steps += [(i, c, k, u, o, len(values)) for k, (u, o) in enumerate(zip(upto, single))]
    counts = (
        wide.select(F.inline(F.array_compact(F.array(*cells))))
        .groupBy("place", "cell")
        .agg(F.count("*").alias("inside"))
    )
    known = spark.createDataFrame(
        steps, "place int, column string, cell int, ref_upto double, on_value boolean, n_ref long"
    )
    # Two cells per reference value, at most twice the sample cap in each window.
    line = Window.partitionBy("place").orderBy("cell")
    whole = Window.partitionBy("place")
    placed = known.join(counts, ["place", "cell"], "left").withColumn(
        "inside", F.coalesce("inside", F.lit(0))
    )
    placed = placed.withColumns(
        {
            "upto": F.sum("inside").over(line.rowsBetween(Window.unboundedPreceding, 0)),
            "n_new": F.sum("inside").over(whole),
        }
    )
    # Within a cell the reference is flat and the new data rise, so the gap is widest at an end.
    gap = F.abs(F.col("ref_upto") - F.try_divide("upto", "n_new"))
    edge = F.abs(F.col("ref_upto") - F.try_divide(F.col("upto") - F.col("inside"), "n_new"))
    inner = F.when(F.col("on_value"), gap).otherwise(F.greatest(gap, edge))
    return placed.groupBy("column", "n_ref").agg(
        F.max("n_new").alias("n_new"), F.max(inner).alias("ks_statistic")
    )


def _cell_splits(values: list[float]) -> list[float]:
    """Every reference value and the next double above it: a cell holds one value or a gap."""
    return sorted({s for v in values for s in (v, math.nextafter(v, math.inf))})


def ks_tables(reference: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_ref, n_new, ks_statistic) of columns of two tables of any size.

    Each table is read once for all columns. Equal values of a column are merged, then both
    distributions of all columns run up together in one ordered pass, bucket by bucket.
    """
    columns = list(columns)
    sides = []
    for df, tag in ((reference, 0), (new, 1)):
        values = [
            F.struct(F.lit(i).alias("place"), C.number(df, c).alias("value")) for i, c in enumerate(columns)
        ]
        sides.append(df.select(F.inline(F.array(*values))).withColumn("side", F.lit(tag)))
    merged = (
        sides[0]
        .unionByName(sides[1])
        .filter(F.col("value").isNotNull())
        .groupBy("place", "value")
        .agg(
            F.count_if(F.col("side") == 0).alias("a"),
            F.count_if(F.col("side") == 1).alias("b"),
        )
    )
    merged = checkpointed(merged)
    seen = running_totals(merged, "value", {"ra": F.col("a"), "rb": F.col("b")}, by="place", stored=True)
    # One row per column.
    sizes = merged.groupBy("place").agg(F.sum("a").alias("n_ref"), F.sum("b").alias("n_new"))
    gap = F.abs(F.try_divide("ra", "n_ref") - F.try_divide("rb", "n_new"))
    names = F.array(*[F.lit(c) for c in columns])
    return (
        seen.join(F.broadcast(sizes), "place")
        .groupBy("place", "n_ref", "n_new")
        .agg(F.max(gap).alias("ks_statistic"))
        .select(names[F.col("place")].alias("column"), "n_ref", "n_new", "ks_statistic")
    )


def ks_between(reference: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """The statistic of one column between two tables of any size."""
    return ks_tables(reference, new, [column])


def drift_report(
    df: DataFrame, reference: DriftReference, params: DriftParams = DriftParams()
) -> DataFrame:
    """(column, status, ks_statistic, p_value, n_ref, n_new) per reference column."""
    if not reference.samples:
        raise ValueError("Drift reference is empty.")
    return _report(df, list(reference.samples), ks_against_reference(df, reference), params)


def drift_between(
    reference: DataFrame, new: DataFrame, columns: Sequence[str], params: DriftParams = DriftParams()
) -> DataFrame:
    """``drift_report`` against the whole reference table: no sample, no cap."""
    if not columns:
        raise ValueError("Drift reference is empty.")
    tested = [c for c in columns if c in new.columns]
    schema = "column string, n_ref long, n_new long, ks_statistic double"
    found = ks_tables(reference, new, tested) if tested else new.sparkSession.createDataFrame([], schema)
    return _report(new, columns, found.filter("n_ref > 0"), params)


def _report(df: DataFrame, columns: Sequence[str], found: DataFrame, params: DriftParams) -> DataFrame:
    """The status of every column from the statistics of the tested ones."""
    spark = df.sparkSession
    found = found.withColumn("p_value", ks_p_value("ks_statistic", "n_ref", "n_new", params.law))
    wanted = spark.createDataFrame([(c, c in df.columns) for c in columns], "column string, present boolean")
    status = (
        F.when(~F.col("present"), "MISSING_IN_NEW_DATA")
        .when(F.coalesce("n_new", F.lit(0)) == 0, "NO_VALID_VALUES")
        .when(F.col("p_value") < params.p_value_bound, "DRIFT_DETECTED")
        .otherwise("OK")
    )
    # One row per reference column on both sides.
    return wanted.join(F.broadcast(found), "column", "left").select(
        "column", status.alias("status"), "ks_statistic", "p_value", "n_ref", "n_new"
    )


def drift_score(report: DataFrame) -> DataFrame:
    """One row: share of problem columns, their names, the overall flag."""
    problem = F.col("status").isin(PROBLEMS)
    return report.agg(
        F.count("*").alias("columns"),
        F.count_if(problem).alias("problem_columns"),
        F.array_sort(F.collect_list(F.when(problem, F.col("column")))).alias("drift_columns"),
    ).select(
        "columns",
        "problem_columns",
        C.safe_ratio(F.col("problem_columns"), F.greatest("columns", F.lit(1))).alias("drift_score"),
        "drift_columns",
        (F.col("problem_columns") > 0).alias("drift_detected"),
    )


def prepare_drift_input(
    df: DataFrame,
    reference: DriftReference,
    medians: Medians | None = None,
    cols: CustomerColumns = CustomerColumns(),
) -> DataFrame:
    """The table as it is when it has every reference column, else cleaned and engineered."""
    body = df.drop(cols.label, cols.id)
    if set(reference.samples) <= set(body.columns):
        return body
    if cols.total in body.columns:
        body = clean_total_charges(body, cols)
    return engineer_features(body, medians, cols)
