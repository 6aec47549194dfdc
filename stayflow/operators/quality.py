"""Quality checks on a raw customer table.

Every count except the duplicates comes from one aggregation over one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.functions import columns as C
from stayflow.params import ValidationRules


class DataValidationError(ValueError):
    """Raised by the strict forms of the validations."""


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, NaN, or text of nothing but white space."""
    c = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return c.isNull() | c.rlike(C.BLANK_TEXT)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def blanks_to_null(df: DataFrame) -> DataFrame:
    return df.select(
        *[C.blank_to_null(F.col(c)).alias(c) if is_text(df, c) else F.col(c) for c in df.columns]
    )


def missing_columns(df: DataFrame, required) -> list[str]:
    """Required names the table lacks, in the required order."""
    return [c for c in required if c not in df.columns]


def column_differences(df: DataFrame, defined: Sequence[str]) -> DataFrame:
    """(column, side): columns of the table that are not defined ('missing' from the definition), and
    defined names that the table lacks ('extra'); a name that is repeated counts once."""
    have, want = list(dict.fromkeys(df.columns)), list(dict.fromkeys(defined))
    lines = [(c, "missing") for c in have if c not in want] + [(c, "extra") for c in want if c not in have]
    return df.sparkSession.createDataFrame(lines, "column string, side string")


def missing_by_column(df: DataFrame) -> DataFrame:
    """(column, missing_count, missing_ratio)."""
    counts = df.agg(
        F.count("*").alias("rows"), *[F.count_if(is_missing(df, c)).alias(c) for c in df.columns]
    )
    return counts.unpivot(["rows"], df.columns, "column", "missing_count").select(
        "column",
        "missing_count",
        C.safe_ratio(F.col("missing_count"), F.col("rows")).alias("missing_ratio"),
    )


def duplicate_stats(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier equal row: every copy after the first."""
    copies = blanks_to_null(df).groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_count"),
    ).withColumn("duplicate_ratio", C.safe_ratio(F.col("duplicate_count"), F.col("rows")))


def type_violation_columns(df: DataFrame, rules: ValidationRules) -> dict[str, Column]:
    """Per numeric feature stored as text: count of values that are no number."""
    return {
        c: F.count_if(~is_missing(df, c) & C.number(df, c).isNull())
        for c in rules.numeric_features
        if c in df.columns and is_text(df, c)
    }


def type_violations(df: DataFrame, rules: ValidationRules) -> DataFrame:
    counts = type_violation_columns(df, rules)
    return _named_counts(df, counts, "column", "invalid_casts")


def range_violation_columns(df: DataFrame, rules: ValidationRules) -> dict[str, Column]:
    """Per rule with a bound: count of values strictly beyond it."""
    counts = {}
    for c, (low, high) in rules.numeric_ranges.items():
        if c not in df.columns:
            continue
        if low is not None:
            counts[f"{c} below_min"] = F.count_if(C.number(df, c) < low)
        if high is not None:
            counts[f"{c} above_max"] = F.count_if(C.number(df, c) > high)
    return counts


def range_violations(df: DataFrame, rules: ValidationRules) -> DataFrame:
    rows = _named_counts(df, range_violation_columns(df, rules), "rule", "violations")
    return rows.select(
        F.substring_index("rule", " ", 1).alias("column"),
        F.substring_index("rule", " ", -1).alias("bound"),
        "violations",
    )


def _named_counts(df: DataFrame, counts: dict[str, Column], name: str, value: str) -> DataFrame:
    if not counts:
        return df.sparkSession.createDataFrame([], f"{name} string, {value} long")
    one = df.agg(*[c.alias(n) for n, c in counts.items()])
    return one.unpivot([], list(counts), name, value)


def target_columns(df: DataFrame, target: str) -> dict[str, Column]:
    """Aggregates behind the target check: valid values, their sum, those not 0/1.

    Text is mapped by Yes/No/yes/no; only when nothing maps it is read as numbers.
    """
    value = C.number(df, target)
    numeric = {
        "valid": F.count(value),
        "total": F.sum(value),
        "non_binary": F.count_if(~value.isin(0.0, 1.0)),
    }
    if not is_text(df, target):
        return numeric
    mapped = F.when(F.col(target).isin("Yes", "yes"), 1.0).when(F.col(target).isin("No", "no"), 0.0)
    some = F.count(mapped) > 0
    return {
        "valid": F.when(some, F.count(mapped)).otherwise(numeric["valid"]),
        "total": F.when(some, F.sum(mapped)).otherwise(numeric["total"]),
        "non_binary": F.when(some, F.lit(0)).otherwise(numeric["non_binary"]),
    }


def target_stats(df: DataFrame, target: str) -> DataFrame:
    one = df.agg(*[c.alias(n) for n, c in target_columns(df, target).items()])
    return one.select(
        F.col("valid").alias("valid_rows"),
        F.col("non_binary").alias("non_binary_rows"),
        F.try_divide("total", "valid").alias("target_rate"),
    )


def invalid_row_flag(df: DataFrame, required) -> Column:
    present = [is_missing(df, c) for c in required if c in df.columns]
    return reduce(lambda a, b: a | b, present, F.lit(False))


def invalid_rows(df: DataFrame, required) -> DataFrame:
    """Share of rows in which any required value is missing."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(invalid_row_flag(df, required)).alias("invalid_rows"),
    ).withColumn("invalid_rows_ratio", C.safe_ratio(F.col("invalid_rows"), F.col("rows")))


def quality_report(df: DataFrame, rules: ValidationRules) -> DataFrame:
    """One row: verdict, sizes, ratios, critical issues and warnings."""
    missing = {c: F.count_if(is_missing(df, c)) for c in df.columns}
    casts = type_violation_columns(df, rules)
    ranges = range_violation_columns(df, rules)
    has_target = rules.target_column in df.columns
    target = target_columns(df, rules.target_column) if has_target else {}
    blocks = {
        "missing": missing,
        "casts": casts,
        "ranges": ranges,
        "target": target,
    }
    one = df.agg(
        F.count("*").alias("rows"),
        F.count_if(invalid_row_flag(df, rules.required_columns)).alias("invalid_rows"),
        *[
            F.struct(*[c.alias(n) for n, c in block.items()]).alias(name)
            for name, block in blocks.items()
            if block
        ],
    )
    duplicates = duplicate_stats(df).select(F.struct("duplicate_count", "duplicate_ratio"))
    one = one.withColumn("duplicates", duplicates.scalar()).select("*", "duplicates.*")

    def field(block: str, name: str) -> Column:
        return F.col(block).getField(name)

    rows = F.col("rows")
    cells = F.greatest(rows * max(len(df.columns), 1), F.lit(1))
    total_missing = reduce(lambda a, b: a + b, [field("missing", c) for c in df.columns], F.lit(0))
    missing_ratio = C.safe_ratio(total_missing, cells)
    invalid_ratio = C.safe_ratio(F.col("invalid_rows"), rows)
    duplicate_ratio = F.col("duplicate_ratio")
    rate = F.try_divide(field("target", "total"), field("target", "valid")) if has_target else None

    def beyond(name: str, ratio: Column, bound: float) -> Column:
        text = F.format_string(f"{name} ratio %.4f exceeds {bound:.4f}.", ratio)
        return F.when(ratio > bound, text)

    def listed(title: str, block: str, names) -> Column:
        found = F.array_compact(
            F.array(
                *[
                    F.when(
                        field(block, n) > 0,
                        F.concat(F.lit(f"{n}: "), field(block, n).cast("string")),
                    )
                    for n in names
                ]
            )
        )
        return F.when(
            F.size(found) > 0, F.concat(F.lit(f"{title}: "), F.array_join(found, ", "))
        )

    issues = []
    if not rules.allow_empty:
        issues.append(F.when(rows == 0, "Input table is empty."))
    absent = missing_columns(df, rules.required_columns)
    if absent:
        issues.append(F.lit(f"Missing required columns: {', '.join(absent)}"))
    issues.append(beyond("Missing", missing_ratio, rules.max_missing_ratio))
    issues.append(beyond("Duplicate", duplicate_ratio, rules.max_duplicate_ratio))
    if casts:
        issues.append(listed("Values that are no number", "casts", casts))
    if ranges:
        issues.append(listed("Range violations", "ranges", ranges))
    if has_target:
        t = rules.target_column
        bounds = f"[{rules.min_target_rate:.4f}, {rules.max_target_rate:.4f}]"
        issues += [
            F.when(field("target", "valid") == 0, f"Target column {t} has no valid values."),
            F.when(field("target", "non_binary") > 0, f"Target column {t} is not binary."),
            F.when(
                (rate < rules.min_target_rate) | (rate > rules.max_target_rate),
                F.format_string(f"Target rate %.4f outside {bounds}.", rate),
            ),
        ]
    issues.append(beyond("Invalid rows", invalid_ratio, rules.max_invalid_rows_ratio))
    warned = [c for c in rules.categorical_features if c in df.columns and not is_text(df, c)]
    warnings = [F.lit(f"Categorical columns stored as numbers: {', '.join(warned)}")] if warned else []
    critical = F.array_compact(F.array(*issues))
    return one.select(
        (F.size(critical) == 0).alias("passed"),
        rows,
        F.lit(len(df.columns)).alias("columns"),
        missing_ratio.alias("missing_ratio_total"),
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in df.columns]),
            F.array(*[C.safe_ratio(field("missing", c), rows) for c in df.columns]),
        ).alias("missing_ratio_per_column"),
        F.col("duplicate_count"),
        duplicate_ratio.alias("duplicate_ratio"),
        (rate if rate is not None else F.lit(None).cast("double")).alias("target_rate"),
        invalid_ratio.alias("invalid_rows_ratio"),
        critical.alias("critical_issues"),
        F.array(*warnings).cast("array<string>").alias("warnings"),
    )


def final_check(df: DataFrame, key: str, label: str) -> DataFrame:
    """The last look at a prepared table: (item, name, count, share) with the rows, the copies of
    earlier rows, the distinct keys (as many as rows, if they are unique), the columns with missing
    values, and the label's values with their share of the labelled rows.
    """
    missing = df.columns
    one = df.agg(
        F.count("*").alias("rows"),
        F.count_distinct(key).alias("keys"),
        *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(missing)],
    )
    rows = F.col("rows")
    line = lambda item, name, n: F.struct(
        F.lit(item).alias("item"), F.lit(name).alias("name"), n.alias("count"),
        C.safe_ratio(n, rows).alias("share"),
    )
    lines = F.array(
        line("rows", "", rows), line("distinct_keys", key, F.col("keys")),
        *[line("missing", c, F.col(f"m{i}")) for i, c in enumerate(missing)],
    )
    counted = one.select(F.inline(lines)).filter((F.col("item") != "missing") | (F.col("count") > 0))
    copies = duplicate_stats(df).select(
        F.lit("copies").alias("item"), F.lit("").alias("name"), F.col("duplicate_count").alias("count"),
        F.col("duplicate_ratio").alias("share"),
    )
    shares = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).cast("string").alias("name")).agg(
        F.count("*").alias("count")
    )
    # One row per label value.
    whole = Window.partitionBy()
    labels = shares.select(
        F.lit("label").alias("item"), "name", "count",
        (F.col("count") / F.sum("count").over(whole)).alias("share"),
    )
    return counted.unionByName(copies).unionByName(labels)


def require_quality(df: DataFrame, rules: ValidationRules) -> Row:
    """Strict form: the report row, or an error that names the critical issues."""
    report = quality_report(df, rules).first()
    if not report["passed"]:
        raise DataValidationError(f"Data validation failed: {report['critical_issues']}")
    return report
