"""Row-by-row input validation and checks of scored output, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.functions import columns as C
from stayflow.operators.quality import DataValidationError, missing_columns
from stayflow.params import CustomerColumns

# Allowed values, fixed.
YES_NO = ["Yes", "No"]
YES_NO_INTERNET = ["Yes", "No", "No internet service"]
YES_NO_PHONE = ["Yes", "No", "No phone service"]
INTERNET_SERVICES = ["DSL", "Fiber optic", "No"]
CONTRACTS = ["Month-to-month", "One year", "Two year"]
PAYMENT_METHODS = [
    "Electronic check",
    "Mailed check",
    "Bank transfer (automatic)",
    "Credit card (automatic)",
]


def _bound_errors(df: DataFrame, name: str, high: int | None, whole: bool) -> list[Column]:
    """Parse error, else each violated bound of one numeric field (NULL where fine)."""
    c, value = F.col(name), C.number(df, name)
    kind = "integer" if whole else "number"
    present = c.isNotNull()
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        present = present & ~F.isnan(c)
    unreadable = present & value.isNull()
    if whole:
        unreadable = unreadable | (value != F.floor(value))
    unreadable = F.coalesce(unreadable, F.lit(False))
    checks = [
        F.when(unreadable, f"Input should be a valid {kind}: {name}"),
        F.when(~unreadable & (value < 0), f"Input should be greater than or equal to 0: {name}"),
    ]
    if high is not None:
        checks.append(
            F.when(
                ~unreadable & (value > high),
                f"Input should be less than or equal to {high}: {name}",
            )
        )
    return checks


def field_errors(df: DataFrame, cols: CustomerColumns) -> Column:
    """All type and bound errors of a row, in field order."""
    checks: list[Column] = []
    for name, high, whole in [
        (cols.senior, 1, True),
        (cols.tenure, None, True),
        (cols.monthly, None, False),
        (cols.total, None, False),
    ]:
        if name in df.columns:
            checks += _bound_errors(df, name, high, whole)
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def category_error(df: DataFrame, cols: CustomerColumns) -> Column:
    """The first field, in fixed order, whose value is outside its set; NULL when all are fine."""
    phrase = "Invalid value '%s' for {}."
    order: list[tuple[str, list[str], str]] = [
        (c, YES_NO, phrase.format(c))
        for c in (cols.partner, cols.dependents, cols.phone, cols.paperless)
    ]
    order.append((cols.multiple_lines, YES_NO_PHONE, phrase.format(cols.multiple_lines)))
    order += [
        (c, YES_NO_INTERNET, phrase.format(c))
        for c in (
            cols.online_security,
            cols.online_backup,
            cols.device_protection,
            cols.tech_support,
            cols.streaming_tv,
            cols.streaming_movies,
        )
    ]
    order += [
        (cols.internet, INTERNET_SERVICES, "Invalid internet service: %s"),
        (cols.contract, CONTRACTS, "Invalid contract: %s"),
        (cols.payment, PAYMENT_METHODS, "Invalid payment method: %s"),
    ]
    checks = [
        F.when(~F.col(c).isin(allowed), F.format_string(text, F.col(c)))
        for c, allowed, text in order
        if c in df.columns
    ]
    return F.coalesce(*checks, F.lit(None).cast("string"))


def required_error(required: Sequence[str]) -> Column:
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in required]))
    return F.when(
        F.size(names) > 0,
        F.concat(F.lit("Null values in required columns: "), F.array_join(names, ", ")),
    )


def with_row_errors(
    df: DataFrame, cols: CustomerColumns = CustomerColumns(), required: Sequence[str] = ()
) -> DataFrame:
    """Add ``errors``: all field errors, else the first category error, else missing values.

    A required column the table lacks fails every row with one batch-level error.
    """
    absent = missing_columns(df, required)
    if absent:
        return df.withColumn(
            "errors", F.array(F.lit(f"Missing required columns: {', '.join(absent)}"))
        )
    fields = field_errors(df, cols)
    later = [category_error(df, cols)]
    if required:
        later.append(required_error(required))
    first = F.coalesce(*later)
    return df.withColumn(
        "errors",
        F.when(F.size(fields) > 0, fields).otherwise(F.array_compact(F.array(first))),
    )


def split_valid(
    df: DataFrame, cols: CustomerColumns = CustomerColumns(), required: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows with their errors)."""
    checked = with_row_errors(df, cols, required)
    fine = F.size("errors") == 0
    return checked.filter(fine).drop("errors"), checked.filter(~fine)


def require_valid_rows(
    df: DataFrame, cols: CustomerColumns = CustomerColumns(), required: Sequence[str] = ()
) -> DataFrame:
    """Strict form: the table itself, or an error with the number of bad rows."""
    absent = missing_columns(df, required)
    if absent:
        raise DataValidationError(f"Batch input validation failed: missing {absent}")
    bad = split_valid(df, cols, required)[1].count()
    if bad:
        raise DataValidationError(f"Batch input validation failed for {bad} rows.")
    return df


def output_issue_counts(scored: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row of issue counts over a scored table; a NULL is an issue in each check."""
    p, decision = F.col("churn_probability"), F.col("decision")

    def failing(fine: Column) -> Column:
        return F.count_if(~F.coalesce(fine, F.lit(False)))

    expected = F.when(p >= F.lit(threshold), "contact").otherwise("no_contact")
    return scored.agg(
        F.count("*").alias("rows"),
        failing(p.between(0, 1)).alias("invalid_probability"),
        failing(F.col("churn_prediction").isin(0, 1)).alias("invalid_prediction"),
        failing(decision.isin("contact", "no_contact")).alias("invalid_decision"),
        (failing(decision == expected) if threshold is not None else F.lit(0)).alias(
            "inconsistent_decision"
        ),
    )


def output_issues(
    scored: DataFrame, threshold: float | None = None, strict: bool = True
) -> list[str]:
    """Texts of the failed output checks; strict raises when there are any."""
    if "churn_probability" not in scored.columns:
        issues = ["Missing 'churn_probability' column."]
    else:
        have = scored
        for name, stand_in in (("churn_prediction", F.lit(0)), ("decision", None)):
            if name not in have.columns:
                if stand_in is None:
                    p = F.col("churn_probability")
                    stand_in = F.when(p >= F.lit(threshold or 0.0), "contact").otherwise(
                        "no_contact"
                    )
                have = have.withColumn(name, stand_in)
        counts = output_issue_counts(have, threshold).first()
        texts = {
            "invalid_probability": "rows have probabilities outside [0, 1].",
            "invalid_prediction": "rows have invalid churn_prediction values.",
            "invalid_decision": "rows have invalid decision values.",
            "inconsistent_decision": "rows have inconsistent decision vs probability.",
        }
        issues = [f"{counts[k]} {text}" for k, text in texts.items() if counts[k] > 0]
    if strict and issues:
        raise DataValidationError(f"Prediction output validation failed: {issues}")
    return issues
