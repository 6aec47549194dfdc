"""Engineered features with statistics learned on the training rows only."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.operators.quantiles import MAX_GROUPS, exact_quantiles
from stayflow.operators.sizing import collect_small
from stayflow.params import CustomerColumns

GLOBAL_GROUP = "__global__"
TENURE_BINS = (0, 6, 12, 24, 48, 72)
TENURE_LABELS = (0.0, 1.0, 2.0, 3.0, 4.0)
MAP_LIMIT = 200

Medians = Mapping[str, float] | DataFrame


def group_medians(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, median): exact, missing groups and values left out."""
    return exact_quantiles(df, [value], [0.5], by=[group]).select(
        F.col(group), F.col("value").alias("median")
    )


def global_median(df: DataFrame, value: str) -> float:
    """Exact median of the zero-filled column; 0 for an empty table."""
    filled = df.select(C.number_or_default(df, value).alias(value))
    row = exact_quantiles(filled, [value], [0.5]).first()
    return float(row["value"]) if row else 0.0


def fit_medians(df: DataFrame, cols: CustomerColumns = CustomerColumns()) -> Medians:
    """Median charge per group of the training rows.

    A dict while the groups are few; beyond that a DataFrame (group, median).
    """
    if cols.internet not in df.columns:
        return {GLOBAL_GROUP: global_median(df, cols.monthly)}
    medians = group_medians(df, cols.internet, cols.monthly)
    few = collect_small(medians, MAX_GROUPS)
    return medians if few is None else {r[cols.internet]: r["median"] for r in few}


def with_group_median(df: DataFrame, group: str, medians: Medians, name: str) -> DataFrame:
    """Look up each row's group; an unknown or missing group gets the global entry, else 0."""
    if isinstance(medians, DataFrame):
        if group not in df.columns:
            return df.withColumn(name, F.lit(0.0))
        known = medians.select(F.col(group), F.col("median").alias(name))
        return df.join(known, group, "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
    fallback = F.lit(float(medians.get(GLOBAL_GROUP, 0.0)))
    groups = {k: float(v) for k, v in medians.items() if k != GLOBAL_GROUP and v is not None}
    if group not in df.columns or not groups:
        return df.withColumn(name, fallback)
    if len(groups) <= MAP_LIMIT:
        pairs = [F.lit(x) for k, v in groups.items() for x in (k, v)]
        found = F.try_element_at(F.create_map(*pairs), F.col(group))
        return df.withColumn(name, F.coalesce(found, fallback))
    kind = df.schema[group].dataType.simpleString()
    known = df.sparkSession.createDataFrame(list(groups.items()), f"`{group}` {kind}, {name} double")
    # A dict of medians holds at most MAX_GROUPS entries, so the broadcast is bounded.
    joined = df.join(F.broadcast(known), group, "left")
    return joined.withColumn(name, F.coalesce(name, fallback))


def count_yes(df: DataFrame, names: list[str]) -> Column:
    flags = [C.flag_equal(F.col(c), "Yes") for c in names if c in df.columns]
    return reduce(lambda a, b: a + b, flags, F.lit(0))


def tenure_group(c: Column, bins=TENURE_BINS, labels=TENURE_LABELS) -> Column:
    return C.right_closed_bins(c, bins, labels)


def engineer_features(
    df: DataFrame,
    medians: Medians | None = None,
    cols: CustomerColumns = CustomerColumns(),
    bins=TENURE_BINS,
    labels=TENURE_LABELS,
) -> DataFrame:
    """Add the 14 engineered columns. A feature whose source column is absent is 0.

    Without medians the table's own global median stands in.
    """
    if medians is None or (not isinstance(medians, DataFrame) and not medians):
        medians = {GLOBAL_GROUP: global_median(df, cols.monthly)}
    base = with_group_median(df, cols.internet, medians, "_median")
    tenure = C.number_or_default(df, cols.tenure)
    monthly = C.number_or_default(df, cols.monthly)
    total = C.number_or_default(df, cols.total)
    safe_tenure = C.at_least(tenure, 1.0)
    support = count_yes(df, cols.support)

    def needs(names: list[str], feature: Column) -> Column:
        return feature if all(n in df.columns for n in names) else F.lit(0)

    month_to_month = (
        F.col(cols.contract).eqNullSafe(F.lit("Month-to-month"))
        if cols.contract in df.columns
        else F.lit(False)
    )
    order = (
        C.ordinal(F.col(cols.contract), C.CONTRACT_ORDER)
        if cols.contract in df.columns
        else F.lit(0)
    )
    features = {
        "avg_monthly_spend": total / safe_tenure,
        "charge_tenure_ratio": monthly / safe_tenure,
        "charge_deviation": monthly - total / safe_tenure,
        "expected_lifetime_value": monthly * tenure,
        "overpay_indicator": monthly - F.col("_median"),
        "tenure_group": tenure_group(tenure, bins, labels),
        "num_support_services": support,
        "num_streaming_services": count_yes(df, cols.streaming),
        "is_mtm_fiber": needs(
            [cols.contract, cols.internet],
            (month_to_month & F.col(cols.internet).eqNullSafe(F.lit("Fiber optic"))).cast("int")
            if cols.internet in df.columns
            else F.lit(0),
        ),
        "is_mtm_no_support": needs([cols.contract], (month_to_month & (support == 0)).cast("int")),
        "is_echeck_mtm": needs(
            [cols.contract, cols.payment],
            (month_to_month & F.col(cols.payment).eqNullSafe(F.lit("Electronic check"))).cast("int")
            if cols.payment in df.columns
            else F.lit(0),
        ),
        "tenure_x_contract": tenure * order,
        "is_auto_pay": C.flag_in(F.col(cols.payment), C.AUTOMATIC_PAYMENTS)
        if cols.payment in df.columns
        else F.lit(0),
        "has_internet": C.flag_not_equal(F.col(cols.internet), "No")
        if cols.internet in df.columns
        else F.lit(0),
    }
    return base.withColumns(features).drop("_median")


def clean_total_charges(df: DataFrame, cols: CustomerColumns = CustomerColumns()) -> DataFrame:
    """Total charges as a number; unreadable or missing becomes 0."""
    return df.withColumn(cols.total, C.number_or_default(df, cols.total))


def prepare_labels(df: DataFrame, cols: CustomerColumns = CustomerColumns()) -> DataFrame:
    """Yes/No label to 1/0; any other label stops the job instead of losing the row."""
    label = C.label_flag(F.col(cols.label))
    bad = F.raise_error(F.concat(F.lit("label is neither Yes nor No: "), F.coalesce(F.col(cols.label), F.lit("NULL"))))
    return df.withColumn(cols.label, F.coalesce(label, bad.cast("int")))


def keep_columns(df: DataFrame, keep: list[str], drop: list[str] = ()) -> DataFrame:
    """Ordered list of columns to keep, absent ones ignored, dropped ones left out."""
    return df.select(*[c for c in dict.fromkeys(keep) if c in df.columns and c not in drop])
