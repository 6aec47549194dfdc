"""Scalar column functions: cleaning, flags, bins, safe arithmetic, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a number in text. Spark's own cast also takes "1d" and "NaN".
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
BLANK_TEXT = r"^\s*$"

CONTRACT_ORDER = {"Month-to-month": 0, "One year": 1, "Two year": 2}
AUTOMATIC_PAYMENTS = ["Bank transfer (automatic)", "Credit card (automatic)"]


def text_to_number(c: Column) -> Column:
    """Text to double; anything that is not plainly a number becomes NULL."""
    return F.when(c.rlike(NUMBER_TEXT), F.trim(c).try_cast("double"))


def number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as double with unreadable values and NaN as NULL."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return text_to_number(F.col(name))
    value = F.col(name).cast("double")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.nanvl(value, F.lit(None).cast("double"))
    return value


def number_or_default(df: DataFrame, name: str, default: float = 0.0) -> Column:
    """Numeric column with NULL filled; a constant where the column is absent."""
    if name not in df.columns:
        return F.lit(float(default))
    return F.coalesce(number(df, name), F.lit(float(default)))


def blank_to_null(c: Column) -> Column:
    return F.when(~c.rlike(BLANK_TEXT), c)


def is_blank(c: Column) -> Column:
    return F.trim(c) == ""


def at_least(c: Column, floor: float) -> Column:
    return F.greatest(c, F.lit(floor))


def flag_equal(c: Column, value) -> Column:
    """1 where equal, 0 elsewhere and for NULL."""
    return c.eqNullSafe(F.lit(value)).cast("int")


def flag_not_equal(c: Column, value) -> Column:
    """1 where different, also for NULL."""
    return (~c.eqNullSafe(F.lit(value))).cast("int")


def flag_in(c: Column, values: Sequence) -> Column:
    return F.coalesce(c.isin(list(values)), F.lit(False)).cast("int")


def ordinal(c: Column, order: Mapping[str, int], unknown: int = 0) -> Column:
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(order.items())])
    return F.coalesce(F.try_element_at(lookup, c), F.lit(unknown))


def right_closed_bins(
    c: Column, edges: Sequence[float], labels: Sequence, include_lowest: bool = True
) -> Column:
    """Bins (e0,e1], (e1,e2] ...; outside is NULL; the lowest edge counts on request."""
    above = c >= edges[0] if include_lowest else c > edges[0]
    result = None
    for upper, label in zip(edges[1:], labels, strict=True):
        hit = above & (c <= upper)
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return result


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def round_even(c: Column, digits: int) -> Column:
    """Round with ties to even."""
    return F.bround(c, digits)


def threshold_grid(low: float, high: float, step: float) -> list[float]:
    """Candidate thresholds from low to high, the end included, two decimals."""
    first, last, width = (round(x * 10_000) for x in (low, high, step))
    return [round(t / 10_000, 2) for t in range(first, last + 1, width)]


def significance(p: Column, otherwise: str = "") -> Column:
    return (
        F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise(otherwise)
    )


def target_status(value: Column, target: Column, minimum: Column) -> Column:
    return F.when(value >= target, "target").when(value >= minimum, "minimum").otherwise("below")


def feature_group(name: Column, keep_prefix: str = "TotalCharges") -> Column:
    """Encoded feature name without its last ``_part``; names with the prefix stay whole."""
    return F.when(name.startswith(keep_prefix), name).otherwise(
        F.regexp_replace(name, r"_[^_]*$", "")
    )


def contains_any(name: Column, parts: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(name, F.lit(p)) for p in parts])


def label_flag(c: Column) -> Column:
    """Yes -> 1, No -> 0, anything else NULL."""
    return F.when(c == "Yes", 1).when(c == "No", 0)


def yes_no(c: Column) -> Column:
    """0 -> No, 1 -> Yes, anything else NULL."""
    return F.when(c == 0, "No").when(c == 1, "Yes")


def percent_difference(a: Column, b: Column, digits: int = 1) -> Column:
    """Difference a - b in percent of b."""
    return round_even(F.try_divide(a - b, b) * 100, digits)
