"""Impute, scale and encode with statistics fitted on the training rows.

The fitted state is a few numbers per column and the category lists, so applying
it is one projection of literals without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.operators.quality import DataValidationError, missing_columns
from stayflow.operators.quantiles import exact_quantiles
from stayflow.operators.sizing import collect_small
from stayflow.operators.stats import column_values
from stayflow.params import ENGINEERED, CustomerColumns

MAX_CATEGORIES = 5_000


@dataclass(frozen=True)
class Preprocessor:
    numeric: list[str]
    categorical: list[str]
    fill: dict[str, float]
    mean: dict[str, float]
    std: dict[str, float]
    mode: dict[str, str | None]
    categories: dict[str, list[str]]
    drop_first: bool = True
    indicators: list[str] = field(default_factory=list)
    #: Share of each category among the training rows, missing values counted as the mode.
    shares: dict[str, dict[str, float]] = field(default_factory=dict)

    def encoded(self, name: str) -> list[str]:
        """Categories that get a column."""
        return self.categories[name][1 if self.drop_first else 0 :]

    def feature_names(self) -> list[str]:
        return [
            *[f"num__{c}" for c in self.numeric],
            *[f"num__{c}_missing" for c in self.indicators],
            *[f"cat__{c}_{v}" for c in self.categorical for v in self.encoded(c)],
        ]

    def feature_means(self) -> dict[str, float]:
        """Mean of every encoded feature over the training rows: scaled ones have 0, a category its
        share. No pass over the rows."""
        out = {n: 0.0 for n in self.feature_names()}
        for c in self.categorical:
            out.update({f"cat__{c}_{v}": self.shares[c][v] for v in self.encoded(c)})
        return out

    def filled(self, df: DataFrame, name: str) -> Column:
        return F.coalesce(C.number(df, name), F.lit(self.fill[name]))

    def scaled(self, value: Column, name: str) -> Column:
        return (value - F.lit(self.mean[name])) / F.lit(self.std[name])

    def feature_columns(self, df: DataFrame) -> dict[str, Column]:
        """Encoded feature name -> expression, in the fixed output order."""
        out = {f"num__{c}": self.scaled(self.filled(df, c), c) for c in self.numeric}
        for c in self.indicators:
            flag = C.number(df, c).isNull().cast("double")
            out[f"num__{c}_missing"] = self.scaled(flag, f"{c}_missing")
        for c in self.categorical:
            value = F.coalesce(F.col(c).cast("string"), F.lit(self.mode[c]))
            for v in self.encoded(c):
                out[f"cat__{c}_{v}"] = C.flag_equal(value, v).cast("double")
        return out

    def require_columns(self, df: DataFrame) -> None:
        absent = missing_columns(df, [*self.numeric, *self.categorical])
        if absent:
            raise DataValidationError(f"Missing features in prepared data: {absent}")

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Kept columns plus ``features array<double>``; everything else is dropped."""
        self.require_columns(df)
        return df.select(*keep, F.array(*self.feature_columns(df).values()).alias("features"))

    def transform_wide(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Kept columns plus one column per encoded feature."""
        self.require_columns(df)
        return df.select(*keep, *[e.alias(n) for n, e in self.feature_columns(df).items()])


def fit_preprocessor(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    impute: str = "median",
    drop_first: bool = True,
    indicators: bool = False,
) -> Preprocessor:
    """Fit on the training rows: exact medians (or zero), population mean and deviation
    after imputing, most frequent value (smallest on ties), sorted category lists."""
    numeric, categorical = list(numeric), list(categorical)
    absent = missing_columns(train, [*numeric, *categorical])
    if absent:
        raise DataValidationError(f"Missing features in prepared data: {absent}")

    fill = {c: 0.0 for c in numeric}
    if impute == "median" and numeric:
        for r in exact_quantiles(train, numeric, [0.5]).collect():
            fill[r["column"]] = r["value"]

    mean, std, marked = {}, {}, []
    if numeric:
        number = {c: C.number(train, c) for c in numeric}
        one = train.agg(
            *[F.count_if(number[c].isNull()).alias(f"{c}|missing") for c in numeric],
            F.count("*").alias("|rows"),
            *[
                agg(F.coalesce(number[c], F.lit(fill[c]))).alias(f"{c}|{tag}")
                for c in numeric
                for tag, agg in (("mean", F.avg), ("std", F.stddev_pop))
            ],
        ).first()
        for c in numeric:
            mean[c], std[c] = one[f"{c}|mean"], one[f"{c}|std"] or 1.0
        if indicators:
            marked = [c for c in numeric if one[f"{c}|missing"] > 0]
            for c in marked:
                share = one[f"{c}|missing"] / one["|rows"]
                mean[f"{c}_missing"] = share
                std[f"{c}_missing"] = (share * (1 - share)) ** 0.5 or 1.0

    counts = category_counts(train, categorical)
    mode, categories = _modes_and_categories(counts)
    shares = {}
    for c, found in counts.items():
        rows = max(sum(found.values()), 1)
        filled = {v: n + (found.get(None, 0) if v == mode[c] else 0) for v, n in found.items() if v is not None}
        shares[c] = {v: n / rows for v, n in filled.items()}
    return Preprocessor(
        numeric, categorical, fill, mean, std, mode, categories, drop_first, marked, shares
    )


def category_counts(train: DataFrame, columns: Sequence[str]) -> dict[str, dict[str | None, int]]:
    """Rows per value of each column, from one grouping. Categories become literals of a plan; more
    than MAX_CATEGORIES are a table of their own, for ``dictionary.fit_dictionary``."""
    out: dict[str, dict[str | None, int]] = {c: {} for c in columns}
    if not columns:
        return out
    values = column_values(train, columns).groupBy("column", "value").count()
    counts = collect_small(values, MAX_CATEGORIES + len(columns))
    if counts is None:
        raise DataValidationError(
            f"more than {MAX_CATEGORIES} categories in {list(columns)}: encode them by a dictionary"
        )
    for r in counts:
        out[r["column"]][r["value"]] = r["count"]
    return out


def _modes_and_categories(
    counts: dict[str, dict[str | None, int]],
) -> tuple[dict[str, str | None], dict[str, list[str]]]:
    categories = {c: sorted(v for v in found if v is not None) for c, found in counts.items()}
    # The first of the sorted values with the most rows.
    return {c: max(v, key=counts[c].__getitem__, default=None) for c, v in categories.items()}, categories


def fit_categories(
    train: DataFrame, columns: Sequence[str]
) -> tuple[dict[str, str | None], dict[str, list[str]]]:
    """(most frequent value, sorted categories) per column."""
    return _modes_and_categories(category_counts(train, columns))


def ordinal_encode(
    df: DataFrame, categories: dict[str, list[str]], unknown: int = -1
) -> dict[str, Column]:
    """Position of each value in its sorted category list; unknown or missing gets -1."""
    out = {}
    for c, values in categories.items():
        place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(c)) - 1
        out[c] = F.coalesce(place, F.lit(unknown)).cast("int")
    return out


def dataset_contract(matrix: DataFrame, width: int, label: str = "label") -> DataFrame:
    """Per split: rows, rows with a label, and the counts that must all be zero."""
    entries = F.col("features")
    return matrix.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.count(label).alias("labelled_rows"),
        F.count_if(F.size(entries) != width).alias("wrong_width"),
        F.count_if(F.exists(entries, lambda x: x.isNull() | F.isnan(x))).alias("rows_with_nan"),
        F.count_if(F.exists(entries, lambda x: F.abs(x) == float("inf"))).alias("rows_with_inf"),
    )


def require_contract(matrix: DataFrame, width: int, label: str = "label") -> None:
    for r in dataset_contract(matrix, width, label).collect():
        bad = r["wrong_width"] + r["rows_with_nan"] + r["rows_with_inf"]
        if bad or r["rows"] != r["labelled_rows"]:
            raise DataValidationError(f"dataset contract broken in split {r['split']}: {r.asDict()}")


def feature_sets(cols: CustomerColumns) -> dict[str, list[str]]:
    """The three compared feature lists, each followed by the engineered features."""
    # The order of the lists is the order of the features.
    core = [
        cols.tenure, cols.monthly, cols.contract, cols.internet,
        cols.online_security, cols.tech_support, cols.payment,
    ]
    full = [
        cols.gender, cols.senior, cols.partner, cols.dependents, cols.tenure,
        cols.phone, cols.multiple_lines, cols.internet, cols.online_security,
        cols.online_backup, cols.device_protection, cols.tech_support, cols.streaming_tv,
        cols.streaming_movies, cols.contract, cols.paperless, cols.payment,
        cols.monthly, cols.total,
    ]
    moderate = [
        cols.tenure, cols.monthly, cols.total, cols.senior,
        cols.dependents, cols.paperless, cols.contract, cols.internet,
        cols.online_security, cols.tech_support, cols.payment,
    ]
    return {
        name: list(dict.fromkeys([*raw, *ENGINEERED]))
        for name, raw in (("A", core), ("B", full), ("C", moderate))
    }


def numeric_and_text(df: DataFrame, names: Sequence[str]) -> tuple[list[str], list[str]]:
    """Split the names that exist into numeric and text columns, order kept."""
    kinds = dict(df.dtypes)
    present = [c for c in names if c in kinds]
    return (
        [c for c in present if kinds[c] != "string"],
        [c for c in present if kinds[c] == "string"],
    )
