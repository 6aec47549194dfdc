"""Encode columns with any number of categories: a dictionary table and sparse vectors.

The literal path of ``preprocess`` holds every category in the plan, which suits some thousands. Here
the categories are a table (column, value, place, rows) that rows are joined with, and the encoded
features are MLlib sparse vectors, whose width is one number per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.operators.sizing import materialize
from stayflow.operators.stats import column_values


@dataclass(frozen=True)
class Dictionary:
    """Places of the sorted values of each column, from 0; per column the number of values and the
    most frequent one (the smallest of equals), None where it has none."""

    table: DataFrame
    sizes: dict[str, int]
    modes: dict[str, str | None]

    def with_places(self, df: DataFrame, columns: Mapping[str, str], fill: bool = False) -> DataFrame:
        """Add for each column its place under another name; missing and unknown values have none.
        With ``fill`` a missing value counts as the most frequent one.

        One unhinted join per column: small parts are broadcast by their size, and a frequent value
        of a large part can be split, as nothing above the join asks for its key.
        """
        for column, name in columns.items():
            part = self.table.filter(F.col("column") == column).select(
                F.col("value").alias("_value"), F.col("place").alias(name)
            )
            value = F.col(column).cast("string")
            if fill:
                value = F.coalesce(value, F.lit(self.modes[column]))
            df = df.join(part, value == F.col("_value"), "left").drop("_value")
        return df


def fit_dictionary(train: DataFrame, columns: Sequence[str]) -> Dictionary:
    """The dictionary of the values (as text) that occur in the training rows.

    Values are merged, dealt to ranges in their order, and placed by the totals of the ranges before
    them, so no task sorts a whole column. The driver gets one row per column.
    """
    spark = train.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = column_values(train, list(columns)).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count("*").alias("rows")
    )
    # Stored, because ranges are cut by a sample and must be the same for all that follows.
    dealt = materialize(
        counts.repartitionByRange(parts, "column", "value").withColumn("part", F.spark_partition_id())
    )
    line = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("column", "part").agg(F.count("*").alias("n")).select(
        F.col("column").alias("_column"), F.col("part").alias("_part"),
        F.coalesce(F.sum("n").over(line), F.lit(0)).alias("before"),
    )
    inside = Window.partitionBy("column", "part").orderBy("value")
    table = materialize(
        dealt.join(
            F.broadcast(offsets), (F.col("column") == F.col("_column")) & (F.col("part") == F.col("_part"))
        ).select(
            "column", "value", (F.col("before") + F.row_number().over(inside) - 1).alias("place"), "rows"
        )
    )
    sizes, modes = dict.fromkeys(columns, 0), dict.fromkeys(columns)
    most = F.max_by("value", F.struct("rows", -F.col("place")))
    for r in table.groupBy("column").agg(F.count("*").alias("n"), most.alias("mode")).collect():
        sizes[r["column"]], modes[r["column"]] = r["n"], r["mode"]
    return Dictionary(table, sizes, modes)


def ordinal_encode(df: DataFrame, dictionary: Dictionary, columns: Sequence[str], unknown: int = -1) -> DataFrame:
    """Add ``<column>_place``: the place of each value; unknown or missing gets -1."""
    names = {c: f"{c}_place" for c in columns}
    placed = dictionary.with_places(df, names)
    return placed.withColumns({n: F.coalesce(F.col(n), F.lit(unknown)).cast("long") for n in names.values()})


def one_hot_encode(
    df: DataFrame,
    dictionary: Dictionary,
    columns: Sequence[str],
    numbers: Mapping[str, Column] | None = None,
    drop_first: bool = True,
    name: str = "features",
) -> DataFrame:
    """Add a vector: the ``numbers`` in order, then for each column one place per category (the first
    left out), in sorted order. Missing values count as the most frequent one, unknown ones as none.

    ``numbers`` must not hold NULL. A row's vector holds its own few entries, whatever the width.
    """
    numbers = dict(numbers or {})
    columns = [c for c in columns if dictionary.sizes[c] > (1 if drop_first else 0)]
    places = {c: f"_place{i}" for i, c in enumerate(columns)}
    dots = {c: f"_dots{i}" for i, c in enumerate(columns)}
    rows = dictionary.with_places(df, places, fill=True)
    # The encoder leaves out the last place: that of the first category, or of unknown values.
    for c, place in places.items():
        size = dictionary.sizes[c]
        if drop_first:
            index = F.when(F.col(place) > 0, F.col(place) - 1).otherwise(size - 1)
        else:
            index = F.coalesce(F.col(place), F.lit(size))
        rows = rows.withColumn(place, F.coalesce(index, F.lit(size - 1)).cast("double"))
    held = [f"_number{i}" for i in range(len(numbers))]
    rows = rows.withColumns({h: e for h, e in zip(held, numbers.values())})
    if columns:
        rows = _encoder(df, dictionary, places, dots, drop_first).transform(rows)
    inputs = [*held, *dots.values()]
    return VectorAssembler(inputCols=inputs, outputCol=name).transform(rows).drop(*held, *places.values(), *dots.values())


def _encoder(
    df: DataFrame, dictionary: Dictionary, places: dict[str, str], dots: dict[str, str], drop_first: bool
) -> OneHotEncoderModel:
    """MLlib's encoder for known widths: fitted on one row that holds the last place of each column."""
    last = [float(dictionary.sizes[c] - (1 if drop_first else 0)) for c in places]
    one = df.sparkSession.createDataFrame([last], ", ".join(f"{p} double" for p in places.values()))
    return OneHotEncoder(inputCols=list(places.values()), outputCols=list(dots.values()), dropLast=True).fit(one)


def encoded_names(
    dictionary: Dictionary, columns: Sequence[str], numbers: Sequence[str] = (), drop_first: bool = True
) -> DataFrame:
    """(place, name) of the entries of the encoded vector."""
    spark = dictionary.table.sparkSession
    first = int(drop_first)
    before, lines = len(numbers), []
    for c in columns:
        lines.append((c, before))
        before += max(dictionary.sizes[c] - first, 0)
    offsets = spark.createDataFrame(lines, "of string, before long")
    texts = dictionary.table.join(F.broadcast(offsets), F.col("column") == F.col("of")).filter(F.col("place") >= first)
    names = texts.select(
        (F.col("before") + F.col("place") - first).alias("place"),
        F.concat(F.lit("cat__"), "column", F.lit("_"), "value").alias("name"),
    )
    own = [(i, f"num__{n}") for i, n in enumerate(numbers)]
    return names.unionByName(spark.createDataFrame(own, "place long, name string")) if own else names
