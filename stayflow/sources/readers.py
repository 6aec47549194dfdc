"""Readers: customer CSV, fitted medians, results history, processed matrix."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.operators.quantiles import MAX_GROUPS
from stayflow.operators.sizing import collect_small
from stayflow.functions import columns as C

# Texts that mean "missing" in a CSV file, fixed.
NA_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("customerID", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("SeniorCitizen", T.IntegerType()),
        T.StructField("Partner", T.StringType()),
        T.StructField("Dependents", T.StringType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("PhoneService", T.StringType()),
        T.StructField("MultipleLines", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("OnlineSecurity", T.StringType()),
        T.StructField("OnlineBackup", T.StringType()),
        T.StructField("DeviceProtection", T.StringType()),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("StreamingTV", T.StringType()),
        T.StructField("StreamingMovies", T.StringType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("PaperlessBilling", T.StringType()),
        T.StructField("PaymentMethod", T.StringType()),
        T.StructField("MonthlyCharges", T.DoubleType()),
        T.StructField("TotalCharges", T.StringType()),
        T.StructField("Churn", T.StringType()),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = CUSTOMER_SCHEMA) -> DataFrame:
    """CSV with a header, columns matched by name; missing-value texts become NULL, a lone
    space stays. Columns the file lacks are left out, extra ones stay text."""
    raw = (
        spark.read.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .csv(path)
    )
    kinds = {f.name: f.dataType for f in schema.fields}
    columns = []
    for name in raw.columns:
        text = F.when(~F.col(f"`{name}`").isin(NA_TEXTS), F.col(f"`{name}`"))
        kind = kinds.get(name, T.StringType())
        if not isinstance(kind, T.StringType):
            text = C.text_to_number(text).cast(kind)
        columns.append(text.alias(name))
    return raw.select(*columns)


def read_medians(
    spark: SparkSession, path: str, group: str = "group"
) -> dict[str, float] | DataFrame | None:
    """Group medians written by ``write_json``; None when the file is missing or no object.

    Like ``fit_medians``: a dict while the groups are few, beyond that a DataFrame (group, median)
    whose group column is called ``group``.
    """
    try:
        table = spark.read.json(path)
        if not {"group", "median"} <= set(table.columns):
            return None
        table = table.filter(F.col("group").isNotNull()).select(
            F.col("group").alias(group), F.col("median").cast("double").alias("median")
        )
        few = collect_small(table, MAX_GROUPS)
    except AnalysisException:
        return None
    return table if few is None else {r[group]: r["median"] for r in few}


def read_matrix(spark: SparkSession, path: str, splits: list[str] | None = None) -> DataFrame:
    """Processed rows; asking for some splits reads only their partitions."""
    matrix = spark.read.parquet(path)
    return matrix.filter(F.col("split").isin(splits)) if splits else matrix


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is NULL from here on, never NaN."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            F.nanvl(F.col(c), F.lit(None).cast(kinds[c])).alias(c)
            if kinds[c] in ("double", "float")
            else F.col(c)
            for c in df.columns
        ]
    )
