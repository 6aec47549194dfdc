"""Account views derived from the order tables (column rules in FIXTURES.md).

Only the joins that the wanted columns need are planned: customer and lineitem
are left joins on unique keys, so leaving one out never changes the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SERVICES = {
    "online_security": lambda i: i % 3 == 0,
    "tech_support": lambda i: i % 5 < 2,
    "online_backup": lambda i: i % 7 < 3,
    "device_protection": lambda i: i % 4 == 1,
    "streaming_tv": lambda i: i % 2 == 0,
    "streaming_movies": lambda i: i % 9 < 4,
}
ACCOUNT_FIELDS = [
    "account_id",
    "customer_id",
    "tenure",
    "monthly_charges",
    "total_charges",
    "contract",
    "internet_service",
    "payment_method",
    *SERVICES,
    "dependents",
    "paperless_billing",
    "senior_citizen",
    "churn",
]
FAULTY_FIELDS = [
    "account_id",
    "tenure",
    "monthly_charges",
    "total_charges",
    "contract",
    "internet_service",
    "payment_method",
    "senior_citizen",
    "churn",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def accounts(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str] | None = None,
    orders: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """One account per order, with the wanted columns (default: all).

    ``orders`` may be other rows than the whole order table, ``totals`` maintained sums
    (o_orderkey, line_total) in place of an aggregation of all line items.
    """
    wanted = list(columns or ACCOUNT_FIELDS)
    rows = table(spark, sf_dir, "orders") if orders is None else orders
    if {"payment_method", "senior_citizen"} & set(wanted):
        customers = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal"
        )
        rows = rows.join(customers, "o_custkey", "left")
    if "total_charges" in wanted:
        if totals is None:
            totals = line_totals(table(spark, sf_dir, "lineitem"))
        rows = rows.join(totals, "o_orderkey", "left")
    return rows.select(*[account_rule(c).alias(c) for c in wanted])


def line_prices(lines: DataFrame) -> DataFrame:
    """(o_orderkey, line_total) of each line item."""
    return lines.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("line_total"),
    )


def line_totals(lines: DataFrame) -> DataFrame:
    """(o_orderkey, line_total decimal(22,2)). Whole cents are added up as longs: a task that holds many
    orders needs less memory for them than for wide decimals. A sum beyond a long is an error, as
    a sum beyond the decimal is."""
    cents = F.sum((F.col("line_total") * 100).cast("long"))
    sums = line_prices(lines).groupBy("o_orderkey").agg(cents.alias("cents"))
    total = F.col("cents").cast("decimal(20,0)") * F.lit(Decimal("0.01"))
    return sums.select("o_orderkey", total.cast("decimal(22,2)").alias("line_total"))


def _tenure() -> Column:
    return ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1).cast("int")


def _contract() -> Column:
    digit = F.substring("o_orderpriority", 1, 1)
    return (
        F.when(digit.isin("1", "2", "5"), "Month-to-month")
        .when(digit == "3", "One year")
        .when(digit == "4", "Two year")
    )


def _churn_points() -> Column:
    contract = _contract()
    return (
        F.lit(15)
        + F.when(contract == "Month-to-month", 25).when(contract == "Two year", -10).otherwise(0)
        + F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 101 != 0), 20).otherwise(0)
        + F.when(_tenure() < 12, 10).otherwise(0)
    )


def _service(name: str) -> Column:
    return (
        F.when(F.col("o_orderstatus") == "P", "No internet service")
        .when(SERVICES[name](F.col("o_orderkey")), "Yes")
        .otherwise("No")
    )


# Each account column over orders (and customer, lineitem sums).
RULES = {
    "account_id": lambda: F.col("o_orderkey"),
    "customer_id": lambda: F.col("o_custkey"),
    "tenure": _tenure,
    "monthly_charges": lambda: F.col("o_totalprice") / 64,
    "total_charges": lambda: F.when(
        F.col("line_total").isNull() | (_tenure() == 0), " "
    ).otherwise(F.col("line_total").cast("string")),
    "contract": _contract,
    "internet_service": lambda: F.when(F.col("o_orderkey") % 101 == 0, None)
    .when(F.col("o_orderstatus") == "F", "Fiber optic")
    .when(F.col("o_orderstatus") == "O", "DSL")
    .when(F.col("o_orderstatus") == "P", "No"),
    "payment_method": lambda: F.when(F.col("o_orderkey") % 97 == 0, None)
    .when(F.col("c_mktsegment") == "BUILDING", "Mailed check")
    .when(F.col("c_mktsegment") == "FURNITURE", "Bank transfer (automatic)")
    .when(F.col("c_mktsegment") == "HOUSEHOLD", "Credit card (automatic)")
    .otherwise("Electronic check"),
    "dependents": lambda: F.when(F.col("o_custkey") % 10 < 3, "Yes").otherwise("No"),
    "paperless_billing": lambda: F.when(F.col("o_orderkey") % 5 == 0, "No").otherwise("Yes"),
    "senior_citizen": lambda: F.when(F.col("c_acctbal") < 0, 1).otherwise(0),
    "churn": lambda: F.when(
        (F.col("o_orderkey") * 7919) % 100 < _churn_points(), "Yes"
    ).otherwise("No"),
}


def account_rule(name: str) -> Column:
    return RULES[name]() if name in RULES else _service(name)


def fixed_score(df: DataFrame) -> DataFrame:
    """Add label ``y`` and the fixed score ``p``; needs contract, service, tenure, churn."""
    points = (
        F.when(F.col("contract") == "Month-to-month", 40)
        .when(F.col("contract") == "One year", 15)
        .otherwise(5)
        + F.when(F.col("internet_service") == "Fiber optic", 20).otherwise(0)
        + F.when(F.col("tenure") < 12, 10).otherwise(0)
        + F.col("account_id") % 11
    )
    return df.withColumns(
        {
            "p": points.cast("double") / F.lit(100.0),
            "y": F.when(F.col("churn") == "Yes", 1).otherwise(0),
        }
    )


def scored_accounts(
    spark: SparkSession, sf_dir: str, extra: Sequence[str] = ()
) -> DataFrame:
    needed = ["account_id", "tenure", "contract", "internet_service", "churn"]
    rows = accounts(spark, sf_dir, [*needed, *[c for c in extra if c not in needed]])
    return fixed_score(rows).select("account_id", *extra, "y", "p")


def faulty_accounts(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = tuple(FAULTY_FIELDS)
) -> DataFrame:
    """Accounts with planted faults and repeated rows, for the validation operations."""
    key = F.col("account_id")
    faults = {
        "tenure": F.when(key % 211 == 0, -1).otherwise(F.col("tenure")),
        "monthly_charges": F.when(key % 229 != 0, F.col("monthly_charges")),
        "total_charges": F.when(key % 227 == 0, "abc").otherwise(F.col("total_charges")),
        "internet_service": F.when(key % 223 == 0, "Satellite").otherwise(
            F.col("internet_service")
        ),
    }
    rows = accounts(spark, sf_dir, columns).withColumns(
        {c: fault for c, fault in faults.items() if c in columns}
    )
    # One pass: a row to repeat is exploded into two copies instead of a second scan.
    copies = F.when(key % 61 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("copy", F.explode(copies)).drop("copy")


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring batch per day of events: size, failures, latency."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("batch_day"))
        .agg(
            F.count("*").alias("batch_size"),
            F.count_if(F.col("event_type") == "error").alias("failed_rows"),
            F.sum("value").alias("latency_ms"),
        )
    )


def threshold_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results history: one row per event, the event type standing for the model."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("model_id"),
        (((F.col("event_id") * 37) % 66 + 20).cast("double") / F.lit(100.0)).alias(
            "final_threshold"
        ),
    )
