"""Audit, quality checks and row validation over accounts with planted faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.operators import quality as Q
from stayflow.operators import rows as R
from stayflow.operators import stats as St
from stayflow.operators.features import clean_total_charges as clean_totals
from stayflow.operators.sizing import scratch_folder
from stayflow.params import ACCOUNT_COLUMNS, ACCOUNT_RULES
from stayflow.plans import check_sql as S
from stayflow.plans.registry import query, rounded
from stayflow.sources.accounts import ACCOUNT_FIELDS, FAULTY_FIELDS, accounts, faulty_accounts
from stayflow.sources.readers import read_csv
from stayflow.sources.sinks import write_csv

_FAULTY = f"WITH {S.FAULTY}"
_TEXT = ["total_charges", "contract", "internet_service", "payment_method", "churn"]


def _missing(c: str) -> str:
    return f"({c} IS NULL OR regexp_full_match({c}, '\\s*'))" if c in _TEXT else f"({c} IS NULL)"


def _number(c: str) -> str:
    return f"try_cast(trim({c}) AS DOUBLE)" if c == "total_charges" else f"CAST({c} AS DOUBLE)"


# ---- sources ----------------------------------------------------------------


@query(
    "scan_csv_roundtrip",
    f"""WITH {S.ACCOUNTS} SELECT account_id, tenure, monthly_charges, total_charges, contract,
  internet_service, payment_method, churn FROM accounts""",
)
def scan_csv_roundtrip(spark, sf_dir):
    """Accounts written as CSV and read back by declared schema: values and blanks survive."""
    names = [
        "account_id", "tenure", "monthly_charges", "total_charges", "contract",
        "internet_service", "payment_method", "churn",
    ]
    rows = accounts(spark, sf_dir, names)
    path = scratch_folder(spark)
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


# ---- cleaning and audit -------------------------------------------------------


@query(
    "clean_total_charges",
    f"{_FAULTY} SELECT account_id, coalesce({_number('total_charges')}, 0) AS total_charges FROM faulty",
)
def clean_total_charges(spark, sf_dir):
    rows = faulty_accounts(spark, sf_dir, ["account_id", "total_charges"])
    return clean_totals(rows, ACCOUNT_COLUMNS)


_DTYPES = {"account_id": "bigint", "customer_id": "bigint", "tenure": "int", "monthly_charges": "double", "senior_citizen": "int"}


@query(
    "audit_summary",
    f"WITH {S.ACCOUNTS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{_DTYPES.get(c, 'string')}' AS dtype, count(*) - count({c}) AS missing_count, "
        f"round_even(CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100, 2) AS missing_pct, "
        + (f"count(*) FILTER (WHERE trim({c}) = '')" if c not in _DTYPES else "CAST(0 AS BIGINT)")
        + f" AS blank_count, count(DISTINCT {c}) AS unique_values FROM accounts"
        for c in ACCOUNT_FIELDS
    ),
)
def audit_summary(spark, sf_dir):
    return St.column_profile(accounts(spark, sf_dir))


@query(
    "missing_rows",
    f"""WITH {S.ACCOUNTS},
missing AS (SELECT tenure, monthly_charges FROM accounts WHERE {_number('total_charges')} IS NULL)
SELECT count(*) AS missing_rows, count(*) FILTER (WHERE tenure = 0) AS with_tenure_zero,
  bool_and(tenure = 0) AS all_tenure_zero, min(tenure) AS min_tenure, max(tenure) AS max_tenure,
  round(avg(monthly_charges), 6) AS mean_monthly FROM missing""",
)
def missing_rows(spark, sf_dir):
    """Rows without a total, and whether all of them are new customers."""
    rows = accounts(spark, sf_dir, ["account_id", "tenure", "monthly_charges", "total_charges"])
    missing = rows.filter(C.number(rows, "total_charges").isNull())
    return rounded(
        missing.agg(
            F.count("*").alias("missing_rows"),
            F.count_if(F.col("tenure") == 0).alias("with_tenure_zero"),
            F.bool_and(F.col("tenure") == 0).alias("all_tenure_zero"),
            F.min("tenure").alias("min_tenure"),
            F.max("tenure").alias("max_tenure"),
            F.avg("monthly_charges").alias("mean_monthly"),
        )
    )


# ---- quality checks -------------------------------------------------------------


@query(
    "dq_missing",
    _FAULTY
    + " UNION ALL ".join(
        f" SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {_missing(c)}) AS missing_count, "
        f"round(CAST(count(*) FILTER (WHERE {_missing(c)}) AS DOUBLE) / count(*), 6) AS missing_ratio FROM faulty"
        for c in FAULTY_FIELDS
    ),
)
def dq_missing(spark, sf_dir):
    return rounded(Q.missing_by_column(faulty_accounts(spark, sf_dir)))


_COPIES = (
    "copies AS (SELECT count(*) AS n FROM faulty GROUP BY "
    + ", ".join(f"CASE WHEN NOT {_missing(c)} THEN {c} END" for c in FAULTY_FIELDS)
    + ")"
)


@query(
    "duplicate_stats",
    f"""{_FAULTY}, {_COPIES}
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
  round(CAST(sum(n - 1) AS DOUBLE) / sum(n), 6) AS duplicate_ratio FROM copies""",
)
def duplicate_stats(spark, sf_dir):
    return rounded(Q.duplicate_stats(faulty_accounts(spark, sf_dir)))


@query(
    "final_check",
    f"""{_FAULTY}, {_COPIES}, sizes AS (SELECT count(*) AS n FROM faulty), found AS (
  SELECT 'rows' AS item, '' AS name, count(*) AS count FROM faulty UNION ALL
  SELECT 'distinct_keys', 'account_id', count(DISTINCT account_id) FROM faulty UNION ALL
  SELECT 'copies', '', CAST(sum(n - 1) AS BIGINT) FROM copies UNION ALL
  SELECT * FROM ({' UNION ALL '.join(f"SELECT 'missing', '{c}', count(*) FILTER (WHERE {_missing(c)}) FROM faulty" for c in FAULTY_FIELDS)}))
SELECT item, name, count, round(CAST(count AS DOUBLE) / n, 6) AS share FROM found, sizes WHERE item <> 'missing' OR count > 0
UNION ALL SELECT 'label', churn, count(*), round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6)
FROM faulty WHERE churn IS NOT NULL GROUP BY churn""",
)
def final_check(spark, sf_dir):
    return rounded(Q.final_check(faulty_accounts(spark, sf_dir), "account_id", "churn"))


@query(
    "column_differences",
    f"""{_FAULTY}, named AS (SELECT unnest(['tenure', 'contract', 'contract', 'gender', 'partner', 'churn']) AS c)
SELECT column_name AS "column", 'missing' AS side FROM (DESCRIBE SELECT * FROM faulty) WHERE column_name NOT IN (SELECT c FROM named)
UNION ALL SELECT DISTINCT c, 'extra' FROM named WHERE c IN ('gender', 'partner') AND (SELECT count(*) FROM faulty) > 0""",
)
def column_differences(spark, sf_dir):
    """Columns that a feature list leaves out, and names it has too many."""
    defined = ["tenure", "contract", "contract", "gender", "partner", "churn"]
    return Q.column_differences(faulty_accounts(spark, sf_dir), defined)


@query(
    "dq_type_violations",
    f"""{_FAULTY} SELECT 'total_charges' AS "column",
  count(*) FILTER (WHERE NOT {_missing('total_charges')} AND {_number('total_charges')} IS NULL) AS invalid_casts
FROM faulty""",
)
def dq_type_violations(spark, sf_dir):
    return Q.type_violations(faulty_accounts(spark, sf_dir), ACCOUNT_RULES)


_BOUNDS = [
    (c, name, f"{_number(c)} {op} {b}")
    for c, (low, high) in ACCOUNT_RULES.numeric_ranges.items()
    for name, op, b in (("below_min", "<", low), ("above_max", ">", high))
    if b is not None
]


@query(
    "dq_ranges",
    _FAULTY
    + " UNION ALL ".join(
        f" SELECT '{c}' AS \"column\", '{name}' AS bound, count(*) FILTER (WHERE {bad}) AS violations FROM faulty"
        for c, name, bad in _BOUNDS
    ),
)
def dq_ranges(spark, sf_dir):
    return Q.range_violations(faulty_accounts(spark, sf_dir), ACCOUNT_RULES)


_TARGET = """count(churn) FILTER (WHERE churn IN ('Yes', 'No', 'yes', 'no'))"""
_RATE = f"CAST(count(*) FILTER (WHERE churn IN ('Yes', 'yes')) AS DOUBLE) / {_TARGET}"


@query(
    "dq_target",
    f"""{_FAULTY} SELECT {_TARGET} AS valid_rows, CAST(0 AS BIGINT) AS non_binary_rows,
  round({_RATE}, 6) AS target_rate FROM faulty""",
)
def dq_target(spark, sf_dir):
    stats = Q.target_stats(faulty_accounts(spark, sf_dir), "churn")
    return rounded(stats)


_ANY_MISSING = " OR ".join(_missing(c) for c in ACCOUNT_RULES.required_columns)


@query(
    "dq_invalid_rows",
    f"""{_FAULTY} SELECT count(*) AS rows, count(*) FILTER (WHERE {_ANY_MISSING}) AS invalid_rows,
  round(CAST(count(*) FILTER (WHERE {_ANY_MISSING}) AS DOUBLE) / count(*), 6) AS invalid_rows_ratio FROM faulty""",
)
def dq_invalid_rows(spark, sf_dir):
    return rounded(Q.invalid_rows(faulty_accounts(spark, sf_dir), ACCOUNT_RULES.required_columns))


_RANGE_TEXT = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN count(*) FILTER (WHERE {bad}) > 0 THEN '{c} {name}: ' || CAST(count(*) FILTER (WHERE {bad}) AS VARCHAR) END"
    for c, name, bad in _BOUNDS
) + ")"
_MISSING_CELLS = " + ".join(f"count(*) FILTER (WHERE {_missing(c)})" for c in FAULTY_FIELDS)


@query(
    "dq_report",
    f"""{_FAULTY}, {_COPIES},
dup AS (SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_count, CAST(sum(n - 1) AS DOUBLE) / sum(n) AS duplicate_ratio FROM copies),
facts AS (SELECT count(*) AS rows,
  CAST({_MISSING_CELLS} AS DOUBLE) / (count(*) * {len(FAULTY_FIELDS)}) AS missing_ratio,
  CAST(count(*) FILTER (WHERE {_ANY_MISSING}) AS DOUBLE) / count(*) AS invalid_ratio,
  {_RATE} AS target_rate,
  count(*) FILTER (WHERE NOT {_missing('total_charges')} AND {_number('total_charges')} IS NULL) AS casts,
  {_RANGE_TEXT} AS ranges FROM faulty),
texts AS (SELECT *, concat_ws(' | ',
    CASE WHEN missing_ratio > 0.05 THEN printf('Missing ratio %.4f exceeds 0.0500.', missing_ratio) END,
    CASE WHEN duplicate_ratio > 0.02 THEN printf('Duplicate ratio %.4f exceeds 0.0200.', duplicate_ratio) END,
    CASE WHEN casts > 0 THEN 'Values that are no number: total_charges: ' || CAST(casts AS VARCHAR) END,
    CASE WHEN ranges <> '' THEN 'Range violations: ' || ranges END,
    CASE WHEN target_rate < 0.05 OR target_rate > 0.95 THEN printf('Target rate %.4f outside [0.0500, 0.9500].', target_rate) END,
    CASE WHEN invalid_ratio > 0.05 THEN printf('Invalid rows ratio %.4f exceeds 0.0500.', invalid_ratio) END) AS issues
  FROM facts, dup)
SELECT issues = '' AS passed, rows, CAST({len(FAULTY_FIELDS)} AS INTEGER) AS columns, round(missing_ratio, 6) AS missing_ratio_total,
  duplicate_count, round(duplicate_ratio, 6) AS duplicate_ratio, round(target_rate, 6) AS target_rate,
  round(invalid_ratio, 6) AS invalid_rows_ratio, issues AS critical_issues, '' AS warnings FROM texts""",
)
def dq_report(spark, sf_dir):
    report = Q.quality_report(faulty_accounts(spark, sf_dir), ACCOUNT_RULES)
    return rounded(
        report.drop("missing_ratio_per_column")
        .withColumn("critical_issues", F.array_join("critical_issues", " | "))
        .withColumn("warnings", F.array_join("warnings", " | "))
    )


@query(
    "required_columns",
    f"""{_FAULTY}
SELECT 'tenure' AS missing_column, count(*) AS failed_rows FROM faulty
UNION ALL SELECT 'contract', count(*) FROM faulty""",
)
def required_columns(spark, sf_dir):
    """A batch that lacks required columns: every row fails with one batch-level error."""
    rows = faulty_accounts(spark, sf_dir).drop("tenure", "contract")
    required = ["tenure", "monthly_charges", "contract", "churn"]
    absent = Q.missing_columns(rows, required)
    checked = R.with_row_errors(rows, ACCOUNT_COLUMNS, required).select(
        "errors", F.explode(F.array(*[F.lit(c) for c in absent])).alias("missing_column")
    )
    return checked.groupBy("missing_column").agg(F.count_if(F.size("errors") > 0).alias("failed_rows"))


# ---- row validation ---------------------------------------------------------------


@query(
    "row_validation",
    f"{_FAULTY} SELECT account_id, {S.row_error_sql(True)} AS errors FROM faulty",
)
def row_validation(spark, sf_dir):
    checked = R.with_row_errors(
        faulty_accounts(spark, sf_dir).drop("churn"), ACCOUNT_COLUMNS, S.REQUIRED
    )
    return checked.select("account_id", F.array_join("errors", "; ").alias("errors"))


@query(
    "row_validation_counts",
    f"""{_FAULTY}, checked AS (SELECT {S.row_error_sql(False)} AS errors FROM faulty)
SELECT CASE WHEN errors = '' THEN 'valid' ELSE errors END AS outcome, count(*) AS rows FROM checked GROUP BY 1""",
)
def row_validation_counts(spark, sf_dir):
    checked = R.with_row_errors(faulty_accounts(spark, sf_dir).drop("churn"), ACCOUNT_COLUMNS)
    outcome = F.when(F.size("errors") == 0, "valid").otherwise(F.array_join("errors", "; "))
    return checked.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("rows"))
