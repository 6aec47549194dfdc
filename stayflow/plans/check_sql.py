"""Shared parts of the check SQL: the account views and fitted statistics as CTEs."""

from __future__ import annotations

from stayflow.params import ACCOUNT_COLUMNS, BusinessParams
from stayflow.sources.accounts import ACCOUNT_FIELDS, FAULTY_FIELDS

_SERVICE_RULES = {
    "online_security": "o_orderkey % 3 = 0",
    "tech_support": "o_orderkey % 5 < 2",
    "online_backup": "o_orderkey % 7 < 3",
    "device_protection": "o_orderkey % 4 = 1",
    "streaming_tv": "o_orderkey % 2 = 0",
    "streaming_movies": "o_orderkey % 9 < 4",
}
_TENURE = "CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS INTEGER)"
_CONTRACT = (
    "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Month-to-month' WHEN '2' THEN 'Month-to-month' "
    "WHEN '5' THEN 'Month-to-month' WHEN '3' THEN 'One year' WHEN '4' THEN 'Two year' END"
)
_SERVICES = ",\n    ".join(
    f"CASE WHEN o_orderstatus = 'P' THEN 'No internet service' WHEN {rule} THEN 'Yes' ELSE 'No' END AS {c}"
    for c, rule in _SERVICE_RULES.items()
)
ACCOUNTS = f"""
line_totals AS (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS line_total
  FROM lineitem GROUP BY l_orderkey),
accounts AS (
  SELECT o_orderkey AS account_id, o_custkey AS customer_id,
    {_TENURE} AS tenure,
    o_totalprice / 64 AS monthly_charges,
    CASE WHEN line_total IS NULL OR {_TENURE} = 0 THEN ' '
         ELSE CAST(line_total AS VARCHAR) END AS total_charges,
    {_CONTRACT} AS contract,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Fiber optic'
         WHEN o_orderstatus = 'O' THEN 'DSL' WHEN o_orderstatus = 'P' THEN 'No' END AS internet_service,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'Mailed check'
         WHEN c_mktsegment = 'FURNITURE' THEN 'Bank transfer (automatic)'
         WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Credit card (automatic)'
         ELSE 'Electronic check' END AS payment_method,
    {_SERVICES},
    CASE WHEN o_custkey % 10 < 3 THEN 'Yes' ELSE 'No' END AS dependents,
    CASE WHEN o_orderkey % 5 = 0 THEN 'No' ELSE 'Yes' END AS paperless_billing,
    CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS INTEGER) AS senior_citizen,
    CASE WHEN (o_orderkey * 7919) % 100 <
      15 + CASE {_CONTRACT} WHEN 'Month-to-month' THEN 25 WHEN 'Two year' THEN -10 ELSE 0 END
         + CASE WHEN o_orderstatus = 'F' AND o_orderkey % 101 <> 0 THEN 20 ELSE 0 END
         + CASE WHEN {_TENURE} < 12 THEN 10 ELSE 0 END
      THEN 'Yes' ELSE 'No' END AS churn
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN line_totals ON l_orderkey = o_orderkey)"""

SCORED = f"""{ACCOUNTS},
scored AS (
  SELECT account_id, contract, internet_service, tenure,
    CAST(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS INTEGER) AS y,
    CAST(CASE contract WHEN 'Month-to-month' THEN 40 WHEN 'One year' THEN 15 ELSE 5 END
      + CASE WHEN internet_service = 'Fiber optic' THEN 20 ELSE 0 END
      + CASE WHEN tenure < 12 THEN 10 ELSE 0 END
      + account_id % 11 AS DOUBLE) / CAST(100 AS DOUBLE) AS p
  FROM accounts)"""


def _faulty(columns: list[str], name: str) -> str:
    faults = {
        "tenure": "CAST(CASE WHEN account_id % 211 = 0 THEN -1 ELSE tenure END AS INTEGER)",
        "monthly_charges": "CASE WHEN account_id % 229 <> 0 THEN monthly_charges END",
        "total_charges": "CASE WHEN account_id % 227 = 0 THEN 'abc' ELSE total_charges END",
        "internet_service": "CASE WHEN account_id % 223 = 0 THEN 'Satellite' ELSE internet_service END",
    }
    select = ", ".join(f"{faults[c]} AS {c}" if c in faults else c for c in columns)
    return f"""
{name}_once AS (SELECT {select} FROM accounts),
{name} AS (
  SELECT * FROM {name}_once UNION ALL
  SELECT * FROM {name}_once WHERE account_id % 61 = 0)"""


FAULTY = f"{ACCOUNTS},{_faulty(FAULTY_FIELDS, 'faulty')}"
FAULTY_ALL = _faulty(ACCOUNT_FIELDS, "faulty_all")

BATCH_LOG = """
batch_log AS (
  SELECT CAST(ts AS DATE) AS batch_day, count(*) AS batch_size,
    count(*) FILTER (WHERE event_type = 'error') AS failed_rows, sum(value) AS latency_ms
  FROM events GROUP BY 1)"""

HISTORY = """
history AS (
  SELECT event_id AS seq, event_type AS model_id,
    CAST((event_id * 37) % 66 + 20 AS DOUBLE) / CAST(100 AS DOUBLE) AS final_threshold
  FROM events)"""

# Exact stratified split and folds by md5 order inside the label.
SPLIT = f"""{ACCOUNTS},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY churn
      ORDER BY md5(concat(CAST(account_id AS VARCHAR), '|42')), account_id) AS place,
    count(*) OVER (PARTITION BY churn) AS label_rows
  FROM accounts),
split_accounts AS (
  SELECT *, CASE WHEN place <= (label_rows * 6) // 10 THEN 'train'
                 WHEN place <= (label_rows * 8) // 10 THEN 'val' ELSE 'test' END AS split,
    CAST((place - 1) % 5 AS INTEGER) AS fold,
    CAST(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS INTEGER) AS y
  FROM placed)"""

SCORED_SPLIT = f"""{SPLIT},
scored_split AS (
  SELECT account_id, split, fold, y,
    CAST(CASE contract WHEN 'Month-to-month' THEN 40 WHEN 'One year' THEN 15 ELSE 5 END
      + CASE WHEN internet_service = 'Fiber optic' THEN 20 ELSE 0 END
      + CASE WHEN tenure < 12 THEN 10 ELSE 0 END
      + account_id % 11 AS DOUBLE) / CAST(100 AS DOUBLE) AS p
  FROM split_accounts)"""

MEDIANS = """
medians AS (
  SELECT internet_service AS med_group, median(monthly_charges) AS med
  FROM split_accounts WHERE split = 'train' AND internet_service IS NOT NULL GROUP BY 1)"""


def engineered(source: str, name: str) -> str:
    """CTE with the engineered features of ``source``; needs the medians CTE."""
    mtm = "contract IS NOT DISTINCT FROM 'Month-to-month'"

    def yes(columns: list[str]) -> str:
        return " + ".join(f"CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END" for c in columns)

    support = yes(ACCOUNT_COLUMNS.support)
    return f"""
{name}_base AS (
  SELECT s.* EXCLUDE (total_charges),
    coalesce(try_cast(trim(total_charges) AS DOUBLE), 0) AS total_charges,
    coalesce(monthly_charges, 0) AS monthly, greatest(tenure, 1) AS safe_tenure,
    coalesce(med, 0) AS med
  FROM {source} s LEFT JOIN medians ON med_group = internet_service),
{name} AS (
  SELECT * EXCLUDE (monthly, safe_tenure, med),
    total_charges / safe_tenure AS avg_monthly_spend,
    monthly / safe_tenure AS charge_tenure_ratio,
    monthly - total_charges / safe_tenure AS charge_deviation,
    monthly * tenure AS expected_lifetime_value,
    monthly - med AS overpay_indicator,
    CAST(CASE WHEN tenure < 0 THEN NULL WHEN tenure <= 6 THEN 0 WHEN tenure <= 12 THEN 1
      WHEN tenure <= 24 THEN 2 WHEN tenure <= 48 THEN 3 WHEN tenure <= 72 THEN 4 END AS DOUBLE) AS tenure_group,
    CAST({support} AS INTEGER) AS num_support_services,
    CAST({yes(ACCOUNT_COLUMNS.streaming)} AS INTEGER) AS num_streaming_services,
    CAST({mtm} AND internet_service IS NOT DISTINCT FROM 'Fiber optic' AS INTEGER) AS is_mtm_fiber,
    CAST({mtm} AND ({support}) = 0 AS INTEGER) AS is_mtm_no_support,
    CAST({mtm} AND payment_method IS NOT DISTINCT FROM 'Electronic check' AS INTEGER) AS is_echeck_mtm,
    CAST(tenure * CASE contract WHEN 'One year' THEN 1 WHEN 'Two year' THEN 2 ELSE 0 END AS DOUBLE) AS tenure_x_contract,
    CAST(coalesce(payment_method IN ('Bank transfer (automatic)', 'Credit card (automatic)'), false) AS INTEGER) AS is_auto_pay,
    CAST(internet_service IS DISTINCT FROM 'No' AS INTEGER) AS has_internet
  FROM {name}_base)"""


ENGINEERED = f"{SPLIT},{MEDIANS},{engineered('split_accounts', 'engineered')}"

NUMERIC = ACCOUNT_COLUMNS.numeric_features
CATEGORIES = {
    "contract": ["Month-to-month", "One year", "Two year"],
    "internet_service": ["DSL", "Fiber optic", "No"],
    "online_security": ["No", "No internet service", "Yes"],
    "tech_support": ["No", "No internet service", "Yes"],
    "payment_method": [
        "Bank transfer (automatic)",
        "Credit card (automatic)",
        "Electronic check",
        "Mailed check",
    ],
    "dependents": ["No", "Yes"],
    "paperless_billing": ["No", "Yes"],
}
FEATURE_NAMES = [f"num__{c}" for c in NUMERIC] + [
    f"cat__{c}_{v}" for c, values in CATEGORIES.items() for v in values[1:]
]

_MODES = ", ".join(
    f"(SELECT {c} FROM engineered WHERE split = 'train' AND {c} IS NOT NULL "
    f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode_{c}"
    for c in CATEGORIES
)
FITTED = f"""{ENGINEERED},
fill AS (SELECT {', '.join(f'median({c}) AS fill_{c}' for c in NUMERIC)} FROM engineered WHERE split = 'train'),
fitted AS (
  SELECT {', '.join(f'any_value(fill_{c}) AS fill_{c}, avg(coalesce({c}, fill_{c})) AS mean_{c}, '
                    f'coalesce(nullif(stddev_pop(coalesce({c}, fill_{c})), 0), 1) AS std_{c}' for c in NUMERIC)},
    {_MODES}
  FROM engineered, fill WHERE split = 'train')"""


def feature_sql() -> dict[str, str]:
    """Encoded feature -> SQL over a row of engineered columns joined with ``fitted``."""
    out = {f"num__{c}": f"(coalesce({c}, fill_{c}) - mean_{c}) / std_{c}" for c in NUMERIC}
    for c, values in CATEGORIES.items():
        for v in values[1:]:
            out[f"cat__{c}_{v}"] = f"CAST(coalesce({c}, mode_{c}) = '{v}' AS INTEGER)"
    return out


# The fixed linear model of the scoring and explanation queries.
INTERCEPT = -0.5
COEFFICIENTS = {n: ((7 * i) % 11 - 5) / 10 for i, n in enumerate(FEATURE_NAMES)}
MARGIN = f"CAST({INTERCEPT} AS DOUBLE)" + "".join(
    f" + ({e}) * CAST({COEFFICIENTS[n]} AS DOUBLE)" for n, e in feature_sql().items()
)

_BUSINESS = BusinessParams()
VALUE, COST = _BUSINESS.retained_value, _BUSINESS.contact_cost


def field_error_sql() -> str:
    """All field errors of a faulty row, joined; the empty text when there are none."""
    checks = [
        "CASE WHEN tenure < 0 THEN 'Input should be greater than or equal to 0: tenure' END",
        "CASE WHEN monthly_charges < 0 THEN 'Input should be greater than or equal to 0: monthly_charges' END",
        "CASE WHEN total_charges IS NOT NULL AND try_cast(trim(total_charges) AS DOUBLE) IS NULL "
        "THEN 'Input should be a valid number: total_charges' END",
        "CASE WHEN try_cast(trim(total_charges) AS DOUBLE) < 0 "
        "THEN 'Input should be greater than or equal to 0: total_charges' END",
    ]
    return f"concat_ws('; ', {', '.join(checks)})"


CATEGORY_ERROR = (
    "CASE WHEN internet_service NOT IN ('DSL', 'Fiber optic', 'No') "
    "THEN 'Invalid internet service: ' || internet_service END"
)
REQUIRED = ["tenure", "monthly_charges", "total_charges", "contract", "internet_service", "payment_method"]
_NULLS = "concat_ws(', ', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in REQUIRED) + ")"
REQUIRED_ERROR = f"CASE WHEN {_NULLS} <> '' THEN 'Null values in required columns: ' || {_NULLS} END"


def row_error_sql(required: bool) -> str:
    later = f"{CATEGORY_ERROR}, {REQUIRED_ERROR}, ''" if required else f"{CATEGORY_ERROR}, ''"
    return f"CASE WHEN {field_error_sql()} <> '' THEN {field_error_sql()} ELSE coalesce({later}) END"


def sweep_sql(source: str, where: str = "true", name: str = "sweep") -> str:
    """CTE ``sweep`` over (y, p) rows of ``source``: the cross-join form of the threshold sweep."""
    return f"""
{name}_grid AS (SELECT CAST(t AS DOUBLE) / 100 AS threshold FROM range(20, 86, 5) g(t)),
{name}_counts AS (
  SELECT threshold,
    count(*) FILTER (WHERE y = 1 AND p >= threshold) AS tp,
    count(*) FILTER (WHERE y = 0 AND p >= threshold) AS fp,
    count(*) FILTER (WHERE y = 1 AND p < threshold) AS fn,
    count(*) FILTER (WHERE y = 0 AND p < threshold) AS tn
  FROM {source}, {name}_grid WHERE {where} GROUP BY threshold),
{name} AS (
  SELECT threshold,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
    coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1_score,
    tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) * 100 AS captured_pct,
    coalesce(CAST(fp AS DOUBLE) / nullif(tn + fp, 0), 0) * 100 AS false_positive_pct,
    tp + fp AS total_flagged,
    CAST(tp * {VALUE} - (tp + fp) * {COST} AS DOUBLE) AS net_value,
    coalesce(CAST(tp * {VALUE} - (tp + fp) * {COST} AS DOUBLE) / nullif(tp + fp, 0), 0) AS net_per_flagged
  FROM {name}_counts)"""


SWEEP_COLUMNS = """round(threshold, 6) AS threshold, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
  true_positives, false_positives, false_negatives, true_negatives,
  round(captured_pct, 6) AS captured_pct, round(false_positive_pct, 6) AS false_positive_pct,
  total_flagged, round(net_value, 6) AS net_value, round(net_per_flagged, 6) AS net_per_flagged"""


def chosen_sql(source: str, min_recall: float, min_precision: float, goal: str) -> str:
    """The first best row among those that fit, else the first best F1 of all."""
    fits = f"recall >= {min_recall} AND precision >= {min_precision}"
    return f"""SELECT *, {fits} AS fits FROM {source}
ORDER BY CASE WHEN {fits} THEN 0 ELSE 1 END,
  CASE WHEN {fits} THEN {goal} ELSE f1_score END DESC, threshold LIMIT 1"""
