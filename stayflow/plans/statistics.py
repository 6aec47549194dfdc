"""Exploratory statistics over the accounts."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.operators import stats as St
from stayflow.operators.sizing import materialize
from stayflow.plans import check_sql as S
from stayflow.plans.registry import query, rounded
from stayflow.sources.accounts import SERVICES, accounts

NUMBERS = ["tenure", "monthly_charges", "total_charges"]
CATEGORIES = [
    "senior_citizen",
    "dependents",
    "internet_service",
    *SERVICES,
    "contract",
    "paperless_billing",
    "payment_method",
]

_ACCOUNTS = f"WITH {S.ACCOUNTS}"
_LONG = (
    f"{_ACCOUNTS}, long AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", churn, CAST({'try_cast(trim(total_charges) AS DOUBLE)' if c == 'total_charges' else c} AS DOUBLE) AS v FROM accounts"
        for c in NUMBERS
    )
    + "), vals AS (SELECT * FROM long WHERE v IS NOT NULL)"
)
_CATS = (
    f"{_ACCOUNTS}, cats AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, churn FROM accounts" for c in CATEGORIES
    )
    + "), cells AS (SELECT * FROM cats WHERE value IS NOT NULL)"
)
_RATE = """count(*) AS count, count(*) FILTER (WHERE churn = 'Yes') AS churn_count,
  round_even(avg(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END) * 100, 2) AS churn_rate"""


def numbers(spark, sf_dir):
    return accounts(spark, sf_dir, [*NUMBERS, "churn"])


def kept_numbers(spark, sf_dir):
    """Written once for the statistics that need several passes over the joined accounts."""
    return materialize(numbers(spark, sf_dir))


@query(
    "describe",
    f"""{_LONG} SELECT "column", count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std,
  round(min(v), 4) AS min, round(quantile_cont(v, 0.25), 4) AS q25, round(median(v), 4) AS median,
  round(quantile_cont(v, 0.75), 4) AS q75, round(max(v), 4) AS max FROM vals GROUP BY 1""",
)
def describe(spark, sf_dir):
    return rounded(St.describe(kept_numbers(spark, sf_dir), NUMBERS), 4)


@query(
    "value_counts",
    f"""{_CATS} SELECT "column", value, count(*) AS count,
  round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY "column"), 6) AS share FROM cells GROUP BY 1, 2""",
)
def value_counts(spark, sf_dir):
    return rounded(St.value_counts(accounts(spark, sf_dir, CATEGORIES), CATEGORIES))


@query("rate_by_category", f"{_ACCOUNTS} SELECT contract, {_RATE} FROM accounts GROUP BY contract")
def rate_by_category(spark, sf_dir):
    return St.rate_by_category(accounts(spark, sf_dir, ["contract", "churn"]), "contract", "churn")


@query(
    "rate_by_all_categories",
    f"{_CATS.replace('CAST(senior_citizen AS VARCHAR)', '''CASE senior_citizen WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' END''')} "
    f'SELECT "column", value, {_RATE} FROM cells GROUP BY 1, 2',
)
def rate_by_all_categories(spark, sf_dir):
    rows = accounts(spark, sf_dir, [*CATEGORIES, "churn"])
    named = rows.withColumn("senior_citizen", C.yes_no(F.col("senior_citizen")))
    return St.rate_by_all_categories(named, CATEGORIES, "churn")


@query(
    "crosstab",
    f"""{_ACCOUNTS} SELECT contract, count(*) FILTER (WHERE churn = 'No') AS "No",
  count(*) FILTER (WHERE churn = 'Yes') AS "Yes" FROM accounts GROUP BY contract""",
)
def crosstab(spark, sf_dir):
    rows = accounts(spark, sf_dir, ["contract", "churn"])
    return St.crosstab(rows, "contract", "churn", ["No", "Yes"])


@query(
    "mean_by_label",
    f"""{_LONG}, m AS (SELECT "column", avg(v) FILTER (WHERE churn = 'No') AS mean_no,
  avg(v) FILTER (WHERE churn = 'Yes') AS mean_yes FROM vals GROUP BY 1)
SELECT "column", round(mean_no, 4) AS mean_no, round(mean_yes, 4) AS mean_yes,
  round(mean_yes - mean_no, 4) + 0 AS difference, round_even((mean_yes - mean_no) / mean_no * 100, 1) AS pct_difference FROM m""",
)
def mean_by_label(spark, sf_dir):
    return rounded(St.mean_by_label(numbers(spark, sf_dir), NUMBERS, "churn"), 4)


@query(
    "iqr_outliers",
    f"""{_LONG}, q AS (SELECT "column" AS c, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM vals GROUP BY 1),
fences AS (SELECT c, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT "column", round(any_value(lower), 4) AS lower, round(any_value(upper), 4) AS upper,
  count(*) FILTER (WHERE v < lower OR v > upper) AS outliers,
  round(CAST(count(*) FILTER (WHERE v < lower OR v > upper) AS DOUBLE) / count(*) * 100, 4) AS outlier_pct
FROM vals JOIN fences ON c = "column" GROUP BY 1""",
)
def iqr_outliers(spark, sf_dir):
    return rounded(St.iqr_outliers(kept_numbers(spark, sf_dir), NUMBERS), 4)


@query(
    "box_stats",
    f"""{_LONG}, q AS (SELECT "column" AS c, churn AS g, quantile_cont(v, 0.25) AS q1, median(v) AS med, quantile_cont(v, 0.75) AS q3
  FROM vals GROUP BY 1, 2)
SELECT churn, "column", round(any_value(q1), 4) AS q1, round(any_value(med), 4) AS median, round(any_value(q3), 4) AS q3,
  round(min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_low,
  round(max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
  count(*) FILTER (WHERE NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM vals JOIN q ON c = "column" AND g = churn GROUP BY 1, 2""",
)
def box_stats(spark, sf_dir):
    return rounded(St.box_stats(kept_numbers(spark, sf_dir), NUMBERS, "churn"), 4)


@query(
    "histogram",
    f"""{_ACCOUNTS}, ends AS (SELECT min(monthly_charges) AS low, max(monthly_charges) AS high FROM accounts),
edges AS (SELECT CAST(i AS INTEGER) AS bin, low + (high - low) * i / 30 AS low,
  CASE WHEN i = 29 THEN high ELSE low + (high - low) * (i + 1) / 30 END AS high FROM ends, range(0, 30) r(i))
SELECT bin, round(any_value(low), 4) AS low, round(any_value(high), 4) AS high, count(monthly_charges) AS count
FROM edges LEFT JOIN accounts ON monthly_charges >= low AND (monthly_charges < high OR (bin = 29 AND monthly_charges <= high))
GROUP BY bin""",
)
def histogram(spark, sf_dir):
    rows = accounts(spark, sf_dir, ["monthly_charges"])
    return rounded(St.histogram(rows, "monthly_charges", 30), 4)


@query(
    "kde_curve",
    f"""{_ACCOUNTS}, shape AS (SELECT churn AS g, count(*) AS n, stddev_samp(tenure) * pow(count(*), CAST(-0.2 AS DOUBLE)) AS h,
  min(tenure) AS low, max(tenure) AS high FROM accounts GROUP BY 1),
grid AS (SELECT g, n, h, CAST(i AS INTEGER) AS point, low - 0.5 * (high - low) + CAST(2 * (high - low) AS DOUBLE) * i / 100 AS x
  FROM shape, range(0, 101) r(i)),
weights AS (SELECT churn, tenure, count(*) AS w FROM accounts GROUP BY 1, 2)
SELECT churn, point, round(any_value(x), 6) AS x,
  round(sum(w * exp(-0.5 * pow((tenure - x) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM weights JOIN grid ON g = churn GROUP BY 1, 2""",
)
def kde_curve(spark, sf_dir):
    return rounded(St.kde_curve(accounts(spark, sf_dir, ["tenure", "churn"]), "tenure", "churn", points=101))


_Y = "CASE WHEN churn = 'Yes' THEN 1 WHEN churn = 'No' THEN 0 END"
_N = {c: "try_cast(trim(total_charges) AS DOUBLE)" if c == "total_charges" else c for c in NUMBERS} | {"churn_flag": _Y}


@query(
    "corr_matrix",
    _ACCOUNTS
    + " UNION ALL ".join(
        f" SELECT '{a}' AS a, '{b}' AS b, round(corr({_N[a]}, {_N[b]}), 6) AS corr FROM accounts"
        for a in _N
        for b in _N
    ),
)
def corr_matrix(spark, sf_dir):
    rows = numbers(spark, sf_dir).withColumn("churn_flag", C.label_flag(F.col("churn")))
    return rounded(St.corr_matrix(rows, list(_N)))


@query(
    "target_corr",
    _ACCOUNTS
    + " UNION ALL ".join(
        f' SELECT \'{c}\' AS "column", round(corr({_N[c]}, {_Y}), 6) AS corr, abs(corr({_N[c]}, {_Y})) > 0.7 AS high FROM accounts'
        for c in NUMBERS
    ),
)
def target_corr(spark, sf_dir):
    flag = C.label_flag(F.col("churn"))
    return rounded(St.target_corr(numbers(spark, sf_dir), NUMBERS, flag))


@query(
    "t_test",
    f"""{_LONG}, s AS (SELECT "column", count(*) FILTER (WHERE churn = 'Yes') AS n1, count(*) FILTER (WHERE churn = 'No') AS n0,
  avg(v) FILTER (WHERE churn = 'Yes') AS m1, avg(v) FILTER (WHERE churn = 'No') AS m0,
  var_samp(v) FILTER (WHERE churn = 'Yes') AS v1, var_samp(v) FILTER (WHERE churn = 'No') AS v0 FROM vals GROUP BY 1)
SELECT "column", n1 + n0 - 2 AS dof, round((m1 - m0) / sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2)
  * (CAST(1 AS DOUBLE) / n1 + CAST(1 AS DOUBLE) / n0)), 6) + 0 AS t_stat FROM s""",
)
def t_test(spark, sf_dir):
    return rounded(St.t_test(numbers(spark, sf_dir), NUMBERS, "churn").select("column", "dof", "t_stat"))


@query(
    "chi_square",
    f"""{_CATS}, counts AS (SELECT "column", value, CAST(count(*) FILTER (WHERE churn = 'Yes') AS DOUBLE) AS yes,
  CAST(count(*) FILTER (WHERE churn = 'No') AS DOUBLE) AS no FROM cells GROUP BY 1, 2),
margins AS (SELECT *, sum(yes) OVER w AS ay, sum(no) OVER w AS an, count(*) OVER w - 1 AS dof FROM counts WINDOW w AS (PARTITION BY "column")),
gaps AS (SELECT *, (yes + no) * ay / (ay + an) AS ey, (yes + no) * an / (ay + an) AS en FROM margins),
parts AS (SELECT *, abs(yes - ey) - CASE WHEN dof = 1 THEN least(0.5, abs(yes - ey)) ELSE 0 END AS gy,
  abs(no - en) - CASE WHEN dof = 1 THEN least(0.5, abs(no - en)) ELSE 0 END AS gn FROM gaps),
chi AS (SELECT "column", sum(gy * gy / ey + gn * gn / en) AS chi2, any_value(dof) AS dof, any_value(ay + an) AS n FROM parts GROUP BY 1),
v AS (SELECT *, sqrt(chi2 / n) AS v FROM chi)
SELECT "column", round(chi2, 6) AS chi2, dof, round(v, 6) AS cramers_v,
  CASE WHEN v <= 0 THEN NULL WHEN v <= 0.1 THEN 'Low' WHEN v <= 0.2 THEN 'Medium' WHEN v <= 0.3 THEN 'High' WHEN v <= 1 THEN 'Very High' END AS importance FROM v""",
)
def chi_square(spark, sf_dir):
    rows = accounts(spark, sf_dir, [*CATEGORIES, "churn"])
    return rounded(St.chi_square(rows, CATEGORIES, "churn").drop("p_value", "significance"))


@query("association_p_values")
def association_p_values(spark, sf_dir):
    """p-values and stars of both tests, which no SQL function gives."""
    rows = accounts(spark, sf_dir, [*NUMBERS, *[c for c in CATEGORIES if c not in NUMBERS], "churn"])
    means = St.t_test(rows, NUMBERS, "churn").select(F.lit("t").alias("test"), "column", "p_value", "significance")
    independence = St.chi_square(rows, CATEGORIES, "churn").select(
        F.lit("chi2").alias("test"), "column", "p_value", "significance"
    )
    return means.unionByName(independence)
