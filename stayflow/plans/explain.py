"""Importance tables and linear contributions.

The coefficient table is learned from the accounts: the correlation of every
encoded feature with the label over the training rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.operators import explain as X
from stayflow.operators.sizing import collect_small
from stayflow.operators.stats import target_corr
from stayflow.plans import check_sql as S
from stayflow.plans.features import fitted
from stayflow.plans.registry import query, rounded
from stayflow.plans.scoring import MODEL

TOTAL = "total_charges"
DEMOGRAPHIC = ["senior_citizen", "dependents"]


def plain(name: str) -> str:
    return name.split("__", 1)[1]


def coefficients(spark, sf_dir) -> DataFrame:
    fit = fitted(spark, sf_dir)
    rows, pre = fit.rows, fit.preprocessor
    train = pre.transform_wide(rows.filter("split = 'train'"), ["y"])
    names = pre.feature_names()
    # Short positional names: encoded names contain spaces and brackets.
    short = train.toDF("y", *[f"f{i}" for i in range(len(names))])
    found = target_corr(short, short.columns[1:], F.col("y"))
    values = {r["column"]: r["corr"] for r in collect_small(found)}
    return X.coefficient_table(
        spark,
        [round(values[f"f{i}"] or 0.0, 9) for i in range(len(names))],
        [plain(n) for n in names],
    )


_FEATURES = S.feature_sql()
_CORRS = ", ".join(
    f"round(corr(CAST({e} AS DOUBLE), y), 9) + 0 AS c{i}" for i, e in enumerate(_FEATURES.values())
)
_COEFS = f"""WITH {S.FITTED},
corrs AS (SELECT {_CORRS} FROM engineered, fitted WHERE split = 'train'),
coefs AS ({' UNION ALL '.join(f"SELECT '{plain(n)}' AS feature, c{i} AS coefficient FROM corrs" for i, n in enumerate(_FEATURES))})"""


@query(
    "coef_rank",
    f"""{_COEFS} SELECT feature, round(coefficient, 6) + 0 AS coefficient, round(abs(coefficient), 6) AS abs_coefficient,
  CAST(row_number() OVER (ORDER BY abs(coefficient) DESC, feature) AS INTEGER) AS rank FROM coefs""",
)
def coef_rank(spark, sf_dir):
    return rounded(X.rank_coefficients(coefficients(spark, sf_dir)))


@query(
    "top_features",
    f"""{_COEFS} SELECT * FROM (SELECT feature, round(coefficient, 6) + 0 AS coefficient, round(abs(coefficient), 6) AS abs_coefficient,
  CAST(row_number() OVER (ORDER BY abs(coefficient) DESC, feature) AS INTEGER) AS rank,
  CASE WHEN coefficient > 0 THEN 'driver' WHEN coefficient < 0 THEN 'preventer' END AS direction FROM coefs) WHERE rank <= 20""",
)
def top_features(spark, sf_dir):
    return rounded(X.top_features(coefficients(spark, sf_dir)))


@query(
    "coef_groups",
    f"""{_COEFS} SELECT 'driver' AS list, feature, round(coefficient, 6) + 0 AS coefficient FROM coefs WHERE coefficient > 0
UNION ALL SELECT 'preventer', feature, round(coefficient, 6) + 0 FROM coefs WHERE coefficient < 0
UNION ALL SELECT 'weak', feature, round(coefficient, 6) + 0 FROM coefs WHERE abs(coefficient) < 0.05""",
)
def coef_groups(spark, sf_dir):
    return rounded(X.coefficient_groups(coefficients(spark, sf_dir)))


@query(
    "coef_summary",
    f"""{_COEFS} SELECT round(avg(coefficient), 6) + 0 AS mean, round(stddev_samp(coefficient), 6) AS std,
  round(min(coefficient), 6) AS min, round(max(coefficient), 6) AS max FROM coefs""",
)
def coef_summary(spark, sf_dir):
    return rounded(X.coefficient_summary(coefficients(spark, sf_dir)))


_GROUP = f"CASE WHEN starts_with(feature, '{TOTAL}') THEN feature ELSE regexp_replace(feature, '_[^_]*$', '') END"


@query(
    "group_importance",
    f"""{_COEFS} SELECT {_GROUP} AS feature_group, round_even(sum(abs(coefficient)), 4) AS total_importance,
  round_even(max(abs(coefficient)), 4) AS max_importance, count(*) AS n_categories FROM coefs GROUP BY 1""",
)
def group_importance(spark, sf_dir):
    return X.group_importance(coefficients(spark, sf_dir), TOTAL)


_DEMO = " OR ".join(f"contains(feature, '{d}')" for d in DEMOGRAPHIC)


@query(
    "feature_decisions",
    f"""{_COEFS} SELECT feature, CASE WHEN abs(coefficient) >= 0.05 THEN 'KEEP' ELSE 'REVIEW' END AS decision,
  CASE WHEN abs(coefficient) >= 0.2 THEN 'Strong predictive power' WHEN abs(coefficient) >= 0.05 THEN 'Moderate predictive power'
    WHEN {_DEMO} THEN 'Weak but business-relevant demographic'
    WHEN contains(feature, '{TOTAL}') THEN 'Redundant with tenure (corr=0.83)'
    ELSE 'Weak coefficient - candidate for removal' END AS justification FROM coefs""",
)
def feature_decisions(spark, sf_dir):
    return X.feature_decisions(coefficients(spark, sf_dir), DEMOGRAPHIC, TOTAL)


# ---- linear contributions of the fixed model -----------------------------------

_MEANS = f"""WITH {S.FITTED},
encoded AS (SELECT account_id, split, monthly_charges, {', '.join(f'CAST({e} AS DOUBLE) AS x{i}' for i, e in enumerate(_FEATURES.values()))}
  FROM engineered, fitted),
background AS (SELECT {', '.join(f'avg(x{i}) AS m{i}' for i in range(len(_FEATURES)))} FROM encoded WHERE split = 'train'),
parts AS (SELECT account_id, split, monthly_charges,
  {', '.join(f'(x{i} - m{i}) * CAST({S.COEFFICIENTS[n]} AS DOUBLE) AS c{i}' for i, n in enumerate(_FEATURES))},
  CAST({S.INTERCEPT} AS DOUBLE) + {' + '.join(f'm{i} * CAST({S.COEFFICIENTS[n]} AS DOUBLE)' for i, n in enumerate(_FEATURES))} AS base_value
  FROM encoded, background)"""
_N = range(len(_FEATURES))


def background(spark, sf_dir):
    fit = fitted(spark, sf_dir)
    rows, pre = fit.rows, fit.preprocessor
    return rows, pre, pre.feature_means()


@query(
    "linear_contributions",
    f"""{_MEANS} SELECT account_id, round(base_value, 6) + 0 AS base_value,
  round(base_value + {' + '.join(f'c{i}' for i in _N)}, 6) + 0 AS margin,
  round(greatest({', '.join(f'abs(c{i})' for i in _N)}), 6) AS largest FROM parts""",
)
def linear_contributions(spark, sf_dir):
    rows, pre, means = background(spark, sf_dir)
    shares = X.linear_contributions(rows, "account_id", pre, MODEL, means)
    largest = F.array_max(F.transform("contributions", lambda c: F.abs(c)))
    return rounded(shares.select("account_id", "base_value", "margin", largest.alias("largest")))


@query(
    "global_contributions",
    _MEANS
    + " UNION ALL ".join(
        f" SELECT '{n}' AS feature, round(avg(abs(c{i})), 6) AS mean_abs_contribution FROM parts WHERE split = 'train'"
        for i, n in enumerate(_FEATURES)
    ),
)
def global_contributions(spark, sf_dir):
    rows, pre, means = background(spark, sf_dir)
    return rounded(X.global_contributions(rows.filter("split = 'train'"), pre, MODEL, means))


@query(
    "local_contributions",
    f"{_MEANS}, one AS (SELECT * FROM parts ORDER BY monthly_charges DESC, account_id LIMIT 1)"
    + " UNION ALL ".join(
        f" SELECT account_id, '{n}' AS feature, round(c{i}, 6) + 0 AS contribution FROM one" for i, n in enumerate(_FEATURES)
    ),
)
def local_contributions(spark, sf_dir):
    """Why the account with the highest charge got its score."""
    rows, pre, means = background(spark, sf_dir)
    top = rows.agg(F.min_by("account_id", F.struct(-F.col("monthly_charges"), "account_id"))).first()[0]
    shares = X.linear_contributions(rows, "account_id", pre, MODEL, means)
    found = X.local_contributions(shares, list(MODEL.coefficients), F.col("account_id") == top)
    return rounded(found.select(F.lit(top).cast("long").alias("account_id"), "*"))
