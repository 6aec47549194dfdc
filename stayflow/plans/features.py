"""Engineered features, splits, encoding and the processed matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.operators import dictionary as Dc
from stayflow.operators import features as Fe
from stayflow.operators import preprocess as P
from stayflow.operators import stats as St
from stayflow.operators.sizing import materialize
from stayflow.operators.splits import stratified_cuts, stratified_folds
from stayflow.operators.training import class_weights as weights_by_class
from stayflow.params import ACCOUNT_COLUMNS, ENGINEERED
from stayflow.plans import check_sql as S
from stayflow.plans.registry import query, rounded
from stayflow.sources.accounts import ACCOUNT_FIELDS, accounts, faulty_accounts

COLS = ACCOUNT_COLUMNS
MODEL_FIELDS = [c for c in ACCOUNT_FIELDS if c != "customer_id"]


def split_accounts(spark, sf_dir, columns=MODEL_FIELDS) -> DataFrame:
    """Accounts with y and split; the cut points come from the order table alone."""
    cuts = stratified_cuts(accounts(spark, sf_dir, [COLS.id, COLS.label]), COLS.id, COLS.label)
    rows = accounts(spark, sf_dir, columns)
    return cuts.apply(rows.withColumn("y", F.when(F.col("churn") == "Yes", 1).otherwise(0)))


def train_medians(rows: DataFrame):
    return Fe.fit_medians(rows.filter("split = 'train'"), COLS)


def engineered(spark, sf_dir) -> tuple[DataFrame, Fe.Medians]:
    """Accounts with split, cleaned totals and engineered features; the medians behind them.

    The joined accounts are written once: fitting and transforming read them several
    times, and everything after the write is a projection of it.
    """
    rows = materialize(split_accounts(spark, sf_dir))
    medians = train_medians(rows)
    return Fe.engineer_features(Fe.clean_total_charges(rows, COLS), medians, COLS), medians


@dataclass(frozen=True)
class Fitted:
    rows: DataFrame
    preprocessor: P.Preprocessor
    medians: Fe.Medians


def fitted(spark, sf_dir) -> Fitted:
    """Engineered accounts with the preprocessor fitted on their training rows."""
    rows, medians = engineered(spark, sf_dir)
    train = rows.filter("split = 'train'")
    preprocessor = P.fit_preprocessor(train, COLS.numeric_features, COLS.categorical_features)
    return Fitted(rows, preprocessor, medians)


def set_columns(rows: DataFrame, feature_set: str) -> tuple[list[str], list[str]]:
    """Numeric and text columns of a feature set (A, B or C), as far as the accounts have them."""
    return P.numeric_and_text(rows, P.feature_sets(COLS)[feature_set])


_ENGINEERED = f"WITH {S.ENGINEERED}"
_FITTED = f"WITH {S.FITTED}"


@query(
    "engineered_features",
    f"""{_ENGINEERED} SELECT account_id, split,
  {', '.join(f'round({c}, 9) + 0 AS {c}' if c == 'overpay_indicator' else c for c in ENGINEERED)} FROM engineered""",
)
def engineered_features(spark, sf_dir):
    rows = engineered(spark, sf_dir)[0].select("account_id", "split", *ENGINEERED)
    return rows.withColumn("overpay_indicator", F.round("overpay_indicator", 9))


@query(
    "tenure_bins",
    f"""WITH {S.ACCOUNTS} SELECT CAST(CASE WHEN tenure < 0 THEN NULL WHEN tenure <= 6 THEN 0 WHEN tenure <= 12 THEN 1
    WHEN tenure <= 24 THEN 2 WHEN tenure <= 48 THEN 3 WHEN tenure <= 72 THEN 4 END AS DOUBLE) AS tenure_group,
  count(*) AS rows, min(tenure) AS low, max(tenure) AS high FROM accounts GROUP BY 1""",
)
def tenure_bins(spark, sf_dir):
    group = Fe.tenure_group(F.col("tenure"))
    return (
        accounts(spark, sf_dir, ["tenure"])
        .groupBy(group.alias("tenure_group"))
        .agg(F.count("*").alias("rows"), F.min("tenure").alias("low"), F.max("tenure").alias("high"))
    )


@query(
    "charge_ratio_stats",
    f"""WITH {S.ACCOUNTS},
ratios AS (SELECT try_cast(trim(total_charges) AS DOUBLE) / (tenure * monthly_charges) AS r FROM accounts WHERE tenure > 0)
SELECT count(r) AS count, round(avg(r), 6) AS mean, round(stddev_samp(r), 6) AS std, round(min(r), 6) AS min,
  round(quantile_cont(r, 0.25), 6) AS q25, round(median(r), 6) AS median, round(quantile_cont(r, 0.75), 6) AS q75,
  round(max(r), 6) AS max FROM ratios""",
)
def charge_ratio_stats(spark, sf_dir):
    rows = accounts(spark, sf_dir, ["tenure", "monthly_charges", "total_charges"])
    ratio = F.try_divide(C.number(rows, "total_charges"), F.col("tenure") * F.col("monthly_charges"))
    ratios = rows.filter("tenure > 0").select(ratio.alias("charge_ratio"))
    return rounded(St.describe(ratios, ["charge_ratio"]).drop("column"))


@query(
    "group_medians",
    f"""WITH {S.SPLIT},{S.MEDIANS}
SELECT med_group AS internet_service, round(med, 9) AS median FROM medians
UNION ALL SELECT '__global__', round(median(monthly_charges), 9) FROM split_accounts WHERE split = 'train'""",
)
def group_medians(spark, sf_dir):
    rows = split_accounts(spark, sf_dir, ["account_id", "internet_service", "monthly_charges", "churn"])
    train = rows.filter("split = 'train'")
    whole = Fe.exact_quantiles(train, ["monthly_charges"], [0.5]).select(
        F.lit(Fe.GLOBAL_GROUP).alias("internet_service"), F.col("value").alias("median")
    )
    groups = Fe.group_medians(train, "internet_service", "monthly_charges")
    return rounded(groups.unionByName(whole), 9)


@query(
    "overpay_lookup",
    f"""WITH {S.SPLIT},{S.MEDIANS}
SELECT account_id, round(monthly_charges - coalesce(med, 0), 9) + 0 AS overpay_indicator
FROM split_accounts LEFT JOIN medians ON med_group = internet_service""",
)
def overpay_lookup(spark, sf_dir):
    rows = split_accounts(spark, sf_dir, ["account_id", "internet_service", "monthly_charges", "churn"])
    found = Fe.with_group_median(rows, "internet_service", train_medians(rows), "med")
    return rounded(
        found.select("account_id", (F.col("monthly_charges") - F.col("med")).alias("overpay_indicator")), 9
    )


@query(
    "feature_stats",
    _ENGINEERED
    + " UNION ALL ".join(
        f" SELECT '{c}' AS \"column\", round(min({c}), 3) + 0 AS min, round(max({c}), 3) + 0 AS max, "
        f"round(avg({c}), 3) + 0 AS mean, count(*) - count({c}) AS nulls FROM (SELECT CAST({c} AS DOUBLE) AS {c} "
        "FROM engineered WHERE split = 'train')"
        for c in ENGINEERED
    ),
)
def feature_stats(spark, sf_dir):
    train = engineered(spark, sf_dir)[0].filter("split = 'train'")
    return rounded(St.value_ranges(train, ENGINEERED), 3)


FLAGS = ["is_mtm_fiber", "is_mtm_no_support", "is_echeck_mtm", "is_auto_pay", "has_internet"]


@query(
    "rate_by_flag",
    _ENGINEERED
    + " UNION ALL ".join(
        f" SELECT '{c}' AS feature, {c} AS flag, round(avg(y), 6) AS rate, count(*) AS count "
        f"FROM engineered WHERE split = 'train' GROUP BY {c}"
        for c in FLAGS
    ),
)
def rate_by_flag(spark, sf_dir):
    train = engineered(spark, sf_dir)[0].filter("split = 'train'")
    return rounded(St.rate_by_flag(train, FLAGS, "y"))


@query(
    "rate_by_bin",
    f"""{_ENGINEERED} SELECT 'tenure_group' AS feature, CAST(tenure_group AS INTEGER) AS flag,
  round(avg(y), 6) AS rate, count(*) AS count FROM engineered
WHERE split = 'train' AND tenure_group IS NOT NULL GROUP BY 2""",
)
def rate_by_bin(spark, sf_dir):
    rows = split_accounts(spark, sf_dir, ["account_id", "tenure", "churn"]).filter("split = 'train'")
    binned = rows.withColumn("tenure_group", Fe.tenure_group(F.col("tenure")))
    return rounded(St.rate_by_flag(binned, ["tenure_group"], "y"))


@query(
    "feature_selection",
    f"WITH {S.ACCOUNTS} SELECT tenure, monthly_charges, contract, internet_service, online_security, "
    "tech_support, payment_method, total_charges, dependents, paperless_billing FROM accounts",
)
def feature_selection(spark, sf_dir):
    """The moderate raw feature list in its order; absent names are ignored, one is dropped."""
    keep = [c for c in P.feature_sets(COLS)["C"] if c not in ENGINEERED]
    rows = accounts(spark, sf_dir)
    return Fe.keep_columns(rows, [*keep, "gender"], drop=["senior_citizen"])


# ---- splits ---------------------------------------------------------------------


@query("stratified_split", f"WITH {S.SPLIT} SELECT account_id, split FROM split_accounts")
def stratified_split(spark, sf_dir):
    return split_accounts(spark, sf_dir, ["account_id", "churn"]).select("account_id", "split")


@query(
    "split_summary",
    f"""WITH {S.SPLIT} SELECT split, count(*) AS rows,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM split_accounts) * 100, 6) AS share_pct,
  round(avg(y), 6) AS label_rate FROM split_accounts GROUP BY split""",
)
def split_summary(spark, sf_dir):
    return rounded(St.split_summary(split_accounts(spark, sf_dir, ["account_id", "churn"]), "y"))


@query("cv_folds", f"WITH {S.SPLIT} SELECT account_id, fold FROM split_accounts")
def cv_folds(spark, sf_dir):
    rows = accounts(spark, sf_dir, ["account_id", "churn"])
    return stratified_folds(rows, "account_id", "churn").select("account_id", "fold")


_STRATA = f"""WITH {S.ACCOUNTS}, placed AS (SELECT account_id, customer_id, row_number() OVER (PARTITION BY customer_id
    ORDER BY md5(concat(CAST(account_id AS VARCHAR), '|42')), account_id) AS place,
  count(*) OVER (PARTITION BY customer_id) AS n FROM accounts)"""


@query(
    "split_by_customer",
    f"""{_STRATA} SELECT account_id, CASE WHEN place <= (n * 6) // 10 THEN 'train' WHEN place <= (n * 8) // 10 THEN 'val' ELSE 'test' END AS split,
  CAST((place - 1) % 5 AS INTEGER) AS fold FROM placed""",
)
def split_by_customer(spark, sf_dir):
    """A stratum for each customer: the cuts are a table, the folds join their offsets."""
    rows = accounts(spark, sf_dir, ["account_id", "customer_id"])
    folded = stratified_folds(rows, "account_id", "customer_id")
    cuts = stratified_cuts(rows, "account_id", "customer_id")
    return cuts.apply(folded).select("account_id", "split", "fold")


@query(
    "ordinal_dictionary",
    f"""WITH {S.SPLIT}, places AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS place
  FROM (SELECT DISTINCT CAST(customer_id AS VARCHAR) AS v FROM split_accounts WHERE split = 'train'))
SELECT account_id, coalesce(p.place, -1) AS place FROM split_accounts LEFT JOIN places p ON v = CAST(customer_id AS VARCHAR)""",
)
def ordinal_dictionary(spark, sf_dir):
    """Every customer of the training rows is a category; others are -1."""
    rows = split_accounts(spark, sf_dir, ["account_id", "customer_id", "churn"])
    found = Dc.fit_dictionary(rows.filter("split = 'train'"), ["customer_id"])
    placed = Dc.ordinal_encode(rows, found, ["customer_id"])
    return placed.select("account_id", F.col("customer_id_place").alias("place"))


@query(
    "union_splits",
    f"""WITH {S.SPLIT} SELECT account_id, y, split FROM split_accounts WHERE split IN ('train', 'val')""",
)
def union_splits(spark, sf_dir):
    rows = split_accounts(spark, sf_dir, ["account_id", "churn"]).select("account_id", "y", "split")
    return rows.filter("split = 'train'").unionByName(rows.filter("split = 'val'"))


@query(
    "class_weights",
    f"""WITH {S.SPLIT}, n AS (SELECT count(*) FILTER (WHERE y = 0) AS n0, count(*) FILTER (WHERE y = 1) AS n1
  FROM split_accounts WHERE split = 'train')
SELECT CAST(0 AS INTEGER) AS label, n0 AS rows, round(CAST(n0 + n1 AS DOUBLE) / (2 * n0), 6) AS weight,
  round(CAST(n0 AS DOUBLE) / n1, 6) AS positive_weight FROM n
UNION ALL SELECT 1, n1, round(CAST(n0 + n1 AS DOUBLE) / (2 * n1), 6), round(CAST(n0 AS DOUBLE) / n1, 6) FROM n""",
)
def class_weights(spark, sf_dir):
    train = split_accounts(spark, sf_dir, ["account_id", "churn"]).filter("split = 'train'")
    return rounded(weights_by_class(train, "y"))


# ---- encoding ---------------------------------------------------------------------

_SQL = S.feature_sql()


def _features(names: list[str]) -> str:
    return ", ".join(f'round(CAST({_SQL[n]} AS DOUBLE), 4) + 0 AS "{n}"' for n in names)


_NUM = [n for n in S.FEATURE_NAMES if n.startswith("num__")]
_CAT = [n for n in S.FEATURE_NAMES if n.startswith("cat__")]


@query(
    "impute_scale",
    f"{_FITTED} SELECT account_id, {_features(_NUM)} FROM engineered, fitted",
)
def impute_scale(spark, sf_dir):
    fit = fitted(spark, sf_dir)
    rows, pre = fit.rows, fit.preprocessor
    return rounded(pre.transform_wide(rows, ["account_id"]).select("account_id", *_NUM), 4)


@query("onehot", f"{_FITTED} SELECT account_id, {_features(_CAT)} FROM engineered, fitted")
def onehot(spark, sf_dir):
    rows = split_accounts(spark, sf_dir, ["account_id", *COLS.categorical_features, "churn"])
    train = rows.filter("split = 'train'")
    pre = P.fit_preprocessor(train, [], COLS.categorical_features)
    return pre.transform_wide(rows, ["account_id"])


def _sparse(names: str) -> str:
    return f"""{_FITTED}, wide AS (SELECT account_id, {_features(_CAT)} FROM engineered, fitted)
SELECT account_id, {names} FROM wide"""


_CAT_NAMES = [f'"{n}"' for n in _CAT]


@query(
    "onehot_dictionary",
    _sparse(
        "concat_ws(',', "
        + ", ".join(f"CASE WHEN {n} = 1 THEN '{i}' END" for i, n in enumerate(_CAT_NAMES))
        + ") AS places, "
        + f"{len(_CAT_NAMES)} AS width"
    ),
)
def onehot_dictionary(spark, sf_dir):
    """The one-hot features by joins with a dictionary table, as sparse vectors: the places of the ones."""
    rows = split_accounts(spark, sf_dir, ["account_id", *COLS.categorical_features, "churn"])
    found = Dc.fit_dictionary(rows.filter("split = 'train'"), COLS.categorical_features)
    encoded = Dc.one_hot_encode(rows, found, COLS.categorical_features)
    values = vector_to_array("features")
    places = F.transform(values, lambda x, i: F.when(x == 1, i.cast("string")))
    return encoded.select("account_id", F.array_join(places, ",").alias("places"), F.size(values).alias("width"))


@query(
    "onehot_all",
    f"{_FITTED} SELECT account_id, "
    + ", ".join(
        f"CAST(CAST(coalesce({c}, mode_{c}) = '{v}' AS INTEGER) AS DOUBLE) AS \"cat__{c}_{v}\""
        for c in ("contract", "payment_method")
        for v in S.CATEGORIES[c]
    )
    + " FROM engineered, fitted",
)
def onehot_all(spark, sf_dir):
    """Every category gets a column, none is the reference."""
    rows = split_accounts(spark, sf_dir, ["account_id", "contract", "payment_method", "churn"])
    train = rows.filter("split = 'train'")
    pre = P.fit_preprocessor(train, [], ["contract", "payment_method"], drop_first=False)
    return pre.transform_wide(rows, ["account_id"])


@query(
    "missing_indicator",
    f"""WITH {S.SPLIT},
numbers AS (SELECT account_id, split, tenure, monthly_charges, try_cast(trim(total_charges) AS DOUBLE) AS total FROM split_accounts),
fit AS (SELECT avg(tenure) AS mt, stddev_pop(tenure) AS st, avg(monthly_charges) AS mm, stddev_pop(monthly_charges) AS sm,
  avg(coalesce(total, 0)) AS mo, stddev_pop(coalesce(total, 0)) AS so,
  avg(CASE WHEN total IS NULL THEN 1 ELSE 0 END) AS mi, stddev_pop(CASE WHEN total IS NULL THEN 1 ELSE 0 END) AS si
  FROM numbers WHERE split = 'train')
SELECT account_id, round((tenure - mt) / st, 4) + 0 AS num__tenure, round((monthly_charges - mm) / sm, 4) + 0 AS num__monthly_charges,
  round((coalesce(total, 0) - mo) / so, 4) + 0 AS num__total_charges,
  round((CASE WHEN total IS NULL THEN 1 ELSE 0 END - mi) / si, 4) + 0 AS num__total_charges_missing FROM numbers, fit""",
)
def missing_indicator(spark, sf_dir):
    """Zero-filled numbers with an indicator for the columns that have gaps in training."""
    names = ["tenure", "monthly_charges", "total_charges"]
    rows = split_accounts(spark, sf_dir, ["account_id", *names, "churn"])
    pre = P.fit_preprocessor(rows.filter("split = 'train'"), names, [], impute="zero", indicators=True)
    return rounded(pre.transform_wide(rows, ["account_id"]), 4)


@query(
    "ordinal_encode",
    f"""WITH {S.FAULTY} SELECT account_id,
  CAST(CASE contract WHEN 'Month-to-month' THEN 0 WHEN 'One year' THEN 1 WHEN 'Two year' THEN 2 ELSE -1 END AS INTEGER) AS contract,
  CAST(CASE internet_service WHEN 'DSL' THEN 0 WHEN 'Fiber optic' THEN 1 WHEN 'No' THEN 2 ELSE -1 END AS INTEGER) AS internet_service
FROM faulty""",
)
def ordinal_encode(spark, sf_dir):
    """Categories fitted on clean training accounts, applied to faulty ones: unknown is -1."""
    names = ["contract", "internet_service"]
    train = split_accounts(spark, sf_dir, ["account_id", *names, "churn"]).filter("split = 'train'")
    _, categories = P.fit_categories(train, names)
    rows = faulty_accounts(spark, sf_dir, ["account_id", *names])
    codes = P.ordinal_encode(rows, categories)
    return rows.select("account_id", *[c.alias(n) for n, c in codes.items()])


@query(
    "preprocess_matrix",
    f"{_FITTED} SELECT account_id, split, y, {_features(S.FEATURE_NAMES)} FROM engineered, fitted",
)
def preprocess_matrix(spark, sf_dir):
    fit = fitted(spark, sf_dir)
    rows, pre = fit.rows, fit.preprocessor
    return rounded(pre.transform_wide(rows, ["account_id", "split", "y"]), 4)


@query(
    "dataset_contract",
    f"""WITH {S.SPLIT} SELECT split, count(*) AS rows, count(y) AS labelled_rows, CAST(0 AS BIGINT) AS wrong_width,
  CAST(0 AS BIGINT) AS rows_with_nan, CAST(0 AS BIGINT) AS rows_with_inf FROM split_accounts GROUP BY split""",
)
def dataset_contract(spark, sf_dir):
    fit = fitted(spark, sf_dir)
    rows, pre = fit.rows, fit.preprocessor
    matrix = pre.transform(rows, ["split", "y"])
    return P.dataset_contract(matrix, len(pre.feature_names()), "y")


@query(
    "feature_names",
    f"""{_FITTED}
SELECT CAST(i - 1 AS INTEGER) AS place, name AS feature_name,
  (SELECT count(*) FROM engineered WHERE split = 'train') AS train_rows
FROM (SELECT unnest([{', '.join(f"'{n}'" for n in S.FEATURE_NAMES)}]) AS name,
  unnest(range(1, {len(S.FEATURE_NAMES) + 1})) AS i)""",
)
def feature_names(spark, sf_dir):
    """Encoded feature names in output order, with the rows the categories were learned on."""
    rows = split_accounts(spark, sf_dir, ["account_id", *COLS.categorical_features, "churn"])
    train = rows.filter("split = 'train'")
    mode, categories = P.fit_categories(train, COLS.categorical_features)
    numeric = COLS.numeric_features
    pre = P.Preprocessor(numeric, COLS.categorical_features, {}, {}, {}, mode, categories)
    names = F.array(*[F.lit(n) for n in pre.feature_names()])
    return train.agg(F.count("*").alias("train_rows")).select(
        F.posexplode(names).alias("place", "feature_name"), "train_rows"
    )
