"""Batch scoring, threshold lookups, drift and batch metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.operators import batches as B
from stayflow.operators import drift as D
from stayflow.operators import lookups as L
from stayflow.operators import rows as R
from stayflow.operators import scoring as Sc
from stayflow.operators import training as Tr
from stayflow.operators.sizing import materialize, scratch_folder
from stayflow.params import ACCOUNT_COLUMNS, DriftParams
from stayflow.plans import check_sql as S
from stayflow.plans.features import MODEL_FIELDS, engineered, fitted, split_accounts
from stayflow.plans.registry import query, rounded
from stayflow.sources.state import FittedState, load_state, save_state
from stayflow.sources.accounts import (
    ACCOUNT_FIELDS,
    batch_log,
    faulty_accounts,
    scored_accounts,
    threshold_history,
)

COLS = ACCOUNT_COLUMNS
MODEL = Sc.LinearModel(S.INTERCEPT, S.COEFFICIENTS, "linear-v1")


def scored_batch(spark, sf_dir, threshold: float = 0.5) -> DataFrame:
    """Faulty accounts scored by the fixed linear model; repeated rows are scored like any."""
    fit = fitted(spark, sf_dir)
    batch = faulty_accounts(spark, sf_dir, ACCOUNT_FIELDS).drop("customer_id")
    return Sc.score_batch(batch, fit.preprocessor, MODEL, fit.medians, threshold, COLS)


def scored_sql(source: str) -> str:
    """CTE ``batch`` (account_id, p, prediction_status) of the scored account-like rows."""
    views = f"{S.FITTED},{S.FAULTY_ALL}, checked AS (SELECT *, {S.row_error_sql(False)} AS errors FROM {source})"
    return f"""WITH {views},{S.engineered('checked', 'ready')},
batch AS (SELECT account_id, CASE WHEN errors = '' THEN 1 / (1 + exp(-({S.MARGIN}))) END AS p,
  CASE WHEN errors = '' THEN 'ok' ELSE 'failed' END AS prediction_status FROM ready, fitted)"""


SCORED_COLUMNS = f"""account_id, round(p, 6) AS churn_probability, prediction_status,
  CAST(p >= 0.5 AS INTEGER) AS churn_prediction, CASE WHEN p >= 0.5 THEN 'contact' WHEN p < 0.5 THEN 'no_contact' END AS decision,
  round(p * {S.VALUE} - {S.COST}, 3) + 0 AS expected_value, 'linear-v1' AS model_id"""
_SCORED_BATCH = scored_sql("faulty_all")


@query(
    "score_batch",
    f"{_SCORED_BATCH} SELECT {SCORED_COLUMNS} FROM batch",
)
def score_batch(spark, sf_dir):
    return rounded(scored_batch(spark, sf_dir), 6, expected_value=3)


@query("score_saved_state", f"{_SCORED_BATCH} SELECT {SCORED_COLUMNS} FROM batch")
def score_saved_state(spark, sf_dir):
    """Fit, save, load, and score the batch from the loaded state alone."""
    fit = fitted(spark, sf_dir)
    folder = scratch_folder(spark)
    save_state(spark, folder, FittedState(fit.preprocessor, fit.medians, {"linear": MODEL}), COLS.internet)
    state = load_state(spark, folder, COLS.internet)
    batch = faulty_accounts(spark, sf_dir, ACCOUNT_FIELDS).drop("customer_id")
    scored = Sc.score_batch(batch, state.preprocessor, state.models["linear"], state.medians, 0.5, COLS)
    return rounded(scored, 6, expected_value=3)


@query(
    "score_trained",
    f"""{_SCORED_BATCH} SELECT account_id, prediction_status, p IS NOT NULL AS scored, true AS consistent FROM batch""",
)
def score_trained(spark, sf_dir):
    """Decisions of a trained logistic regression and a trained forest, loaded from saved state,
    by soft vote; ``consistent`` checks each row against its two probabilities."""
    fit = fitted(spark, sf_dir)
    matrix = fit.preprocessor.transform(fit.rows.filter("split = 'train'"), [F.col("y").alias("label")])
    names = fit.preprocessor.feature_names()
    with Tr.kept(matrix) as (train,):
        linear = Sc.linear_from_ml(Tr.fit(Tr.DEFAULT_CANDIDATE, train), names)
        forest = Tr.fit(Tr.BASELINES[2], train)
    folder = scratch_folder(spark)
    models = {"linear": linear, "forest": forest}
    save_state(spark, folder, FittedState(fit.preprocessor, fit.medians, models), COLS.internet)
    state = load_state(spark, folder, COLS.internet)
    batch = faulty_accounts(spark, sf_dir, ACCOUNT_FIELDS).drop("customer_id")
    rows = Sc.score_batch_with(batch, state.preprocessor, state.models, state.medians, 0.5, COLS)
    p, mean = F.col("churn_probability"), (F.col("p_linear") + F.col("p_forest")) / 2
    inside = F.col("p_linear").between(0, 1) & F.col("p_forest").between(0, 1)
    decided = F.col("decision") == F.when(mean >= 0.5, "contact").otherwise("no_contact")
    value = F.abs(F.col("expected_value") - (mean * S.VALUE - S.COST)) < 1e-6
    good = inside & (F.abs(p - mean) < 1e-12) & decided & value & (F.col("churn_prediction") == (mean >= 0.5).cast("int"))
    empty = p.isNull() & F.col("decision").isNull() & F.col("expected_value").isNull() & F.col("churn_prediction").isNull()
    return rows.select(
        "account_id", "prediction_status", p.isNotNull().alias("scored"),
        F.when(F.col("prediction_status") == "ok", F.coalesce(good, F.lit(False))).otherwise(empty).alias("consistent"),
    )


@query(
    "output_validation",
    f"""{_SCORED_BATCH} SELECT count(*) AS rows, count(*) FILTER (WHERE p IS NULL) AS invalid_probability,
  count(*) FILTER (WHERE p IS NULL) AS invalid_prediction, count(*) FILTER (WHERE p IS NULL) AS invalid_decision,
  count(*) FILTER (WHERE p IS NULL) AS inconsistent_decision FROM batch""",
)
def output_validation(spark, sf_dir):
    return R.output_issue_counts(scored_batch(spark, sf_dir), 0.5)


@query(
    "scored_batch_log",
    f"""{_SCORED_BATCH} SELECT count(*) AS batch_size,
  count(*) FILTER (WHERE prediction_status = 'failed') AS failed_rows FROM batch""",
)
def scored_batch_log(spark, sf_dir):
    """The batch-log row that scoring the faulty accounts adds."""
    return B.batch_row(scored_batch(spark, sf_dir))


@query(
    "score_left_join",
    f"""WITH {S.FAULTY},
scored AS (SELECT account_id, CAST(CASE contract WHEN 'Month-to-month' THEN 40 WHEN 'One year' THEN 15 ELSE 5 END
      + CASE WHEN internet_service = 'Fiber optic' THEN 20 ELSE 0 END + CASE WHEN tenure < 12 THEN 10 ELSE 0 END
      + account_id % 11 AS DOUBLE) / CAST(100 AS DOUBLE) AS p FROM accounts)
SELECT f.account_id, CASE WHEN {S.field_error_sql()} = '' THEN p END AS p
FROM faulty f JOIN scored s ON s.account_id = f.account_id""",
)
def score_left_join(spark, sf_dir):
    """Scores computed apart for the valid rows only, written back to all rows."""
    rows = faulty_accounts(spark, sf_dir)
    valid = rows.filter(F.size(R.field_errors(rows, COLS)) == 0).select("account_id").distinct()
    scores = scored_accounts(spark, sf_dir).select("account_id", "p").join(valid, "account_id", "left_semi")
    return L.attach_scores(rows.select("account_id"), scores, "account_id")


@query(
    "soft_vote",
    f"""WITH {S.SCORED} SELECT account_id, round((p + p * p + sqrt(p)) / 3, 6) AS p_vote FROM scored""",
)
def soft_vote(spark, sf_dir):
    """Mean of three given model scores per account."""
    p = F.col("p")
    models = scored_accounts(spark, sf_dir).select(
        "account_id", p.alias("p1"), (p * p).alias("p2"), F.sqrt(p).alias("p3")
    )
    return rounded(models.select("account_id", Sc.soft_vote(["p1", "p2", "p3"]).alias("p_vote")))


@query(
    "contact_list",
    f"""WITH {S.SCORED} SELECT account_id, p, CASE WHEN p >= 0.7 THEN 'High' WHEN p >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_level,
  CASE WHEN p >= 0.7 THEN 'Urgent Retention' WHEN p >= 0.4 THEN 'Targeted Offer' ELSE 'Monitor' END AS recommended_action
FROM scored ORDER BY p DESC, account_id LIMIT 500""",
)
def contact_list(spark, sf_dir):
    return Sc.contact_list(scored_accounts(spark, sf_dir), "account_id")


# ---- results history -----------------------------------------------------------

_LAST = "last AS (SELECT model_id, max_by(final_threshold, seq) AS final_threshold, max(seq) AS last_seq FROM history GROUP BY 1)"


@query(
    "last_per_key",
    f"WITH {S.HISTORY}, {_LAST} SELECT model_id, final_threshold, last_seq FROM last",
)
def last_per_key(spark, sf_dir):
    return L.last_per_key(threshold_history(spark, sf_dir), "model_id", "final_threshold", "seq")


_MODEL_OF = "CASE contract WHEN 'Month-to-month' THEN 'click' WHEN 'One year' THEN 'view' ELSE 'unlisted' END"


@query(
    "threshold_lookup",
    f"""WITH {S.SCORED},{S.HISTORY}, {_LAST},
found AS (SELECT {_MODEL_OF} AS model_id, p, coalesce(final_threshold,
    (SELECT max_by(final_threshold, seq) FROM history), 0.5) AS threshold
  FROM scored LEFT JOIN last ON last.model_id = {_MODEL_OF})
SELECT model_id, threshold, count(*) AS rows, count(*) FILTER (WHERE p >= threshold) AS contacts FROM found GROUP BY 1, 2""",
)
def threshold_lookup(spark, sf_dir):
    """Each account's model decides its threshold; an unlisted model takes the latest of all."""
    contract = F.col("contract")
    model = F.when(contract == "Month-to-month", "click").when(contract == "One year", "view").otherwise("unlisted")
    rows = scored_accounts(spark, sf_dir, ["contract"]).withColumn("model_id", model)
    found = L.with_model_threshold(rows, threshold_history(spark, sf_dir))
    return found.groupBy("model_id", "threshold").agg(
        F.count("*").alias("rows"), F.count_if(F.col("p") >= F.col("threshold")).alias("contacts")
    )


# ---- drift -----------------------------------------------------------------------

DRIFT_COLUMNS = ["tenure", "monthly_charges", "total_charges"]
_VALUE = {c: "try_cast(trim(total_charges) AS DOUBLE)" if c == "total_charges" else f"CAST({c} AS DOUBLE)" for c in DRIFT_COLUMNS}
_REFERENCE = (
    f"WITH {S.SPLIT}, train_values AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", account_id, {_VALUE[c]} AS value FROM split_accounts WHERE split = 'train'"
        for c in DRIFT_COLUMNS
    )
    + """), ranked AS (SELECT *, row_number() OVER (PARTITION BY "column"
    ORDER BY md5(concat(CAST(account_id AS VARCHAR), '|', "column", '|42')), account_id) AS place,
    count(*) OVER (PARTITION BY "column") AS original FROM train_values WHERE value IS NOT NULL),
reference AS (SELECT "column", value, original FROM ranked WHERE place <= 2000)"""
)


#: These queries compare with a stored sample, as their check SQL does; the ones named tables do not.
SAMPLE = DriftParams(max_reference_samples=2000)


def drift_input(spark, sf_dir) -> DataFrame:
    """Written once: the reference and every checked batch read it."""
    return materialize(split_accounts(spark, sf_dir, ["account_id", *DRIFT_COLUMNS, "churn"]))


@query("drift_reference", f"{_REFERENCE} SELECT * FROM reference")
def drift_reference(spark, sf_dir):
    train = drift_input(spark, sf_dir).filter("split = 'train'")
    return D.reference_sample(train, DRIFT_COLUMNS, "account_id", SAMPLE)


def drifted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("monthly_charges", F.col("monthly_charges") * 1.5)


_INPUTS = {"same": "monthly_charges", "drifted": "monthly_charges * 1.5"}


def ks_sql(reference: str) -> str:
    """The statistics of both inputs against a table ``reference`` defined by the given SQL."""
    return (
        f"{reference}, new_values AS ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS input, '{c}' AS \"column\", {expr if c == 'monthly_charges' else _VALUE[c]} AS value FROM split_accounts WHERE split = 'test'"
            for name, expr in _INPUTS.items()
            for c in DRIFT_COLUMNS
        )
        + """), sides AS (SELECT input, "column", value, 1 AS r, 0 AS n FROM reference, (SELECT DISTINCT input FROM new_values)
  UNION ALL SELECT input, "column", value, 0, 1 FROM new_values WHERE value IS NOT NULL),
merged AS (SELECT input, "column", value, sum(r) AS r, sum(n) AS n FROM sides GROUP BY 1, 2, 3),
cumulated AS (SELECT input, "column", CAST(sum(r) OVER w AS DOUBLE) AS cr, CAST(sum(n) OVER w AS DOUBLE) AS cn,
  CAST(sum(r) OVER g AS DOUBLE) AS tr, CAST(sum(n) OVER g AS DOUBLE) AS tn FROM merged
  WINDOW w AS (PARTITION BY input, "column" ORDER BY value), g AS (PARTITION BY input, "column")),
ks AS (SELECT input, "column", CAST(any_value(tr) AS BIGINT) AS n_ref, CAST(any_value(tn) AS BIGINT) AS n_new,
  max(abs(cr / tr - cn / tn)) AS ks_statistic FROM cumulated GROUP BY 1, 2)"""
    )


_KS = ks_sql(_REFERENCE)
_WHOLE = ks_sql(
    f"WITH {S.SPLIT}, reference AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {_VALUE[c]} AS value FROM split_accounts WHERE split = 'train' AND {_VALUE[c]} IS NOT NULL"
        for c in DRIFT_COLUMNS
    )
    + ")"
)


@query("ks_drift", f'{_KS} SELECT input, "column", n_ref, n_new, round(ks_statistic, 6) AS ks_statistic FROM ks')
def ks_drift(spark, sf_dir):
    rows = drift_input(spark, sf_dir)
    reference = D.fit_reference(rows.filter("split = 'train'"), DRIFT_COLUMNS, "account_id", SAMPLE)
    test = rows.filter("split = 'test'")
    same = D.ks_against_reference(test, reference).select(F.lit("same").alias("input"), "*")
    moved = D.ks_against_reference(drifted(test), reference).select(F.lit("drifted").alias("input"), "*")
    return rounded(same.unionByName(moved))


@query(
    "ks_tables",
    f"""WITH {S.SPLIT}, v AS (SELECT monthly_charges AS value, split FROM split_accounts WHERE split IN ('train', 'test')),
merged AS (SELECT value, count(*) FILTER (WHERE split = 'train') AS r, count(*) FILTER (WHERE split = 'test') AS n FROM v GROUP BY 1),
cumulated AS (SELECT CAST(sum(r) OVER (ORDER BY value) AS DOUBLE) AS cr, CAST(sum(n) OVER (ORDER BY value) AS DOUBLE) AS cn,
  CAST(sum(r) OVER () AS DOUBLE) AS tr, CAST(sum(n) OVER () AS DOUBLE) AS tn FROM merged)
SELECT 'monthly_charges' AS "column", CAST(any_value(tr) AS BIGINT) AS n_ref, CAST(any_value(tn) AS BIGINT) AS n_new,
  round(max(abs(cr / tr - cn / tn)), 6) AS ks_statistic FROM cumulated""",
)
def ks_tables(spark, sf_dir):
    """The uncapped form: both sides are whole tables."""
    rows = split_accounts(spark, sf_dir, ["account_id", "monthly_charges", "churn"])
    return rounded(
        D.ks_between(rows.filter("split = 'train'"), rows.filter("split = 'test'"), "monthly_charges")
    )


@query("ks_drift_tables", f'{_WHOLE} SELECT input, "column", n_ref, n_new, round(ks_statistic, 6) AS ks_statistic FROM ks')
def ks_drift_tables(spark, sf_dir):
    """All columns of the whole train and test rows, each table read once for an input."""
    rows = drift_input(spark, sf_dir)
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    same = D.ks_tables(train, test, DRIFT_COLUMNS).select(F.lit("same").alias("input"), "*")
    moved = D.ks_tables(train, drifted(test), DRIFT_COLUMNS).select(F.lit("drifted").alias("input"), "*")
    return rounded(same.unionByName(moved))


def problem_rows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Train rows, and test rows with drifted charges, a dropped column and one without a number."""
    rows = drift_input(spark, sf_dir)
    test = drifted(rows.filter("split = 'test'")).drop("tenure").withColumn("total_charges", F.lit("abc"))
    return rows.filter("split = 'train'"), test


def problem_report(spark, sf_dir) -> DataFrame:
    train, test = problem_rows(spark, sf_dir)
    return D.drift_report(test, D.fit_reference(train, DRIFT_COLUMNS, "account_id", SAMPLE))


def whole_problem_report(spark, sf_dir) -> DataFrame:
    train, test = problem_rows(spark, sf_dir)
    return D.drift_between(train, test, DRIFT_COLUMNS)


def problems_sql(ks: str) -> str:
    return f"""{ks}, problems AS (
  SELECT 'tenure' AS "column", 'MISSING_IN_NEW_DATA' AS status, CAST(NULL AS DOUBLE) AS ks_statistic UNION ALL
  SELECT 'total_charges', 'NO_VALID_VALUES', NULL UNION ALL
  SELECT "column", CASE WHEN ks_statistic * sqrt(CAST(n_ref AS DOUBLE) * n_new / (n_ref + n_new)) > 1.358 THEN 'DRIFT_DETECTED' ELSE 'OK' END,
    ks_statistic FROM ks WHERE input = 'drifted' AND "column" = 'monthly_charges')"""


_PROBLEMS, _WHOLE_PROBLEMS = problems_sql(_KS), problems_sql(_WHOLE)


@query("drift_report", f'{_PROBLEMS} SELECT "column", status, round(ks_statistic, 6) AS ks_statistic FROM problems')
def drift_report(spark, sf_dir):
    return rounded(problem_report(spark, sf_dir).select("column", "status", "ks_statistic"))


@query("drift_report_tables", f'{_WHOLE_PROBLEMS} SELECT "column", status, round(ks_statistic, 6) AS ks_statistic FROM problems')
def drift_report_tables(spark, sf_dir):
    return rounded(whole_problem_report(spark, sf_dir).select("column", "status", "ks_statistic"))


_SCORE = """ SELECT count(*) AS columns, count(*) FILTER (WHERE status <> 'OK') AS problem_columns,
  round(CAST(count(*) FILTER (WHERE status <> 'OK') AS DOUBLE) / count(*), 6) AS drift_score,
  string_agg("column", ',' ORDER BY "column") FILTER (WHERE status <> 'OK') AS drift_columns,
  bool_or(status <> 'OK') AS drift_detected FROM problems"""


def score_of(report: DataFrame) -> DataFrame:
    return rounded(D.drift_score(report).withColumn("drift_columns", F.array_join("drift_columns", ",")))


@query("drift_score", _PROBLEMS + _SCORE)
def drift_score(spark, sf_dir):
    return score_of(problem_report(spark, sf_dir))


@query("drift_score_tables", _WHOLE_PROBLEMS + _SCORE)
def drift_score_tables(spark, sf_dir):
    return score_of(whole_problem_report(spark, sf_dir))


@query("drift_engineered")
def drift_engineered(spark, sf_dir):
    """Raw rows checked against all engineered train rows: engineered first."""
    rows, medians = engineered(spark, sf_dir)
    names = ["avg_monthly_spend", "overpay_indicator", "tenure_x_contract"]
    raw = split_accounts(spark, sf_dir, MODEL_FIELDS).filter("split = 'test'").drop("split", "y")
    ready = D.prepare_drift_input(raw, D.DriftReference({c: [] for c in names}), medians, COLS)
    return D.drift_between(rows.filter("split = 'train'"), ready, names)


# ---- batch metrics ----------------------------------------------------------------

_LOG = f"WITH {S.BATCH_LOG}"


@query(
    "batch_metrics",
    f"""{_LOG} SELECT count(*) AS prediction_batches, CAST(sum(batch_size) AS BIGINT) AS predictions_total,
  CAST(sum(failed_rows) AS BIGINT) AS prediction_failures, round(avg(latency_ms), 4) AS avg_latency_ms,
  round(max_by(CAST(failed_rows AS DOUBLE) / batch_size, batch_day), 4) AS last_drift_score,
  round(CAST(sum(failed_rows) AS DOUBLE) / greatest(sum(batch_size), 1), 4) AS failure_rate FROM batch_log""",
)
def batch_metrics(spark, sf_dir):
    log = batch_log(spark, sf_dir)
    # The share of failures stands in for the drift score of each batch.
    scored = log.withColumn("drift_score", F.col("failed_rows") / F.col("batch_size"))
    return rounded(B.batch_metrics(scored, "batch_day", "drift_score"), 4)


@query(
    "batch_metrics_running",
    f"""{_LOG} SELECT batch_day, CAST(datediff('day', DATE '1970-01-01', batch_day) AS INTEGER) AS seq,
  batch_size, failed_rows, round(latency_ms, 4) AS latency_ms,
  count(*) OVER w AS prediction_batches, CAST(sum(batch_size) OVER w AS BIGINT) AS predictions_total,
  CAST(sum(failed_rows) OVER w AS BIGINT) AS prediction_failures,
  round(CAST(sum(failed_rows) OVER w AS DOUBLE) / sum(batch_size) OVER w, 4) AS failure_rate,
  round(sum(latency_ms) OVER w / count(*) OVER w, 4) AS avg_latency_ms
FROM batch_log WINDOW w AS (ORDER BY batch_day)""",
)
def batch_metrics_running(spark, sf_dir):
    log = batch_log(spark, sf_dir).withColumn("seq", F.unix_date("batch_day"))
    return rounded(B.batch_metrics_running(log, "seq"), 4)


@query(
    "batch_metrics_history",
    f"""{_LOG} SELECT batch_day, batch_size, failed_rows, round(latency_ms, 4) AS latency_ms FROM batch_log
ORDER BY batch_day DESC LIMIT 200""",
)
def batch_metrics_history(spark, sf_dir):
    return rounded(B.batch_history(batch_log(spark, sf_dir), "batch_day"), 4)
