"""Threshold sweep, threshold choice, metrics and curves over the scored accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions.columns import threshold_grid
from stayflow.operators import evaluation as E
from stayflow.operators.sizing import materialize
from stayflow.operators.splits import stratified_split
from stayflow.params import BusinessParams, QualityGates
from stayflow.plans import check_sql as S
from stayflow.plans.registry import query, rounded
from stayflow.sources.accounts import accounts, fixed_score, scored_accounts

GRID = threshold_grid(0.20, 0.85, 0.05)
MONEY = BusinessParams()


def sweep(spark, sf_dir) -> DataFrame:
    return E.threshold_sweep(
        scored_accounts(spark, sf_dir), GRID, MONEY.retained_value, MONEY.contact_cost
    )


def scored_split(spark, sf_dir) -> DataFrame:
    """(y, p, split), written once: choosing and testing a threshold read it several times."""
    rows = accounts(spark, sf_dir, ["account_id", "tenure", "contract", "internet_service", "churn"])
    scored = fixed_score(rows).select("account_id", "y", "p")
    return materialize(stratified_split(scored, "account_id", "y").drop("account_id"))


_SWEEP = f"WITH {S.SCORED},{S.sweep_sql('scored')}"


@query("threshold_sweep", f"{_SWEEP} SELECT {S.SWEEP_COLUMNS} FROM sweep")
def threshold_sweep(spark, sf_dir):
    return rounded(sweep(spark, sf_dir))


_CHOICES = [
    ("fallback", 0.70, 0.50, "net_value", "Validation fallback: Best F1 (no threshold met constraints: Recall >= 0.70 & Precision >= 0.50)"),
    ("net_value", 0.70, 0.45, "net_value", "Validation selection: Best Net_Value (constraints: Recall >= 0.70 & Precision >= 0.45)"),
    ("precision", 0.80, 0.0, "precision", "Validation selection: Best Precision (constraints: Recall >= 0.80)"),
    ("f1", 0.0, 0.0, "f1", "Validation selection: Best F1 (constraints: no constraints)"),
]


@query(
    "select_threshold",
    _SWEEP
    + " UNION ALL ".join(
        f" SELECT '{name}' AS rule, {S.SWEEP_COLUMNS}, '{reason}' AS reason "
        f"FROM ({S.chosen_sql('sweep', r, p, 'f1_score' if goal == 'f1' else goal)})"
        for name, r, p, goal, reason in _CHOICES
    ),
)
def select_threshold(spark, sf_dir):
    table = sweep(spark, sf_dir)
    picks = [
        E.select_threshold(table, r, goal, p).select(F.lit(name).alias("rule"), "*")
        for name, r, p, goal, _ in _CHOICES
    ]
    result = picks[0]
    for pick in picks[1:]:
        result = result.unionByName(pick)
    return rounded(result)


_TARGETS = (0.3, 0.4, 0.5, 0.6)


@query(
    "nearest_threshold",
    _SWEEP
    + " UNION ALL ".join(
        f" SELECT CAST({t} AS DOUBLE) AS target, {S.SWEEP_COLUMNS} FROM "
        f"(SELECT * FROM sweep ORDER BY abs(threshold - CAST({t} AS DOUBLE)), threshold LIMIT 1)"
        for t in _TARGETS
    ),
)
def nearest_threshold(spark, sf_dir):
    return rounded(E.nearest_threshold(sweep(spark, sf_dir), _TARGETS))


@query(
    "top_thresholds",
    f"""{_SWEEP}
(SELECT 'all' AS rule, {S.SWEEP_COLUMNS} FROM (SELECT * FROM sweep ORDER BY net_value DESC, threshold LIMIT 5))
UNION ALL
(SELECT 'safe' AS rule, {S.SWEEP_COLUMNS} FROM (SELECT * FROM sweep
  WHERE recall >= 0.7 AND precision >= 0.45 ORDER BY net_value DESC, threshold LIMIT 5))""",
)
def top_thresholds(spark, sf_dir):
    table = sweep(spark, sf_dir)
    free = E.top_thresholds(table).select(F.lit("all").alias("rule"), "*")
    safe = E.top_thresholds(table, 5, 0.70, 0.45).select(F.lit("safe").alias("rule"), "*")
    return rounded(free.unionByName(safe))


_COUNTS = f"""WITH {S.SCORED},
counts AS (SELECT
  count(*) FILTER (WHERE y = 0 AND p < 0.5) AS tn, count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp,
  count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn, count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp
  FROM scored)"""


def counts_at(spark, sf_dir, threshold: float = 0.5) -> DataFrame:
    return E.confusion(scored_accounts(spark, sf_dir), threshold)


@query(
    "confusion",
    f"""{_COUNTS},
cells AS (
  SELECT 0 AS actual, 0 AS predicted, tn AS n, tn + fp AS of_actual FROM counts UNION ALL
  SELECT 0, 1, fp, tn + fp FROM counts UNION ALL
  SELECT 1, 0, fn, fn + tp FROM counts UNION ALL
  SELECT 1, 1, tp, fn + tp FROM counts)
SELECT actual, predicted, n AS count,
  round(CAST(n AS DOUBLE) / (SELECT tn + fp + fn + tp FROM counts) * 100, 6) AS pct_of_total,
  round(CAST(n AS DOUBLE) / of_actual, 6) AS share_of_actual FROM cells""",
)
def confusion(spark, sf_dir):
    return rounded(E.confusion_shares(counts_at(spark, sf_dir)))


@query(
    "classification_metrics",
    f"""{_COUNTS}
SELECT tn, fp, fn, tp, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision,
  round(CAST(tp AS DOUBLE) / (tp + fn), 6) AS recall,
  round(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), 6) AS f1 FROM counts""",
)
def classification_metrics(spark, sf_dir):
    return rounded(E.classification_metrics(counts_at(spark, sf_dir)))


@query(
    "classification_report",
    f"""{_COUNTS},
sides AS (SELECT *,
  CAST(tn AS DOUBLE) / (tn + fn) AS p0, CAST(tn AS DOUBLE) / (tn + fp) AS r0,
  CAST(2 * tn AS DOUBLE) / (2 * tn + fn + fp) AS f0,
  CAST(tp AS DOUBLE) / (tp + fp) AS p1, CAST(tp AS DOUBLE) / (tp + fn) AS r1,
  CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1,
  tn + fp AS s0, tp + fn AS s1, tn + fp + fn + tp AS n,
  CAST(tn + tp AS DOUBLE) / (tn + fp + fn + tp) AS acc FROM counts),
report AS (
  SELECT '0' AS class, p0 AS p, r0 AS r, f0 AS f, s0 AS support FROM sides UNION ALL
  SELECT '1', p1, r1, f1, s1 FROM sides UNION ALL
  SELECT 'accuracy', acc, acc, acc, n FROM sides UNION ALL
  SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM sides UNION ALL
  SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM sides)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM report""",
)
def classification_report(spark, sf_dir):
    return rounded(E.classification_report(counts_at(spark, sf_dir)))


@query(
    "contact_value",
    f"""{_COUNTS} SELECT tp AS correct_contacts, CAST(550 AS DOUBLE) AS value_per_correct_contact,
  CAST(550 * tp AS DOUBLE) AS total_value FROM counts""",
)
def contact_value(spark, sf_dir):
    return E.contact_value(counts_at(spark, sf_dir), MONEY)


@query(
    "campaign_kpis",
    f"""{_COUNTS}
SELECT tn + fp + fn + tp AS customers, tp + fn AS churners, tp AS captured,
  round(CAST(tp AS DOUBLE) / (tp + fn) * 100, 6) AS captured_pct, fn AS missed,
  round(CAST(fn AS DOUBLE) / (tp + fn) * 100, 6) AS missed_pct, fp AS false_alarms,
  round(CAST(fp AS DOUBLE) / (tn + fp) * 100, 6) AS false_alarm_pct, tp + fp AS flagged,
  round(CAST(tp AS DOUBLE) / (tp + fp) * 100, 6) AS campaign_precision_pct FROM counts""",
)
def campaign_kpis(spark, sf_dir):
    return rounded(E.campaign_kpis(counts_at(spark, sf_dir)))


def auc_sql(source: str, where: str = "true") -> str:
    return f"""SELECT CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg,
  sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS roc_auc
FROM (SELECT pos, neg, CAST(sum(neg) OVER (ORDER BY p) - neg AS DOUBLE) AS below
  FROM (SELECT p, CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) AS pos,
    CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE) AS neg FROM {source} WHERE {where} GROUP BY p))"""


@query(
    "roc_auc",
    f"WITH {S.SCORED} SELECT pos, neg, round(roc_auc, 6) AS roc_auc FROM ({auc_sql('scored')})",
)
def roc_auc(spark, sf_dir):
    return rounded(E.roc_auc(scored_accounts(spark, sf_dir)))


_CURVE = f"""WITH {S.SCORED},
score_groups AS (SELECT p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
  FROM scored GROUP BY p),
curve AS (SELECT p, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
  CAST(sum(pos) OVER () AS DOUBLE) AS all_pos, CAST(sum(neg) OVER () AS DOUBLE) AS all_neg
  FROM score_groups WINDOW w AS (ORDER BY p DESC))"""


@query(
    "roc_points",
    f"{_CURVE} SELECT round(p, 6) AS threshold, round(fp / all_neg, 6) AS fpr, "
    "round(tp / all_pos, 6) AS tpr FROM curve UNION ALL SELECT NULL, 0.0, 0.0",
)
def roc_points(spark, sf_dir):
    return rounded(E.roc_points(scored_accounts(spark, sf_dir), ends=True))


@query(
    "pr_points",
    f"{_CURVE} SELECT round(p, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, "
    "round(tp / all_pos, 6) AS recall, round(all_pos / (all_pos + all_neg), 6) AS baseline FROM curve "
    "UNION ALL SELECT NULL, 1.0, 0.0, round(avg(CAST(y AS DOUBLE)), 6) FROM scored",
)
def pr_points(spark, sf_dir):
    return rounded(E.pr_points(scored_accounts(spark, sf_dir), ends=True))


# ---- result row on the test split -----------------------------------------

_MIN_RECALL, _MIN_PRECISION = 0.70, 0.45
_FINAL = f"""WITH {S.SCORED_SPLIT},{S.sweep_sql('scored_split', "split = 'val'")},
chosen AS ({S.chosen_sql('sweep', _MIN_RECALL, _MIN_PRECISION, 'net_value')}),
auc AS ({auc_sql('scored_split', "split = 'test'")}),
counts AS (SELECT any_value(threshold) AS threshold, any_value(fits) AS fits,
  count(*) FILTER (WHERE y = 0 AND p < threshold) AS tn, count(*) FILTER (WHERE y = 0 AND p >= threshold) AS fp,
  count(*) FILTER (WHERE y = 1 AND p < threshold) AS fn, count(*) FILTER (WHERE y = 1 AND p >= threshold) AS tp
  FROM scored_split, (SELECT threshold, fits FROM chosen) WHERE split = 'test'),
result AS (SELECT counts.*, auc.roc_auc, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
  CAST(tp AS DOUBLE) / (tp + fn) AS recall, CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1
  FROM counts, auc)"""
_GATES = """concat_ws(',', CASE WHEN roc_auc < 0.83 THEN 'roc_auc' END,
  CASE WHEN recall < 0.70 THEN 'recall' END, CASE WHEN precision < 0.45 THEN 'precision' END)"""


def result_row(spark, sf_dir) -> DataFrame:
    rows = scored_split(spark, sf_dir)
    return E.final_results(
        rows.filter("split = 'val'"),
        rows.filter("split = 'test'"),
        GRID,
        _MIN_RECALL,
        _MIN_PRECISION,
        MONEY.retained_value,
        MONEY.contact_cost,
        QualityGates(),
    )


@query(
    "final_results",
    f"""{_FINAL}
SELECT threshold AS final_threshold, CAST(0.7 AS DOUBLE) AS selection_min_recall,
  CAST(0.45 AS DOUBLE) AS selection_min_precision, tn + fp + fn + tp AS test_set_size,
  round(roc_auc, 6) AS roc_auc, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1_score, tp AS true_positives, fp AS false_positives, tn AS true_negatives,
  fn AS false_negatives, round(CAST(tp * {S.VALUE} - (tp + fp) * {S.COST} AS DOUBLE), 6) AS net_value,
  round(CAST(tp * {S.VALUE} - (tp + fp) * {S.COST} AS DOUBLE) / greatest(tp + fp, 1), 6) AS net_value_per_flagged,
  CASE WHEN fits THEN 'Validation selection: Best Net_Value (constraints: Recall >= 0.70 & Precision >= 0.45)'
    ELSE 'Validation fallback: Best F1 (no threshold met constraints: Recall >= 0.70 & Precision >= 0.45)' END AS selection_reason,
  {_GATES} AS failed_gates FROM result""",
)
def final_results(spark, sf_dir):
    return rounded(
        result_row(spark, sf_dir).withColumn("failed_gates", F.array_join("failed_gates", ","))
    )


@query(
    "quality_gates",
    f"""{_FINAL}
SELECT round(roc_auc, 6) AS roc_auc, round(recall, 6) AS recall, round(precision, 6) AS precision,
  {_GATES} AS failed_gates, {_GATES} = '' AS passed FROM result""",
)
def quality_gates(spark, sf_dir):
    return rounded(
        result_row(spark, sf_dir).select(
            "roc_auc",
            "recall",
            "precision",
            F.array_join("failed_gates", ",").alias("failed_gates"),
            (F.size("failed_gates") == 0).alias("passed"),
        )
    )


# Target, minimum and earlier value of each metric, fixed.
METRIC_TARGETS = {
    "recall": (0.80, 0.70, 0.8610),
    "roc_auc": (0.85, 0.80, 0.8282),
    "precision": (0.50, 0.40, 0.4626),
}


@query(
    "target_status",
    _FINAL
    + " UNION ALL ".join(
        f""" SELECT '{m}' AS metric, round({m}, 6) AS achieved, CAST({goal} AS DOUBLE) AS target,
  CAST({least} AS DOUBLE) AS minimum,
  CASE WHEN {m} >= {goal} THEN 'target' WHEN {m} >= {least} THEN 'minimum' ELSE 'below' END AS status,
  round(({m} - {earlier}) * 100, 6) AS delta_points FROM result"""
        for m, (goal, least, earlier) in METRIC_TARGETS.items()
    ),
)
def target_status(spark, sf_dir):
    return rounded(E.metric_targets(result_row(spark, sf_dir), METRIC_TARGETS))
