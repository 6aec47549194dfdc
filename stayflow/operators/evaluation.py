"""Threshold sweep, threshold choice, classification metrics, ranking curves."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions import columns as C
from stayflow.operators.ordering import running_totals
from stayflow.operators.sizing import checkpointed
from stayflow.params import BusinessParams, QualityGates


def precision(tp: Column, fp: Column) -> Column:
    return C.safe_ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return C.safe_ratio(tp, tp + fn)


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return C.safe_ratio(2 * tp, 2 * tp + fp + fn)


# ---- counts at one threshold ----------------------------------------------


def reaches(score: str, threshold: float) -> Column:
    """Whether the score is at least the threshold; a missing or NaN score is not."""
    return F.coalesce((F.col(score) >= F.lit(threshold)) & ~F.isnan(score), F.lit(False))


def confusion(scored: DataFrame, threshold: float, label: str = "y", score: str = "p") -> DataFrame:
    """One row (tn, fp, fn, tp), also when a class is absent. A row without a score is not flagged."""
    flagged, positive = reaches(score, threshold), F.col(label) == 1
    return scored.agg(
        F.count_if(~positive & ~flagged).alias("tn"),
        F.count_if(~positive & flagged).alias("fp"),
        F.count_if(positive & ~flagged).alias("fn"),
        F.count_if(positive & flagged).alias("tp"),
    )


def confusion_shares(counts: DataFrame) -> DataFrame:
    """(actual, predicted, count, pct_of_total, share_of_actual)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    cells = F.array(
        *[
            F.struct(
                F.lit(actual).alias("actual"),
                F.lit(predicted).alias("predicted"),
                n.alias("count"),
                (C.safe_ratio(n, total) * 100).alias("pct_of_total"),
                C.safe_ratio(n, row).alias("share_of_actual"),
            )
            for actual, predicted, n, row in (
                (0, 0, tn, tn + fp),
                (0, 1, fp, tn + fp),
                (1, 0, fn, fn + tp),
                (1, 1, tp, fn + tp),
            )
        ]
    )
    return counts.select(F.inline(cells))


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Add precision, recall and F1 to confusion counts; 0 on an empty denominator."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {"precision": precision(tp, fp), "recall": recall(tp, fn), "f1": f1(tp, fp, fn)}
    )


def classification_report(counts: DataFrame) -> DataFrame:
    """(class, precision, recall, f1, support) for 0, 1, accuracy, macro and weighted mean."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    sides = {
        "0": (precision(tn, fn), recall(tn, fp), f1(tn, fn, fp), tn + fp),
        "1": (precision(tp, fp), recall(tp, fn), f1(tp, fp, fn), tp + fn),
    }
    total = tn + fp + fn + tp
    (p0, r0, f0, s0), (p1, r1, f1_, s1) = sides["0"], sides["1"]
    accuracy = C.safe_ratio(tn + tp, total)

    def weighted(a: Column, b: Column) -> Column:
        return C.safe_ratio(a * s0 + b * s1, total)

    lines = {
        **sides,
        "accuracy": (accuracy, accuracy, accuracy, total),
        "macro avg": ((p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1_) / 2, total),
        "weighted avg": (weighted(p0, p1), weighted(r0, r1), weighted(f0, f1_), total),
    }
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("class"),
                        a.alias("precision"),
                        b.alias("recall"),
                        c.alias("f1"),
                        d.alias("support"),
                    )
                    for name, (a, b, c, d) in lines.items()
                ]
            )
        )
    )


def campaign_kpis(counts: DataFrame) -> DataFrame:
    """Captured, missed and false-alarm shares of a contact campaign, in %."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.select(
        (tn + fp + fn + tp).alias("customers"),
        (tp + fn).alias("churners"),
        tp.alias("captured"),
        (C.safe_ratio(tp, tp + fn) * 100).alias("captured_pct"),
        fn.alias("missed"),
        (C.safe_ratio(fn, tp + fn) * 100).alias("missed_pct"),
        fp.alias("false_alarms"),
        (C.safe_ratio(fp, tn + fp) * 100).alias("false_alarm_pct"),
        (tp + fp).alias("flagged"),
        (C.safe_ratio(tp, tp + fp) * 100).alias("campaign_precision_pct"),
    )


def contact_value(counts: DataFrame, business: BusinessParams = BusinessParams()) -> DataFrame:
    """Correct contacts, the value of one (lifetime value x success rate - cost) and of all."""
    one = F.lit(business.correct_contact_value)
    return counts.select(
        F.col("tp").alias("correct_contacts"),
        one.alias("value_per_correct_contact"),
        (F.col("tp") * one).alias("total_value"),
    )


# ---- threshold sweep ------------------------------------------------------


def threshold_sweep(
    scored: DataFrame,
    thresholds: Sequence[float],
    retained_value: float | None = None,
    contact_cost: float | None = None,
    label: str = "y",
    score: str = "p",
) -> DataFrame:
    """Metrics and money value at every threshold, from one scan.

    A row's bucket is the number of thresholds its score reaches; counts per bucket
    (at most thresholds + 1 rows) hold all that the whole sweep needs.
    """
    grid = sorted(thresholds)
    reached = [reaches(score, t).cast("int") for t in grid]
    bucket = reduce(lambda a, b: a + b, reached)
    counts = scored.groupBy(bucket.alias("bucket")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    gathered = counts.agg(F.collect_list(F.struct("bucket", "pos", "neg")).alias("counts"))

    def total(name: str, wanted) -> Column:
        parts = F.filter("counts", wanted)
        return F.aggregate(parts, F.lit(0).cast("long"), lambda acc, x: acc + x[name])

    rows = gathered.select(
        "counts", F.posexplode(F.array(*[F.lit(t) for t in grid])).alias("i", "threshold")
    )
    above = lambda x: x["bucket"] > F.col("i")
    below = lambda x: x["bucket"] <= F.col("i")
    rows = rows.select(
        "threshold",
        total("pos", above).alias("true_positives"),
        total("neg", above).alias("false_positives"),
        total("pos", below).alias("false_negatives"),
        total("neg", below).alias("true_negatives"),
    )
    return sweep_metrics(rows, retained_value, contact_cost)


def sweep_metrics(
    counts: DataFrame, retained_value: float | None = None, contact_cost: float | None = None
) -> DataFrame:
    """Ratios and (with both money inputs) net value of rows of the four counts."""
    tp, fp = F.col("true_positives"), F.col("false_positives")
    fn, tn = F.col("false_negatives"), F.col("true_negatives")
    out = counts.select(
        "threshold",
        precision(tp, fp).alias("precision"),
        recall(tp, fn).alias("recall"),
        f1(tp, fp, fn).alias("f1_score"),
        tp,
        fp,
        fn,
        tn,
        (C.safe_ratio(tp, tp + fn) * 100).alias("captured_pct"),
        (C.safe_ratio(fp, tn + fp) * 100).alias("false_positive_pct"),
        (tp + fp).alias("total_flagged"),
    )
    if retained_value is None or contact_cost is None:
        return out
    flagged = F.col("total_flagged")
    net = F.col("true_positives") * F.lit(float(retained_value)) - flagged * F.lit(float(contact_cost))
    return out.withColumn("net_value", net).withColumn(
        "net_per_flagged", C.safe_ratio(F.col("net_value"), flagged)
    )


def select_threshold(
    sweep: DataFrame,
    min_recall: float,
    optimize_for: str = "net_value",
    min_precision: float = 0.0,
) -> DataFrame:
    """The chosen sweep row plus ``reason``.

    Among the rows that meet the bounds the best by the goal; when none does, the best
    F1 of all rows. The first row wins a tie.
    """
    bounds = []
    fits = F.lit(True)
    if min_recall > 0:
        bounds.append(f"Recall >= {min_recall:.2f}")
        fits = fits & (F.col("recall") >= min_recall)
    if min_precision > 0:
        bounds.append(f"Precision >= {min_precision:.2f}")
        fits = fits & (F.col("precision") >= min_precision)
    text = " & ".join(bounds) or "no constraints"
    goal, title = "f1_score", "F1"
    if optimize_for == "net_value" and "net_value" in sweep.columns:
        goal, title = "net_value", "Net_Value"
    elif optimize_for == "precision":
        goal, title = "precision", "Precision"

    def first_best(column: str, allowed: Column) -> Column:
        rank = F.when(allowed, F.struct(-F.col(column), F.col("threshold")))
        return F.min_by(F.struct(*sweep.columns), rank)

    best = sweep.agg(
        first_best(goal, fits).alias("fitting"), first_best("f1_score", F.lit(True)).alias("any")
    )
    return best.select(
        F.coalesce("fitting", "any").alias("row"),
        F.when(
            F.col("fitting").isNull(),
            f"Validation fallback: Best F1 (no threshold met constraints: {text})",
        )
        .otherwise(f"Validation selection: Best {title} (constraints: {text})")
        .alias("reason"),
    ).select("row.*", "reason")


def nearest_threshold(sweep: DataFrame, targets: Sequence[float]) -> DataFrame:
    """For each target the sweep row with the closest threshold, the first on a tie."""
    picks = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("target"),
                F.min_by(
                    F.struct(*sweep.columns),
                    F.struct(F.abs(F.col("threshold") - F.lit(float(t))), F.col("threshold")),
                ).alias("row"),
            )
            for t in targets
        ]
    )
    return sweep.agg(picks.alias("picks")).select(F.inline("picks")).select("target", "row.*")


def top_thresholds(
    sweep: DataFrame, k: int = 5, min_recall: float = 0.0, min_precision: float = 0.0
) -> DataFrame:
    """The k thresholds with the highest net value among those that meet the bounds."""
    fits = (F.col("recall") >= min_recall) & (F.col("precision") >= min_precision)
    return sweep.filter(fits).orderBy(F.desc("net_value"), "threshold").limit(k)


def failed_gates(gates: QualityGates, roc_auc: Column, rec: Column, prec: Column) -> Column:
    """Names of the gates strictly missed, in fixed order."""
    return F.array_compact(
        F.array(
            F.when(roc_auc < gates.min_roc_auc, "roc_auc"),
            F.when(rec < gates.min_recall, "recall"),
            F.when(prec < gates.min_precision, "precision"),
        )
    )


# ---- ranking curves -------------------------------------------------------


def score_groups(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """(score, pos, neg) per distinct score: ties are merged before anything is sorted.

    Rows without a score, which no threshold flags, stand below all others, at -infinity.
    """
    lowest = F.lit(float("-inf"))
    return (
        scored.groupBy(F.coalesce(F.nanvl(F.col(score).cast("double"), lowest), lowest).alias("score"))
        .agg(
            F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
        )
    )


def roc_auc(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """One row (pos, neg, roc_auc): the exact rank statistic, ties counted half."""
    return _areas(score_groups(scored, label, score))


def roc_auc_by(groups: DataFrame, by: str, threshold: float | None = None) -> DataFrame:
    """(by, pos, neg, roc_auc) of score histograms (by, score, pos, neg); ``by`` numbers them from 0.

    All groups go through one running total. Equal scores of a group are merged first. With a threshold the
    counts (tn, fp, fn, tp) at it follow.
    """
    merged = groups.groupBy(by, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return _areas(merged, by, threshold)


def _areas(groups: DataFrame, by: str | None = None, threshold: float | None = None) -> DataFrame:
    ranked = running_totals(groups, "score", {"neg_seen": F.col("neg")}, by=by)
    below = F.col("neg_seen") - F.col("neg")
    keys = [] if by is None else [by]
    counts = {}
    if threshold is not None:
        flagged = reaches("score", threshold)
        sides = {"tn": ("neg", ~flagged), "fp": ("neg", flagged), "fn": ("pos", ~flagged), "tp": ("pos", flagged)}
        counts = {n: F.sum(F.when(side, F.col(c)).otherwise(0)) for n, (c, side) in sides.items()}
    return ranked.groupBy(*keys).agg(
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum(F.col("pos") * (below.cast("double") + F.col("neg") / 2)).alias("wins"),
        *[total.alias(n) for n, total in counts.items()],
    ).select(
        *keys,
        "pos",
        "neg",
        *counts,
        F.try_divide("wins", F.col("pos").cast("double") * F.col("neg")).alias("roc_auc"),
    )


def _curve(scored: DataFrame, label: str, score: str) -> tuple[DataFrame, DataFrame]:
    """(score, tp, fp, all_pos, all_neg) at every distinct score, and the totals alone.

    The input is read once, into a stored histogram of its scores.
    """
    groups = checkpointed(score_groups(scored, label, score))
    seen = running_totals(
        groups, "score", {"tp": F.col("pos"), "fp": F.col("neg")}, descending=True, stored=True
    )
    totals = groups.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg")).filter("all_pos + all_neg > 0")
    seen = seen.filter(F.col("score") > F.lit(float("-inf")))
    # One row.
    return seen.crossJoin(F.broadcast(totals)), totals


def roc_points(scored: DataFrame, label: str = "y", score: str = "p", ends: bool = False) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score; with ``ends`` also (0, 0), where nobody is
    flagged, which has no threshold."""
    curve, totals = _curve(scored, label, score)
    points = curve.select(
        F.col("score").alias("threshold"),
        C.safe_ratio(F.col("fp"), F.col("all_neg")).alias("fpr"),
        C.safe_ratio(F.col("tp"), F.col("all_pos")).alias("tpr"),
    )
    if not ends:
        return points
    none = F.lit(None).cast("double").alias("threshold")
    return points.unionByName(totals.select(none, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")))


def pr_points(scored: DataFrame, label: str = "y", score: str = "p", ends: bool = False) -> DataFrame:
    """(threshold, precision, recall, baseline) at every distinct score; with ``ends`` also the end of
    the curve at recall 0 and precision 1, which has no threshold."""
    curve, totals = _curve(scored, label, score)
    baseline = C.safe_ratio(F.col("all_pos"), F.col("all_pos") + F.col("all_neg")).alias("baseline")
    points = curve.select(
        F.col("score").alias("threshold"),
        precision(F.col("tp"), F.col("fp")).alias("precision"),
        C.safe_ratio(F.col("tp"), F.col("all_pos")).alias("recall"),
        baseline,
    )
    if not ends:
        return points
    none = F.lit(None).cast("double").alias("threshold")
    end = totals.select(none, F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), baseline)
    return points.unionByName(end)


# ---- the result row -------------------------------------------------------


def final_results(
    val: DataFrame,
    test: DataFrame,
    thresholds: Sequence[float],
    min_recall: float,
    min_precision: float,
    retained_value: float,
    contact_cost: float,
    gates: QualityGates = QualityGates(),
    optimize_for: str = "net_value",
    label: str = "y",
    score: str = "p",
) -> DataFrame:
    """Choose the threshold on validation, evaluate once on test, apply the gates."""
    sweep = threshold_sweep(val, thresholds, retained_value, contact_cost, label, score)
    chosen = select_threshold(sweep, min_recall, optimize_for, min_precision).first()
    threshold = chosen["threshold"]
    counts = classification_metrics(confusion(test, threshold, label, score))
    area = roc_auc(test, label, score).select("roc_auc")
    tp, fp = F.col("tp"), F.col("fp")
    flagged = tp + fp
    net = tp * F.lit(float(retained_value)) - flagged * F.lit(float(contact_cost))
    one = counts.withColumn("roc_auc", area.scalar())
    return one.select(
        F.lit(threshold).alias("final_threshold"),
        F.lit(float(min_recall)).alias("selection_min_recall"),
        F.lit(float(min_precision)).alias("selection_min_precision"),
        (F.col("tn") + fp + F.col("fn") + tp).alias("test_set_size"),
        "roc_auc",
        "precision",
        "recall",
        F.col("f1").alias("f1_score"),
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        F.col("tn").alias("true_negatives"),
        F.col("fn").alias("false_negatives"),
        net.alias("net_value"),
        (net / F.greatest(flagged, F.lit(1))).alias("net_value_per_flagged"),
        F.lit(chosen["reason"]).alias("selection_reason"),
        failed_gates(gates, F.col("roc_auc"), F.col("recall"), F.col("precision")).alias(
            "failed_gates"
        ),
    )


def metric_targets(metrics: DataFrame, targets: dict[str, tuple[float, float, float]]) -> DataFrame:
    """(metric, achieved, target, minimum, status, delta) of one metrics row.

    ``targets`` maps a metric column to (target, minimum, earlier value).
    """
    lines = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(m).alias("achieved"),
                F.lit(goal).alias("target"),
                F.lit(least).alias("minimum"),
                C.target_status(F.col(m), F.lit(goal), F.lit(least)).alias("status"),
                ((F.col(m) - earlier) * 100).alias("delta_points"),
            )
            for m, (goal, least, earlier) in targets.items()
        ]
    )
    return metrics.select(F.inline(lines))
