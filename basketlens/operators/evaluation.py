"""Classifier evaluation: ranking, threshold and calibration metrics per group.

All metrics are computed from one row per (group, distinct score), so ties need
no special case and a score shared by many rows is a single row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketlens.functions.bins import bin_of, unit_edges
from basketlens.functions.probability import log_loss

SCORE_BANDS = 256
THRESHOLD_METRICS = (
    "accuracy", "precision", "recall", "f1", "true_negative", "false_positive",
    "false_negative", "true_positive", "positive_prediction_rate",
    "mean_predicted_probability", "actual_positive_rate", "brier_score", "log_loss")


def long_scores(df: DataFrame, scores: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """Unpivot score columns to ``(…, score_kind, score)``; keys are kinds, values columns."""
    named = df.select(*keep, *[F.col(column).cast("double").alias(kind)
                               for kind, column in scores.items()])
    return named.unpivot(list(keep), list(scores), "score_kind", "score")


def score_counts(scored: DataFrame, groups: Sequence[str], score: str = "score",
                 label: str = "target_redeemed") -> DataFrame:
    """Rows and positives per group and distinct score: all that any metric needs.

    Every metric below reads this one aggregate, so evaluating costs a single
    shuffle of the scores, and plans that combine metrics reuse it.
    """
    return scored.groupBy(*groups, F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"))


def _band(score: Column, coarse: Column, cuts: Column) -> Column:
    """How many cut points do not exceed the score, by a coarse and then a fine step."""
    width = math.isqrt(SCORE_BANDS)
    passed = F.greatest(F.size(F.filter(coarse, lambda cut: cut <= score)), F.lit(1))
    fine = F.filter(F.slice(cuts, (passed - 1) * width + 1, width), lambda cut: cut <= score)
    return (passed - 1) * width + F.size(fine)


def _ranking(counts: DataFrame, groups: list[str]) -> DataFrame:
    """Cumulative counts in two levels: within narrow bands of scores and over bands.

    Bands hold about equally many distinct scores, wherever the scores lie: their cut points
    come from a sketch, which decides on the work of a task and not on any sum.  No task
    ever orders all scores of a group.
    """
    shares = [i / SCORE_BANDS for i in range(1, SCORE_BANDS)]
    cuts = counts.groupBy(*groups).agg(
        F.percentile_approx("score", shares, 20 * SCORE_BANDS).alias("cuts"))
    width = F.lit(math.isqrt(SCORE_BANDS))
    cuts = cuts.withColumn("coarse", F.filter("cuts", lambda cut, i: i % width == 0))
    same_group = [F.col(f"c.{g}").eqNullSafe(F.col(f"k.{g}")) for g in groups]
    distinct = counts.alias("c").join(cuts.alias("k"), same_group).select(
        "c.*", _band(F.col("score"), F.col("coarse"), F.col("cuts")).alias("band"))
    whole = Window.partitionBy(*groups)
    higher = (whole.orderBy(F.desc("band"))
              .rowsBetween(Window.unboundedPreceding, -1))
    bands = distinct.groupBy(*groups, "band").agg(
        F.sum("n").alias("band_n"), F.sum("pos").alias("band_pos")).select(
        *groups, "band",
        F.coalesce(F.sum("band_n").over(higher), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("band_pos").over(higher), F.lit(0)).alias("pos_above"),
        F.sum("band_n").over(whole).alias("total"),
        F.sum("band_pos").over(whole).alias("positives"))
    running = (Window.partitionBy(*groups, "band").orderBy(F.desc("score"))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (distinct
              .withColumns({"n_seen": F.sum("n").over(running),
                            "pos_seen": F.sum("pos").over(running)})
              .join(bands, [*groups, "band"])
              .withColumns({"n_seen": F.col("n_seen") + F.col("n_above"),
                            "pos_seen": F.col("pos_seen") + F.col("pos_above")}))
    negatives = F.col("total") - F.col("positives")
    neg = F.col("n") - F.col("pos")
    neg_below = negatives - (F.col("n_seen") - F.col("pos_seen"))
    wins = F.sum(F.col("pos") * (neg_below + neg * 0.5))
    precision_area = F.sum(F.col("pos") * F.col("pos_seen") / F.col("n_seen"))
    return ranked.groupBy(*groups, "total", "positives").agg(
        wins.alias("wins"), precision_area.alias("area")).select(
        *groups,
        F.when((F.col("positives") > 0) & (negatives > 0),
               F.col("wins") / (F.col("positives") * negatives))
        .otherwise(F.lit(float("nan"))).alias("roc_auc"),
        F.when(F.col("positives") > 0, F.col("area") / F.col("positives"))
        .otherwise(F.lit(float("nan"))).alias("pr_auc_average_precision"))


def ranking_metrics(scored: DataFrame, groups: Sequence[str], score: str = "score",
                    label: str = "target_redeemed") -> DataFrame:
    """ROC-AUC with averaged ties and average precision at distinct thresholds."""
    return _ranking(score_counts(scored, groups, score, label), list(groups))


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(0.0)


def mean_log_loss(eps: float) -> Column:
    """Log loss as an aggregate over score counts."""
    p, pos, n = F.col("score"), F.col("pos"), F.col("n")
    return F.sum(pos * log_loss(p, F.lit(1), eps)
                 + (n - pos) * log_loss(p, F.lit(0), eps)) / F.sum("n")


def _thresholds(counts: DataFrame, groups: list[str], threshold: float,
                eps: float) -> DataFrame:
    p, n, pos = F.col("score"), F.col("n"), F.col("pos")
    called = p >= threshold

    def total(condition: Column, amount: Column) -> Column:
        return F.sum(F.when(condition, amount).otherwise(0))

    squared = pos * (p - 1) * (p - 1) + (n - pos) * p * p
    sums = counts.groupBy(*groups).agg(
        F.sum("n").alias("observations"),
        total(~called, n - pos).alias("true_negative"),
        total(called, n - pos).alias("false_positive"),
        total(~called, pos).alias("false_negative"),
        total(called, pos).alias("true_positive"),
        (F.sum(p * n) / F.sum("n")).alias("mean_predicted_probability"),
        (F.sum("pos") / F.sum("n")).alias("actual_positive_rate"),
        (F.sum(squared) / F.sum("n")).alias("brier_score"),
        mean_log_loss(eps).alias("log_loss"))
    tp, rows = F.col("true_positive"), F.col("observations")
    predicted = tp + F.col("false_positive")
    precision, recall = _ratio(tp, predicted), _ratio(tp, tp + F.col("false_negative"))
    return sums.withColumns({
        "accuracy": (tp + F.col("true_negative")) / rows,
        "precision": precision,
        "recall": recall,
        "f1": _ratio(2 * precision * recall, precision + recall),
        "positive_prediction_rate": predicted / rows,
        "threshold": F.lit(float(threshold)),
    }).select(*groups, "observations", "threshold", *THRESHOLD_METRICS)


def threshold_metrics(scored: DataFrame, groups: Sequence[str], threshold: float = 0.5,
                      score: str = "score", label: str = "target_redeemed",
                      eps: float = 1e-12) -> DataFrame:
    """Confusion counts, rates and probability errors in one aggregation."""
    return _thresholds(score_counts(scored, groups, score, label), list(groups), threshold, eps)


def _reliability(counts: DataFrame, groups: list[str], edges: list[float]) -> DataFrame:
    rows = F.sum("n")
    filled = counts.groupBy(*groups, bin_of(F.col("score"), edges).alias("bin")).agg(
        rows.alias("count"),
        (F.sum(F.col("score") * F.col("n")) / rows).alias("mean_predicted_probability"),
        (F.sum("pos") / rows).alias("observed_redemption_rate"))
    last = len(edges) - 2
    frame = filled.select(*groups).distinct().select(
        *groups, F.explode(F.sequence(F.lit(0), F.lit(last))).alias("bin"))
    limits = F.array(*[F.lit(float(edge)) for edge in edges])
    return frame.join(filled, [*groups, "bin"], "left").select(
        *groups, "bin",
        F.get(limits, F.col("bin")).alias("lower_inclusive"),
        F.get(limits, F.col("bin") + 1).alias("upper_bound"),
        (F.col("bin") == last).alias("upper_inclusive"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"),
        "mean_predicted_probability", "observed_redemption_rate")


def reliability_bins(scored: DataFrame, groups: Sequence[str], bins: int = 10,
                     edges: Sequence[float] | None = None, score: str = "score",
                     label: str = "target_redeemed") -> DataFrame:
    """Fixed-width reliability bins, empty ones included with null means."""
    return _reliability(score_counts(scored, groups, score, label), list(groups),
                        list(edges) if edges is not None else unit_edges(bins))


def calibration_error(bins: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Expected calibration error from reliability bins."""
    gap = F.abs(F.col("mean_predicted_probability") - F.col("observed_redemption_rate"))
    return bins.groupBy(*groups).agg(
        (F.sum(F.col("count") * gap) / F.sum("count")).alias("expected_calibration_error"))


def full_report(scored: DataFrame, groups: Sequence[str], threshold: float = 0.5,
                bins: int = 10, score: str = "score",
                label: str = "target_redeemed") -> DataFrame:
    """All metrics, one row per group."""
    groups = list(groups)
    counts = score_counts(scored, groups, score, label)
    error = calibration_error(_reliability(counts, groups, unit_edges(bins)), groups)
    return (_thresholds(counts, groups, threshold, 1e-12)
            .join(_ranking(counts, groups), groups).join(error, groups))


def loss_and_precision(scored: DataFrame, groups: Sequence[str], eps: float) -> DataFrame:
    """Log loss and average precision per group."""
    return counted_loss_and_precision(score_counts(scored, groups), groups, eps)


def counted_loss_and_precision(counts: DataFrame, groups: Sequence[str], eps: float) -> DataFrame:
    """The same from rows (n) and positives (pos) per group and distinct score."""
    groups = list(groups)
    precision = _ranking(counts, groups).select(
        *groups, F.col("pr_auc_average_precision").alias("precision"))
    return counts.groupBy(*groups).agg(mean_log_loss(eps).alias("loss")).join(precision, groups)


def ranking_change(report: DataFrame, groups: Sequence[str]) -> DataFrame:
    """How calibration moved the ranking metrics: calibrated minus raw, per group."""
    def of(kind: str, metric: str) -> Column:
        return F.max(F.when(F.col("score_kind") == kind, F.col(metric)))

    return report.groupBy(*groups).agg(*[
        (of("calibrated", metric) - of("raw", metric)).alias(f"{metric}_delta")
        for metric in ("roc_auc", "pr_auc_average_precision")])


def baseline_scores(dataset: DataFrame) -> DataFrame:
    """Majority class, constant training rate and prior-redemption indicator as scores."""
    rate = dataset.where(F.col("data_split") == "train").agg(F.avg("target_redeemed")).scalar()
    return dataset.withColumns({
        "constant_training_rate": rate,
        "majority_class": (rate >= 0.5).cast("double"),
        "prior_coupon_redemption_indicator":
            (F.col("prior_coupon_redemption_count") > 0).cast("double")})


BASELINES = {name: name for name in (
    "majority_class", "constant_training_rate", "prior_coupon_redemption_indicator")}


def comparison_table(report: DataFrame, label_columns: Sequence[str],
                     metrics: Sequence[str]) -> DataFrame:
    """Long metric rows pivoted to one column per metric; a missing metric stays null."""
    long = report.unpivot(list(label_columns), list(metrics), "metric", "value")
    return long.groupBy(*label_columns).pivot("metric", list(metrics)).agg(F.first("value"))
