"""Exact binary-classification metrics as distributed queries.

Inputs have ``y_true`` and ``y_pred`` in 0/1 and ``y_prob``.  Everything that
depends on the threshold comes from one frame: positives and negatives per
distinct score with their running totals from the highest score down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.flags import ratio, ratio_or_zero
from encore.operators.ordering import mark_top_fraction, running_totals, with_next
from encore.sources.staging import stage


def _cell(actual: int, predicted: int) -> Column:
    return F.count_if((F.col("y_true") == actual) & (F.col("y_pred") == predicted))


def _cells(scored: DataFrame) -> DataFrame:
    """The four cells in one row."""
    return scored.agg(
        _cell(0, 0).alias("tn"), _cell(0, 1).alias("fp"), _cell(1, 0).alias("fn"), _cell(1, 1).alias("tp")
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Rows per (actual, predicted) pair, zeros included."""
    stacked = F.expr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, cnt)")
    return _cells(scored).select(stacked)


def _f1(precision: Column, recall: Column) -> Column:
    return ratio_or_zero(2 * precision * recall, precision + recall)


def threshold_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1, in one row."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision, recall = ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn)
    return _cells(scored).select(
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
    )


def classification_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with both averages.

    The accuracy row carries its value in ``f1``.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    support = {"0": tn + fp, "1": tp + fn}
    precision = {"0": ratio_or_zero(tn, tn + fn), "1": ratio_or_zero(tp, tp + fp)}
    recall = {"0": ratio_or_zero(tn, tn + fp), "1": ratio_or_zero(tp, tp + fn)}
    f1 = {c: _f1(precision[c], recall[c]) for c in support}
    total = tn + fp + fn + tp

    def line(name: str, p: Column, r: Column, f: Column, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            n.alias("support"),
        )

    def macro(by_class: dict[str, Column]) -> Column:
        return (by_class["0"] + by_class["1"]) / F.lit(2.0)

    def weighted(by_class: dict[str, Column]) -> Column:
        return ratio_or_zero(by_class["0"] * support["0"] + by_class["1"] * support["1"], total)

    unknown = F.lit(None).cast("double")
    lines = F.array(
        *[line(c, precision[c], recall[c], f1[c], support[c]) for c in ("0", "1")],
        line("accuracy", unknown, unknown, ratio(tn + tp, total), total),
        line("macro avg", macro(precision), macro(recall), macro(f1), total),
        line("weighted avg", weighted(precision), weighted(recall), weighted(f1), total),
    )
    return _cells(scored).select(F.inline(lines))


def score_curve(scored: DataFrame) -> DataFrame:
    """Per distinct score: positives, negatives, tp / fp at that threshold, and the class totals.

    The scored rows are read once; their counts per distinct score are staged.
    """
    known = scored.where(F.col("y_prob").isNotNull() & ~F.isnan("y_prob"))
    counts = known.groupBy("y_prob").agg(
        F.count_if(F.col("y_true") == 1).alias("pos"), F.count_if(F.col("y_true") == 0).alias("neg")
    )
    curve = running_totals(stage(counts, "score_counts"), "y_prob", ["pos", "neg"], descending=True)
    return curve.withColumnsRenamed({"pos_upto": "tp", "neg_upto": "fp"})


def without_collinear(curve: DataFrame) -> DataFrame:
    """The curve without points on the straight line between their neighbours.

    A step of the curve is a score's negatives to the right and positives up; between
    two equal steps the point says nothing.  The first and the last point stay.  The
    curve should be staged.
    """
    following = with_next(curve, "y_prob", ["pos", "neg"], descending=True)
    highest = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    turns = (F.col("pos") != F.col("pos_next")) | (F.col("neg") != F.col("neg_next"))
    last = F.col("pos_next").isNull()
    return following.where(highest | last | turns).select(*curve.columns)


def roc_curve(curve: DataFrame, drop_collinear: bool = False) -> DataFrame:
    """False and true positive rate at every threshold, from the (0, 0) corner.

    The rate of a class without rows is null, also in the corner; no rows, no points.
    With ``drop_collinear`` only the points that a drawn line needs, as
    ``without_collinear`` finds them on a staged curve.
    """
    if drop_collinear:
        curve = without_collinear(curve)

    def point(threshold: Column, fp: Column, tp: Column) -> Column:
        return F.struct(
            threshold.cast("double").alias("threshold"),
            fp.cast("bigint").alias("fp"),
            tp.cast("bigint").alias("tp"),
            ratio(fp, F.col("neg_all")).alias("fpr"),
            ratio(tp, F.col("pos_all")).alias("tpr"),
        )

    here = point(F.col("y_prob"), F.col("fp"), F.col("tp"))
    corner = point(F.lit(None), F.lit(0), F.lit(0))
    # the corner goes before the highest score
    highest = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    return curve.select(F.inline(F.when(highest, F.array(corner, here)).otherwise(F.array(here))))


def pr_curve(curve: DataFrame) -> DataFrame:
    """Precision and recall at every threshold, to the (recall 0, precision 1) corner.

    Without any positive row recall is 1 everywhere but in the corner.
    """
    recall = F.coalesce(ratio(F.col("tp"), F.col("pos_all")), F.lit(1.0))
    points = curve.select(
        F.col("y_prob").alias("threshold"),
        ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        recall.alias("recall"),
    )
    corner = curve.sparkSession.range(1).selectExpr(
        "cast(null AS double) AS threshold", "1.0D AS precision", "0.0D AS recall"
    )
    return points.union(corner)


def ranking_metrics(curve: DataFrame) -> DataFrame:
    """ROC AUC with ties counted half, and step-wise average precision, in one row.

    AUC is null unless both classes occur; average precision is 0 without a
    positive.
    """
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    pairs = F.sum(neg * (tp - pos / 2.0))
    steps = F.sum(pos * tp / (tp + fp))
    return curve.agg(
        F.try_divide(pairs, F.sum(pos) * F.sum(neg)).alias("roc_auc"),
        F.coalesce(F.try_divide(steps, F.sum(pos)), F.lit(0.0)).alias("pr_auc"),
    )


def classification_metrics(scored: DataFrame, curve: DataFrame | None = None) -> DataFrame:
    """The six headline metrics as (metric, value)."""
    at_threshold = threshold_metrics(scored)
    by_rank = ranking_metrics(score_curve(scored) if curve is None else curve)
    return at_threshold.unpivot([], at_threshold.columns, "metric", "value").union(
        by_rank.unpivot([], by_rank.columns, "metric", "value")
    )


def top_fraction_lift(scored: DataFrame, tie: str, fraction: float = 0.10) -> DataFrame:
    """Positive rate of the highest-scored rows against the overall rate, in one row."""
    marked = mark_top_fraction(scored.select("y_true", "y_prob", tie), "y_prob", tie, fraction, "_top")
    in_top = F.col("_top")
    rates = marked.agg(
        F.avg("y_true").alias("overall_rate"),
        F.avg(F.when(in_top, F.col("y_true"))).alias("top_rate"),
        F.count_if(in_top).alias("top_rows"),
        F.count_if(in_top & (F.col("y_true") == 1)).alias("top_positives"),
    )
    return rates.withColumn("lift", F.try_divide("top_rate", "overall_rate"))
