"""Scored rows to the full set of evaluation tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from encore.operators import evaluate
from encore.sources.staging import stage


@dataclass(frozen=True)
class Evaluation:
    metrics: DataFrame
    report: DataFrame
    confusion: DataFrame
    roc: DataFrame
    precision_recall: DataFrame
    lift: DataFrame


def evaluation(scored: DataFrame, tie: str = "customer_unique_id", top: float = 0.10) -> Evaluation:
    """The curve has one row per distinct score and feeds three tables: staged."""
    curve = stage(evaluate.score_curve(scored), "curve")
    return Evaluation(
        metrics=evaluate.classification_metrics(scored, curve),
        report=evaluate.classification_report(scored),
        confusion=evaluate.confusion_matrix(scored),
        roc=evaluate.roc_curve(curve),
        precision_recall=evaluate.pr_curve(curve),
        lift=evaluate.top_fraction_lift(scored, tie, top),
    )
