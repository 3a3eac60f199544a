"""Base table to a fitted model and scored test rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from encore.operators import model
from encore.operators.features import ModelColumns
from encore.operators.ordering import TimeSplit, time_split
from encore.sources.staging import stage


@dataclass(frozen=True)
class ModelRun:
    split: TimeSplit
    model: PipelineModel
    scored: DataFrame


def train_and_score(
    base_table: DataFrame,
    columns: ModelColumns = ModelColumns(),
    fraction: float = 0.8,
) -> ModelRun:
    """Split by time, fit on the early rows, score the late ones once.

    The scored rows are staged: every metric reads them.
    """
    split = time_split(base_table, columns.ts, columns.key, fraction)
    fitted = model.fit(split.train, columns)
    scored = stage(model.score(fitted, split.test, columns), "scored")
    return ModelRun(split, fitted, scored)
