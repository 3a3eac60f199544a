"""A fitted regression as one native expression: no vectors, no pipeline stages.

Imputing, scaling, one-hot encoding and the coefficients fold into a sum over plain
columns, so scoring is a projection that whole-stage code covers and that reads the
model's columns only.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.operators.features import MISSING, ModelColumns

# categories that are told apart inside the expression; more are looked up by a join
MOST_BRANCHES = 200


@dataclass(frozen=True)
class Scaled:
    """A number: the value for null, the centre, the spread, and the coefficient."""

    median: float
    mean: float
    deviation: float
    coefficient: float

    def term(self, name: str) -> Column:
        known = F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(self.median))
        return (known - F.lit(self.mean)) / F.lit(self.deviation) * F.lit(self.coefficient)


@dataclass(frozen=True)
class LinearModel:
    """Coefficients by column; a category that is not listed counts 0, null is ``MISSING``."""

    intercept: float
    numeric: Mapping[str, Scaled]
    categorical: Mapping[str, Mapping[str, float]]
    binary: Mapping[str, float]

    def _with_lookups(self, df: DataFrame) -> tuple[DataFrame, list[Column]]:
        terms = []
        for i, (name, by_category) in enumerate(self.categorical.items()):
            known = F.coalesce(F.col(f"`{name}`"), F.lit(MISSING))
            if len(by_category) <= MOST_BRANCHES:
                branches = F.lit(0.0)
                for category, coefficient in by_category.items():
                    branches = F.when(known == category, F.lit(coefficient)).otherwise(branches)
                terms.append(branches)
            else:
                table = df.sparkSession.createDataFrame([*by_category.items()], f"_category{i} string, _weight{i} double")
                df = df.join(table, known == F.col(f"_category{i}"), "left")
                terms.append(F.coalesce(f"_weight{i}", F.lit(0.0)))
        return df, terms

    def score(self, df: DataFrame, label: str | None = None) -> DataFrame:
        """The rows with ``y_prob`` = P(label 1) and ``y_pred``; and ``y_true`` if ``label`` is named."""
        kept = [F.col(f"`{c}`") for c in df.columns]
        looked_up, categories = self._with_lookups(df)
        terms = [number.term(name) for name, number in self.numeric.items()] + categories
        terms += [F.col(f"`{name}`").cast("double") * F.lit(c) for name, c in self.binary.items()]
        margin = reduce(add, terms, F.lit(float(self.intercept)))
        probability = 1.0 / (1.0 + F.exp(-margin))
        truth = [F.col(f"`{label}`").alias("y_true")] if label else []
        scored = looked_up.select(*kept, *truth, probability.alias("y_prob"))
        return scored.withColumn("y_pred", (F.col("y_prob") > 0.5).cast("int"))


def _statistics(cleaner: SQLTransformer, name: str) -> tuple[float, float, float]:
    """What the cleaning stage puts in for null, takes off and divides by."""
    number = r"(\S+)D"
    part = rf"\(coalesce\(cast\(`{re.escape(name)}` AS double\), {number}\) - {number}\) / {number} AS "
    median, mean, deviation = map(float, re.search(part, cleaner.getStatement()).groups())
    return median, mean, deviation


def compiled(model: PipelineModel, columns: ModelColumns = ModelColumns()) -> LinearModel:
    """The model that ``operators.model.fit`` returned, as plain numbers."""
    cleaner = next(stage for stage in model.stages if isinstance(stage, SQLTransformer))
    indexer = next(stage for stage in model.stages if isinstance(stage, StringIndexerModel))
    regression = model.stages[-1]
    coefficients = iter(regression.coefficients.toArray().tolist())
    numeric = {c: Scaled(*_statistics(cleaner, c), next(coefficients)) for c in columns.numeric}
    categorical = {
        c: {category: next(coefficients) for category in known}
        for c, known in zip(columns.categorical, indexer.labelsArray, strict=True)
    }
    binary = {c: next(coefficients) for c in columns.binary}
    return LinearModel(regression.intercept, numeric, categorical, binary)
