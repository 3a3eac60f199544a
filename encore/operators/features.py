"""Model inputs: scaled numbers, one-hot categories, class weights, one vector.

All statistics come from the training rows.  The fitted steps are stages of an
ordinary Spark ML pipeline, so a fitted model can be saved and loaded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.operators.ordering import exact_quantiles

# stands for "no value" as a category of its own
MISSING = "__missing__"


@dataclass(frozen=True)
class ModelColumns:
    """Which base-table columns play which part.

    ``unused`` are selected as features but assigned to no transformer, so they
    do not reach the model; move them to ``numeric`` to use them.
    """

    key: str = "customer_unique_id"
    ts: str = "first_purchase_ts"
    label: str = "purchase_2nd_within_90d"
    numeric: tuple[str, ...] = ("delivery_days_mean", "first_event_review_score_mean")
    categorical: tuple[str, ...] = ("customer_state",)
    binary: tuple[str, ...] = ("late_flag", "has_review")
    unused: tuple[str, ...] = ("first_item_cnt", "first_purchase_gmv")

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.binary + self.categorical + self.unused


def features_and_target(df: DataFrame, columns: ModelColumns) -> DataFrame:
    """Key, features and label, nothing else."""
    return df.select(columns.key, *columns.features, columns.label)


def _scaled(name: str) -> str:
    return f"{name}_scaled"


def numeric_statistics(train: DataFrame, columns: tuple[str, ...]) -> dict[str, tuple[float, float, float]]:
    """Per column: exact median, then mean and population deviation after imputing it.

    A column without spread gets deviation 1, so it is only centred.  Fetches
    three numbers per column.
    """
    medians = exact_quantiles(train, list(columns))
    unknown = [c for c, median in medians.items() if median is None]
    if unknown:
        raise ValueError(f"no known training value in {', '.join(unknown)}")
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in columns}
    moments = train.agg(
        *[F.avg(filled[c]).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(filled[c]).alias(f"dev_{c}") for c in columns],
    ).first()
    return {c: (medians[c], moments[f"mean_{c}"], moments[f"dev_{c}"] or 1.0) for c in columns}


def cleaner(train: DataFrame, columns: ModelColumns) -> Transformer:
    """Impute and scale the numbers, give missing categories their own value."""
    statistics = numeric_statistics(train, columns.numeric)
    parts = [
        f"(coalesce(cast(`{c}` AS double), {median!r}D) - {mean!r}D) / {dev!r}D AS `{_scaled(c)}`"
        for c, (median, mean, dev) in statistics.items()
    ]
    parts += [f"coalesce(`{c}`, '{MISSING}') AS `{c}_known`" for c in columns.categorical]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def encoder_stages(columns: ModelColumns) -> list:
    """One column per training category in sorted order; others are all zeros."""
    indexer = StringIndexer(
        inputCols=[f"{c}_known" for c in columns.categorical],
        outputCols=[f"{c}_index" for c in columns.categorical],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns.categorical],
        outputCols=[f"{c}_onehot" for c in columns.categorical],
        dropLast=True,
    )
    return [indexer, encoder]


def assembler(columns: ModelColumns) -> VectorAssembler:
    """Scaled numbers, then one-hot categories, then the 0/1 flags as they are."""
    inputs = [_scaled(c) for c in columns.numeric]
    inputs += [f"{c}_onehot" for c in columns.categorical]
    inputs += list(columns.binary)
    return VectorAssembler(inputCols=inputs, outputCol="features")


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (classes * rows of the class): one row per class."""
    counts = train.groupBy(label).agg(F.count("*").alias("cnt"))
    classes = Window.partitionBy()
    weight = F.sum("cnt").over(classes) / (F.count("*").over(classes) * F.col("cnt"))
    return counts.select(label, "cnt", weight.cast("double").alias("weight"))
