"""Class-balanced logistic regression."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators.features import ModelColumns, assembler, cleaner, encoder_stages


def fit(
    train: DataFrame,
    columns: ModelColumns = ModelColumns(),
    max_iter: int = 1000,
    tol: float = 3e-8,
    inverse_penalty: float = 1.0,
    depth: int = 2,
    max_gradient: float = 1e-6,
) -> PipelineModel:
    """Minimise sum(weight * log loss) + |coefficients|^2 / (2 * inverse_penalty).

    MLlib divides the loss by the weight total, which is the row count for
    balanced weights, hence the penalty 1 / (inverse_penalty * rows).  A much
    smaller ``tol`` is below what the line search can resolve.  Raise
    ``depth`` (levels of the gradient aggregation) on a very large cluster.  A
    gradient a row above ``max_gradient`` at the end is an error, not a fit.
    """
    rows = features_and_label(train, columns)
    label = F.col(columns.label)
    ones, zeros, total = rows.agg(F.count_if(label == 1), F.count_if(label == 0), F.count("*")).first()
    if not ones or not zeros or ones + zeros != total:
        raise ValueError(f"training labels must be 0 and 1, found {zeros} of 0, {ones} of 1, {total} rows")
    weight = F.when(label == 1, total / (2 * ones)).otherwise(total / (2 * zeros))
    weighted = rows.withColumn("weight", weight)
    regression = LogisticRegression(
        labelCol=columns.label,
        weightCol="weight",
        maxIter=max_iter,
        tol=tol,
        regParam=1.0 / (inverse_penalty * total),
        elasticNetParam=0.0,
        standardization=False,
        aggregationDepth=depth,
    )
    stages = [cleaner(rows, columns), *encoder_stages(columns), assembler(columns), regression]
    fitted = Pipeline(stages=stages).fit(weighted)
    steepest = optimality(fitted, weighted, columns, inverse_penalty).agg(F.max(F.abs("gradient"))).first()[0]
    if not steepest < max_gradient:
        raise ArithmeticError(f"the solver stopped at a gradient of {steepest} a row, {max_gradient} is allowed")
    return fitted


def column_names(model: PipelineModel, columns: ModelColumns) -> list[str]:
    """The coefficients' names in their order: numbers, ``column=category``, flags."""
    indexer = next(stage for stage in model.stages if isinstance(stage, StringIndexerModel))
    states = [
        f"{c}={category}"
        for c, known in zip(columns.categorical, indexer.labelsArray, strict=True)
        for category in known
    ]
    return [*columns.numeric, *states, *columns.binary]


def optimality(
    model: PipelineModel, weighted: DataFrame, columns: ModelColumns = ModelColumns(), inverse_penalty: float = 1.0
) -> DataFrame:
    """Per coefficient and the intercept: the column's sum and the loss gradient a row.

    ``weighted`` are the training rows with their ``weight``.  At the optimum, which is
    unique, every gradient is 0.  ``n_wrong`` counts the rows whose prediction is not
    what their probability says.  One aggregate over the rows, six expressions however
    many coefficients there are.
    """
    coefficients = [*model.stages[-1].coefficients.toArray().tolist(), 0.0]
    names = [*column_names(model, columns), "intercept"]
    probability = vector_to_array("probability")[1]
    residual = F.col("weight") * (probability - F.col(columns.label))
    rows = model.transform(weighted).select(
        "features",
        residual.alias("_residual"),
        # a summary takes no negative weights
        F.greatest(residual, F.lit(0.0)).alias("_over"),
        F.greatest(-residual, F.lit(0.0)).alias("_under"),
        (F.col("prediction") != (probability > 0.5).cast("double")).alias("_wrong"),
    )
    total = Summarizer.metrics("sum")
    sums = rows.agg(
        F.count("*").alias("_rows"),
        F.count_if("_wrong").alias("n_wrong"),
        F.sum("_residual").alias("_slope"),
        total.summary(F.col("features")).alias("_total"),
        total.summary(F.col("features"), F.col("_over")).alias("_over"),
        total.summary(F.col("features"), F.col("_under")).alias("_under"),
    )
    rows_as_double = F.col("_rows").cast("double")
    vectors = {
        "total": F.concat(vector_to_array("_total.sum"), F.array(rows_as_double)),
        "over": F.concat(vector_to_array("_over.sum"), F.array("_slope")),
        "under": F.concat(vector_to_array("_under.sum"), F.array(F.lit(0.0))),
    }
    zipped = F.arrays_zip(*[column.alias(name) for name, column in vectors.items()])
    # one row per coefficient on both sides
    lines = sums.select("_rows", "n_wrong", F.posexplode(zipped).alias("_at", "_sums"))
    named = model_names(weighted.sparkSession, names, coefficients)
    gradient = (F.col("_sums.over") - F.col("_sums.under") + F.col("_coefficient") / inverse_penalty) / F.col("_rows")
    return lines.join(named, "_at").select(
        "name", F.col("_sums.total").alias("total"), gradient.alias("gradient"), "n_wrong"
    )


def model_names(spark: SparkSession, names: list[str], coefficients: list[float]) -> DataFrame:
    """The coefficients of a fitted model as a table: ``_at``, ``name`` and ``_coefficient``."""
    rows = [(i, name, c) for i, (name, c) in enumerate(zip(names, coefficients, strict=True))]
    return spark.createDataFrame(rows, "_at int, name string, _coefficient double")


def features_and_label(df: DataFrame, columns: ModelColumns) -> DataFrame:
    """Only what the regression reads."""
    return df.select(*columns.numeric, *columns.categorical, *columns.binary, columns.label)


def score(model: PipelineModel, df: DataFrame, columns: ModelColumns = ModelColumns()) -> DataFrame:
    """Add y_true, y_prob = P(label 1) and y_pred to the rows."""
    return model.transform(df).select(
        *df.columns,
        F.col(columns.label).alias("y_true"),
        vector_to_array("probability")[1].alias("y_prob"),
        F.col("prediction").cast("int").alias("y_pred"),
    )
