"""Median imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.ordering import exact_quantiles


def impute_median(df: DataFrame, column: str, fit_on: DataFrame | None = None) -> DataFrame:
    """Replace nulls by the exact median of the column.

    The median is taken over ``fit_on`` (``df`` itself when left out; pass the
    training rows to keep later rows out of it).  Runs ``exact_quantiles``.
    """
    median = exact_quantiles(df if fit_on is None else fit_on, [column])[column]
    if median is None:
        return df
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(median)))
