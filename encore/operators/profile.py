"""Data-quality summaries, each one pass with map-side aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.flags import ratio


def _known(df: DataFrame, column: str) -> Column:
    """NaN is no value, as null."""
    value = F.col(f"`{column}`")
    floating = dict(df.dtypes)[column] in ("double", "float")
    return value.isNotNull() & ~F.isnan(value) if floating else value.isNotNull()


def null_profile(df: DataFrame) -> DataFrame:
    """Number of nulls and NaNs in every column."""
    counts = df.agg(*[F.count_if(~_known(df, c)).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_cnt")


def schema_profile(df: DataFrame) -> DataFrame:
    """Type and number of known values of every column."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    counts = df.agg(*[F.count_if(_known(df, c)).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column_name", "non_null_cnt")
    return long.withColumn("data_type", types[F.col("column_name")])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per known value."""
    value = F.col(column)
    return df.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("cnt"))


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Share of every known value among the known values."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.select("value", ratio(F.col("cnt"), total).alias("share"))


def split_label_rates(split: DataFrame, label: str) -> DataFrame:
    """Rows and label shares in every part of a split."""
    counts = split.groupBy("split", F.col(label).alias("label")).agg(F.count("*").alias("cnt"))
    size = F.sum("cnt").over(Window.partitionBy("split"))
    return counts.select(
        "split", "label", "cnt", size.alias("split_rows"), ratio(F.col("cnt"), size).alias("share")
    )
