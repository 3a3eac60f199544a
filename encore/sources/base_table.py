"""The base table on disk: the hand-over between preparation and modelling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.temporal import strict_ts
from encore.schemas import BASE_TABLE
from encore.sources.raw import apply_schema, read_csv_text, without_nan


def write_abt(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the base table as a folder of part files.

    CSV gets a header per part and timestamps as ``yyyy-MM-dd HH:mm:ss`` (plus
    the fraction when there is one), and text keeps its outer blanks, so nothing
    is lost on the way back.
    """
    if fmt == "csv":
        stamps = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
        text = df.withColumns({c: F.col(c).cast("string") for c in stamps})
        text.write.mode("overwrite").options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def load_abt(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = BASE_TABLE,
    multi_line: bool = True,
) -> DataFrame:
    """Read the base table back; a malformed timestamp fails the job.

    Text columns of a CSV may hold line breaks; without them ``multi_line=False``
    lets Spark split the part files, and a broken row then fails the job.
    """
    if fmt != "csv":
        return without_nan(spark.read.format(fmt).schema(schema).load(path))
    stamps = [f.name for f in schema if isinstance(f.dataType, T.TimestampNTZType)]
    text_stamps = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in stamps else f.dataType) for f in schema]
    )
    table = apply_schema(read_csv_text(spark, path, multi_line), text_stamps)
    return without_nan(strict_ts(table, stamps))
