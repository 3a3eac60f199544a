"""What the operators share: tables, texts inside Arrow batches, row output."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.sources.staging import Workspace

WORKSPACE_CODEC = {"compression": "zstd"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str, workspace: Workspace | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and scan it."""
    return (workspace or Workspace(df.sparkSession)).stage(df, label, **WORKSPACE_CODEC)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with as many underscores before it as no column has, in whatever case."""
    taken = {column.lower() for column in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(docs: DataFrame, work: Workspace) -> tuple[DataFrame, str]:
    """``docs`` written once with a number for every row, and that column's name."""
    row = free_name("_row", docs.columns)
    return stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered", work), row


def values(column: pa.Array, missing=None) -> Iterator:
    """A column's values one by one, never as one list."""
    for value in column:
        plain = value.as_py()
        yield missing if plain is None else plain


def once_per_worker(name: str, make: Callable):
    """``make()``, kept by the Python worker, which serves many tasks one after another.

    For what every task would have to load or learn anew; never for results.
    """
    memory = sys.modules.setdefault("_worker_memory", ModuleType("_worker_memory")).__dict__
    if name not in memory:
        memory[name] = make()
    return memory[name]


class Rows:
    """Collects rows and gives them out as batches of bounded size."""

    def __init__(self, schema: pa.Schema, most: int = 4096, most_bytes: int = 8 << 20):
        self.schema, self.most, self.most_bytes = schema, most, most_bytes
        self.rows: list[tuple] = []
        self.held = 0

    def add(self, row: tuple, weight: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.held += weight
        if len(self.rows) >= self.most or self.held >= self.most_bytes:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)]
            self.rows, self.held = [], 0
            yield pa.record_batch(arrays, schema=self.schema)


def bucketed(df: DataFrame, label: str, work: Workspace, buckets: int, key: str) -> DataFrame:
    """``df`` written sorted, in buckets by ``key``, so that later joins on it shuffle nothing of it."""
    spark = df.sparkSession
    name = f"{label}_{uuid4().hex}"
    writer = df.write.bucketBy(buckets, key).sortBy(key).options(**WORKSPACE_CODEC)
    writer.option("path", work.new_path(label)).saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved now; the name is not needed any more, the files are
    spark.sql(f"DROP TABLE {name}")
    return table
