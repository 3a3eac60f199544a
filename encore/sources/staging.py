"""Written tables between steps.

A step whose result is read several times is written once, as Parquet, to the
shared folder the cluster names in ``spark.checkpoint.dir``; without that
setting, to a folder in Spark's own warehouse.  Later readers scan only the
columns they need, and a lost executor never re-runs the joins behind the table.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def staging_folder(spark: SparkSession) -> str:
    """The shared folder; refused if it is one machine's disk on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
    files, _ = _file_system(spark, folder)
    if files.getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


class Workspace:
    """One run's staged tables, and the owner that can delete them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{staging_folder(spark)}/encore/{uuid4().hex}"

    def new_path(self, label: str) -> str:
        return f"{self.folder}/{label}-{uuid4().hex[:8]}"

    def stage(self, df: DataFrame, label: str, **options: str) -> DataFrame:
        """Write ``df`` and return a scan of the written table."""
        path = self.new_path(label)
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def stage_bucketed(self, df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
        """As ``stage``, in buckets by ``key``: grouping by it later shuffles nothing.

        Needs a catalog in which a table may be created; its name is dropped at once.
        """
        name = f"{label}_{uuid4().hex}"
        df.write.bucketBy(buckets, key).option("path", self.new_path(label)).saveAsTable(name, format="parquet")
        table = self.spark.table(name)
        table.schema  # resolved now; the name is not needed any more, the files are
        self.spark.sql(f"DROP TABLE {name}")
        return table

    def delete(self) -> None:
        """Remove the tables; frames that read them no longer work."""
        files, where = _file_system(self.spark, self.folder)
        files.delete(where, True)


def new_path(spark: SparkSession, label: str) -> str:
    return Workspace(spark).new_path(label)


def stage(df: DataFrame, label: str, workspace: Workspace | None = None) -> DataFrame:
    """Write ``df`` to the workspace, or to one of its own, and scan it."""
    return (workspace or Workspace(df.sparkSession)).stage(df, label)
