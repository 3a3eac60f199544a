"""Lines that many documents share, counted in levelled sorted runs of line hashes.

Documents come in batches.  A run is a table of line hashes, sorted and bucketed by
hash, each with the number of documents it was seen in.  A new batch

1. is cut down to its different hashes per document and counted by hash,
2. is merge-anti-joined with the runs: a hash that a run already holds as common
   is settled and needs no more counting,
3. adds what is left as a run of its own on the lowest level.

When a level holds ``fan`` runs they are compacted into one run of the next level,
which adds their counts.  A hash is rewritten once a level, however many batches
come.  All runs have the same buckets, so joins and compactions shuffle the new
batch only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.expressions import let
from encore.llm.tables import bucketed, stage
from encore.sources.staging import Workspace

LEAST_DOCS = 10
LEAST_CHARS = 1
BATCHES = 4
FAN = 2
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PART_BITS = 33


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def line_hashes(text: Column, least_chars: int = LEAST_CHARS) -> Column:
    """The 128-bit hash of every line's key in order; null where the key is too short."""

    def hashed(key: Column) -> Column:
        return F.when(F.char_length(key) >= least_chars, F.unhex(F.md5(key)))

    return F.transform(F.split(text, "\n", -1), lambda line: let(line_key(line), hashed))


class LineRuns:
    """Counts of line hashes over any number of batches.

    ``least`` is the number of documents that makes a line common, ``fan`` the
    number of runs a level holds before they are compacted.  ``add`` also serves
    as the body of a stream's ``foreachBatch``.
    """

    def __init__(self, work: Workspace, least: int = LEAST_DOCS, fan: int = FAN):
        if fan < 2:
            raise ValueError("a level needs at least two runs to compact")
        self.work, self.least, self.fan = work, least, fan
        self.spark: SparkSession = work.spark
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame, hashes: str) -> None:
        """Count a batch: one row per document, ``hashes`` an array that may hold nulls and repeats."""
        # array_distinct keeps one null, which the filter takes out
        seen = batch.select(F.explode(F.array_distinct(hashes)).alias("_key")).where("_key IS NOT NULL")
        fresh = seen.groupBy("_key").agg(F.count("*").alias("_n"))
        for run in self.runs:
            settled = run.where(F.col("_n") >= self.least).select("_key")
            fresh = fresh.join(settled.hint("merge"), "_key", "left_anti")
        self._put(0, fresh)

    def _put(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(bucketed(run, "run", self.work, self.buckets, "_key"))
        if len(self.levels[level]) >= self.fan:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._merged(full))

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        """Counts added by merging sorted runs; a union would lose their common order."""

        def merge(left: DataFrame, right: DataFrame) -> DataFrame:
            right = right.withColumnRenamed("_n", "_more").hint("merge")
            both = F.coalesce("_n", F.lit(0)) + F.coalesce("_more", F.lit(0))
            return left.join(right, "_key", "full").select("_key", both.alias("_n"))

        return reduce(merge, runs)

    def common(self) -> DataFrame:
        """The hashes of common lines, each once."""
        if not self.runs:
            return self.spark.createDataFrame([], "_key binary")
        return self._merged(self.runs).where(F.col("_n") >= self.least).select("_key")


def drop_common_lines(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    least_chars: int = LEAST_CHARS,
    batches: int = BATCHES,
    fan: int = FAN,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every row of ``docs`` without the lines that at least ``least_docs`` rows have.

    Lines end at ``\\n`` only.  A line's key is the line without ``[\\x20\\x09-\\x0D]``
    at both ends, A-Z in lower case; keys under ``least_chars`` code points are never
    common.  All lines of a common key go, in every row; the others stay, joined by
    ``\\n``.  Returns ``doc_id``, ``n_lines`` (before), ``n_dropped`` and ``kept``.  A
    null or empty text is one empty line.  Every row is a document of its own, also
    with a null or repeated id.  Other columns are not read; an empty table gives an
    empty result.  Keys are told apart by 128-bit hashes.  ``batches`` and ``fan``
    change how the work is cut, not the result.
    """
    spark = docs.sparkSession
    work = Workspace(spark)
    given = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = stage(
        given.withColumn("_hashes", line_hashes(F.col("_text"), least_chars)).withColumn(
            "_batch", F.pmod(F.shiftright("_row", PART_BITS), F.lit(batches)).cast("int")
        ),
        "lines",
        work,
    )
    runs = LineRuns(work, least_docs, fan)
    for batch in range(batches):
        runs.add(rows.where(F.col("_batch") == batch), "_hashes")
    # written, so that the join below is one of two plain shuffles and hot lines can be split
    common = stage(runs.common(), "common", work)
    return _without(rows, common)


def _without(rows: DataFrame, common: DataFrame) -> DataFrame:
    placed = rows.select("_row", F.posexplode("_hashes").alias("_at", "_key")).where("_key IS NOT NULL")
    gone = placed.join(common, "_key", "left_semi").groupBy("_row").agg(F.collect_list("_at").alias("_gone"))
    places = F.array_except(F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), F.col("_gone"))
    # the text is cut once, not once a line
    left = let(F.split("_text", "\n", -1), lambda lines: F.transform(places, lambda at: F.get(lines, at)))
    return (
        rows.select("_row", "doc_id", "_text", F.size("_hashes").cast("long").alias("n_lines"))
        .join(gone, "_row", "left")
        .select(
            "doc_id",
            "n_lines",
            F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
            F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(left, "\n")).alias("kept"),
        )
    )
