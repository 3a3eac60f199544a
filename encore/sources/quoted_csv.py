"""One quoted CSV file over many tasks, although quoted text may hold line breaks.

Whether a line end is real depends on every quote before it in the file.  A line
read on its own tells what it does to the two possible answers: keep them, swap
them, or settle them, as a text whose quotes are no field's quotes may.  Such steps
can be joined in any grouping, so

1. every chunk of a split, of at most ``CHUNK_LINES`` lines, reduces its lines to one step,
2. a running combination over one row per chunk tells how each chunk begins,
3. chunks that begin outside of quoted text and never open one hold a record a line:
   these lines go on where they are read,
4. in the others the same combination tells how each line begins,
5. lines that begin inside a quoted text are glued to the record before, first
   within the chunk, then the at most two open pieces of every chunk.

Only chunks with breaks in quoted text are shuffled, once, by chunk; a line stands in
the split it begins in.  Both scans have to cut the files alike: a line that the first
scan did not see in the same place is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

# consecutive lines of a split that are looked at together
CHUNK_LINES = 1 << 16
CHUNK = ("_file", "_block", "_length", "_chunk")
PLACE = ("_block", "_chunk")
MOVED = (
    "the files were cut into other splits the second time they were read; "
    "set spark.sql.files.minPartitionNum, so that the number of executors does not matter"
)
QUOTE = '"'
# what the next quote of a line does: nothing, end a quoted text, or begin one if nothing is before it
STRAY, INSIDE, FRESH = 0, 1, 2


def _inside_after(line: Column, begin: int, sep: str) -> Column:
    """Whether the end of a line lies inside a quoted text.

    A quote begins a text only at the begin of a field; right after a text's end it is
    the second half of an escaped quote; anywhere else it is an ordinary character.
    """

    def meet_quote(state: Column, ahead: Column) -> Column:
        begins = ahead.endswith(sep) | ((state == FRESH) & (ahead == ""))
        return F.when(state == INSIDE, FRESH).when(begins, INSIDE).otherwise(STRAY)

    between = F.split(line, QUOTE, -1)
    before_quotes = F.slice(between, 1, F.size(between) - 1)
    return F.aggregate(before_quotes, F.lit(begin), meet_quote) == INSIDE


def _steps(lines: DataFrame, sep: str) -> DataFrame:
    """Add what a line does: ``_settles`` the answer (0 or 1), or ``_swaps`` it (0 or 1)."""
    from_outside = _inside_after(F.col("_line"), FRESH, sep)
    from_inside = _inside_after(F.col("_line"), INSIDE, sep)
    quoted = F.contains("_line", F.lit(QUOTE))
    return (
        lines.withColumn("_ends", F.when(quoted, F.struct(from_outside.alias("out"), from_inside.alias("in"))))
        .withColumn("_settles", F.when(F.col("_ends.out") == F.col("_ends.in"), F.col("_ends.out").cast("int")))
        .withColumn("_swaps", F.coalesce((F.col("_ends.out") & ~F.col("_ends.in")).cast("int"), F.lit(0)))
        .drop("_ends")
    )


def _with_ends(steps: DataFrame, order: WindowSpec, begin: Column) -> DataFrame:
    """Add ``_begins`` and ``_ends``: whether a row begins and ends inside a quoted text (0 or 1)."""
    return (
        steps.withColumn("_swapped", F.sum("_swaps").over(order))
        # an answer that is settled here is swapped by the rows that follow only
        .withColumn("_last", F.last(F.col("_settles") + F.col("_swapped"), ignorenulls=True).over(order))
        .withColumn("_ends", F.pmod(F.coalesce("_last", begin) + F.col("_swapped"), F.lit(2)))
        .withColumn("_begins", F.coalesce(F.lag("_ends").over(order), begin))
        .drop("_swapped", "_last")
    )


def _chunks(steps: DataFrame) -> DataFrame:
    """How every chunk begins, whether a record is a line in it, where it and its file's header are.

    One row per chunk, from one step per chunk.
    """
    swapping = F.struct("_at", "_settles", "_swaps")
    # only lines that do something, in order; a chunk holds its own and no more
    acting = F.when(F.col("_settles").isNotNull() | (F.col("_swaps") == 1), swapping)

    def join(step: Column, line: Column) -> Column:
        settles = F.coalesce(line["_settles"], F.pmod(step["settles"] + line["_swaps"], F.lit(2)))
        swaps = F.when(line["_settles"].isNotNull(), 0).otherwise(F.pmod(step["swaps"] + line["_swaps"], F.lit(2)))
        return F.struct(settles.alias("settles"), swaps.alias("swaps"))

    nothing = F.struct(F.lit(None).cast("int").alias("settles"), F.lit(0).alias("swaps"))
    chunks = steps.groupBy(*CHUNK).agg(
        F.array_sort(F.collect_list(acting)).alias("_acting"),
        F.max(F.coalesce("_settles", "_swaps")).alias("_opens"),
        F.min("_at").alias("_from"),
        F.max("_at").alias("_to"),
        F.min(F.when(~_blank(), F.col("_at"))).alias("_filled"),
    )
    reduced = chunks.withColumn("_step", F.aggregate("_acting", nothing, join)).select(
        *CHUNK, "_opens", "_from", "_to", "_filled", F.col("_step.settles").alias("_settles"), F.col("_step.swaps").alias("_swaps")
    )
    in_file = Window.partitionBy("_file").orderBy(*PLACE)
    return _with_ends(reduced, in_file, F.lit(0)).select(
        *CHUNK,
        "_from",
        "_to",
        F.col("_begins").alias("_chunk_begins"),
        ((F.col("_begins") == 0) & (F.col("_opens") == 0)).alias("_by_line"),
        F.first("_filled", ignorenulls=True).over(in_file).alias("_head"),
    )


def _blank() -> Column:
    return F.col("_line").isin("", "\r")


def _glued(lines: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Lines of one record joined again, with whether the record's begin and end are among them."""
    parts = F.array_sort(F.collect_list(F.struct(*order, "_line")))
    return lines.groupBy(*keys).agg(
        F.array_join(F.transform(parts, lambda part: part["_line"]), "\n").alias("_line"),
        F.min_by("_begins", F.struct(*order)).alias("_begins"),
        F.max_by("_ends", F.struct(*order)).alias("_ends"),
        F.max("_header").alias("_header"),
    )


def _joined(lines: DataFrame, sep: str) -> DataFrame:
    """The records of chunks whose quoted text holds line breaks."""
    in_chunk = Window.partitionBy(*CHUNK).orderBy("_at")
    placed = _with_ends(_steps(lines, sep), in_chunk, F.col("_chunk_begins"))
    placed = placed.where((F.col("_begins") == 1) | ~_blank())
    numbered = placed.withColumn("_record", F.sum(1 - F.col("_begins")).over(in_chunk)).select(
        *CHUNK, "_record", "_at", "_begins", "_ends", "_header", "_line"
    )

    one_line = (F.col("_begins") == 0) & (F.col("_ends") == 0)
    found = ["_file", "_header", "_line"]
    pieces = _glued(numbered.where(~one_line), [*CHUNK, "_record"], ["_at"])
    # at most two open pieces per chunk: records that go on over its borders
    in_file = Window.partitionBy("_file").orderBy(*PLACE, "_record")
    opened = pieces.where(~one_line).withColumn("_whole", F.sum(1 - F.col("_begins")).over(in_file))
    across = _glued(opened, ["_file", "_whole"], [*PLACE, "_record"]).select(found)
    return numbered.where(one_line).select(found).unionByName(pieces.where(one_line).select(found)).unionByName(across)


def records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """The records of the files at ``path`` as text: ``_file``, ``_header`` and ``_line``.

    Records end at ``\\n`` or ``\\r\\n`` outside quoted text; empty lines between them are
    skipped.  ``_header`` tells the first record of a file.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.col("_metadata.file_block_length").alias("_length"),
            F.monotonically_increasing_id().alias("_at"),
            F.col("value").alias("_line"),
        )
        .withColumn("_chunk", F.col("_at").cast("long") - F.pmod("_at", F.lit(CHUNK_LINES)))
    )
    known = lines.join(F.broadcast(_chunks(_steps(lines, sep))), list(CHUNK), "left")
    by_line = F.when(F.col("_at").between(F.col("_from"), F.col("_to")), F.col("_by_line"))
    known = known.withColumn("_by_line", F.coalesce(by_line, F.raise_error(F.lit(MOVED)).cast("boolean")))
    known = known.withColumn("_header", F.col("_at").eqNullSafe(F.col("_head")))
    # text of the answer, so that what a reader filters or casts never meets a line that is no record
    record = F.when(F.col("_by_line"), F.col("_line")).alias("_line")
    alone = known.where(F.col("_by_line") & ~_blank()).select("_file", "_header", record)
    found = alone.unionByName(_joined(known.where(~F.col("_by_line")), sep))
    # a record that ends at CR LF has its quoted line breaks as LF, as the reader of whole files does
    plain = F.regexp_replace(F.replace("_line", F.lit("\r\n"), F.lit("\n")), "\r$", "")
    return found.withColumn("_line", F.when(F.col("_line").endswith("\r"), plain).otherwise(F.col("_line")))


def read_quoted_csv(spark: SparkSession, path: str, options: dict[str, str], names: list[str]) -> DataFrame:
    """All columns as text, named ``names``; the first record of every file is its header."""
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    found = records(spark, path, options.get("sep", ","))
    rows = found.where(~F.col("_header"))
    # a row of its own, so that a line is parsed once, not again for every filter and field read from it
    parsed = rows.select(F.inline(F.array(F.from_csv("_line", schema, options))))
    return parsed.toDF(*names)
