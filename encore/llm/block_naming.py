"""Exact dedup by deterministic block naming.

A text without white space is cut into blocks of fixed size.  Different blocks
get different integer names by sorting them; then adjacent pairs of names are
named the same way, and their pairs again, until one name is left of every text.
Two texts have the same name exactly if they are equal: names come from
comparing contents, never from a hash alone.

Blocks are first named within the task that reads them, so that each task sends
a block once however many copies it has.  Hash partitions sort them, and a
block's name is its partition and its rank there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.tables import Rows, numbered, stage, values
from encore.sources.staging import Workspace

BLOCK_BYTES = 4096
PART_BITS = 33
SPACE = b" \t\n\x0b\x0c\r"
# bytes of blocks a task remembers; beyond it blocks are sent again
REMEMBERED_BYTES = 48 << 20

CUT = pa.schema(
    [
        ("_doc", pa.int64()),
        ("_row", pa.int64()),
        ("_points", pa.int64()),
        ("_sha", pa.string()),
        ("_names", pa.list_(pa.int64())),
        ("_local", pa.int64()),
        ("_block", pa.binary()),
    ]
)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its local block names, per new block its content."""
    rows, known, held = Rows(CUT), {}, 0
    following = TaskContext.get().partitionId() << PART_BITS
    for batch in batches:
        ids, texts, numbers = batch.columns
        for doc, text, row in zip(values(ids), values(texts, ""), values(numbers), strict=True):
            squeezed = text.encode().translate(None, SPACE)
            names = []
            for at in range(0, max(1, len(squeezed)), BLOCK_BYTES):
                block = squeezed[at : at + BLOCK_BYTES]
                name = known.get(block)
                if name is None:
                    name, following = following, following + 1
                    if held > REMEMBERED_BYTES:
                        known, held = {}, 0
                    known[block] = name
                    held += len(block) + 150
                    yield from rows.add((None, None, None, None, None, name, block), len(block))
                names.append(name)
            sha = hashlib.sha256(squeezed).hexdigest()
            yield from rows.add((doc, row, len(text), sha, names, None, None), 8 * len(names))
    yield from rows.rest()


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of blocks that come sorted: the partition above, the rank below."""
    rank, last = (TaskContext.get().partitionId() << PART_BITS) - 1, None
    for batch in batches:
        names = []
        for block in values(batch.column(1)):
            if block != last:
                rank, last = rank + 1, block
            names.append(rank)
        yield pa.record_batch([batch.column(0), pa.array(names, pa.int64())], names=["_local", "_name"])


def _name_pairs(pairs: DataFrame) -> DataFrame:
    """Distinct pairs of names with a name of their own."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        pairs.select("_a", "_b")
        .distinct()
        .repartition(parts, "_a", "_b")
        .sortWithinPartitions("_a", "_b")
        .withColumn("_next", F.monotonically_increasing_id())
    )


def _identities(names: DataFrame, longest: int, work: Workspace) -> DataFrame:
    """One name per document from (``_row``, ``_blocks``, ``_seq``, ``_left``, ``_name``)."""
    done = names.where("_left = 1").select("_row", "_blocks", "_name")
    names = names.where("_left > 1")
    while longest > 1:
        half = F.call_function("div", F.col("_seq"), F.lit(2))
        first = F.when(F.pmod("_seq", F.lit(2)) == 0, F.col("_name"))
        second = F.when(F.pmod("_seq", F.lit(2)) == 1, F.col("_name"))
        pairs = stage(
            names.groupBy("_row", "_blocks", "_left", half.cast("int").alias("_seq")).agg(
                F.max(first).alias("_a"), F.coalesce(F.max(second), F.lit(-1).cast("long")).alias("_b")
            ),
            "pairs",
            work,
        )
        named = stage(_name_pairs(pairs), "pair_names", work)
        names = pairs.join(named, ["_a", "_b"]).select(
            "_row",
            "_blocks",
            F.call_function("div", F.col("_left") + 1, F.lit(2)).cast("int").alias("_left"),
            "_seq",
            F.col("_next").alias("_name"),
        )
        names = stage(names, "names", work)
        done = done.unionByName(names.where("_left = 1").select("_row", "_blocks", "_name"))
        names, longest = names.where("_left > 1"), (longest + 1) // 2
    return done


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs`` with the group of equal texts it is in.

    Texts are equal when identical without the characters ``[\\x20\\x09-\\x0D]``;
    null is an empty text, and empty texts are equal.  Of a group the row with the
    most code points in its original text stays, then the smallest id (null ids
    last), then, among repeated rows, one of them.  Returns ``doc_id``, ``keep_id``,
    ``group_size``, ``kept``, ``text_sha256`` (of the text without white space) and
    ``_row``, a row's place in the table as read.  Other columns are not read; an
    empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).cast("long"), F.col(text), F.monotonically_increasing_id())
    return _exact(rows, Workspace(docs.sparkSession))


def _exact(rows: DataFrame, work: Workspace) -> DataFrame:
    """``exact_groups`` of (id, text, row number) rows."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = stage(
        rows.mapInArrow(
            _cut, "_doc long, _row long, _points long, _sha string, _names array<long>, _local long, _block binary"
        ),
        "blocks",
        work,
    )
    texts = cut.where("_local IS NULL").select("_row", "_doc", "_points", "_sha")
    ranked = (
        cut.where("_local IS NOT NULL")
        .select("_local", "_block")
        .repartition(parts, F.xxhash64("_block"))
        .sortWithinPartitions("_block")
        .mapInArrow(_rank, "_local long, _name long")
    )
    local = cut.where("_local IS NULL").select(
        "_row", F.size("_names").alias("_blocks"), F.posexplode("_names").alias("_seq", "_local")
    )
    names = stage(
        local.join(ranked, "_local").select("_row", "_blocks", F.col("_blocks").alias("_left"), "_seq", "_name"),
        "names",
        work,
    )
    longest = names.agg(F.max("_blocks")).first()[0] or 0
    identified = stage(_identities(names, longest, work).join(texts, "_row"), "identities", work)
    return _groups(identified, work)


def _stays(points: Column, doc: Column, row: Column) -> Column:
    """The largest of these is the row that stays."""
    return F.struct(points, doc.isNotNull().alias("known"), (-doc).alias("doc"), (-row).alias("row"))


def _groups(identified: DataFrame, work: Workspace) -> DataFrame:
    order = _stays(F.col("_points"), F.col("_doc"), F.col("_row"))
    # written, so that the join below is one of two plain shuffles and its hot keys can be split
    best = stage(
        identified.groupBy("_blocks", "_name").agg(F.count("*").alias("group_size"), F.max(order).alias("_best")),
        "groups",
        work,
    )
    return identified.join(best, ["_blocks", "_name"]).select(
        F.col("_doc").alias("doc_id"),
        (-F.col("_best.doc")).alias("keep_id"),
        "group_size",
        (F.col("_row") == -F.col("_best.row")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
        "_row",
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per group of equal texts as in ``exact_groups``.

    Every row is told by a number of its own, so ids may be null or repeat; columns
    are kept; an empty table gives an empty one.
    """
    work = Workspace(docs.sparkSession)
    rows, row = numbered(docs, work)
    given = rows.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`"), F.col(row))
    stays = _exact(given, work).where("kept").select(F.col("_row").alias("_kept_row"))
    return rows.join(stays, rows[row] == stays["_kept_row"], "left_semi").drop(row)
