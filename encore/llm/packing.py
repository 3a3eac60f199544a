"""Concatenate and cut: documents as one stream of token ids, cut into windows.

Two passes.  The first encodes every document and counts tokens while it writes,
so that a document knows its offset inside its partition.  The second adds up the
partitions' totals, which gives every partition, and so every document, its
offset in the whole stream.  A document's pieces are the windows its range
touches; where it crosses a border the pieces are the border's records.
Only the last window can have room left.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.tables import Rows, once_per_worker, stage, values

WIDTH = 2048
END_ID = 1
PART_BITS = 33
# words whose ids a task remembers; beyond it the memory starts anew
REMEMBERED_WORDS = 600_000
LONGEST_REMEMBERED = 48

ENCODED = pa.schema([("_doc", pa.int64()), ("_ahead", pa.int64()), ("_n", pa.int64()), ("_ids", pa.binary())])


# a run of these after letters is a piece of its own
TAILS = b".,!?$%&*#;:"
# letters whose lower case or normal form needs the tokenizer's own rules
FAR = re.compile("[^a-z\u00aa-\u00ff]")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the letters from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordIds(dict):
    """Ids of a word, as little-endian 32-bit integers, found once and remembered.

    The vocabulary drops white space, so words are encoded apart from each other.
    Letters of Latin-1 need no normalising but lower case and are one piece, which
    goes straight to the merges; a tail of punctuation is the next piece.  All
    other words take the whole way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.encode, self.merge = tokenizer.encode, tokenizer.model.tokenize
        self.stems: dict[str, bytes] = {}
        self.letters = byte_letters()

    def _stem(self, stem: str) -> bytes:
        ids = self.stems.get(stem)
        if ids is None:
            piece = stem if stem.isascii() else stem.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [token.id for token in self.merge(piece)]).tobytes()
            if len(self.stems) >= REMEMBERED_WORDS:
                self.stems.clear()
            self.stems[stem] = ids
        return ids

    def __missing__(self, word: bytes) -> bytes:
        if len(word) > LONGEST_REMEMBERED:
            return self._whole(word.decode())
        stem = word.rstrip(TAILS)
        text = stem.decode().lower()
        if text.isalpha() and (text.isascii() or not FAR.search(text)):
            ids = self._stem(text)
            if len(stem) < len(word):
                ids += self[word[len(stem) :]]
        else:
            ids = self._whole(word.decode())
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        return array("I", self.encode(text, add_special_tokens=False).ids).tobytes()


def _encoder(path: str, end_id: int):
    end = array("I", [end_id]).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = once_per_worker(f"word_ids {path}", lambda: WordIds(path))
        rows, ahead = Rows(ENCODED), 0
        for batch in batches:
            for doc, text in zip(values(batch.column(0)), values(batch.column(1), ""), strict=True):
                ids = b"".join(map(words.__getitem__, text.encode().split())) + end
                count = len(ids) // 4
                yield from rows.add((doc, ahead, count, ids), len(ids))
                ahead += count
        yield from rows.rest()

    return encode


def pack(
    docs: DataFrame,
    tokenizer: str,
    width: int = WIDTH,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of ``docs`` in windows of ``width`` tokens.

    One row per piece: the document, ``start`` (ids of it before the piece),
    ``length``, ``piece_ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset`` in that window.  A null or empty text is the
    end id alone.  Repeated rows are packed as often as they occur and a null
    document id stays null.  An empty table gives no pieces.  Other columns are
    not read.  ``tokenizer`` is the path of a vocabulary that drops white space.
    """
    spark = docs.sparkSession
    encoded = stage(
        docs.select(F.col(doc_id).cast("long"), F.col(text))
        .mapInArrow(_encoder(tokenizer, end_id), "_doc long, _ahead long, _n long, _ids binary")
        .withColumn("_part", F.shiftright(F.monotonically_increasing_id(), PART_BITS)),
        "encoded",
    )
    # one total per partition, whatever the number of documents
    totals = sorted(encoded.groupBy("_part").agg(F.max(F.col("_ahead") + F.col("_n"))).collect())
    begins = accumulate((total for _, total in totals), initial=0)
    starts = [(part, begin) for (part, _), begin in zip(totals, begins, strict=False)]
    begin = spark.createDataFrame(starts, "_part long, _begin long")
    placed = encoded.join(F.broadcast(begin), "_part").withColumn("_at", F.col("_begin") + F.col("_ahead"))

    at, end, span = F.col("_at"), F.col("_at") + F.col("_n"), F.lit(width).cast("long")
    first, last = F.call_function("div", at, span), F.call_function("div", end - 1, span)

    def piece(sequence):
        left = F.greatest(at, sequence * span)
        right = F.least(end, (sequence + 1) * span)
        start, length = left - at, right - left
        return F.struct(
            start.alias("start"),
            length.alias("length"),
            F.substring("_ids", (start * 4 + 1).cast("int"), (length * 4).cast("int")).alias("piece_ids"),
            sequence.alias("sequence_id"),
            (left - sequence * span).alias("offset"),
        )

    pieces = F.transform(F.sequence(first, last), piece)
    return placed.select(
        F.col("_doc").alias("doc_id"), F.col("_n").alias("doc_tokens"), F.explode(pieces).alias("_piece")
    ).select("doc_id", "doc_tokens", "_piece.*")
