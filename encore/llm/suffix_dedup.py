"""Removes passages that an earlier document has, byte by byte, over all documents.

A passage is any string of 50 bytes that also starts in a document with a smaller
id.  Equal strings contain equal minimisers (the smallest hash of their 24-byte
substrings), so strings meet in the task of their minimiser:

1. Documents are written in blocks of about 2 MB, bucketed by block number.
2. Every block sends its minimisers' hashes, some 4 bytes each, by hash range.
   A range answers which of them occur in several documents.
3. Every block sends the text around those, each different piece once, with its
   smallest document.  A range sorts its pieces' suffixes and finds the smallest
   document of every string by breadth-first search on the Burrows-Wheeler
   transform (``shared_prefixes``).  Pieces whose minimiser no other piece has
   are equal to themselves only and need no search.
4. Every block marks the covered bytes of its documents.

A line that very many documents have between different texts gives one minimiser
with as many different pieces.  Blocks report how many they have, and a range calls
a minimiser crowded beyond ``crowd``.  Crowded pieces travel as single strings of
50 bytes, each by its own hash, so they spread over all ranges, and each block sends
a string once.

Blocks are read three times but never shuffled: answers come to their buckets.
The number of ranges follows the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.shared_prefixes import least_owners
from encore.llm.tables import Rows, stage, values
from encore.sources.staging import Workspace

LENGTH = 50
SEED_BYTES = 24
BLOCK_BYTES = 2 << 20
# minimisers per hash range, on average
RANGE_ROWS = 1 << 19
RANGE_BITS = 40
# windows of one minimiser that travel as one piece
MOST_WINDOWS = 64
# bytes of pieces searched together
SEARCH_BYTES = 1 << 20
# different pieces of one minimiser that one task takes
CROWD = 1 << 12
# of 256 marks of pieces, how many blocks must show to tell many pieces from copies
CROWD_MARKS = 128
FAR = np.iinfo(np.int64).max

BLOCKS = pa.schema([("b", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("lens", pa.binary()), ("body", pa.binary())])
NOTES = pa.schema([("r", pa.int64()), ("b", pa.int64()), ("kind", pa.int32()), ("note", pa.binary())])
NOTES_SQL = "r long, b long, kind int, note binary"


# --- blocks ------------------------------------------------------------------------


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in blocks; a null id is larger than all others."""
    rows, number = Rows(BLOCKS, most_bytes=4 << 20), TaskContext.get().partitionId() << 33
    ids, texts, held = [], [], 0

    def block() -> tuple:
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        body = zstandard.compress(b"".join(texts), 3)
        return number, int(lens.sum()), np.array(ids, np.int64).tobytes(), lens.tobytes(), body

    for batch in batches:
        for doc, text in zip(values(batch.column(0), FAR), values(batch.column(1), ""), strict=True):
            ids.append(doc)
            texts.append(text.encode())
            held += len(texts[-1])
            if held >= BLOCK_BYTES:
                made = block()
                yield from rows.add(made, len(made[-1]))
                number, ids, texts, held = number + 1, [], [], 0
    if ids:
        yield from rows.add(block())
    yield from rows.rest()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> np.uint64(29)
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def _hashes(x: np.ndarray) -> np.ndarray:
    """A hash of every SEED_BYTES-byte substring, by joining hashes of halves."""
    base = 0x9E3779B97F4A7C15
    parts = {1: (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)}
    size = 1
    while 2 * size <= SEED_BYTES:
        a = parts[size]
        parts[2 * size] = a[:-size] * np.uint64(pow(base, size, 1 << 64)) + a[size:]
        size *= 2
    joined, done = None, 0
    for size in sorted(parts, reverse=True):
        if SEED_BYTES - done >= size:
            a = parts[size][done:]
            joined = a if joined is None else joined[: len(a)] * np.uint64(pow(base, size, 1 << 64)) + a
            done += size
    return _mixed(joined)


class Block:
    """One block's documents and their pieces: runs of windows with one minimiser."""

    def __init__(self, ids: bytes, lens: bytes, body: bytes):
        self.ids, self.lens = np.frombuffer(ids, np.int64), np.frombuffer(lens, np.int64)
        self.ends = np.cumsum(self.lens)
        self.body = zstandard.decompress(body) if len(body) else b""
        x = np.frombuffer(self.body, np.uint8)
        windows = len(x) - LENGTH + 1
        doc = np.repeat(np.arange(len(self.lens)), self.lens)
        if windows <= 0:
            self.start = self.count = self.doc = np.zeros(0, np.int64)
            self.seed = self.hashes = np.zeros(0, np.uint64)
            return
        self.hashes = _hashes(x)
        least, size, span = self.hashes, 1, LENGTH - SEED_BYTES + 1
        while 2 * size <= span:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        least = np.minimum(least[:windows], least[span - size : span - size + windows])
        inside = doc[:windows] == doc[LENGTH - 1 :]
        change = np.ones(windows, bool)
        change[1:] = (least[1:] != least[:-1]) | (doc[1:windows] != doc[: windows - 1]) | (inside[1:] != inside[:-1])
        begin = np.flatnonzero(change)
        begin = begin[inside[begin]]
        end = np.minimum(np.append(np.flatnonzero(change)[1:], windows)[np.searchsorted(np.flatnonzero(change), begin)], windows)
        cuts = -(-(end - begin) // MOST_WINDOWS)
        nth = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        self.start = np.repeat(begin, cuts) + nth * MOST_WINDOWS
        self.count = np.minimum(np.repeat(end, cuts) - self.start, MOST_WINDOWS)
        self.seed = _mixed(least[self.start] + np.uint64(0x632BE59BD9B4E019))
        self.doc = doc[self.start]

    def _ends(self, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """A hash of the first and the last bytes of pieces; of all 50 bytes of a single string."""
        x, last = np.frombuffer(self.body, np.uint8), start + count + LENGTH - 1
        ends = self.hashes[start] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[last - SEED_BYTES]
        for at in range(SEED_BYTES, LENGTH - SEED_BYTES):
            ends = ends * np.uint64(257) + x[start + at]
        return _mixed(ends)

    def seeds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different minimisers, sorted; which of them several documents here have; how
        many different pieces here; and a mark of one of these, the same for the same pieces."""
        ends = self._ends(self.start, self.count)
        order = np.lexsort((ends, self.seed))
        seed, doc, ends = self.seed[order], self.ids[self.doc[order]], ends[order]
        if not len(seed):
            return seed, np.zeros(0, bool), np.zeros(0, np.uint16), np.zeros(0, np.uint8)
        fresh = np.append(True, seed[1:] != seed[:-1])
        begin = np.flatnonzero(fresh)
        several = np.minimum.reduceat(doc, begin) != np.maximum.reduceat(doc, begin)
        fresh[1:] |= ends[1:] != ends[:-1]
        pieces = np.minimum(np.add.reduceat(fresh.astype(np.int64), begin), 0xFFFF).astype(np.uint16)
        return seed[begin], several, pieces, (_mixed(ends[begin]) & np.uint64(0xFF)).astype(np.uint8)

    def single(self, crowded: np.ndarray) -> np.ndarray:
        """Cut the pieces of crowded minimisers to single strings; their hashes, sorted, as minimisers."""
        chosen = np.isin(self.seed, crowded)
        if not chosen.any():
            return np.zeros(0, np.uint64)
        count = self.count[chosen]
        start = np.repeat(self.start[chosen], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        one = np.ones(len(start), np.int64)
        seed = self._ends(start, one)
        self.doc = np.append(self.doc[~chosen], np.repeat(self.doc[chosen], count))
        self.start, self.count = np.append(self.start[~chosen], start), np.append(self.count[~chosen], one)
        self.seed = np.append(self.seed[~chosen], seed)
        return np.unique(seed)

    def pieces(self, shared: np.ndarray) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        """Different texts of pieces with a shared minimiser, their minimisers and smallest documents.

        Sorted by minimiser, then by first place.  With them the occurrences: piece
        number and index of the segment.
        """
        at = np.searchsorted(shared, self.seed)
        at[at == len(shared)] = 0
        chosen = np.flatnonzero(shared[at] == self.seed) if len(shared) else np.zeros(0, np.int64)
        chosen = chosen[np.argsort(self.seed[chosen], kind="stable")]
        numbers: dict[bytes, int] = {}
        body = self.body
        number = np.fromiter(
            (
                numbers.setdefault(body[a : a + n + LENGTH - 1], len(numbers))
                for a, n in zip(self.start[chosen].tolist(), self.count[chosen].tolist(), strict=True)
            ),
            np.int64,
            len(chosen),
        )
        owners = np.full(len(numbers), FAR)
        np.minimum.at(owners, number, self.ids[self.doc[chosen]])
        seeds = np.zeros(len(numbers), np.uint64)
        seeds[number] = self.seed[chosen]
        return list(numbers), seeds, owners, np.column_stack([number, chosen])


# --- notes between blocks and ranges -----------------------------------------------


def _packed(*arrays: np.ndarray) -> bytes:
    head = np.array([a.nbytes for a in arrays], np.int64).tobytes()
    return zstandard.compress(head + b"".join(a.tobytes() for a in arrays), 1)


def _unpacked(note: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.decompress(note)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    at, arrays = 8 * len(kinds), []
    for size, kind in zip(sizes, kinds, strict=True):
        arrays.append(np.frombuffer(raw[at : at + size], kind))
        at += size
    return arrays


def _split(seeds: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted minimisers by hash range."""
    if not len(seeds):
        return
    ranges = (seeds >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(seeds), np.int64)
    begin = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))
    for a, z in zip(begin, [*begin[1:], len(ranges)], strict=True):
        yield int(ranges[a]), slice(int(a), int(z))


def _short(seeds: np.ndarray, bits: int) -> np.ndarray:
    """A minimiser's next bits below its range; equal ones stay equal."""
    return seeds << np.uint64(bits) >> np.uint64(64 - RANGE_BITS)


def _tell_seeds(bits: int):
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(NOTES, most_bytes=4 << 20)
        for batch in batches:
            for b, ids, lens, body in zip(*(values(batch.column(i)) for i in range(4)), strict=True):
                seeds, several, pieces, mark = Block(ids, lens, body).seeds()
                for r, part in _split(seeds, bits):
                    steps = np.diff(_short(seeds[part], bits), prepend=np.uint64(0))
                    small = steps.astype(np.uint32) if steps.max() < 1 << 32 else steps
                    note = _packed(np.array([small.itemsize]), small, np.packbits(several[part]), pieces[part], mark[part])
                    yield from rows.add((r, b, 0, note), len(note))
        yield from rows.rest()

    return tell


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int], list[bytes]]]:
    """All notes of one range after the other; they come sorted by range."""
    here, blocks, notes = None, [], []
    for batch in batches:
        for r, b, note in zip(values(batch.column(0)), values(batch.column(1)), values(batch.column(3)), strict=True):
            if r != here and notes:
                yield here, blocks, notes
                blocks, notes = [], []
            here = r
            blocks.append(b)
            notes.append(note)
    if notes:
        yield here, blocks, notes


def _crowded(sums: np.ndarray, begin: np.ndarray, marks: np.ndarray, crowd: int) -> np.ndarray:
    """Which minimisers have too many pieces for one task, copies in many blocks apart."""
    ends, crowded = np.append(begin[1:], len(marks)), sums > crowd
    for i in np.flatnonzero(crowded).tolist():
        shown = len(np.unique(marks[begin[i] : ends[i]]))
        crowded[i] = shown >= min(CROWD_MARKS, (ends[i] - begin[i] + 1) // 2)
    return crowded


def _answer_seeds(crowd: int):
    """To each block, which of its minimisers in this range several documents have, and which are crowded."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(NOTES, most_bytes=4 << 20)
        for r, blocks, notes in _by_range(batches):
            seeds, flags, pieces, marks = [], [], [], []
            for note in notes:
                size, steps, several, n, mark = _unpacked(note, np.int64, np.uint8, np.uint8, np.uint16, np.uint8)
                steps = steps.view(np.uint32 if size[0] == 4 else np.uint64)
                seeds.append(np.cumsum(steps, dtype=np.uint64))
                flags.append(np.unpackbits(several, count=len(steps)).astype(bool))
                pieces.append(n)
                marks.append(mark)
            joined = np.concatenate(seeds)
            order = np.argsort(joined, kind="stable")
            begin = np.flatnonzero(np.append(True, joined[order][1:] != joined[order][:-1]))
            held = np.diff(begin, append=len(joined))
            sums = np.add.reduceat(np.concatenate(pieces)[order].astype(np.int64), begin)
            crowded = _crowded(sums, begin, np.concatenate(marks)[order], crowd)
            shared = np.empty((2, len(joined)), bool)
            shared[:, order] = np.repeat([held > 1, crowded], held, axis=1)
            shared[0] |= np.concatenate(flags)
            at = 0
            for b, mine in zip(blocks, seeds, strict=True):
                here = _packed(*np.packbits(shared[:, at : at + len(mine)], axis=1))
                at += len(mine)
                yield from rows.add((r, b, 1, here), len(here))
        yield from rows.rest()

    return answer


def _chosen(block: Block, notes: list[dict], bits: int) -> np.ndarray:
    """The block's minimisers that the ranges found in several documents, crowded ones cut up."""
    seeds = np.unique(block.seed)
    answers = {n["r"]: n["note"] for n in notes if n["kind"] == 1}
    kept = np.zeros((2, len(seeds)), bool)
    for r, part in _split(seeds, bits):
        kept[:, part] = [np.unpackbits(a, count=part.stop - part.start) for a in _unpacked(answers[r], np.uint8, np.uint8)]
    shared, crowded = kept[0], kept[0] & kept[1]
    return np.union1d(seeds[shared & ~crowded], block.single(seeds[crowded]))


def _tell_pieces(bits: int):
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(NOTES, most_bytes=4 << 20)
        for batch in batches:
            for b, ids, lens, body, notes in zip(*(values(batch.column(i)) for i in range(5)), strict=True):
                block = Block(ids, lens, body)
                texts, seeds, owners, _ = block.pieces(_chosen(block, notes or [], bits))
                for r, part in _split(seeds, bits):
                    mine = texts[part]
                    sizes = np.fromiter(map(len, mine), np.int32, len(mine))
                    note = _packed(seeds[part], sizes, owners[part], np.frombuffer(b"".join(mine), np.uint8))
                    yield from rows.add((r, b, 2, note), len(note))
        yield from rows.rest()

    return tell


def _searched(texts: list[bytes], seeds: np.ndarray, owners: np.ndarray) -> dict[int, np.ndarray]:
    """The smallest documents of the windows of pieces that share a minimiser, some at a time."""
    order = np.argsort(seeds, kind="stable")
    border = np.flatnonzero(np.append(True, seeds[order][1:] != seeds[order][:-1]))
    found: dict[int, np.ndarray] = {}
    batch, held = [], 0

    def search() -> None:
        if batch:
            found.update(zip(batch, least_owners([texts[i] for i in batch], owners[batch], LENGTH), strict=True))

    for a, z in zip(border, [*border[1:], len(order)], strict=True):
        if z - a > 1:
            group = order[a:z].tolist()
            batch += group
            held += sum(len(texts[i]) for i in group)
            if held >= SEARCH_BYTES:
                search()
                batch, held = [], 0
    search()
    return found


def _answer_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To each block, windows of its pieces that a document smaller than its own has."""
    rows = Rows(NOTES, most_bytes=4 << 20)
    for r, blocks, notes in _by_range(batches):
        numbers: dict[bytes, int] = {}
        given = []
        for note in notes:
            seeds, sizes, owners, text = _unpacked(note, np.uint64, np.int32, np.int64, np.uint8)
            text, ends = text.tobytes(), np.cumsum(sizes)
            mine = [
                numbers.setdefault(text[z - n : z], len(numbers))
                for z, n in zip(ends.tolist(), sizes.tolist(), strict=True)
            ]
            given.append((np.array(mine, np.int64), seeds, owners))
        least, key = np.full(len(numbers), FAR), np.zeros(len(numbers), np.uint64)
        for mine, seeds, owners in given:
            np.minimum.at(least, mine, owners)
            key[mine] = seeds
        found = _searched(list(numbers), key, least)
        for b, (mine, _, owners) in zip(blocks, given, strict=True):
            answer = []
            for i, (number, own) in enumerate(zip(mine.tolist(), owners.tolist(), strict=True)):
                windows = found.get(number)
                if windows is None:
                    if least[number] < own:
                        answer.append((i, 0, MOST_WINDOWS, least[number]))
                elif windows.min() < own:
                    change = np.flatnonzero(windows[1:] != windows[:-1]) + 1
                    for a, z in zip([0, *change], [*change, len(windows)], strict=True):
                        if windows[a] < own:
                            answer.append((i, a, z, windows[a]))
            if answer:
                note = _packed(np.array(answer, np.int64))
                yield from rows.add((r, b, 2, note), len(note))
    yield from rows.rest()


def _covered(block: Block, notes: list[dict], bits: int) -> np.ndarray:
    """Which bytes of the block lie in a string a smaller document has."""
    _, seeds, owners, occurrences = block.pieces(_chosen(block, notes or [], bits))
    marks = np.zeros(len(block.body) + 1, np.int32)
    number, segment = occurrences[:, 0], occurrences[:, 1]
    doc, start, count = block.ids[block.doc[segment]], block.start[segment], block.count[segment]

    def mark(which: np.ndarray, first: np.ndarray, end: np.ndarray) -> None:
        np.add.at(marks, start[which] + first, 1)
        np.add.at(marks, start[which] + end + LENGTH - 1, -1)

    # a smaller document of this block has the whole piece
    own = np.flatnonzero(owners[number] < doc)
    mark(own, np.zeros(len(own), np.int64), count[own])
    answers = {n["r"]: n["note"] for n in notes if n["kind"] == 2}
    told = []
    for r, part in _split(seeds, bits):
        if r in answers:
            (answer,) = _unpacked(answers[r], np.int64)
            answer = answer.reshape(-1, 4).copy()
            answer[:, 0] += part.start
            told.append(answer)
    if told:
        told = np.concatenate(told)
        told = told[np.argsort(told[:, 0], kind="stable")]
        first, last = (np.searchsorted(told[:, 0], number, side) for side in ("left", "right"))
        which = np.repeat(np.arange(len(number)), last - first)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(last - first) - last, last - first)
        kept = told[rows, 3] < doc[which]
        which, rows = which[kept], rows[kept]
        mark(which, told[rows, 1], np.minimum(told[rows, 2], count[which]))
    return np.cumsum(marks[:-1]) > 0


REMOVED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("removed", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
        ("kept", pa.binary()),
    ]
)


def _mark(bits: int):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(REMOVED, most_bytes=4 << 20)
        for batch in batches:
            for _, ids, lens, body, notes in zip(*(values(batch.column(i)) for i in range(5)), strict=True):
                block = Block(ids, lens, body)
                gone, x = _covered(block, notes or [], bits), np.frombuffer(block.body, np.uint8)
                for doc, size, end in zip(block.ids.tolist(), block.lens.tolist(), block.ends.tolist(), strict=True):
                    here = gone[end - size : end]
                    edges = np.flatnonzero(np.diff(here, prepend=False, append=False)).tolist()
                    spans = [{"start": a, "length": z - a} for a, z in zip(edges[::2], edges[1::2], strict=True)]
                    kept = x[end - size : end][~here].tobytes() if spans else block.body[end - size : end]
                    yield from rows.add((None if doc == FAR else doc, size, spans, kept), size)
        yield from rows.rest()

    return mark


# --- the operator ------------------------------------------------------------------


def _bucketed(blocks: DataFrame, work: Workspace, buckets: int) -> DataFrame:
    """``blocks`` as a table bucketed by block number, in the shared folder."""
    spark: SparkSession = blocks.sparkSession
    name = f"blocks_{uuid4().hex}"
    blocks.write.bucketBy(buckets, "b").option("path", work.new_path("blocks")).option(
        "compression", "uncompressed"
    ).saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved now; the name is not needed any more, the files are
    spark.sql(f"DROP TABLE {name}")
    return table


def remove_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """What is left of every row of ``docs`` without passages of smaller documents.

    A text is its UTF-8 bytes, null is empty.  A byte goes if a 50-byte string of
    its document that covers it also starts in a document with a smaller id;
    strings are judged on the texts as given and never cross documents.  Returns
    ``doc_id``, ``n_bytes``, ``removed`` (start and length of the maximal runs) and
    ``kept`` (the remaining bytes).  Null ids count as larger than all others, rows
    with one id do not remove from each other.  Texts under 50 bytes stay whole.
    Other columns are not read; an empty table gives an empty result.  ``crowd``
    changes how the work spreads, not the result.
    """
    spark = docs.sparkSession
    work = Workspace(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _bucketed(
        docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
            _blocked, "b long, n long, ids binary, lens binary, body binary"
        ),
        work,
        parts,
    )
    size = blocks.agg(F.sum("n")).first()[0] or 0
    seeds = 2 * size // (LENGTH - SEED_BYTES + 2)
    bits = max(0, (seeds // RANGE_ROWS).bit_length())
    block = blocks.select("b", "ids", "lens", "body")

    def told(notes: DataFrame, answer) -> DataFrame:
        """Notes of a range meet in a task, which answers."""
        return stage(
            notes.repartition(parts, "r").sortWithinPartitions("r", "b").mapInArrow(answer, NOTES_SQL), "notes", work
        )

    def with_notes(notes: DataFrame) -> DataFrame:
        mine = notes.groupBy("b").agg(F.collect_list(F.struct("r", "kind", "note")).alias("notes"))
        return block.join(mine, "b", "left")

    shared = told(block.mapInArrow(_tell_seeds(bits), NOTES_SQL), _answer_seeds(crowd))
    least = told(with_notes(shared).mapInArrow(_tell_pieces(bits), NOTES_SQL), _answer_pieces)
    return with_notes(shared.unionByName(least)).mapInArrow(
        _mark(bits),
        "doc_id long, n_bytes long, removed array<struct<start: long, length: long>>, kept binary",
    )
