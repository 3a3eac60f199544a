"""Alignment of two tokenizers over the same bytes, and how steadily it links their ids.

A text with a space before it is encoded by a byte-level vocabulary (A), the text by
a sentencepiece model that adds the space itself (B).  A gives character offsets, B's
proto gives byte spans.  Both are coarse: the tokens of a character that A cuts apart
all report the whole character, and B's byte-fallback tokens report nothing until the
last.  A token whose span is as long as its decoded bytes ends where the span ends;
the others are refined by adding up decoded bytes since the last such end.

Neither tokenizer has a token that goes on over a single space between two other
characters, so texts are cut into words there.  Words are aligned many at once, as one
text, and a word's alignment is remembered for the next document.

Offsets where a token of A and one of B end together cut the tokens into groups.  No
entry of a vocabulary is empty, so exactly one token of each ends at a cut: a group
is one link, between its last token of A and its last token of B.

The ends of linked tokens agree, so one's bytes are the end of the other's.  Every
entry has as many ends as bytes, hence the table of linked id pairs has at most as
many rows as both vocabularies have bytes, whatever the corpus; that table alone is
sent to all tasks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.packing import byte_letters
from encore.llm.tables import once_per_worker, stage, values
from encore.sources.staging import Workspace

SPACE_PIECE = "▁"
# a single space between two characters that are no white space
BORDER = re.compile(r" (?<=\S )(?=\S)")
# words a worker learns, 230 bytes each, before it forgets those it has not met since the last time
REMEMBERED_WORDS = 500_000
LONGEST_REMEMBERED = 64
# characters of new words that are encoded as one text
BATCH_CHARS = 1 << 16
# characters that are aligned, links that are counted, and bytes of packed groups that are written at once
HELD_CHARS = 1 << 18
HELD_LINKS = 1 << 18
HELD_BYTES = 1 << 18

ALIGNED = pa.schema([("doc_id", pa.int64()), ("body", pa.binary()), ("pair", pa.int64()), ("n", pa.int64())])
ALIGNED_SQL = "doc_id long, body binary, pair long, n long"
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
SCORED = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in NUMBERS), ("alignment", pa.string())])
SCORED_SQL = ", ".join(["doc_id long", *(f"{c} long" for c in NUMBERS), "alignment string"])

NOTHING = np.zeros(0, np.int64)


# --- two tokenizers over one text --------------------------------------------------


def refined(start: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte offsets where tokens end, from coarse byte spans and the lengths of decoded bytes."""
    settled = end - start == size
    told = np.cumsum(size)
    last = np.maximum.accumulate(np.where(settled, np.arange(len(size)), -1))
    base = np.where(last >= 0, end[last] - told[last], 0)
    return base + told


class Aligner:
    """Both tokenizers, their entries' bytes, and groups of their tokens."""

    def __init__(self, byte_level: str, pieces: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        with open(byte_level, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["normalizer"] or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError(f"not a plain byte-level vocabulary: {byte_level}")
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=pieces)

        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            plain = all(c in byte_of for c in token)
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if plain else token.encode()
        self.b_bytes = []
        self.cuttable = True
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            # a piece with a space inside would go on over a border
            self.cuttable &= SPACE_PIECE not in piece.lstrip(SPACE_PIECE)
            whole = bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE_PIECE, " ").encode()
            self.b_bytes.append(whole)
        # per word its counts of A's tokens, B's tokens and groups, A's ids, B's ids, and how many
        # of each every group has, as 32-bit integers; None for a word that is not given back
        self.known: dict[str, bytes | None] = {}
        self.before: dict[str, bytes | None] = {}
        self.a_size, self.b_size = (np.array([*map(len, x)]) for x in (self.a_bytes, self.b_bytes))

    def words(self, text: str) -> list[str]:
        """``text`` cut at every border; an empty text has no words."""
        if not text:
            return []
        return BORDER.split(text) if self.cuttable else [text]

    def spans_a(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and ends of A's tokens, from character offsets."""
        encoding = self.a.encode(text, add_special_tokens=False)
        ids = np.array(encoding.ids, np.int64)
        spans = np.fromiter(chain.from_iterable(encoding.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        if not text.isascii():
            code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            wide = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
            spans = np.concatenate([[0], np.cumsum(wide)])[spans]
        return ids, refined(spans[:, 0], spans[:, 1], self.a_size[ids])

    def spans_b(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and ends of B's tokens, from the proto's byte spans; B adds the first space itself."""
        found = [(piece.id, piece.end) for piece in self.b.encode(text[1:], return_type="proto").pieces]
        if not found:
            return NOTHING, NOTHING
        ids, end = np.array(found, np.int64).T
        # spans leave no gap; B's text lacks the space
        start = np.concatenate([[0], end[:-1]])
        return ids, refined(start + 1, end + 1, self.b_size[ids])

    def _learn(self, words: list[str]) -> None:
        """Align words, encoded as one text: a border is an end of both, so every group is in one word."""
        text = " " + " ".join(words)
        whole = text.encode()
        a_ids, a_ends = self.spans_a(text)
        b_ids, b_ends = self.spans_b(text)
        given_back = (
            b"".join(map(self.a_bytes.__getitem__, a_ids.tolist())) == whole
            and b"".join(map(self.b_bytes.__getitem__, b_ids.tolist())) == whole
        )
        if not given_back:
            if len(words) == 1:
                self.known[words[0]] = None
            else:
                for word in words:
                    self._learn([word])
            return
        ends = np.zeros(len(whole) + 1, np.int8)
        ends[a_ends] += 1
        ends[b_ends] += 2
        a_upto, b_upto = (np.flatnonzero(ends[x] == 3) + 1 for x in (a_ends, b_ends))
        # groups, and with them tokens, up to the end of every word
        at = np.searchsorted(a_ends[a_upto - 1], np.cumsum([len(w.encode()) + 1 for w in words]), "right")
        counts = [np.diff(x, prepend=0) for x in (a_upto[at - 1], b_upto[at - 1], at)]
        lists = [a_ids, b_ids, np.diff(a_upto, prepend=0), np.diff(b_upto, prepend=0)]
        ends = np.cumsum(counts[0] + counts[1] + 2 * counts[2] + 3)
        begin = np.concatenate([[0], ends[:-1]])
        out = np.zeros(ends[-1], np.int32)
        for i, count in enumerate(counts):
            out[begin + i] = count
        begin += 3
        for numbers, count in zip(lists, (*counts, counts[2]), strict=True):
            out[_runs(begin, count)] = numbers
            begin += count
        packed, ends = out.tobytes(), (4 * ends).tolist()
        self.known.update((w, packed[a:z]) for w, a, z in zip(words, [0, *ends], ends))

    def _remember(self, words: set[str]) -> set[str]:
        """Make all words known; those that are too long to keep are returned."""
        if len(self.known) >= REMEMBERED_WORDS:
            self.before, self.known = self.known, {}
        fresh = words.difference(self.known)
        again = fresh.intersection(self.before)
        self.known.update((w, self.before[w]) for w in again)
        together, held = [], 0
        for word in fresh - again:
            # white space at an end could join a neighbour's
            if not self.cuttable or word[0].isspace() or word[-1].isspace():
                self._learn([word])
                continue
            together.append(word)
            held += len(word)
            if held >= BATCH_CHARS:
                self._learn(together)
                together, held = [], 0
        if together:
            self._learn(together)
        return {w for w in fresh if len(w) > LONGEST_REMEMBERED}

    def align(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """A's ids, B's ids and the groups' sizes in both: four lists, a run of each per text; and the runs' lengths.

        A text that is empty or not given back has none.
        """
        cut = [self.words(text) for text in texts]
        long = self._remember(set().union(*cut))
        found, upto = [], []
        for words in cut:
            here = [*map(self.known.__getitem__, words)]
            if None not in here:
                found += here
            upto.append(len(found))
        for word in long:
            del self.known[word]
        packed = np.frombuffer(b"".join(found), np.int32)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(size) - size
        counts = [packed[begin + i] for i in (0, 1, 2, 2)]
        begin += 3
        lists = []
        for count in counts:
            lists.append(packed[_runs(begin, count)])
            begin += count
        return lists, [_shares(count, np.array(upto, np.int64)) for count in counts]

    def pair(self, a_ids: np.ndarray, b_ids: np.ndarray) -> np.ndarray:
        return _pair(a_ids, b_ids, len(self.b_bytes))


def _runs(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places of consecutive runs: ``count`` from each ``begin``."""
    count = count.astype(np.int64)
    return np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())


def _shares(numbers: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs that end at ``ends``."""
    return np.diff(np.concatenate([[0], np.cumsum(numbers, dtype=np.int64)])[ends], prepend=0)


def _pair(a_ids: np.ndarray, b_ids: np.ndarray, b_entries: int) -> np.ndarray:
    return a_ids.astype(np.int64) * b_entries + b_ids


def _last(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The last id of every group."""
    return ids[np.cumsum(sizes) - 1]


class Tally:
    """Counts of id pairs; at most one entry a pair that the vocabularies allow."""

    def __init__(self):
        self.pairs, self.n = NOTHING, NOTHING
        self.fresh: list[np.ndarray] = []
        self.held = 0

    def add(self, pairs: np.ndarray) -> None:
        self.fresh.append(pairs)
        self.held += len(pairs)
        if self.held >= HELD_LINKS:
            self.settle()

    def settle(self) -> None:
        pairs, n = np.unique(np.concatenate([NOTHING, *self.fresh]), return_counts=True)
        both = np.concatenate([self.pairs, pairs])
        self.pairs, where = np.unique(both, return_inverse=True)
        total = np.zeros(len(self.pairs), np.int64)
        np.add.at(total, where, np.concatenate([self.n, n]))
        self.n, self.fresh, self.held = total, [], 0


def _bodies(lists: list[np.ndarray], lengths: list[np.ndarray]) -> list[bytes]:
    """Each text's lengths and lists, packed."""
    lists = [x.astype(np.int32, copy=False) for x in lists]
    ends = [np.cumsum(x).tolist() for x in lengths]
    heads = np.stack(lengths, axis=1).astype(np.int32)
    pack, bodies, at = zstandard.ZstdCompressor(level=1).compress, [], [0] * len(lists)
    for head, *to in zip(heads, *ends, strict=True):
        parts = [x[a:z].tobytes() for x, a, z in zip(lists, at, to, strict=True)]
        bodies.append(pack(head.tobytes() + b"".join(parts)))
        at = to
    return bodies


def _aligned(byte_level: str, pieces: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = once_per_worker(f"aligner {byte_level} {pieces}", lambda: Aligner(byte_level, pieces))
        tally = Tally()

        def done(docs: list, texts: list[str]) -> pa.RecordBatch:
            lists, lengths = aligner.align(texts)
            a_ids, b_ids, a_sizes, b_sizes = lists
            tally.add(aligner.pair(_last(a_ids, a_sizes), _last(b_ids, b_sizes)))
            bodies = pa.array(_bodies(lists, lengths), pa.binary())
            none = pa.nulls(len(docs), pa.int64())
            return pa.record_batch([pa.array(docs, pa.int64()), bodies, none, none], schema=ALIGNED)

        for batch in batches:
            docs, texts, held = [], [], 0
            for doc, text in zip(values(batch.column(0)), values(batch.column(1), ""), strict=True):
                docs.append(doc)
                texts.append(text)
                held += len(text)
                if held >= HELD_CHARS:
                    yield done(docs, texts)
                    docs, texts, held = [], [], 0
            if docs:
                yield done(docs, texts)
        tally.settle()
        none = pa.nulls(len(tally.pairs))
        yield pa.record_batch([none.cast(pa.int64()), none.cast(pa.binary()), tally.pairs, tally.n], schema=ALIGNED)

    return align


# --- scores ------------------------------------------------------------------------


class Writer:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, a_entries: int, b_entries: int):
        # an id with what follows it inside its group and at its end
        self.a = np.array([f"{i}{end}" for i in range(a_entries) for end in ",|"], object)
        self.b = np.array([f"{i}{end}" for i in range(b_entries) for end in ",;"], object)

    def parts(self, a_ids, b_ids, a_sizes, b_sizes) -> np.ndarray:
        """Ids in order of groups, A's before B's, each with what follows it."""
        a_upto, b_upto = np.cumsum(a_sizes), np.cumsum(b_sizes)
        a_code, b_code = 2 * a_ids, 2 * b_ids
        a_code[a_upto - 1] += 1
        b_code[b_upto - 1] += 1
        parts = np.empty(len(a_ids) + len(b_ids), object)
        parts[np.arange(len(a_ids)) + np.repeat(b_upto - b_sizes, a_sizes)] = self.a[a_code]
        parts[np.arange(len(b_ids)) + np.repeat(a_upto, b_sizes)] = self.b[b_code]
        return parts


def _scored(a_entries: int, b_entries: int, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = once_per_worker(f"writer {a_entries} {b_entries}", lambda: Writer(a_entries, b_entries))

        def scored(docs: list, bodies: list[bytes]) -> pa.RecordBatch:
            unpacked = [np.frombuffer(zstandard.decompress(body), np.int32) for body in bodies]
            lengths = np.array([x[:4] for x in unpacked], np.int64).T
            cuts = 4 + np.cumsum(lengths, axis=0)
            lists = [
                np.concatenate([x[end - n : end] for x, end, n in zip(unpacked, *y, strict=True)])
                for y in zip(cuts, lengths, strict=True)
            ]
            a_ids, b_ids, a_sizes, b_sizes = lists
            at = np.searchsorted(pairs, _pair(_last(a_ids, a_sizes), _last(b_ids, b_sizes), b_entries))
            group_ends = np.cumsum(lengths[2])
            parts, ends = writer.parts(*lists), np.cumsum(lengths[0] + lengths[1]).tolist()
            texts = ["".join(parts[a:z].tolist())[:-1] for a, z in zip([0, *ends], ends)]
            numbers = [*lengths[:3], lengths[2], *(_shares(x[at], group_ends) for x in (best.astype(np.int64), counts))]
            return pa.record_batch([pa.array(docs, pa.int64()), *numbers, pa.array(texts, pa.string())], schema=SCORED)

        for batch in batches:
            docs, bodies, held = [], [], 0
            for doc, body in zip(values(batch.column(0)), values(batch.column(1)), strict=True):
                docs.append(doc)
                bodies.append(body)
                held += len(body)
                if held >= HELD_BYTES:
                    yield scored(docs, bodies)
                    docs, bodies, held = [], [], 0
            if docs:
                yield scored(docs, bodies)

    return score


def align(docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's groups of tokens of two vocabularies that end together, and its links' counts.

    ``byte_level`` is the path of a byte-level vocabulary, ``pieces`` that of a
    sentencepiece model which adds a space.  Special tokens' strings are plain text.
    Returns ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose
    id pair is the most linked one of its B id, ties included), ``count_sum`` (over
    its links, how many links of the whole table have their pair) and ``alignment``,
    the groups as ``a1,a2|b1;a3|b2,b3``.  A text that is null or empty, or whose bytes
    a tokenizer does not give back, has no tokens: zeros and an empty alignment.  Every
    row is aligned and counted on its own, repeats alike, null ids kept; other columns
    are not read; an empty table gives an empty result.
    """
    work = Workspace(docs.sparkSession)
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("_doc"), F.col(f"`{text}`").alias("_text"))
    aligned = stage(given.mapInArrow(_aligned(byte_level, pieces), ALIGNED_SQL), "aligned", work)
    # at most one row per byte of both vocabularies, see above
    counts = aligned.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n")).orderBy("pair").toArrow()
    pairs, n = (counts.column(c).to_numpy().astype(np.int64) for c in ("pair", "n"))
    aligner = Aligner(byte_level, pieces)
    b_entries = len(aligner.b_bytes)
    most = np.zeros(b_entries, np.int64)
    np.maximum.at(most, pairs % b_entries, n)
    score = _scored(len(aligner.a_bytes), b_entries, pairs, n, n == most[pairs % b_entries])
    return aligned.where("pair IS NULL").select("doc_id", "body").mapInArrow(score, SCORED_SQL)
