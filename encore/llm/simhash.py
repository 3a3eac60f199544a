"""SimHash near-duplicates with a hierarchical index over Gray-ordered fingerprints.

Fingerprints that differ in at most 3 of 64 bits agree in at least one of four
16-bit blocks.  The agreed block is the uppermost masked pattern: distinct
fingerprints are shuffled by it, sorted by Gray rank, and indexed in the task.
In the index every run of eight neighbours has a node that holds the bits they
all share; bits shared higher up are left out below.  A search adds up the
differences from node to node and drops a whole run when there are more than
three, or when all of it is already known to belong together.

A block value shared by very many fingerprints is split again: what is left are
48 bits, of which one of four 12-bit parts has to agree.

Wider distances take one block more than bits may differ, so that one block always
agrees; below it the same holds for the parts of the other bits.

Near copies lie too far apart for that: blocks get so short that a key's share of all
fingerprints does not shrink as the corpus grows, and unrelated fingerprints come
close by chance.  Their keys are minimal hashes of five-word shingles instead, which
only texts with common shingles share.  Below a key the same index searches the
fingerprints, and a link counts only if a second sketch, of hashes that are not the
fingerprint's, agrees; then groups are compared by their sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.components import components
from encore.llm.tables import Rows, numbered, stage, values
from encore.sources.staging import Workspace

MOST_DIFFERENT = 3
SHINGLE_WORDS = 3
SEED = 42
# a block key: the block's number above its bits; a part key has these bits below the block key
BLOCK_BITS = 16
PART_BITS = 12
NUMBER_BITS = 4
HOT_MARK = 1 << 62
RUN = 8
# fingerprints with one block value beyond which the value is split
HOT = 20_000
# pairs a search step may look at together
FRONTIER = 1 << 21
BATCH = 1 << 17

# near copies: sets of five-word shingles, searched for by fingerprints that differ in so many bits
SET_WORDS = 5
SIMILAR = 0.8
SEARCHED_BITS = 14
# minimal hashes of a text's set: so many are keys, so many make its sketch, of 16 bits each,
# and so many of those have to agree; of two texts with a similarity of 0.8, 99.85 % do
KEY_SLOTS = 8
SKETCH_SLOTS = 16
LEAST_ALIKE = 8
# fingerprints of a key that are searched as a whole, not part by part
WHOLE = 64
# texts and shingles of a tile's side; larger groups are compared tile by tile
TILE_TEXTS = 256
TILE_SHINGLES = 200_000
COLUMNS = 4096

PRINTS = pa.schema([("_doc", pa.int64()), ("_fp", pa.int64()), ("_row", pa.int64())])
LANES = [f"_lane{i}" for i in range(SKETCH_SLOTS // 4)]
SKETCHES = pa.schema(
    [*PRINTS, *((lane, pa.int64()) for lane in LANES), ("_mins", pa.list_(pa.int64()))]
)
SETS = pa.schema([("_row", pa.int64()), ("_group", pa.int64()), ("_n", pa.int64()), ("_set", pa.binary())])


# --- fingerprints ----------------------------------------------------------------


def shingles(text: str, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of a text's shingles in their order, as often as they occur."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    last = ends[min(len(words), size) - 1 :]
    return np.fromiter(
        (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)),
        np.uint64,
        n,
    )


def fingerprint(text: str, size: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text as an unsigned number; 0 without words."""
    hashes = shingles(text, size)
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        part = hashes[at : at + 8192]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(size: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(PRINTS)
        for batch in batches:
            ids, texts, numbers = batch.columns
            for doc, text, row in zip(values(ids), values(texts, ""), values(numbers), strict=True):
                value = fingerprint(text, size)
                yield from rows.add((doc, value - (1 << 64) if value >> 63 else value, row))
        yield from rows.rest()

    return prints


# --- the index -------------------------------------------------------------------


def _levels(codes: np.ndarray, groups: np.ndarray) -> list[tuple]:
    """Nodes from the roots down: shared bits, their values, first child, last leaf, group.

    ``codes`` are sorted by group, then Gray rank.  A root per group; the masks
    of a level hold only bits that no level above holds.
    """
    ones, zeros, owners = codes, ~codes, groups
    leaves = np.arange(len(codes) + 1)
    levels = []
    while True:
        change = np.flatnonzero(np.diff(owners)) + 1
        begin = np.concatenate([[0], change])
        within = np.arange(len(owners)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(owners)]])))
        starts = np.flatnonzero(within % RUN == 0)
        ones = np.bitwise_and.reduceat(ones, starts)
        zeros = np.bitwise_and.reduceat(zeros, starts)
        children = np.concatenate([starts, [len(owners)]])
        leaves = leaves[children]
        owners = owners[starts]
        levels.append((ones | zeros, ones, children, leaves, owners))
        if len(owners) == len(begin):
            break
    return levels[::-1]


class GrayIndex:
    """Finds which of the indexed fingerprints belong together, group by group."""

    def __init__(self, codes: np.ndarray, groups: np.ndarray, most: int = MOST_DIFFERENT, accept=None):
        self.codes, self.most, self.accept = codes, most, accept
        self.levels = _levels(codes, groups)
        self.labels = np.arange(len(codes))
        self.roots = np.repeat(np.arange(len(self.levels[0][4])), np.diff(self.levels[0][3]))
        self.sizes = np.diff(self.levels[0][3])[self.roots]

    def link(self) -> np.ndarray:
        """The smallest position each fingerprint is linked to, at most ``most`` bits a step."""
        at, n = 0, len(self.codes)
        while at < n:
            budget = np.cumsum(self.sizes[at:])
            step = max(1, int(np.searchsorted(budget, FRONTIER, "right")))
            self._search(np.arange(at, min(n, at + step)))
            at += step
        return self.labels

    def _search(self, queries: np.ndarray) -> None:
        node, distance = self.roots[queries], np.zeros(len(queries), np.int64)
        above = np.zeros(len(queries), np.uint64)
        spans = self._spans()
        for depth, (mask, ones, children, leaves, _) in enumerate(self.levels):
            code = self.codes[queries]
            distance = distance + np.bitwise_count((code ^ ones[node]) & mask[node] & ~above)
            least, most = spans[depth]
            own = self.labels[queries]
            known = (least[node] == own) & (most[node] == own)
            # only partners further on, so that a pair is met once
            open_ = (distance <= self.most) & (leaves[node + 1] > queries + 1) & ~known
            queries, node, distance = queries[open_], node[open_], distance[open_]
            above = mask[node]
            fan = children[node + 1] - children[node]
            first = np.repeat(children[node] - (np.cumsum(fan) - fan), fan)
            queries, distance, above = (np.repeat(x, fan) for x in (queries, distance, above))
            node = first + np.arange(len(first))
        distance = distance + np.bitwise_count((self.codes[queries] ^ self.codes[node]) & ~above)
        near = (distance <= self.most) & (node > queries)
        queries, node = queries[near], node[near]
        if self.accept is not None:
            accepted = self.accept(queries, node)
            queries, node = queries[accepted], node[accepted]
        _unite(self.labels, queries, node)

    def _spans(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Smallest and largest label under every node."""
        return [
            (np.minimum.reduceat(self.labels, leaves[:-1]), np.maximum.reduceat(self.labels, leaves[:-1]))
            for _, _, _, leaves, _ in self.levels
        ]


def _unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give what ``a`` and ``b`` link pair by pair one label, the smallest."""
    while True:
        left, right = labels[a], labels[b]
        differ = left != right
        if not differ.any():
            return
        a, b, left, right = a[differ], b[differ], left[differ], right[differ]
        np.minimum.at(labels, np.maximum(left, right), np.minimum(left, right))
        while True:
            further = labels[labels]
            if np.array_equal(further, labels):
                break
            labels[:] = further


def _complete(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Whole groups of (key, code, node, ...) rows that come sorted by key, some at a time."""
    held: list[tuple[np.ndarray, ...]] = []
    count = 0
    for batch in batches:
        held.append(tuple(column.to_numpy() for column in batch.columns))
        count += batch.num_rows
        if count >= BATCH:
            joined = tuple(map(np.concatenate, zip(*held, strict=True)))
            cut = int(np.searchsorted(joined[0], joined[0][-1]))  # where the last key begins
            if cut:
                yield tuple(x[:cut] for x in joined)
            held, count = [tuple(x[cut:] for x in joined)], len(joined[0]) - cut
    if count:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _cuts(bits: int, most: int) -> list[tuple[int, int]]:
    """Lowest bit and width of one part more than bits may differ, four parts at least."""
    parts = max(most, MOST_DIFFERENT) + 1
    edges = [bits * i // parts for i in range(parts + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _rest_bits(most: int) -> int:
    return 64 - min(width for _, width in _cuts(64, most))


def _labels(keys: np.ndarray, codes: np.ndarray, most: int) -> np.ndarray:
    """Which fingerprints of each key belong together.

    Beyond 3 bits a block holds too few bits to search all that share it: each key
    is searched part by part, and partners agree in one part.
    """
    if most <= MOST_DIFFERENT:
        return GrayIndex(codes, keys, most).link()
    labels = np.arange(len(codes))
    groups = np.cumsum(np.concatenate([[0], np.diff(keys) != 0]))
    split = keys >= HOT_MARK
    blocks = np.array(_cuts(64, most), np.uint64)
    low, width = blocks[np.where(split, 0, keys >> BLOCK_BITS)].T
    rest = codes & ((np.uint64(1) << low) - np.uint64(1)) | codes >> low >> width << low
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    for number, (low, width) in enumerate(_cuts(_rest_bits(most), most)):
        part = (rest >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)
        # keys that are split already are searched once, as they are
        within = groups << PART_BITS | np.where(split, 0, part)
        chosen = np.flatnonzero(~split) if number else np.arange(len(codes))
        order = chosen[np.lexsort((rank[chosen], within[chosen]))]
        if len(order):
            found = GrayIndex(codes[order], within[order], most).link()
            _unite(labels, order, order[found])
    return labels


def _link(most: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, codes, nodes in _complete(batches):
            labels = _labels(keys, codes.view(np.uint64), most)
            linked = np.flatnonzero(labels != np.arange(len(labels)))
            # a forest: one link fewer than members, whatever the number of pairs
            yield pa.record_batch([pa.array(nodes[linked]), pa.array(nodes[labels[linked]])], names=["a", "b"])

    return link


# --- the operator ------------------------------------------------------------------


def _gray_rank(code: Column) -> Column:
    """The position of a code in the reflected Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _bits(code: Column, low: int, count: int) -> Column:
    return F.shiftrightunsigned(code, low).bitwiseAND(F.lit((1 << count) - 1).cast("long"))


def _block_keys(code: Column, most: int) -> Column:
    """One key per block: the block's number and its bits."""
    return F.array(
        *[
            F.lit(i << BLOCK_BITS).cast("long").bitwiseOR(_bits(code, low, width))
            for i, (low, width) in enumerate(_cuts(64, most))
        ]
    )


def _part_keys(code: Column, key: Column, most: int) -> Column:
    """Keys below a block key: one for each part of the other bits."""
    blocks = _cuts(64, most)
    number = F.shiftright(key, BLOCK_BITS).cast("int")
    low, width = (F.array(*[F.lit(block[i]) for block in blocks])[number] for i in range(2))
    below = code.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), low) - 1)
    # the bits above the block, moved down over it; two shifts, as one of 64 would do nothing
    top = F.call_function("shiftrightunsigned", F.call_function("shiftrightunsigned", code, low), width)
    rest = below.bitwiseOR(F.call_function("shiftleft", top, low))
    return F.array(
        *[
            F.lit(HOT_MARK).cast("long")
            .bitwiseOR(F.shiftleft(key, PART_BITS + NUMBER_BITS))
            .bitwiseOR(F.lit(i << PART_BITS).cast("long"))
            .bitwiseOR(_bits(rest, at, bits))
            for i, (at, bits) in enumerate(_cuts(_rest_bits(most), most))
        ]
    )


def _keyed(distinct: DataFrame, most: int = MOST_DIFFERENT) -> DataFrame:
    """Fingerprints under each key where a partner has to be."""
    keyed = distinct.select("_fp", "_node", F.explode(_block_keys(F.col("_fp"), most)).alias("_key"))
    # at most one row per possible block value: 4 * 65,536 for 3 bits
    hot = keyed.groupBy("_key").count().where(F.col("count") > HOT).select("_key", F.lit(True).alias("_hot"))
    marked = keyed.join(F.broadcast(hot), "_key", "left")
    parts = _part_keys(F.col("_fp"), F.col("_key"), most)
    return marked.select(
        "_fp", "_node", F.explode(F.when(F.col("_hot"), parts).otherwise(F.array("_key"))).alias("_key")
    )


def _linked(rows: DataFrame, size: int, most: int, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of (id, text, row number) rows, and the group of each different one."""
    if not 0 <= most < 1 << NUMBER_BITS:
        raise ValueError("fingerprints are searched for up to 15 different bits")
    spark = rows.sparkSession
    prints = stage(rows.mapInArrow(_fingerprints(size), "_doc long, _fp long, _row long"), "fingerprints", work)
    # equal fingerprints are one node from here on, known by a number of its own
    distinct = stage(
        prints.groupBy("_fp")
        .agg(F.min("_doc").alias("_least"), F.count("*").alias("_n"))
        .withColumn("_node", F.monotonically_increasing_id()),
        "distinct",
        work,
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = (
        _keyed(distinct, most)
        .repartition(parts, "_key")
        .sortWithinPartitions("_key", _gray_rank(F.col("_fp")))
        .select("_key", "_fp", "_node")
        .mapInArrow(_link(most), "a long, b long")
    )
    found = components(links, work)
    joined = distinct.join(found, F.col("_node") == F.col("node"), "left").select(
        "_fp", "_least", "_n", F.coalesce("component", "_node").alias("_group")
    )
    return prints, stage(joined, "grouped", work)


def near_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    most_different: int = MOST_DIFFERENT,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint``, ``component_id``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case, shingles
    ``shingle_words`` words joined by spaces, each as often as it occurs; a text of
    fewer words is one shingle.  A text without words, empty or null, has fingerprint
    zero and is linked like any other.  Fingerprints that differ in at most
    ``most_different`` bits are linked; ``component_id`` is the smallest id reachable.
    Rows without an id take part under no id: they get the component of equal or
    linked fingerprints that have one, else null.  Repeated rows each give a row;
    other columns are not read; an empty table gives an empty result.
    """
    work = Workspace(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long"), F.col(text), F.lit(0).cast("long"))
    prints, joined = _linked(rows, shingle_words, most_different, work)
    # written, so that the join is one of two plain shuffles and a large group can be split
    least = stage(joined.groupBy("_group").agg(F.min("_least").alias("component_id")), "least", work)
    by_print = stage(joined.join(least, "_group").select("_fp", "component_id"), "components", work)
    return prints.join(by_print, "_fp").select(
        F.col("_doc").alias("doc_id"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# --- near copies -------------------------------------------------------------------


def _multipliers() -> np.ndarray:
    """An odd number per slot, by a fixed rule; each turns the hashes into another order."""
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(bytes([slot]), SEED) | 1 for slot in range(SKETCH_SLOTS)], np.uint64)


def minimal_hashes(hashes: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The smallest hash of a set in every slot's order; zeros without any."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max if len(hashes) else 0, np.uint64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192] * multipliers[:, None]
        least = np.minimum(least, part.min(axis=1))
    return least


def sketch(least: np.ndarray) -> np.ndarray:
    """Sixteen bits of every minimal hash, four to a number; the lowest bits of a minimum are still random."""
    return least.astype(np.uint16).view(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, multipliers = Rows(SKETCHES), _multipliers()
    for batch in batches:
        for doc, text, row in zip(*map(values, batch.columns), strict=True):
            text = text or ""
            code = np.uint64(fingerprint(text)).astype(np.int64)
            least = minimal_hashes(shingles(text, SET_WORDS), multipliers)
            yield from rows.add((doc, int(code), row, *sketch(least).tolist(), least[:KEY_SLOTS].astype(np.int64)))
    yield from rows.rest()


def _alike(lanes: np.ndarray, least: int = LEAST_ALIKE):
    """Whether the sketches of pairs of positions agree in so many slots."""

    def accept(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        agree = np.zeros(len(a), bool)
        for at in range(0, len(a), BATCH):
            here = slice(at, at + BATCH)
            apart = lanes[a[here]] ^ lanes[b[here]]
            agree[here] = (apart.view(np.uint16) == 0).sum(axis=1) >= least
        return agree

    return accept


def _sketch_labels(keys: np.ndarray, codes: np.ndarray, lanes: np.ndarray, most: int) -> np.ndarray:
    """Which fingerprints of each key belong together, by distance and sketch.

    A key of many fingerprints is searched part by part; partners agree in one part.
    """
    labels = np.arange(len(codes))
    groups = np.cumsum(np.concatenate([[0], np.diff(keys) != 0]))
    whole = np.bincount(groups)[groups] <= WHOLE
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    for number, (low, width) in enumerate(_cuts(64, most)):
        part = (codes >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)
        within = groups << BLOCK_BITS | np.where(whole, 0, part)
        chosen = np.flatnonzero(~whole) if number else np.arange(len(codes))
        if len(chosen):
            order = chosen[np.lexsort((rank[chosen], within[chosen]))]
            found = GrayIndex(codes[order], within[order], most, _alike(lanes[order])).link()
            _unite(labels, order, order[found])
    return labels


def _sketch_link(most: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, codes, nodes, *lanes in _complete(batches):
            labels = _sketch_labels(keys, codes.view(np.uint64), np.stack(lanes, axis=1), most)
            linked = np.flatnonzero(labels != np.arange(len(labels)))
            yield pa.record_batch([pa.array(nodes[linked]), pa.array(nodes[labels[linked]])], names=["a", "b"])

    return link


def _split(keyed: DataFrame, parts: Column, label: str, work: Workspace) -> DataFrame:
    """``keyed`` with the keys of more than ``HOT`` fingerprints replaced by their ``parts``."""
    hot = keyed.groupBy("_key").count().where(F.col("count") > HOT).select("_key", F.lit(True).alias("_hot"))
    marked = keyed.join(stage(hot, label, work), "_key", "left")
    keys = F.when(F.col("_hot"), parts).otherwise(F.array("_key"))
    return marked.withColumn("_key", F.explode(keys)).drop("_hot")


def _sketch_keyed(distinct: DataFrame, most: int, work: Workspace) -> DataFrame:
    """Fingerprints under each key where a partner is looked for.

    A key is one minimal hash.  One that very many share takes a second: partners with
    sketches that agree have several in common.  What still is too much are texts with
    largely the same shingles; there a block of the fingerprint has to agree as well.
    """
    keyed = distinct.select("*", F.posexplode("_mins").alias("_slot", "_min"))
    keyed = keyed.withColumn("_key", F.xxhash64("_slot", "_min"))

    def pair(least: Column, slot: Column) -> Column:
        ahead = F.struct(slot.alias("slot"), least.alias("least")) < F.struct("_slot", "_min")
        both = F.when(ahead, F.xxhash64(slot, least, "_slot", "_min"))
        return both.otherwise(F.xxhash64("_slot", "_min", slot, least))

    # the slot itself makes a key of equal halves that nobody needs
    second = F.filter(F.transform("_mins", pair), lambda _, slot: slot != F.col("_slot"))
    keyed = _split(keyed, second, "hot", work).drop("_mins", "_slot", "_min")
    blocks = F.transform(_block_keys(F.col("_fp"), most), lambda block: F.xxhash64("_key", block))
    return _split(keyed, blocks, "hotter", work)


def _candidates(prints: DataFrame, most: int, work: Workspace) -> DataFrame:
    """``_row`` and ``_group`` of the rows that links of fingerprint and sketch join to others."""
    known = ["_fp", *LANES]
    distinct = prints.groupBy(known).agg(F.min("_mins").alias("_mins"), F.count("*").alias("_n"))
    distinct = stage(distinct.withColumn("_node", F.monotonically_increasing_id()), "distinct", work)
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = (
        _sketch_keyed(distinct.drop("_n"), most, work)
        .select("_key", "_fp", "_node", *LANES)
        .repartition(parts, "_key")
        .sortWithinPartitions("_key")
        .mapInArrow(_sketch_link(most), "a long, b long")
    )
    found = components(links, work).select(F.col("node").alias("_node"), "component")
    # alone are texts without a link whose fingerprint and sketch no other row has
    grouped = (
        distinct.join(found, "_node", "left")
        .where("component IS NOT NULL OR _n > 1")
        .select(*known, F.coalesce("component", "_node").alias("_group"))
    )
    return prints.join(stage(grouped, "grouped", work), known).select("_row", "_group")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = Rows(SETS)
    for batch in batches:
        numbers, groups, texts = batch.columns
        for row, group, text in zip(values(numbers), values(groups), values(texts, ""), strict=True):
            held = np.unique(shingles(text, SET_WORDS))
            yield from rows.add((row, group, len(held), held.tobytes()), held.nbytes)
    yield from rows.rest()


def _similar(sets: list[np.ndarray], similar: float) -> np.ndarray:
    """The smallest position each set is linked to by pairs of so high a Jaccard similarity."""
    n, labels = len(sets), np.arange(len(sets))
    sizes = np.array([len(held) for held in sets])
    owners = np.repeat(np.arange(n), sizes)
    _, names, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = counts > 1
    columns = (np.cumsum(often) - 1)[names]
    owners, columns = owners[often[names]], columns[often[names]]
    order = np.argsort(columns, kind="stable")
    owners, columns = owners[order], columns[order]
    shared = np.zeros((n, n), np.int64)
    for first in range(0, int(often.sum()), COLUMNS):
        begin, end = np.searchsorted(columns, [first, first + COLUMNS])
        has = np.zeros((n, COLUMNS), np.float32)
        has[owners[begin:end], columns[begin:end] - first] = 1
        shared += (has @ has.T).astype(np.int64)
    least = Fraction(str(similar))
    either = sizes[:, None] + sizes[None, :] - shared
    a, b = np.nonzero(np.triu(shared * least.denominator >= either * least.numerator, 1))
    _unite(labels, a, b)
    return labels


def _compared(similar: float):
    """Links between the rows of each tile; rows come sorted by tile."""

    def links(tile: list[tuple[int, bytes]]) -> pa.RecordBatch:
        labels = _similar([np.frombuffer(held, np.uint64) for _, held in tile], similar)
        linked = np.flatnonzero(labels != np.arange(len(tile))).tolist()
        made = [[tile[i][0] for i in linked], [tile[labels[i]][0] for i in linked]]
        return pa.record_batch([pa.array(x, pa.int64()) for x in made], names=["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, at = [], None
        for batch in batches:
            for *key, row, held in zip(*map(values, batch.columns), strict=True):
                if key != at:
                    if len(tile) > 1:
                        yield links(tile)
                    tile, at = [], key
                tile.append((row, held))
        if len(tile) > 1:
            yield links(tile)

    return compare


def _copies(members: DataFrame, similar: float, work: Workspace) -> DataFrame:
    """``node`` and ``component`` of (``_row``, ``_group``, ``text``) rows similar to another of their group."""
    schema = "_row long, _group long, _n long, _set binary"
    sets = members.mapInArrow(_sets, schema).withColumn("_sha", F.sha2("_set", 256))
    sets = stage(sets, "sets", work)
    # equal sets are compared once, by their first row
    first = stage(sets.groupBy("_group", "_sha").agg(F.min("_row").alias("_first")), "first", work)
    equal = sets.select("_row", "_group", "_sha").join(first, ["_group", "_sha"])
    equal = equal.where("_row <> _first").select(F.col("_row").alias("a"), F.col("_first").alias("b"))
    firsts = first.select(F.col("_first").alias("_row"))
    different = stage(sets.join(firsts, "_row", "left_semi").drop("_sha"), "different", work)
    sides = F.greatest(F.ceil(F.count("*") / TILE_TEXTS), F.ceil(F.sum("_n") / TILE_SHINGLES)).cast("int")
    # groups of one tile need no row here: a row per TILE_TEXTS texts or TILE_SHINGLES shingles at most
    large = stage(different.groupBy("_group").agg(sides.alias("_sides")).where("_sides > 1"), "large", work)
    tiles = different.join(large, "_group", "left").withColumn("_sides", F.coalesce("_sides", F.lit(1)))
    tiles = tiles.withColumn("_side", F.pmod(F.xxhash64("_row"), F.col("_sides")).cast("int"))
    tiles = tiles.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_sides") - 1)))
    key = [F.col("_group"), F.least("_side", "_other").alias("_low"), F.greatest("_side", "_other").alias("_high")]
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = (
        tiles.select(*key, "_row", "_set")
        .repartition(parts, "_group", "_low", "_high")
        .sortWithinPartitions("_group", "_low", "_high")
        .mapInArrow(_compared(similar), "a long, b long")
    )
    return components(links.unionByName(equal), work)


def drop_near_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similar: float = SIMILAR,
    most_different: int = SEARCHED_BITS,
) -> DataFrame:
    """One row of every group of near copies stays: the smallest id, nulls last, then the first row.

    Near copies have sets of five-word shingles (by their 64-bit hashes; a shorter
    text is one shingle, texts without words are alike) with a Jaccard similarity of
    ``similar`` or more, and groups are what such pairs link.  Compared are all texts
    that links join: at most ``most_different`` bits between three-word fingerprints,
    and half of sixteen minimal hashes in common.  A pair that lies further apart and
    is not joined over others is missed; of pairs at 0.8 and more that is about one in
    a hundred.  Every row is told by a number of its own, so ids may be null or repeat;
    columns are kept; an empty table gives an empty one.
    """
    work = Workspace(docs.sparkSession)
    rows, row = numbered(docs, work)
    given = rows.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`"), F.col(row))
    lanes = ", ".join(f"{lane} long" for lane in LANES)
    prints = given.mapInArrow(_sketched, f"_doc long, _fp long, _row long, {lanes}, _mins array<long>")
    prints = stage(prints, "sketches", work)
    placed = stage(_candidates(prints, most_different, work), "placed", work)
    texts = rows.select(F.col(row).alias("_row"), F.col(f"`{text}`").alias("text"))
    found = _copies(placed.join(texts, "_row").select("_row", "_group", "text"), similar, work)
    found = stage(found, "copies", work)
    ids = prints.join(found, prints["_row"] == found["node"]).select("_row", "_doc", "component")
    order = F.struct(F.col("_doc").isNull(), "_doc", "_row")
    best = stage(ids.groupBy("component").agg(F.min(order)["_row"].alias("_row")), "best", work)
    goes = found.select(F.col("node").alias("_row")).join(best, "_row", "left_anti")
    return rows.join(goes, rows[row] == goes["_row"], "left_anti").drop(row)
