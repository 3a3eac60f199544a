"""Source divergence audit on a K-squared quadtree over the group-term count matrix.

A group is a (language, source) pair; the matrix of a language has a row per group
and a column per kept term.  It is cut into square tiles, and each tile is held as a
K-squared tree: a node is a quadrant, its bits say which of its four quadrants hold
a count, and only those have nodes of their own; the last level holds the counts'
probabilities.

The divergence of two groups is a sum over all columns.  Two tiles of the same
columns are traversed jointly for all pairs of their rows: where neither group has a
count in a quadrant, its columns all have the same price, which is multiplied, not
visited; the traversal goes on only below nodes that one of the two has.

Columns are ordered by falling frequency and rows by falling size, so that counts
crowd in few tiles and the rest is priced near the root.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.tables import stage
from encore.operators.ordering import global_index
from encore.sources.staging import Workspace

LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
# a tile has 2 ** LEVELS rows and columns
LEVELS = 7
# counts a task holds; beyond it they are sent on
HELD_TERMS = 300_000
# sums of tile pairs a task holds
HELD_PAIRS = 64

# fixed: bytes of words; A-Z become small letters, all other ASCII is a gap
GAPS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

COUNTED = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("docs", pa.int64()), ("n", pa.int64())]
)
SUMMED = pa.schema([("lang", pa.string()), ("row", pa.int64()), ("other", pa.int64()), ("value", pa.int64())])


# --- counts ------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group and term the documents and occurrences, added up in the task; a null term per group."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def done() -> Iterator[pa.RecordBatch]:
        for (lang, source), (docs, n) in groups.items():
            terms = [None, *n]
            columns = [[lang] * len(terms), [source] * len(terms), terms, [0, *map(docs.__getitem__, n)], [0, *n.values()]]
            yield pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(columns, COUNTED, strict=True)], schema=COUNTED
            )

    for batch in batches:
        for lang, source, text in zip(*batch.columns, strict=True):
            words = text.as_py().encode().translate(GAPS).split()
            key = (lang.as_py(), source.as_py())
            if key not in groups:
                groups[key] = (Counter(), Counter())
                held += 1
            docs, n = groups[key]
            before = len(n)
            n.update(words)
            docs.update(set(words))
            held += len(n) - before
            if held >= HELD_TERMS:
                yield from done()
                groups, held = {}, 0
    yield from done()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Documents and occurrences by (``lang``, ``source``, ``term``); each group has a row with a null term too.

    Terms are runs of letters A-Z, a-z and all characters beyond ASCII, with A-Z in
    lower case.  Null language, source and text are empty.
    """
    names = ((lang, "lang"), (source, "source"), (text, "text"))
    given = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in names]
    counted = docs.select(*given).mapInArrow(_count, "lang string, source string, term binary, docs long, n long")
    return (
        counted.withColumn("term", F.col("term").cast("string"))
        .groupBy("lang", "source", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    )


def _div(part: Column, whole: Column) -> Column:
    return F.call_function("div", part, whole)


def _probability(n: Column, total: Column, terms: Column) -> Column:
    """Smoothed and scaled, exact: 1 + floor(SCALE * (n + 2) / (total + 2 * terms))."""
    wide = [c.cast("decimal(20,0)") for c in (n + 2, total + 2 * terms)]
    return F.when(terms > 0, 1 + _div(wide[0] * F.lit(SCALE).cast("decimal(10,0)"), wide[1])).otherwise(1).cast("long")


# --- the tree of a tile ------------------------------------------------------------


class Tree:
    """The K-squared tree of a tile of 2 ** ``levels`` rows and columns, K = 2.

    Per level the four bits of every node, in order, and their rank, which is the
    number of the child.  Nodes of the last level are the cells.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, levels: int):
        code = np.zeros(len(rows), np.int64)
        for bit in range(levels):
            code |= (rows >> bit & 1) << 2 * bit + 1 | (columns >> bit & 1) << 2 * bit
        order = np.argsort(code, kind="stable")
        code, self.values = code[order], values[order]
        self.bits, self.rank = [], []
        above = np.unique(code >> 2 * levels)
        for level in range(1, levels + 1):
            here = np.unique(code >> 2 * (levels - level))
            bits = np.zeros(4 * len(above), bool)
            bits[4 * np.searchsorted(above, here >> 2) + (here & 3)] = True
            self.bits.append(bits)
            self.rank.append(np.cumsum(bits) - 1)
            above = here
        self.empty = len(code) == 0

    def child(self, level: int, node: np.ndarray, quadrant: np.ndarray | int) -> np.ndarray:
        """The nodes' quadrants one level down; -1 without a count, also below -1."""
        if self.empty:
            return np.full(len(node), -1)
        at = 4 * np.maximum(node, 0) + quadrant
        return np.where((node >= 0) & self.bits[level][at], self.rank[level][at], -1)


def divergence(p, q):
    """floor((p - q)² / (p + q)) of scaled probabilities up to 10⁹ + 1, in 64 bits."""
    return (p - q) * (p - q) // (p + q)


def joint(
    first: Tree, second: Tree, none_first: np.ndarray, none_second: np.ndarray, width: int, levels: int, same: bool
) -> np.ndarray:
    """Summed divergences of every row of ``first`` and every row of ``second`` over ``width`` columns.

    ``none_first`` and ``none_second`` hold each row's probability without a count.
    Of one and the same tile (``same``) only pairs of a row and a later one count.
    """
    na, nb = len(none_first), len(none_second)
    zero_width = np.zeros((na, nb), np.int64)  # columns that neither row has
    total = np.zeros((na, nb), np.int64)
    root = np.zeros(1, np.int64)
    a = b = c = root
    x = root - 1 if first.empty else root
    y = root - 1 if second.empty else root
    for level in range(levels + 1):
        size = 1 << levels - level
        # quadrants beyond the tile's rows and columns, and the mirrored half of one tile
        real = (a * size < na) & (b * size < nb) & (c * size < width)
        if same:
            real &= a <= b if size > 1 else a < b
        zero = real & (x < 0) & (y < 0)
        if zero.any():
            columns = np.minimum(size, width - c[zero] * size)
            grid = np.zeros((-(-na // size), -(-nb // size)), np.int64)
            np.add.at(grid, (a[zero], b[zero]), columns)
            zero_width += grid.repeat(size, 0)[:na].repeat(size, 1)[:, :nb]
        on = real & ~zero
        a, b, c, x, y = a[on], b[on], c[on], x[on], y[on]
        if level == levels or not len(a):
            break
        parts = []
        for quadrant in range(8):
            down, side, right = quadrant >> 2, quadrant >> 1 & 1, quadrant & 1
            below_x = first.child(level, x, 2 * down + right)
            below_y = second.child(level, y, 2 * side + right)
            parts.append((2 * a + down, 2 * b + side, 2 * c + right, below_x, below_y))
        a, b, c, x, y = (np.concatenate(p) for p in zip(*parts, strict=True))
    if len(a):
        p = np.where(x >= 0, first.values[np.maximum(x, 0)] if not first.empty else 0, none_first[a])
        q = np.where(y >= 0, second.values[np.maximum(y, 0)] if not second.empty else 0, none_second[b])
        np.add.at(total, (a, b), divergence(p, q))
    if same:
        zero_width = np.triu(zero_width, 1)
    return total + zero_width * divergence(none_first[:, None], none_second[None, :])


def _tree(cells, levels: int) -> Tree:
    """From a list of packed cells: row, column, probability."""
    if not cells.is_valid:
        none = np.zeros(0, np.int64)
        return Tree(none, none, none, levels)
    fields = [np.asarray(cells.values.field(i)) for i in range(3)]
    return Tree(*(f.astype(np.int64) for f in fields), levels)


def _traverse(levels: int):
    """Sums of all tile pairs, added up per pair of row blocks while the task has room."""

    def batch_of(lang: str, i: int, j: int, total: np.ndarray) -> pa.RecordBatch:
        rows, others = np.indices(total.shape)
        use = rows < others if i == j else np.ones(total.shape, bool)
        rows, others = rows[use] + (i << levels), others[use] + (j << levels)
        columns = [pa.array([lang] * len(rows), pa.string()), pa.array(rows), pa.array(others), pa.array(total[use])]
        return pa.record_batch(columns, schema=SUMMED)

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, int], np.ndarray] = {}
        for batch in batches:
            for lang, i, j, width, none_a, cells_a, none_b, cells_b in zip(*batch.columns, strict=True):
                key = (lang.as_py(), i.as_py(), j.as_py())
                none_a, none_b = np.asarray(none_a.values), np.asarray(none_b.values)
                same = key[1] == key[2]
                first = _tree(cells_a, levels)
                second = first if same else _tree(cells_b, levels)
                found = joint(first, second, none_a, none_b, width.as_py(), levels, same)
                held[key] = held[key] + found if key in held else found
                if len(held) >= HELD_PAIRS:
                    yield from (batch_of(*k, total) for k, total in held.items())
                    held = {}
        yield from (batch_of(*k, total) for k, total in held.items())

    return traverse


# --- the audit ---------------------------------------------------------------------


class Matrix:
    """The groups (rows), kept terms (columns) and counts of all languages, written once."""

    def __init__(self, counts: DataFrame, least_docs: int, levels: int, work: Workspace):
        self.levels, self.side = levels, 1 << levels
        counts = stage(counts, "counts", work)
        by_term = counts.where("term IS NOT NULL").groupBy("lang", "term")
        kept = by_term.agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang")).where(F.col("docs") >= least_docs)
        order = [F.asc("lang"), F.desc("in_lang"), F.asc("term")]
        self.terms = stage(self._placed(kept.drop("docs"), order, "column"), "terms", work)
        self.langs = self.terms.groupBy("lang").agg(
            F.count("*").alias("terms"), F.sum("in_lang").alias("lang_total")
        )
        known = counts.where("term IS NOT NULL").drop("docs")
        cells = stage(known.join(self.terms, ["lang", "term"]), "cells", work)
        totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        every = counts.where("term IS NULL").select("lang", "source")
        groups = (
            every.join(totals, ["lang", "source"], "left")
            .join(self.langs, "lang", "left")
            .na.fill(0, ["total", "terms", "lang_total"])
        )
        order = [F.asc("lang"), F.desc("total"), F.asc("source")]
        placed = self._placed(groups, order, "row")
        none = _probability(F.lit(0).cast("long"), F.col("total"), F.col("terms"))
        self.groups = stage(placed.withColumn("none", none), "groups", work)
        p = _probability(F.col("n"), F.col("total"), F.col("terms"))
        self.cells = stage(cells.join(self.groups, ["lang", "source"]).withColumn("p", p), "matrix", work)

    @staticmethod
    def _placed(table: DataFrame, order: list[Column], name: str) -> DataFrame:
        """``table`` with every row's place within its language."""
        placed = global_index(table, order)
        # written by global_index: the first place of each language needs no second sort
        first = placed.groupBy("lang").agg(F.min("_index").alias("_first"))
        return placed.join(first, "lang").withColumn(name, F.col("_index") - F.col("_first")).drop("_index", "_first")

    def tiles(self) -> DataFrame:
        """All tiles (``lang``, row block ``i``, column block ``k``), those without counts too."""
        side = F.lit(self.side).cast("long")
        block = lambda c: _div(F.col(c), side)
        packed = F.struct(*[F.pmod(F.col(c), side).cast("int").alias(c) for c in ("row", "column")], "p")
        cells = self.cells.groupBy("lang", block("row").alias("i"), block("column").alias("k")).agg(
            F.collect_list(packed).alias("cells")
        )
        rows = self.groups.groupBy("lang", block("row").alias("i"), "terms").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("row", "none"))), lambda x: x["none"]).alias("none")
        )
        last = F.greatest(_div(F.col("terms") - 1, side), F.lit(0).cast("long"))
        frame = rows.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        width = F.least(side, F.col("terms") - F.col("k") * side).alias("width")
        return frame.join(cells, ["lang", "i", "k"], "left").select("lang", "i", "k", width, "none", "cells")

    def pairs(self, work: Workspace) -> DataFrame:
        """The divergence of every two groups of a language, each pair once, by rows."""
        tiles = stage(self.tiles(), "tiles", work)
        left = tiles.select("lang", "k", "i", "width", *[F.col(c).alias(f"{c}_a") for c in ("none", "cells")])
        right = tiles.select("lang", "k", F.col("i").alias("j"), *[F.col(c).alias(f"{c}_b") for c in ("none", "cells")])
        both = left.join(right, (left.lang == right.lang) & (left.k == right.k) & (left.i <= right.j)).select(
            left.lang, "i", "j", "width", "none_a", "cells_a", "none_b", "cells_b"
        )
        sums = both.mapInArrow(_traverse(self.levels), "lang string, row long, other long, value long")
        return sums.groupBy("lang", "row", "other").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    top_terms: int = TOP_TERMS,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    levels: int = LEVELS,
) -> DataFrame:
    """How far the sources of each language are from each other, and by which terms from the language.

    A language keeps the terms that at least ``least_docs`` of its rows have; every
    source and the language give each of them a smoothed probability in whole
    billionths.  Part ``pair`` has for every source each other source of its language
    with the summed divergence over all kept terms (0 without any); part ``term`` has
    the ``top_terms`` terms that a source has, and more often than its language, by
    their divergence.  Returns ``lang``, ``source``, ``part``, ``item``, ``value`` and
    ``rank`` (from 1 per source and part; larger values first, then smaller items).
    Null language, source and text are empty strings; every row is a document of its
    own; other columns are not read; an empty table gives an empty result.  All
    arithmetic is in whole numbers.  ``levels`` sets the size of a tile, not the result.
    """
    work = Workspace(docs.sparkSession)
    matrix = Matrix(term_counts(docs, lang, source, text), least_docs, levels, work)

    names = matrix.groups.select("lang", "row", "source")
    pairs = stage(matrix.pairs(work), "pairs", work)
    mirrored = pairs.select("lang", F.col("other").alias("row"), F.col("row").alias("other"), "value")
    either = pairs.unionByName(mirrored)
    pair = (
        either.join(names, ["lang", "row"])
        .join(names.withColumnsRenamed({"row": "other", "source": "item"}), ["lang", "other"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    in_lang = _probability(F.col("in_lang"), F.col("lang_total"), F.col("terms"))
    p, q = F.col("p"), F.col("q")
    term = (
        matrix.cells.where("n > 0")
        .withColumn("q", in_lang)
        .where(p > q)
        .withColumn("value", _div((p - q) * (p - q), p + q))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    )
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    ranked = pair.withColumn("rank", place).unionByName(
        term.withColumn("rank", place).where(F.col("rank") <= top_terms)
    )
    return ranked.select("lang", "source", "part", "item", "value", "rank")
