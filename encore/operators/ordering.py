"""Global order without a single-task sort.

Row positions come from one range-partitioned sort; cuts and exact quantiles come
from counting alone; running totals come from quantile buckets.  The only rows that
meet in one task are one total per partition or bucket, or a bounded number of values.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.temporal import ts_literal
from encore.sources.staging import Workspace, stage

# monotonically_increasing_id() is the partition number above 33 bits of row number
PART_BITS = 33
ROWS_PER_PART = 1 << PART_BITS
# how far a sketched rank may be off, and how far around a wanted rank values are counted, of all rows
SKETCH_ERROR = 1e-4
MARGIN = 2e-3
# values a column's range may have to be fetched, and values drawn to divide a larger one of strings
FETCH_ROWS = 1 << 16
PIVOTS = 1 << 10
SAME_MEASURE = 1 << 20


# --- row positions ---------------------------------------------------------


def write_in_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """Write ``df`` sorted, with a ``_slot`` that grows along the order.

    ``order`` must end in a unique tie-break, so that equal sort keys are spread
    over tasks too and a re-run places every row alike.
    """
    return stage(
        df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), "ordered"
    )


def write_parts_in_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """As ``write_in_order``, with the number of the sorted partition as ``_part``.

    Each sorted partition is a file in one bucket by ``_part``, so work by ``_part``
    and anything else shuffles nothing.
    """
    spark = df.sparkSession
    placed = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id())
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return Workspace(spark).stage_bucketed(placed.withColumn("_part", part_of_slot()), "ordered", "_part", buckets)


def part_of_slot() -> Column:
    return F.shiftright("_slot", PART_BITS).alias("_part")


def _part_starts(placed: DataFrame) -> DataFrame:
    """Rows ahead of every sorted partition: one row per partition."""
    sizes = placed.groupBy(part_of_slot()).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))


def global_index(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``_index``: every row's 0-based position in the order."""
    placed = write_in_order(df, order)
    # one row per sorted partition, whatever the number of rows
    starts = F.broadcast(_part_starts(placed))
    return (
        placed.withColumn("_part", part_of_slot())
        .join(starts, "_part")
        .withColumn("_index", F.col("_start") + F.pmod(F.col("_slot"), F.lit(ROWS_PER_PART)))
        .drop("_part", "_start", "_slot")
    )


# --- places of an order, by counting ----------------------------------------


@dataclass(frozen=True)
class SortKey:
    """One column of an order, nulls as in Spark: first when ascending, last when descending."""

    name: str
    descending: bool = False


def _constant(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        return ts_literal(value)
    return F.lit(value).cast(kind)


def _ahead_of(key: SortKey, value, kind: T.DataType) -> Column:
    """Whether a row lies before ``value``; never null, plain enough for a scan's filters."""
    column, bound = F.col(key.name), _constant(value, kind)
    if value is None:
        return column.isNotNull() if key.descending else F.lit(False)
    if key.descending:
        return column.isNotNull() & (column > bound)
    return column.isNull() | (column < bound)


@dataclass(frozen=True)
class _Place:
    """A value at a rank, the rows with smaller values, and the rows with this one."""

    value: object
    ahead: int
    ties: int


@dataclass(frozen=True)
class _Sizes:
    nulls: int
    nans: int
    known: int


def _measure(name: str, kind: T.DataType) -> Column | None:
    """A double that never falls where the column rises; None if there is none."""
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{name}`)").cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    return None


@dataclass
class _Target:
    """Some wanted ranks of a column (``picks`` among all of them) and where their values lie.

    ``low`` and ``high`` belong to the range unless it is ``open``; None is no bound.
    ``shares`` say how far into the range the ranks are.
    """

    column: str
    picks: list[int] | None
    shares: list[float]
    low: object = None
    high: object = None
    open: bool = False

    @property
    def single(self) -> bool:
        return self.low is not None and self.low == self.high


NULL, NAN, BEFORE, LOW, INSIDE, HIGH, BEHIND = range(7)


class _Search:
    """The values at some ranks of some columns at once; nothing is sorted or shuffled by value.

    One pass sketches all columns and brackets every wanted rank; one pass counts
    the rows before and behind the brackets and, inside, by value.  Only if that are
    more than ``FETCH_ROWS`` values, counts alone and a sketch inside the brackets
    narrow them first.  A sketch changes the number of passes, never a result.
    """

    def __init__(self, df: DataFrame, columns: list[str], shares: list[float]):
        kinds = {c: df.schema[c].dataType for c in columns}
        self.df = df.select(*columns)
        self.measure = {c: _measure(c, kind) for c, kind in kinds.items()}
        floats = (T.DoubleType, T.FloatType)
        self.is_nan = {c: F.isnan(c) if isinstance(kind, floats) else F.lit(False) for c, kind in kinds.items()}
        self.targets = [_Target(c, None, shares) for c in columns]

    def _side(self, target: _Target) -> Column:
        name, low, high = target.column, target.low, target.high
        value = F.col(name) if self.measure[name] is None else self.measure[name]
        side = F.when(F.col(name).isNull(), NULL).when(self.is_nan[name], NAN)
        if low is not None:
            side = side.when(value < low, BEFORE).when(value == low, BEFORE if target.open else LOW)
        if high is not None:
            side = side.when(value > high, BEHIND).when(value == high, BEHIND if target.open else HIGH)
        return side.otherwise(INSIDE)

    def _within(self, target: _Target) -> Column:
        return self._side(target).between(LOW, HIGH)

    def bracket(self) -> None:
        """Narrow every target to the neighbourhood of its shares."""
        sketched = [t for t in self.targets if self.measure[t.column] is not None]
        if sketched:
            asked = sorted({p for t in sketched for p in _around(t.shares, MARGIN)})
            names = [f"t{i}" for i in range(len(sketched))]
            inside = [
                F.when(self._within(t), self.measure[t.column]).alias(n) for t, n in zip(sketched, names, strict=True)
            ]
            found = self.df.select(*inside).approxQuantile(names, asked, SKETCH_ERROR)
            for target, values in zip(sketched, found, strict=True):
                if values:
                    ends = _around(target.shares, MARGIN)
                    target.low, target.high = (values[asked.index(p)] for p in (ends[0], ends[-1]))
                    target.open = False
        for target in self.targets:
            if target not in sketched:
                # values that are no numbers: a few drawn ones stand for all
                here = self.df.where(self._within(target)).select(target.column)
                drawn = sorted(r[0] for r in here.orderBy(F.rand(7)).limit(PIVOTS).collect())
                ends = _around(target.shares, 2 / math.sqrt(PIVOTS))
                at = [min(len(drawn) - 1, int(p * len(drawn))) for p in (ends[0], ends[-1])]
                target.low, target.high, target.open = drawn[at[0]], drawn[at[1]], False

    def count(self, by_value: bool) -> list[tuple[int, int, object, int]] | None:
        """Rows by target and side and, within the ranges, by value; None if those are too many."""

        def cell(i: int, target: _Target) -> Column:
            value = F.when(self._within(target), F.col(target.column)) if by_value else F.lit(None)
            return F.struct(F.lit(i).alias("target"), self._side(target).alias("side"), value.alias("value"))

        # one grouping serves all targets
        cells = F.explode(F.array(*[cell(i, t) for i, t in enumerate(self.targets)])).alias("_cell")
        counted = self.df.select(cells).groupBy("_cell").count()
        # one double stands for less than a thousand 64-bit integers
        most = sum(SAME_MEASURE if t.single else FETCH_ROWS for t in self.targets) + BEHIND * len(self.targets)
        # a limit alone would be taken in several jobs
        rows = counted.limit(most + 1).coalesce(1).collect()
        return None if len(rows) > most else [(*r["_cell"], r["count"]) for r in rows]

    def run(
        self, ranks: Callable[[_Sizes], list[int]], rows: float = math.inf
    ) -> dict[str, tuple[_Sizes, list[_Place]]]:
        """Per column its sizes and the places at ``ranks(sizes)``, counted among its known values.

        A table known to have few ``rows`` is counted as a whole first.
        """
        found: dict[str, tuple[_Sizes, dict[int, _Place]]] = {}
        if rows > FETCH_ROWS and any(self.measure[t.column] is not None for t in self.targets):
            self.bracket()
        while self.targets:
            cells = self.count(by_value=True)
            fetched = cells is not None
            cells = cells if fetched else self.count(by_value=False)
            left = []
            for i, target in enumerate(self.targets):
                mine = [cell[1:] for cell in cells if cell[0] == i]
                sides = Counter()
                for side, _, n in mine:
                    sides[side] += n
                sizes = _Sizes(sides[NULL], sides[NAN], sum(n for side, n in sides.items() if side >= BEFORE))
                wanted = ranks(sizes)
                picks = range(len(wanted)) if target.picks is None else target.picks
                places = found.setdefault(target.column, (sizes, {}))[1]
                beside = [p for p in picks if not sides[BEFORE] <= wanted[p] < sizes.known - sides[BEHIND]]
                if beside:
                    # the sketch was beside it: once more from the whole column, at the known share
                    left.append(_Target(target.column, [*picks], [(wanted[p] + 0.5) / sizes.known for p in picks]))
                elif fetched:
                    places.update({p: _place(mine, sides[BEFORE], wanted[p]) for p in picks})
                else:
                    left += _parts(target, sides, {p: wanted[p] for p in picks})
            self.targets = left
            if left:
                self.bracket()
        return {c: (sizes, [places[i] for i in sorted(places)]) for c, (sizes, places) in found.items()}


def _around(shares: list[float], margin: float) -> list[float]:
    return sorted(min(1.0, max(0.0, s + d)) for s in shares for d in (-margin, margin))


def _place(cells: list[tuple[int, object, int]], ahead: int, rank: int) -> _Place:
    """The place at ``rank`` among counted values, with ``ahead`` rows before them."""
    for value, n in sorted((value, n) for side, value, n in cells if LOW <= side <= HIGH):
        if rank < ahead + n:
            return _Place(value, ahead, n)
        ahead += n
    raise AssertionError("ranks are checked against the counts")


def _parts(target: _Target, rows: Counter, wanted: dict[int, int]) -> list[_Target]:
    """A target's ends and its open inside, those that hold wanted ranks."""
    if target.single:
        raise ArithmeticError(f"values of {target.column} are too close to each other to be told apart")
    low, high = target.low, target.high
    ends = {LOW: (low, low, False), INSIDE: (low, high, True), HIGH: (high, high, False)}
    parts, ahead = [], rows[BEFORE]
    for side, bounds in ends.items():
        here = {p: r - ahead for p, r in wanted.items() if ahead <= r < ahead + rows[side]}
        if here:
            parts.append(_Target(target.column, [*here], [(r + 0.5) / rows[side] for r in here.values()], *bounds))
        ahead += rows[side]
    return parts


def _first_rows(
    df: DataFrame, keys: list[SortKey], share: float, want: Callable[[int], int], about: float = math.inf
) -> tuple[Column, bool]:
    """Which of the first ``want(n)`` rows of the order these are, and whether ``keys`` could tell.

    ``share`` is about ``want(n) / n``, ``about`` is n where that is known.  If they could not, rows that are equal in all
    keys lie on both sides of the cut, and none of them is counted in.
    """
    key, kind = keys[0], df.schema[keys[0].name].dataType

    def classes(sizes: _Sizes) -> list[tuple[str, int]]:
        ordered = [("null", sizes.nulls), ("known", sizes.known), ("nan", sizes.nans)]
        return ordered[::-1] if key.descending else ordered

    def cut(sizes: _Sizes) -> tuple[str, int, int]:
        """The class of the first row behind the cut, and the rows before that class and in it."""
        ahead, position = 0, want(sizes.nulls + sizes.known + sizes.nans)
        for name, rows in classes(sizes):
            if position < ahead + rows:
                return name, ahead, rows
            ahead += rows
        return "end", ahead, 0

    def rank(sizes: _Sizes) -> list[int]:
        name, ahead, rows = cut(sizes)
        at = want(sizes.nulls + sizes.known + sizes.nans) - ahead
        return [] if name != "known" else [rows - 1 - at if key.descending else at]

    sizes, places = _Search(df, [key.name], [1 - share if key.descending else share]).run(rank, about)[key.name]
    rows = sizes.nulls + sizes.known + sizes.nans
    wanted = want(rows)
    if wanted <= 0:
        return F.lit(False), True
    if wanted >= rows:
        return F.lit(True), True
    name, ahead, ties = cut(sizes)
    value = None if name == "null" else math.nan
    if name == "known":
        place = places[0]
        value, ties = place.value, place.ties
        ahead += sizes.known - place.ahead - ties if key.descending else place.ahead
    before = _ahead_of(key, value, kind)
    short = wanted - ahead
    if short == 0:
        return before, True
    same = F.col(key.name).eqNullSafe(_constant(value, kind))
    if len(keys) == 1:
        return before, False
    rest, exact = _first_rows(df.where(same), keys[1:], short / ties, lambda _: short, ties)
    return before | (same & rest), exact


def _first_fraction(df: DataFrame, keys: list[SortKey], fraction: float) -> tuple[DataFrame, Column]:
    """A table with the rows of ``df``, and which are among the first ``int(n * fraction)`` of the order.

    If rows equal in all keys lie on both sides of the cut, the table is written with
    a number for every row and those with the smallest numbers are taken.
    """
    want = lambda rows: int(rows * fraction)
    early, exact = _first_rows(df, keys, fraction, want)
    if exact:
        return df, early
    numbered = stage(df.withColumn("_slot", F.monotonically_increasing_id()), "numbered")
    return numbered, _first_rows(numbered, [*keys, SortKey("_slot")], fraction, want)[0]


@dataclass(frozen=True)
class TimeSplit:
    """A table cut at one point in time: two filters of the same rows."""

    table: DataFrame
    early: Column
    columns: list[str]

    @property
    def train(self) -> DataFrame:
        return self.table.where(self.early).select(*self.columns)

    @property
    def test(self) -> DataFrame:
        return self.table.where(~self.early).select(*self.columns)

    @property
    def rows(self) -> DataFrame:
        """All rows with a ``split`` column saying train or test."""
        return self.table.select(*self.columns, F.when(self.early, "train").otherwise("test").alias("split"))


def time_split(df: DataFrame, ts: str, tie: str, fraction: float = 0.8) -> TimeSplit:
    """Take the earliest ``int(n * fraction)`` rows for training, the rest for testing.

    ``df`` should be a stored or staged table: it is scanned two or three times for the
    cut, then once per part, but neither sorted nor written.  Rows with one time are
    divided by ``tie``; rows equal in both are divided too, in an order of their own,
    for which the table is written once.
    """
    return TimeSplit(*_first_fraction(df, [SortKey(ts), SortKey(tie)], fraction), df.columns)


def mark_top_fraction(
    df: DataFrame, score: str, tie: str, fraction: float = 0.10, flag: str = "in_top"
) -> DataFrame:
    """Flag the ``int(n * fraction)`` rows with the highest scores; of equal scores the smallest ties.

    ``df`` should be stored or staged, and rows equal in both columns are divided, as
    for ``time_split``.
    """
    table, top = _first_fraction(df, [SortKey(score, descending=True), SortKey(tie)], fraction)
    return table.withColumn(flag, top).select(*[c for c in df.columns if c != flag], flag)


def top_fraction(df: DataFrame, score: str, tie: str, fraction: float = 0.10) -> DataFrame:
    """The ``int(n * fraction)`` rows with the highest scores, exactly as many."""
    table, top = _first_fraction(df, [SortKey(score, descending=True), SortKey(tie)], fraction)
    return table.where(top).select(*df.columns)


# --- quantile buckets ------------------------------------------------------


def _bucket_model(df: DataFrame, columns: list[str]) -> Bucketizer:
    """Buckets of about equal row counts; equal values share a bucket.

    One pass over the columns.  There are as many buckets as shuffle partitions,
    so a bucket shrinks as the session is sized up for more data.
    """
    buckets = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    borders = df.approxQuantile(columns, [i / buckets for i in range(1, buckets)], 0.5 / buckets)
    return Bucketizer(
        inputCols=columns,
        outputCols=[f"_bucket_{c}" for c in columns],
        splitsArray=[
            [-math.inf, *(sorted(set(inner) - {-math.inf, math.inf}) or [0.0]), math.inf] for inner in borders
        ],
        handleInvalid="keep",
    )


def running_totals(values: DataFrame, key: str, totals: list[str], descending: bool) -> DataFrame:
    """Add ``<total>_upto``, the sum over all keys up to and including this one, and ``<total>_all``.

    ``values`` has one row per distinct key and should be stored or staged: one pass
    over its keys finds the bucket borders, so that buckets have about equal numbers
    of keys however many rows a key stands for.
    """
    direction = F.desc if descending else F.asc
    bucketed = (
        _bucket_model(values.select(key), [key])
        .transform(values)
        .withColumnRenamed(f"_bucket_{key}", "_bucket")
    )
    within = (
        Window.partitionBy("_bucket")
        .orderBy(direction(key))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = Window.orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(direction("_bucket")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    sums = bucketed.groupBy("_bucket").agg(*[F.sum(t).alias(t) for t in totals])
    # one row per bucket, whatever the number of keys
    starts = sums.select(
        "_bucket",
        *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"_{t}_before") for t in totals],
        *[F.sum(t).over(everything).alias(f"{t}_all") for t in totals],
    )
    return (
        bucketed.withColumns({f"{t}_upto": F.sum(t).over(within) for t in totals})
        .join(F.broadcast(starts), "_bucket")
        .withColumns({f"{t}_upto": F.col(f"{t}_upto") + F.col(f"_{t}_before") for t in totals})
        .drop("_bucket", *[f"_{t}_before" for t in totals])
    )


def with_next(values: DataFrame, key: str, columns: list[str], descending: bool) -> DataFrame:
    """Add ``<column>_next``, the column at the next key of the order; null at the last key.

    ``values`` as for ``running_totals``.  Neighbours are found within quantile buckets;
    at a bucket's end the next bucket's first row is the neighbour.
    """
    direction = F.desc if descending else F.asc
    bucketed = (
        _bucket_model(values.select(key), [key])
        .transform(values)
        .withColumnRenamed(f"_bucket_{key}", "_bucket")
    )
    within = Window.partitionBy("_bucket").orderBy(direction(key))
    first = F.max_by if descending else F.min_by
    heads = bucketed.groupBy("_bucket").agg(first(F.struct(*columns), key).alias("_head"))
    # one row per bucket, whatever the number of keys
    following = heads.select("_bucket", F.lead("_head").over(Window.orderBy(direction("_bucket"))).alias("_after"))
    here = F.lead(F.struct(*columns)).over(within)
    return (
        bucketed.withColumn("_following", here)
        .join(F.broadcast(following), "_bucket")
        .withColumns({f"{c}_next": F.coalesce(F.col("_following")[c], F.col("_after")[c]) for c in columns})
        .drop("_bucket", "_following", "_after")
    )


def exact_quantiles(df: DataFrame, columns: list[str], q: float = 0.5) -> dict[str, float | None]:
    """The exact quantile of each column, interpolated between neighbours.

    Null and NaN are skipped; a column without values gives None.  Both neighbours of
    all columns are found together, in two passes over the columns as a rule; no pass
    shuffles rows, no task's share grows but with the scan.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])

    def neighbours(sizes: _Sizes) -> list[int]:
        low = int((sizes.known - 1) * q) if sizes.known else 0
        return [low, min(low + 1, sizes.known - 1)] if sizes.known else []

    quantiles: dict[str, float | None] = {}
    for column, (sizes, places) in _Search(values, columns, [q]).run(neighbours).items():
        quantiles[column] = None
        if places:
            below, above = (place.value for place in places)
            # equal infinities have no difference
            share = (sizes.known - 1) * q % 1
            quantiles[column] = below if below == above else below + (above - below) * share
    return {c: quantiles[c] for c in columns}
