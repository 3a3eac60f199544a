"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters of other scripts and
full-width forms to Latin ones, digits inside words to the letters they stand
for, joiners without width removed, everything else a blank.  Accented letters
stay, they tell words apart in most languages.  The lexicon holds words and
beginnings of words with a weight learned from labels; exception phrases take
back the entries inside them.  Weights per word of text and in all make the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.labelled import logistic, sample, with_score
from encore.llm.tables import once_per_worker, values

SAMPLE_ROWS = 12_000
ENTRIES = 2_000
EXCEPTIONS = 1_000
LEAST_DOCS = 5
LEAST_WEIGHT = 2.0
PREFIXES = range(3, 9)

# fixed values: letters of other scripts that look like Latin ones
LOOK_ALIKES = dict(
    zip("авсԁеһіјкӏмոорԛѕтцѵԝхуαβγεικνορτυχωⅼℓℯℴ", "abcdehijklmnopqstuvwxyabyeiknoptuxwlleo", strict=True)
)
# fixed values: digits and signs that stand for letters inside words
DIGITS = dict(zip("0134578@", "oieastba", strict=True))
HIDDEN = dict.fromkeys(map(ord, "­​‌‍⁠﻿"))
WIDE = {0xFEE0 + c: chr(c) for c in range(0x21, 0x7F)}
BLANKS = {c: " " for c in range(128) if not chr(c).isalnum() and chr(c) not in "@$"}
FOLDED = str.maketrans(LOOK_ALIKES) | HIDDEN | WIDE | BLANKS
STANDING_IN = re.compile(r"(?<![\w@$])[\w@$]*[0134578@$][\w@$]*")
LETTER_OF = str.maketrans(DIGITS | {"$": "s"})


def _letters(match: re.Match) -> str:
    """A word with its digits as letters, if it has letters; signs at its ends are none."""
    word = match[0].rstrip("$@")
    return word.translate(LETTER_OF) if any(c.isalpha() for c in word) else " "


def fold(text: str) -> str:
    """A text's words in plain letters, one blank around each."""
    plain = text.lower().translate(FOLDED)
    if any(c in plain for c in "0134578@$"):
        plain = STANDING_IN.sub(_letters, plain)
    return " " + " ".join(plain.split()) + " "


@dataclass(frozen=True)
class Lexicon:
    """Folded patterns with weights; phrases that excuse them; the score's weights."""

    entries: dict[str, float]
    exceptions: frozenset[str]
    shape: tuple[float, float, float] = (1.0, 1.0, -3.0)


class Matcher:
    """Weights found in a text: one automaton for entries and exceptions."""

    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for pattern, weight in lexicon.entries.items():
            self.automaton.add_word(pattern, (len(pattern), weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, None))
        self.empty = len(self.automaton) == 0
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """Begin, end and weight of the heaviest entry at each place, exceptions taken back."""
        if self.empty:
            return []
        best: dict[int, tuple[int, float]] = {}
        excused = []
        for end, (size, weight) in self.automaton.iter(folded):
            begin = end + 1 - size
            if weight is None:
                excused.append((begin, end))
            elif begin not in best or best[begin][1] < weight:
                best[begin] = (end, weight)
        found = [(begin, end, weight) for begin, (end, weight) in best.items()]
        if excused:
            found = [hit for hit in found if not any(a <= hit[0] and hit[1] <= b for a, b in excused)]
        return found

    def measures(self, text: str) -> tuple[float, float]:
        """Weight per word and weight in all, on a logarithmic scale."""
        folded = fold(text)
        words = max(1, folded.count(" ") - 1)
        weight = sum(hit[2] for hit in self.hits(folded))
        return math.log1p(100 * weight / words), math.log1p(weight)

    def score(self, text: str) -> float:
        dense, total = self.measures(text)
        a, b, c = self.lexicon.shape
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a * dense + b * total + c))))


# --- learning ----------------------------------------------------------------------


def patterns(folded: str) -> set[str]:
    """Words and beginnings of words that could be entries."""
    words = set(folded.split())
    return {f" {w} " for w in words if len(w) > 2} | {
        f" {w[:n]}" for w in words for n in PREFIXES if len(w) > n
    }


def _counted(of_text, arguments: tuple = ()):
    """Per task, in how many of its texts each pattern of ``of_text`` occurs, by label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: Counter = Counter()
        for batch in batches:
            for text, label in zip(values(batch.column(0), ""), values(batch.column(1)), strict=True):
                texts.update((pattern, label) for pattern in of_text(text, *arguments))
        rows = list(texts.items())
        for at in range(0, len(rows), 50_000):
            part = rows[at : at + 50_000]
            yield pa.record_batch(
                [
                    pa.array([key[0] for key, _ in part], pa.string()),
                    pa.array([key[1] for key, _ in part], pa.int32()),
                    pa.array([n for _, n in part], pa.int64()),
                ],
                names=["pattern", "label", "n"],
            )

    return count


COUNTS = "pattern string, label int, n long"


def _phrases(text: str, matcher_of) -> set[str]:
    """Entries with the word before or after them."""
    matcher, folded = matcher_of(), fold(text)
    found = set()
    for begin, _, _ in matcher.hits(folded):
        end = folded.index(" ", begin + 1)
        word = folded[begin + 1 : end]
        before = folded[:begin].rpartition(" ")[2]
        after = folded[end + 1 :].partition(" ")[0]
        found |= {f"{before} {word}"} if before else set()
        found |= {f"{word} {after}"} if after else set()
    return found


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    rows: int = SAMPLE_ROWS,
    most_entries: int | None = ENTRIES,
    most_exceptions: int | None = EXCEPTIONS,
) -> Lexicon:
    """A lexicon from at most ``rows`` labelled rows that are not held out.

    Entries occur in at least 5 toxic texts of the sample and far more often there
    than in the others.  All such are weighed; the best ``most_entries`` are kept, and
    the most frequent ``most_exceptions`` phrases, or all with None.  Without labels of
    both kinds the lexicon is empty.
    """
    known = sample(docs, labels, label, rows)
    totals = dict(known.groupBy("label").count().collect())
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return Lexicon({}, frozenset())
    seen = known.where("label = 1").mapInArrow(_counted(lambda text: patterns(fold(text))), COUNTS)
    counts = seen.groupBy("pattern").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS)
    # patterns of a bounded sample, each in several of its texts
    toxic = {r[0]: r[1] for r in counts.collect()}
    wanted = frozenset(toxic)
    other = known.where("label = 0").mapInArrow(_counted(lambda text, w: patterns(fold(text)) & w, (wanted,)), COUNTS)
    clean = dict(other.groupBy("pattern").agg(F.sum("n")).collect())

    def weight(pattern: str) -> float:
        return math.log((toxic[pattern] + 0.5) / (bad + 1)) - math.log((clean.get(pattern, 0) + 0.5) / (good + 1))

    weights = {pattern: weight(pattern) for pattern in toxic}
    best = sorted(((w * math.sqrt(toxic[p]), w, p) for p, w in weights.items() if w >= LEAST_WEIGHT), reverse=True)
    entries = {pattern: w for _, w, pattern in best[:most_entries]}
    draft = Lexicon(entries, frozenset())
    around = known.mapInArrow(_counted(_phrases, (lambda: _matcher(draft),)), COUNTS).groupBy("pattern").pivot(
        "label", [0, 1]
    ).agg(F.sum("n"))
    excused = around.where((F.col("0") >= LEAST_DOCS) & F.col("1").isNull()).orderBy(F.desc("0"), "pattern")
    if most_exceptions is not None:
        excused = excused.limit(most_exceptions)
    lexicon = Lexicon(entries, frozenset(r[0] for r in excused.collect()))
    # two numbers per row of the sample
    measured = np.array(known.mapInArrow(_measured(lexicon), "dense double, total double, label int").collect())
    return Lexicon(entries, lexicon.exceptions, tuple(logistic(measured[:, :2], measured[:, 2])))


def _matcher(lexicon: Lexicon) -> Matcher:
    name = f"lexicon {hash((tuple(lexicon.entries.items()), lexicon.exceptions, lexicon.shape))}"
    return once_per_worker(name, lambda: Matcher(lexicon))


def _measured(lexicon: Lexicon):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(lexicon)
        for batch in batches:
            pairs = [matcher.measures(text) for text in values(batch.column(0), "")]
            yield pa.record_batch(
                [
                    pa.array([p[0] for p in pairs], pa.float64()),
                    pa.array([p[1] for p in pairs], pa.float64()),
                    batch.column(1).cast(pa.int32()),
                ],
                names=["dense", "total", "label"],
            )

    return measure


# --- scoring -----------------------------------------------------------------------


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` with a last column ``_score``: 0 to 1, higher for likelier toxic texts.

    A null or empty text has no weight and the score that goes with that.  Rows
    are scored one by one, repeats alike; an empty table gives an empty one; the
    caller's columns are kept, and a name of theirs is not taken: the score has more
    underscores then.
    """
    names, schema = docs.columns, with_score(docs)
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(lexicon)
        for batch in batches:
            scores = pa.array([matcher.score(t) for t in values(batch.column(at), "")], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=schema.names)

    return docs.mapInArrow(run, schema)
