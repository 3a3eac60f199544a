"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over one document's text; nothing is
shuffled and no user function runs.  A rule is a row of ``RULES``: a measure, the
smallest and the largest value it allows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.expressions import let
from encore.llm.tables import free_name

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
WINDOW = 3

# fixed values: frequent function words of the languages the corpus is in
STOP_WORDS = (
    "the of and to in is that it for as with "
    "der die und das den in von zu mit sich ist nicht "
    "le la les de des et en un une que qui pour dans est "
    "el los las del y que en una por con para se es"
).split()


@dataclass(frozen=True)
class Rule:
    measure: str
    least: float | None = None
    most: float | None = None


# length, symbol, stop-word and line ratios a document has to keep to
RULES = (
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbol_ratio", most=0.3),
    Rule("shout_ratio", most=0.5),
    Rule("stop_word_ratio", least=0.02),
    Rule("dup_line_ratio", most=0.5),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Different hashes prove a text free of repeats.  Else windows are sorted with
    their hash and position, so that equal ones are neighbours, and compared.
    """
    at = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(at, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))

    def placed(found: Column) -> Column:
        blank = F.lit(" ")
        return F.sort_array(
            F.transform(
                found,
                lambda h, i: F.struct(
                    h.alias("h"),
                    F.concat(words[i], blank, words[i + 1], blank, words[i + 2]).alias("w"),
                    i.alias("i"),
                ),
            )
        )

    def starts(rows: Column) -> Column:
        # equal neighbours, marked from the left and from the right
        same = F.zip_with(
            F.slice(rows, 1, F.size(rows) - 1),
            F.slice(rows, 2, F.size(rows) - 1),
            lambda a, b: F.when((a["h"] == b["h"]) & (a["w"] == b["w"]), F.array(a["i"], b["i"])),
        )
        pairs = F.flatten(F.filter(same, lambda pair: pair.isNotNull()))
        return F.sort_array(F.array_distinct(pairs))

    def covered(found: Column) -> Column:
        following = F.concat(F.slice(found, 2, F.size(found)), F.array(F.lit(None).cast("int")))
        steps = F.zip_with(found, following, lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def counted(found: Column) -> Column:
        some = F.size(F.array_distinct(found)) < F.size(found)
        return F.when(some, let(let(placed(found), starts), covered)).otherwise(0)

    return F.when(F.size(words) > WINDOW, let(hashes, counted)).otherwise(0)


def measures(text: Column) -> Column:
    """Counts of one text as a struct; each part of the text is taken once."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            _repeated_words(words).cast("long").alias("n_repeat_words"),
        )

    return F.struct(
        let(words_of(text), of_words).alias("of_words"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("!!")).cast("long").alias("n_shouts"),
        let(
            lines,
            lambda found: F.struct(
                F.size(found).cast("long").alias("n_lines"),
                (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("of_lines"),
    )


RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "shout_ratio": ("n_shouts", "n_words"),
    "stop_word_ratio": ("n_stop_words", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
}


def compile_rules(rules: tuple[Rule, ...], counts: dict[str, Column]) -> Column:
    """One boolean: every rule holds.  A ratio over nothing is 0."""
    passed = F.lit(True)
    for rule in rules:
        part, whole = (counts[name] for name in RATIOS[rule.measure])
        # part / whole against a bound, without dividing
        bounded = lambda bound: F.lit(bound) * whole.cast("double")
        if rule.least is not None:
            passed = passed & (part.cast("double") >= bounded(rule.least))
        if rule.most is not None:
            passed = passed & (part.cast("double") <= bounded(rule.most))
    return passed


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``_quality`` of counts and the verdict.

    Words are runs of ``[^\\x20\\x09-\\x0D]``.  ``base_failed``: fewer than 50
    words, or more than half of the words lie in three-word windows that occur
    twice or more in the text.  ``kept``: not failed, and every rule holds.
    A null or empty text has no words, no lines, and fails.  Rows are judged one
    by one: repeats are judged alike, an empty table gives an empty one, and the
    caller's columns are kept; beside one named ``_quality`` the struct gets a
    name with more underscores before it.
    """
    name = free_name("_quality", docs.columns)
    parts = (f"{name}.of_words.*", f"{name}.n_symbols", f"{name}.n_shouts", f"{name}.of_lines.*")
    return (
        docs.withColumn(name, measures(F.coalesce(F.col(text), F.lit(""))))
        .withColumn(name, F.struct(*parts))
        .withColumn(name, _verdict(rules, name))
    )


def _verdict(rules: tuple[Rule, ...], name: str) -> Column:
    names = ("n_words", "word_chars", "n_stop_words", "n_repeat_words", "n_symbols", "n_shouts", "n_lines", "n_dup_lines")
    counts = {count: F.col(f"{name}.{count}") for count in names}
    failed = (counts["n_words"] < LEAST_WORDS) | (
        100 * counts["n_repeat_words"] > MOST_REPEATED_PERCENT * counts["n_words"]
    )
    return F.struct(
        f"{name}.*", failed.alias("base_failed"), (~failed & compile_rules(rules, counts)).alias("kept")
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns they came with."""
    name = free_name("_quality", docs.columns)
    return judge(docs, rules, text).where(f"{name}.kept").select(*[F.col(f"`{c}`") for c in docs.columns])
