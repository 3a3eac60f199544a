"""Line dedup against a plain count of lines, and its runs."""

import os
import random
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import cases  # noqa: E402

from encore.llm import line_runs  # noqa: E402
from encore.sources.staging import Workspace  # noqa: E402

UPPER = {ord(c): c.lower() for c in line_runs.UPPER}


def plain(rows, least_docs, least_chars=1):
    texts = [(i, (t or "").split("\n")) for i, t in rows]
    key = lambda line: line.strip(line_runs.SPACE).translate(UPPER)
    seen = Counter(k for _, lines in texts for k in {*map(key, lines)})
    gone = {k for k, n in seen.items() if n >= least_docs and len(k) >= least_chars}
    out = []
    for i, lines in texts:
        left = [line for line in lines if key(line) not in gone]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def ours(docs, **how):
    left = line_runs.drop_common_lines(docs, **how)
    return sorted((tuple(r) for r in left.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=repr)


def made(n=150):
    chance = random.Random(11)
    lines = ["", " ", "Zusätzlich É", "A line", "a LINE\t", "ä", "Ä", "x", "\x0bfoot er\r", "foot er", "foot  er", " x"]
    rows = [(i, "\n".join(chance.choices(lines, k=chance.randint(0, 9)) + [f"own {i}"] * (i % 3))) for i in range(n)]
    rows += [(None, "x\n\n x \n"), (3, rows[3][1]), (3, rows[3][1]), (n, None), (n + 1, ""), (n + 2, "\n\n")]
    return rows + [(n + 3, "\n".join(f"line {k % 4000}" if k % 9 else "X" for k in range(60_000)))]


@pytest.mark.parametrize("how", [{}, {"batches": 1}, {"batches": 7, "fan": 3}, {"least_chars": 3}, {"least_docs": 40}])
def test_equals_a_plain_count(spark, how):
    rows = made()
    docs = cases.table(spark, rows).repartition(9)
    assert ours(docs, **how) == plain(rows, how.get("least_docs", 10), how.get("least_chars", 1))


def test_awkward_rows_and_names(spark):
    docs = cases.table(spark).withColumn("_row", F.lit("r")).withColumn("_hashes", F.lit(1)).withColumn("a.b", F.lit(2))
    assert ours(docs, least_docs=2) == plain(cases.ROWS, 2)
    assert ours(docs.where("false")) == []


def test_runs_are_levelled_and_settled_lines_are_not_counted_again(spark):
    runs = line_runs.LineRuns(Workspace(spark), least=3, fan=2)
    assert runs.common().count() == 0
    docs = spark.createDataFrame([(["a", "b", None, "a"],), (["a"],), (["a", "c"],)], "h array<string>")
    batch = docs.select(F.transform("h", lambda x: x.cast("binary")).alias("h"))
    for _ in range(5):
        runs.add(batch, "h")
    # five batches: one run, none of two, one of four
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    newest = {bytes(r._key): r._n for r in runs.levels[0][0].collect()}
    assert newest == {}  # a is settled by the first batch, b and c by the compaction of four
    oldest = {bytes(r._key): r._n for r in runs.levels[2][0].collect()}
    assert oldest == {b"a": 3, b"b": 4, b"c": 4}
    assert {bytes(r._key) for r in runs.common().collect()} == {b"a", b"b", b"c"}


def test_runs_are_not_shuffled(spark):
    runs = line_runs.LineRuns(Workspace(spark), least=3, fan=4)
    batch = spark.range(50).select(F.array(F.col("id").cast("string").cast("binary")).alias("h"))
    runs.add(batch, "h")
    runs.add(batch, "h")
    plan = runs._merged(runs.runs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
