"""The divergence audit against a plain sum over all terms, and its trees."""

import os
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import cases  # noqa: E402

from encore.llm import divergence  # noqa: E402

LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "lang string, source string, text string, docs int, n int, term int, row int"


def price(p, q):
    return (p - q) ** 2 // (p + q)


def plain(rows, least_docs=10, top=10):
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        key = (lang or "", source or "")
        groups.add(key)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts[key].update(words)
        in_docs[key[0]].update({*words})
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= least_docs]
        sources = sorted(s for code, s in groups if code == lang)

        def scaled(count):
            whole = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // whole for t in kept}

        p = {s: scaled(counts[lang, s]) for s in sources}
        q = scaled(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(price(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(price(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def ours(docs, **how):
    return sorted(tuple(r) for r in divergence.audit(docs, **how).collect())


def made(n=400):
    chance = random.Random(2)
    terms = ["The", "the", "tail9x", "naïve", "Ünder", "ünder", "日本", "𐍈", "it's", "under_score", *(f"w{chr(97 + i)}" for i in range(26))]
    rows = []
    for i in range(n):
        few = chance.sample(terms, chance.randint(1, 8))
        source = "hot" if i % 3 else f"s{i % 13}"
        rows.append(("de" if i % 7 == 0 else "en", source, " ".join(chance.choices(few, k=chance.randint(0, 30)))))
    rows += [(None, None, None), (None, "", ""), ("", "a", "alone"), ("fr", "only", "one word " * 20), ("en", "dry", None)]
    return rows + [("en", "long", " ".join(f"tail{'abcdefghij'[k % 10]}" for k in range(40_000)))] * 2


@pytest.mark.parametrize("levels", [1, 2, 3, 7])
@pytest.mark.parametrize("least", [3, 10])
def test_equals_a_plain_sum(spark, levels, least):
    rows = made()
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA).repartition(6)
    assert ours(docs, least_docs=least, levels=levels, top_terms=4) == plain(rows, least, 4)


def test_no_term_is_kept(spark):
    rows = [("en", s, f"own {s}") for s in "abc"] + [("en", "b", None), (None, None, "x")]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)
    assert ours(docs) == plain(rows)
    assert {r[4] for r in ours(docs)} == {0}
    assert ours(docs.where("false")) == []


def test_columns_by_name(spark):
    docs = cases.table(spark).select(F.col("kept").alias("a.lang"), F.col("_part").alias("a.source"), F.col("text").alias("a.text"))
    rows = [("own", "p", t) for _, t in cases.ROWS]
    assert ours(docs, least_docs=2, lang="a.lang", source="a.source", text="a.text") == plain(rows, 2)


def test_probabilities_of_counts_beyond_64_bits(spark):
    big = 10**13 + 7
    row = spark.range(1).select(divergence._probability(F.lit(big), F.lit(3 * big), F.lit(12345)).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 2) // (3 * big + 2 * 12345)


def test_joint_traversal_of_two_trees():
    chance = np.random.default_rng(4)
    for levels, share in ((3, 0.02), (3, 0.4), (4, 0.1), (2, 0.0)):
        side = 1 << levels
        na, nb, width = chance.integers(1, side + 1, 3)
        none = [chance.integers(1, 9, n) for n in (na, nb)]
        dense, trees = [], []
        for rows, zero in zip((na, nb), none, strict=True):
            has = chance.random((rows, width)) < share
            values = chance.integers(1, 10**9, (rows, width))
            dense.append(np.where(has, values, zero[:, None]))
            trees.append(divergence.Tree(*np.nonzero(has), values[has], levels))
        want = [[sum(price(int(p), int(q)) for p, q in zip(a, b)) for b in dense[1]] for a in dense[0]]
        got = divergence.joint(*trees, *none, int(width), levels, False)
        assert got.tolist() == want
        same = divergence.joint(trees[0], trees[0], none[0], none[0], int(width), levels, True)
        for i in range(na):
            for j in range(i + 1, na):
                assert same[i, j] == sum(price(int(p), int(q)) for p, q in zip(dense[0][i], dense[0][j]))


def test_zero_quadrants_are_not_visited(monkeypatch):
    """A tile with one cell: below the root only the path to it is walked."""
    tree = divergence.Tree(np.array([5]), np.array([9]), np.array([7]), 6)
    visited = []
    child = divergence.Tree.child
    monkeypatch.setattr(divergence.Tree, "child", lambda t, level, n, q: visited.append(len(n)) or child(t, level, n, q))
    divergence.joint(tree, tree, np.ones(64, int), np.ones(64, int), 64, 6, True)
    assert sum(visited) < 16 * 200  # of 64 * 63 / 2 * 64 leaves
