"""A small table with every awkward row, and plain versions of the operators."""

import hashlib

import numpy as np

LONG = " ".join(f"word{i % 977} tail{i}" for i in range(6000))
SHARED = "a passage of well over fifty bytes that two documents have in common, é included"
ROWS = [
    (5, None),
    (4, ""),
    (1, " \t\n "),
    (2, "Hello big World, hello big world"),
    (3, "hello\tbig world, hello big world"),
    (6, LONG),
    (7, LONG),
    (8, f"start {SHARED} end"),
    (9, f"another {SHARED} finish"),
    (9, f"another {SHARED} finish"),
    (10, "x" * 3000),
    (11, "Der " * 200),
    (None, "no id <|endoftext|> mail me.12@host.example.org or +1 (377) 555-0271"),
    (12, "twice 10.1.22.133 and again 10.1.22.133, card 4952935900253052"),
]
SCHEMA = "doc_id bigint, text string, kept string, n bigint, _part string, words string, start bigint"


def table(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "own", 7, "p", "w", 3) for i, t in rows], SCHEMA)


def removed(rows):
    """Per row: bytes, removed bytes, runs and what is left, string by string."""
    first = {}
    far = 1 << 62
    texts = [(far if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for a in range(len(t) - 49):
            first[t[a : a + 50]] = min(first.get(t[a : a + 50], far), i)
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for a in range(len(t) - 49):
            if first[t[a : a + 50]] < i:
                gone[a : a + 50] = True
        edges = np.diff(gone, prepend=False).astype(int) * gone
        left = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((None if i == far else i, len(t), int(gone.sum()), int(edges.sum()), left))
    return out


def squeezed(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
