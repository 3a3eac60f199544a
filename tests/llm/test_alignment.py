"""Token alignment against a plain version that adds up every token's bytes."""

import hashlib
import os
import sys
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
import cases  # noqa: E402

from encore.llm import alignment, queries  # noqa: E402
from encore.llm.packing import byte_letters  # noqa: E402
from encore.llm.vocabularies import BYTE_BPE, PIECE_BPE, vocabulary  # noqa: E402

PATHS = vocabulary(BYTE_BPE), vocabulary(PIECE_BPE)
ODD = [
    (20, "é 𐍈x☃​\t ok  two"),
    (21, "a ▁ literal sign"),
    (22, "<|endoftext|> and <s> </s> <unk> <0x41> in a text"),
    (23, "日本語のテキスト、ทดสอบ, क्षि 👩‍👩‍👧 é"),
    (24, " "),
    (25, "\n\n\r\n \x0b\x0c\x00\x7f"),
    (26, "  two before, two behind  "),
    (27, "nbsp and　wide ﻿ bom"),
    (28, "ﬁ ﬀ Ⅳ ①"),
    (29, "\U000f0000 private"),
]
LONG = " ".join(f"word{i % 977} ümlaut{i} 中{i % 5}" for i in range(20_000))


def plain(rows):
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte_of = {letter: byte for byte, letter in byte_letters().items()}
    docs, counts = [], Counter()
    for doc, text in rows:
        whole = f" {text}".encode() if text else b""
        a_ids = a.encode(f" {text}", add_special_tokens=False).ids if text else []
        a_bytes = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in a_ids]
        b_ids = b.encode(text) if text else []
        b_bytes = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i in b_ids
            for p in [b.id_to_piece(i)]
        ]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a_ids = b_ids = a_bytes = b_bytes = []
        groups, left, right, i, j = [], [], [], 0, 0
        a_at = b_at = 0
        while i < len(a_ids) or j < len(b_ids):
            if a_at <= b_at:
                a_at, i = a_at + len(a_bytes[i]), i + 1
                left.append(a_ids[i - 1])
            else:
                b_at, j = b_at + len(b_bytes[j]), j + 1
                right.append(b_ids[j - 1])
            if a_at == b_at:
                groups.append((left, right))
                left, right = [], []
        counts.update((g[0][-1], g[1][-1]) for g in groups)
        docs.append((doc, a_ids, b_ids, groups))
    most = Counter()
    for (_, right), n in counts.items():
        most[right] = max(most[right], n)
    out = []
    for doc, a_ids, b_ids, groups in docs:
        links = [counts[g[0][-1], g[1][-1]] for g in groups]
        best = sum(n == most[g[1][-1]] for n, g in zip(links, groups))
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((doc, len(a_ids), len(b_ids), len(groups), len(groups), best, sum(links), text))
    return sorted(out, key=repr)


def ours(docs):
    return sorted((tuple(r) for r in alignment.align(docs, *PATHS).collect()), key=repr)


def test_awkward_rows(spark):
    rows = cases.ROWS + ODD + [(30, LONG), (30, LONG)]
    docs = cases.table(spark, rows).repartition(5)
    got = ours(docs)
    assert got == plain(rows)
    by_id = {r[0]: r for r in got}
    assert by_id[21][1] == 0 and by_id[5][-1] == "" and by_id[20][1] > 0
    assert ours(docs.where("false")) == []


def test_query_equals_a_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows_of = queries.QUERIES["op12_alignment"](spark, folder)
    got = sorted(map(tuple, rows_of.collect()))
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest() if t else ""
    assert got == sorted((*r[:-1], digest(r[-1])) for r in plain(rows))


def same(one, other):
    return all(np.array_equal(x, y) for a, b in zip(one, other, strict=True) for x, y in zip(a, b, strict=True))


def test_words_are_encoded_as_the_whole_text():
    text = LONG[:30_000] + "  x\ty z" + "q" * 5000 + " end\xa0 of\u3000it  . 's \x1c x\x1c y ́o 'll\n\n  'm"
    texts = [text, f" {text} ", "é 𐍈 ☃ 日本 ﬁ", "one", "", " ", "a ▁ b", text]
    by_word, whole = alignment.Aligner(*PATHS), alignment.Aligner(*PATHS)
    assert by_word.cuttable
    whole.cuttable = False
    assert len(by_word.words(text)) > 1000 and whole.words(text) == [text]
    assert all(" ".join(by_word.words(t)) == t for t in texts)
    want = whole.align(texts)
    assert want[1][0].tolist()[4] == want[1][0].tolist()[6] == 0 < want[1][0].tolist()[5]
    assert same(by_word.align(texts), want)
    assert same(by_word.align(texts), want)  # all remembered now


def test_words_are_forgotten_and_learned_again(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED_WORDS", 50)
    monkeypatch.setattr(alignment, "BATCH_CHARS", 100)
    aligner, whole = alignment.Aligner(*PATHS), alignment.Aligner(*PATHS)
    whole.cuttable = False
    for at in range(0, 6000, 500):
        text = LONG[at : at + 700]
        assert same(aligner.align([text, "▁"]), whole.align([text, "▁"]))


def test_the_table_of_pairs_is_bounded_by_the_vocabularies():
    aligner = alignment.Aligner(*PATHS)
    assert all(aligner.a_bytes) and all(aligner.b_bytes)
    a_ids, b_ids = {}, {}
    for i, token in enumerate(aligner.a_bytes):
        a_ids.setdefault(token, []).append(i)
    for i, token in enumerate(aligner.b_bytes):
        b_ids.setdefault(token, []).append(i)
    pairs = {(i, j) for i, t in enumerate(aligner.a_bytes) for k in range(len(t)) for j in b_ids.get(t[k:], ())}
    pairs |= {(i, j) for j, t in enumerate(aligner.b_bytes) for k in range(len(t)) for i in a_ids.get(t[k:], ())}
    assert len(pairs) < 600_000


def test_refined_ends():
    # a character of four bytes as three tokens, then two plain ones
    start, end = np.array([0, 1, 1, 1, 5, 6]), np.array([1, 5, 5, 5, 6, 8])
    assert alignment.refined(start, end, np.array([1, 1, 2, 1, 1, 2])).tolist() == [1, 2, 4, 5, 6, 8]
    # byte fallback: no span until the last byte
    start, end = np.array([0, 2, 2, 2, 5]), np.array([2, 2, 2, 5, 6])
    assert alignment.refined(start, end, np.array([2, 1, 1, 1, 1])).tolist() == [2, 3, 4, 5, 6]


def test_other_files_are_refused(tmp_path):
    path = tmp_path / "words.json"
    path.write_text('{"normalizer": null, "pre_tokenizer": {"type": "Whitespace"}}')
    with pytest.raises(ValueError):
        alignment.Aligner(str(path), PATHS[1])
