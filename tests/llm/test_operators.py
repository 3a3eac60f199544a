"""Every operator on awkward rows and empty tables, against a plain version."""

import os
import random
import sys
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import cases  # noqa: E402

from encore.llm import (  # noqa: E402
    block_naming,
    byte_bpe,
    byte_cnn,
    chat,
    components,
    packing,
    pii,
    quality_rules,
    shared_prefixes,
    simhash,
    suffix_dedup,
    toxicity,
)
from encore.llm.vocabularies import BYTE_BPE, WORD_BPE, vocabulary  # noqa: E402
from encore.sources.staging import Workspace  # noqa: E402


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def docs(spark):
    return cases.table(spark)


@pytest.fixture(scope="module")
def none(spark):
    return cases.table(spark, []).where("false")


def test_empty_tables(spark, none):
    for result in (
        suffix_dedup.remove_passages(none),
        simhash.near_groups(none),
        byte_bpe.decode(byte_bpe.encode(none, vocabulary(BYTE_BPE)), vocabulary(BYTE_BPE)),
        pii.replace(none, b"k"),
        block_naming.exact_groups(none),
        packing.pack(none, vocabulary(WORD_BPE)),
        quality_rules.judge(none),
        toxicity.score(none, toxicity.Lexicon({}, frozenset())),
        byte_cnn.score(none, byte_cnn.Network.fresh()),
    ):
        assert result.count() == 0


def test_passages(docs):
    got = [
        (r.doc_id, r.n_bytes, sum(s.length for s in r.removed), len(r.removed), bytes(r.kept))
        for r in suffix_dedup.remove_passages(docs).collect()
    ]
    assert sorted(got, key=key) == sorted(cases.removed(cases.ROWS), key=key)


def test_passages_around_a_common_line(spark):
    """The line's minimisers have as many pieces as there are documents."""
    chance = random.Random(5)

    def word():
        return "".join(chance.choice("abcdef") for _ in range(9))

    line = "a line of forty-four bytes in each of them, "
    passage = f"{line}and then one that goes on for longer, é too"
    rows = [
        (i, f"{word()} {passage if i % 3 else line}{word() if i % 4 else 'the same end again and again'} {line}{word()}")
        for i in range(120)
    ]
    rows += [(200 + i, rows[7][1]) for i in range(30)]
    for crowd in (4, 1 << 12):
        got = [
            (r.doc_id, r.n_bytes, sum(s.length for s in r.removed), len(r.removed), bytes(r.kept))
            for r in suffix_dedup.remove_passages(cases.table(spark, rows).repartition(5), crowd=crowd).collect()
        ]
        assert sorted(got) == sorted(cases.removed(rows))


def test_least_owners_of_windows():
    chance = random.Random(3)
    texts = [bytes(chance.choice(b"ab") for _ in range(chance.randint(12, 60))) for _ in range(80)]
    owners = np.array([chance.randint(0, 40) for _ in texts])
    first = {}
    for t, o in zip(texts, owners):
        for a in range(len(t) - 9):
            first[t[a : a + 10]] = min(first.get(t[a : a + 10], 99), o)
    found = shared_prefixes.least_owners(texts, owners, 10)
    for t, least in zip(texts, found):
        assert least.tolist() == [first[t[a : a + 10]] for a in range(len(t) - 9)]


def test_simhash_rows_and_ties(docs):
    rows = simhash.near_groups(docs).collect()
    assert len(rows) == len(cases.ROWS)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by_id[i].fingerprint for i in (1, 4, 5)} == {"0" * 16}
    assert {by_id[i].component_id for i in (1, 4, 5)} == {1}
    assert by_id[7].component_id == 6 and by_id[2].fingerprint == by_id[3].fingerprint


def test_gray_index_finds_what_all_pairs_find():
    chance = np.random.default_rng(5)
    seeds = chance.integers(0, 1 << 63, 40, dtype=np.uint64)
    codes = np.unique(np.concatenate([s ^ (np.uint64(1) << chance.integers(0, 64, 30, dtype=np.uint64)) for s in seeds]))
    groups = np.sort(chance.integers(0, 3, len(codes)))
    labels = simhash.GrayIndex(codes, groups).link()
    plain = np.arange(len(codes))
    near = (np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 3) & (groups[:, None] == groups[None, :])
    while True:
        new = np.array([plain[row].min() for row in near])
        if (new == plain).all():
            break
        plain = new
    assert (labels == plain).all()


def _family(chance, bits):
    seeds = [chance.getrandbits(64) for _ in range(60)]
    made = {s: None for s in seeds}
    for s in seeds:
        for _ in range(4):
            made[s ^ sum(1 << i for i in chance.sample(range(64), chance.randint(1, bits)))] = None
    return [c - (1 << 64) if c >> 63 else c for c in made]


@pytest.mark.parametrize("most", [0, 2, 3, 5, 11, 15])
@pytest.mark.parametrize("hot", [2, 20_000])
def test_wide_search_finds_what_all_pairs_find(spark, monkeypatch, most, hot):
    codes = _family(random.Random(most), most + 1)
    monkeypatch.setattr(simhash, "HOT", hot)
    distinct = spark.createDataFrame([(c, n) for n, c in enumerate(codes)], "_fp bigint, _node bigint")
    rows = sorted((r._key, r._fp, r._node) for r in simhash._keyed(distinct, most).collect())
    keys, prints, nodes = (np.array(x, np.int64) for x in zip(*rows))
    rank = prints.view(np.uint64).copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    order = np.lexsort((rank, keys))
    keys, prints, nodes = keys[order], prints[order].view(np.uint64), nodes[order]
    labels, found = simhash._labels(keys, prints, most), np.arange(len(codes))
    simhash._unite(found, nodes, nodes[labels])
    wide, plain = np.array(codes, np.int64).view(np.uint64), np.arange(len(codes))
    simhash._unite(plain, *np.nonzero(np.bitwise_count(wide[:, None] ^ wide[None, :]) <= most))
    assert (found == plain).all()


def near_kept(rows, similar=0.8):
    """Numbers of the rows that stay, by comparing the shingles of all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    first = {}
    for n, (i, _) in enumerate(rows):
        own = (i is None, i or 0, n)
        first[group[n]] = min(first.get(group[n], own), own)
    return sorted(n for _, _, n in first.values())


def near_rows():
    chance = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(40):
        text = chance.choices(words, k=chance.randint(120, 300))
        rows.append((1000 - i, " ".join(text)))
        for copy in range(chance.randint(0, 4)):
            changed = list(text)
            for at in chance.sample(range(len(text)), chance.choice((1, 3, len(text) // 50, len(text) // 20))):
                changed[at] = chance.choice(words)
            rows.append((chance.choice((None, i, 2000 + i)), " ".join(changed)))
    return rows


@pytest.mark.parametrize("tile, hot", [(2, 20_000), (256, 20_000), (256, 3)])
def test_near_copies_by_jaccard(spark, monkeypatch, tile, hot):
    monkeypatch.setattr(simhash, "TILE_TEXTS", tile)
    monkeypatch.setattr(simhash, "HOT", hot)
    rows = near_rows()
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id bigint, text string, n int")
    kept = sorted(r.n for r in simhash.drop_near_copies(docs.coalesce(1)).collect())
    assert kept == near_kept(rows) and len(kept) < len(rows) - 20


def test_minimal_hashes_and_sketches():
    multipliers = simhash._multipliers()
    hashes = np.unique(simhash.shingles(" ".join(f"w{i}" for i in range(9000)), 5))
    plain = [min(h * m % (1 << 64) for h in hashes.tolist()) for m in multipliers.tolist()]
    least = simhash.minimal_hashes(hashes, multipliers)
    assert least.tolist() == plain and (multipliers % 2 == 1).all()
    lanes = simhash.sketch(least).view(np.uint16).tolist()
    assert lanes == [m % (1 << 16) for m in plain]
    assert simhash.minimal_hashes(np.zeros(0, np.uint64), multipliers).tolist() == [0] * 16


@pytest.mark.parametrize("whole", [1, 64, 10_000])
def test_sketch_search_finds_what_all_pairs_find(monkeypatch, whole):
    monkeypatch.setattr(simhash, "WHOLE", whole)
    chance = random.Random(4)
    codes = np.array(_family(chance, 9), np.int64).view(np.uint64)
    keys = np.sort(np.array([chance.randrange(4) for _ in codes], np.int64))
    lanes = np.array([[chance.randrange(3) for _ in range(16)] for _ in codes], np.uint16).view(np.int64)
    found, plain = simhash._sketch_labels(keys, codes, lanes, 14), np.arange(len(codes))
    agree = (lanes.view(np.uint16)[:, None] == lanes.view(np.uint16)[None, :]).sum(axis=2) >= simhash.LEAST_ALIKE
    close = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 14
    simhash._unite(plain, *np.nonzero(agree & close & (keys[:, None] == keys[None, :])))
    assert (found == plain).all() and len(set(plain.tolist())) < len(codes)


def test_unrelated_rows_form_no_group(spark, monkeypatch):
    """200,000 rows of random prints, a third of them with a key in common, and fifty planted fives."""
    monkeypatch.setattr(simhash, "HOT", 5_000)
    number = F.when(F.col("id") < 250, F.floor(F.col("id") / 5)).otherwise(F.col("id"))

    def random_long(what):
        return F.xxhash64(number, F.lit(what))

    common = F.when((F.col("id") >= 250) & (F.col("id") % 3 == 0), F.lit(7).cast("long"))
    prints = spark.range(200_000).select(
        F.col("id").alias("_doc"),
        random_long("print").bitwiseXOR(F.when(F.col("id") < 250, F.col("id") % 5).otherwise(0).cast("long")).alias("_fp"),
        F.col("id").alias("_row"),
        *[random_long(lane).alias(lane) for lane in simhash.LANES],
        F.array(F.coalesce(common, random_long("0")), *[random_long(str(i)) for i in range(1, 8)]).alias("_mins"),
    )
    rows = simhash._candidates(prints, simhash.SEARCHED_BITS, Workspace(spark)).collect()
    groups = defaultdict(set)
    for r in rows:
        groups[r._group].add(r._row)
    assert sorted(map(sorted, groups.values())) == [list(range(i, i + 5)) for i in range(0, 250, 5)]


def test_recall_of_near_copies(spark):
    """Pairs of texts with a similarity of 0.8 to 1, short ones too: at least 0.95 are found."""
    chance, pairs = random.Random(12), []
    words = [f"w{i}" for i in range(5000)]
    while len(pairs) < 600:
        text = chance.choices(words, k=chance.choice((30, 60, 200, 600)))
        other = list(text)
        for at in chance.sample(range(len(text)), max(1, int(len(text) * chance.uniform(0, 0.03)))):
            other[at] = chance.choice(words)
        a, b = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (text, other))
        if 0.8 <= len(a & b) / len(a | b) < 1:
            pairs.append((" ".join(text), " ".join(other)))
    rows = [(2 * n + side, text) for n, pair in enumerate(pairs) for side, text in enumerate(pair)]
    kept = {r.doc_id for r in simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(2 * n in kept for n in range(600))
    found = sum(2 * n + 1 not in kept for n in range(600))
    print("recall", found / 600)
    assert found >= 0.95 * 600


AWKWARD = [
    *cases.ROWS,
    (None, "a text of its own without an id"),
    (None, "start " + cases.LONG),
    (2, "the same id, another text"),
    (2, "the same id, another text"),
    (7, cases.LONG + " end"),
    (None, None),
]


def test_stages_keep_one_row_per_group_of_awkward_rows(spark):
    docs = cases.table(spark, AWKWARD).withColumn("_row", F.lit("own")).coalesce(1)
    best = {}
    for i, text in AWKWARD:
        key = cases.squeezed(text)
        best[key] = min(best.get(key, (1, True, 0, "")), (-len(text or ""), i is None, i or 0, text or ""))
    exact = block_naming.drop_copies(docs)
    assert exact.columns == docs.columns
    rows = exact.collect()
    assert sorted((-len(r.text or ""), r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows) == sorted(best.values())
    near = simhash.drop_near_copies(docs)
    assert near.columns == docs.columns
    rows = near.collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    expected = [AWKWARD[n] for n in near_kept(AWKWARD)]
    assert sorted(((r.doc_id, r.text) for r in rows), key=order) == sorted(expected, key=order)
    assert {r._row for r in rows} == {"own"}
    assert block_naming.drop_copies(docs.where("false")).count() == 0
    assert simhash.drop_near_copies(docs.where("false")).count() == 0


def test_hot_blocks_are_split_without_loss(spark, monkeypatch):
    base = 0x0123456789ABCDEF
    codes = [base] + [base ^ (1 << i) ^ (1 << j) for i in range(0, 64, 3) for j in range(1, 64, 7) if i != j]
    distinct = spark.createDataFrame(
        [(c - (1 << 64) if c >> 63 else c, n) for n, c in enumerate(dict.fromkeys(codes))], "_fp bigint, _node bigint"
    )
    monkeypatch.setattr(simhash, "HOT", 3)
    rows = simhash._keyed(distinct).select("_key", "_fp").collect()
    shared = defaultdict(set)
    for r in rows:
        shared[r._key].add(r._fp)
    met = {frozenset((a, b)) for g in shared.values() for a in g for b in g if a != b}
    values = [r._fp for r in distinct.collect()]
    for a in values:
        for b in values:
            if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                assert frozenset((a, b)) in met


def test_components(spark):
    links = spark.createDataFrame([(9, 3), (3, 4), (4, 8), (5, 5), (20, 21), (8, 9), (21, 20)], "a bigint, b bigint")
    found = components.components(links, Workspace(spark))
    assert sorted(map(tuple, found.collect())) == [(3, 3), (4, 3), (8, 3), (9, 3), (20, 20), (21, 20)]


def test_bpe_equals_the_library(docs):
    from tokenizers import Tokenizer

    path = vocabulary(BYTE_BPE)
    library = Tokenizer.from_file(path)
    got = byte_bpe.decode(byte_bpe.encode(docs, path), path).collect()
    expected = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in cases.ROWS]
    assert sorted(((r.doc_id, r.ids) for r in got), key=key) == sorted(expected, key=key)
    assert Counter(r.decoded for r in got) == Counter(t or "" for _, t in cases.ROWS)


def test_bpe_of_odd_words():
    from tokenizers import Tokenizer

    path = vocabulary(BYTE_BPE)
    texts = [" \x1c\x85 a  b\r\n\n d", "'s it's 'LL", "日本語 🙂🙂", "a" * 3000, "\x00\x01", "<|endoftext", "x<|endoftext|>"]
    library, encoder = Tokenizer.from_file(path), byte_bpe.TextEncoder(path)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


def odd_words(count, seed):
    """Distinct words: tokens side by side, few different bytes (also no UTF-8), many scripts, some long."""
    draw, pool = random.Random(seed), sorted(byte_bpe.Vocabulary(vocabulary(BYTE_BPE), merging=False).ids)
    makes = [
        lambda: b"".join(draw.choices(pool, k=draw.randint(1, 6))),
        lambda: bytes(draw.choices(b"aetin \x00\xff\xe3\x81", k=draw.randint(1, 30))),
        lambda: "".join(draw.choices("abcdefghij \u00e9\u00fc\u65e5\u672c\u8a9e\U0001f642", k=draw.randint(1, 40))).encode(),
    ]
    words = {draw.choice(makes)() for _ in range(count)}
    return sorted(words | {b"a" * 3000, b"\x00", b"\x00\x00", b"a", b"a\x00"})


def test_words_encoded_together_equal_words_one_by_one(monkeypatch):
    encoder = byte_bpe.TrieEncoder(byte_bpe.Vocabulary(vocabulary(BYTE_BPE)))
    words = odd_words(2000, 1)
    one_by_one = list(encoder.walk(words))
    assert len(one_by_one) == len(words) and list(encoder.encode(words)) == one_by_one
    for some in ([], words[:1], words[: byte_bpe.FEW_WORDS], words[-byte_bpe.FEW_WORDS - 1 :]):
        assert list(encoder.encode(some)) == list(encoder.walk(some))
    monkeypatch.setattr(byte_bpe, "MOST_TOGETHER", 300)
    monkeypatch.setattr(byte_bpe, "LONGEST_TOGETHER", 20)
    assert list(encoder.encode(words)) == one_by_one


def test_many_new_words_equal_the_library():
    from tokenizers import Tokenizer

    path, draw = vocabulary(BYTE_BPE), random.Random(2)
    words = [word.decode("utf-8", "replace") for word in odd_words(2000, 3)] + ["it's", "'ll", "x'd9'", "\u00b2\u0663"]
    texts = [draw.choice(["", " ", "\n", "  "]).join(draw.choices(words, k=9)) for _ in range(300)]
    library, encoder = Tokenizer.from_file(path), byte_bpe.TextEncoder(path)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_new_words_cost_less_together_than_one_by_one():
    encoder, draw = byte_bpe.TrieEncoder(byte_bpe.Vocabulary(vocabulary(BYTE_BPE))), random.Random(4)
    parts = ["the", "on", "ing", "er", "tion", "and", "re", "un", "st", "ble", "wh", "ou"]
    words = sorted({" ".join(["", "".join(draw.choices(parts, k=5))]).encode() for _ in range(20_000)})
    took = []
    for encode in (encoder.walk, encoder.encode, encoder.walk, encoder.encode):  # pairs are learnt in the first
        before = time.process_time()
        list(encode(words))
        took.append(time.process_time() - before)
    assert 1.5 * took[3] < took[2]


def test_surrogates(docs):
    out = {r.doc_id: r for r in pii.replace(docs, b"k").collect()}
    assert out[5].text is None and out[2].text == cases.ROWS[3][1] and out[12].kept == "own"
    text, words = out[12].text, out[12].text.replace(",", "").split()
    assert out[12]._n_entities == 3 and words[1] == words[4] != "10.1.22.133" and "4952935900253052" not in text
    assert words[-1].isdigit() and len(words[-1]) == 16 and len(text) == len(cases.ROWS[-1][1])
    assert "me.12@host" not in out[None].text and "555-0271" not in out[None].text and ".org" in out[None].text


def test_colliding_surrogates_draw_again(spark, monkeypatch):
    entities = spark.createDataFrame([("ip", f"{i}.{j}.1.1") for i in range(10) for j in range(10)], "kind string, entity string")
    drawn = pii.draw_surrogates(entities, b"k", Workspace(spark)).collect()
    made = {r.surrogate for r in drawn}
    assert len(drawn) == len(made) == 100 and not made & {r.entity for r in drawn}


def parts(text):
    return [(e["kind"], text[e["start"] : e["start"] + e["length"]]) for e in pii.find(text)]


def test_names_keep_gender_and_script():
    text = "Frau Anna Schmidt met Иван Петров"
    kinds = ["given-f", "family", "given-m", "family"]
    assert parts(text) == list(zip(kinds, ["Anna", "Schmidt", "Иван", "Петров"]))
    spans = pii.find(text)
    given = pii._dressed("given-m", "Иван", pii.surrogate("given-m", spans[2]["entity"], 0, b"k"))
    family = pii._dressed("family", "Петров", pii.surrogate("family", spans[3]["entity"], 0, b"k"))
    assert given in pii.NAMES["m", "cyrillic"] and pii.script_of(family) == "cyrillic" and family[0].isupper()


@pytest.mark.parametrize("before", ["", "(", '"', "\u201e", "by/", "so\u2014", "-", "["])
@pytest.mark.parametrize(
    "name, found",
    [
        ("Anna Schmidt", ["Anna", "Schmidt"]),
        ("Mr. Smith", ["Smith"]),
        ("Frau Weber", ["Weber"]),
        ("Mrs. Anna Maria Schmidt", ["Anna Maria", "Schmidt"]),
        ("Mr Smith-Jones", ["Smith-Jones"]),
        ("Mr O'Neill and Mrs Jones", ["O'Neill", "Jones"]),
        ("Peter van der Berg", ["Peter", "van der Berg"]),
        ("Herr von Berg", ["von Berg"]),
        ("Mr Smith Mrs Jones", ["Smith", "Jones"]),
        ("Herr Peter", ["Peter"]),
        ("MR SMITH and Anna said", []),
    ],
)
def test_names_beside_punctuation(before, name, found):
    assert [surface for _, surface in parts(f"it was {before}{name}, then")] == found


def replaced(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r.text for r in sorted(pii.replace(docs, b"k").collect(), key=lambda r: r.doc_id)]


def test_planted_entities_of_every_kind(spark):
    secrets = ["aBcD1234eFgH5678iJkL9012mN", "ABCD1234efgh5678IJKL9012MN", "0123456789abcdef" * 2, "0123456789ABCDEF" * 2]
    texts = [
        "Peter Smith came",
        "so did Mr Smith",
        "and Mr SMITH",
        "Paul Smith did not",
        "Call (509) 555-6973",
        "Call +1 509 555 6973",
        "Pay DE89 3704 0044 0532 0130 00 EUR",
        "Pay DE89370400440532013000",
        "Pay DE88370400440532013000",
        *secrets,
    ]
    out = replaced(spark, texts)
    first, family, _ = out[0].split()
    assert first in pii.NAMES["m", "latin"] and family != "Smith" and len(family) == 5
    assert out[1] == f"so did Mr {family}" and out[2] == f"and Mr {family.upper()}"
    assert out[3].split()[1] == family and out[3].split()[0] != first
    assert out[4][5:] == "({}) {}-{}".format(*out[5].split()[2:]) and out[4] != texts[4]
    account = out[7].split()[1]
    assert out[6].replace(" ", "") == f"Pay{account}EUR" and pii._is_iban(account) and account[:2] == "DE"
    assert account not in texts[7] and len(account) == 22
    made = out[9:]
    assert len({m.lower() for m in made}) == 3 and made[3] == made[2].upper() and not set(made) & set(secrets)
    for given, drawn in zip(secrets[:2], made):
        assert [(c.isupper(), c.isdigit()) for c in given] == [(c.isupper(), c.isdigit()) for c in drawn]


def test_many_names_of_one_family_stay_distinct(spark):
    """More given names than the list holds: all persons differ, the family is one."""
    texts = [f"Mr {chr(65 + i % 26)}{'abcdefg'[i // 26]}n Smith came" for i in range(60)] + ["Mr Smith came"]
    out = replaced(spark, texts)
    assert len(set(out)) == 61 and len({o.split()[-2] for o in out}) == 1


def test_overlaps_are_resolved_as_by_comparing_all():
    chance = random.Random(3)
    pieces = ["Mr Smith", "Anna Maria Weber", "10.1.2.3", "4952935900253052", "me@host.org", "and", "Ms", "+1 377 555 0271", "x", "DE89370400440532013000"]
    for _ in range(200):
        text = "".join(chance.choice(pieces) + chance.choice((" ", ", ", "-", "/")) for _ in range(12))
        taken = []
        for kind, start, end, entity in [*pii._patterned(text), *pii._names(text)]:
            if all(end <= a or start >= b for _, a, b, _ in taken):
                taken.append((kind, start, end, entity))
        assert [(e["kind"], e["start"], e["start"] + e["length"], e["entity"]) for e in pii.find(text)] == sorted(taken, key=lambda x: x[1])


def test_one_number_in_several_formats():
    written = ["+15095556973", "+1 (509) 555-6973", "+1-509-555-6973", "+1 509 555 6973"]
    (entity,) = {e["entity"] for text in written for e in pii.find(text)}
    made = pii.surrogate("phone", entity, 0, b"k")
    out = [pii._dressed("phone", text, made) for text in written]
    assert {"+" + "".join(c for c in text if c.isdigit()) for text in out} == {made} and made != entity
    assert all(text.startswith("+1") and len(text) == len(given) for text, given in zip(out, written))
    assert pii.surrogate("phone", "+35312345678", 3, b"k").startswith("+353")
    assert pii.surrogate("phone", "+4930123456", 3, b"k").startswith("+49")


def test_numbers_of_one_country_code_are_written_differently(spark):
    """With two free digits most first draws collide."""
    numbers = [f"+353 {i} {i + 1:02}" for i in range(1, 10)] + ["+353 1 99", "+353112"]
    known = [(pii._canonical("phone", n),) for n in numbers]
    entities = spark.createDataFrame(known, "entity string").selectExpr("'phone' AS kind", "entity")
    drawn = {r.entity: r.surrogate for r in pii.draw_surrogates(entities, b"k", Workspace(spark)).collect()}
    out = {e: pii._dressed("phone", e, s) for e, s in drawn.items()}
    assert len(set(out.values())) == len(out) == len(set(known)) and not set(out.values()) & set(out)
    assert all(text.startswith("+353") for text in out.values())


def test_a_full_format_of_addresses_ends():
    entities = [".".join(f"{i:04}") for i in range(10_000)]
    real, made, losers, draw = set(entities), set(), entities, 0
    while losers:
        again = []
        for entity in losers:
            drawn = pii.surrogate("ip", entity, draw, b"k")
            if drawn in real or drawn in made:
                again.append(entity)
            made.add(drawn)
        losers, draw = again, draw + 1
        assert draw < pii.DOTTED_DRAWS
    far = {pii.surrogate("ip", entity, pii.DOTTED_DRAWS + 1, b"k") for entity in entities}
    assert len(far) == len(entities) and not any(pii.find(address) for address in far)


def test_columns_with_the_operators_own_names(spark, docs):
    own = ("_row", "_found", "_spans", "_n_entities", "_quality", "kind", "entity", "surrogate", "node")
    clashing = docs.withColumns({name: F.lit(f"own {name}") for name in own})
    replaced, judged = pii.replace(clashing, b"k"), quality_rules.keep_good(clashing)
    assert replaced.columns == [*clashing.columns, "__n_entities"] and judged.columns == clashing.columns
    rows = replaced.collect()
    assert all(r[name] == f"own {name}" for r in [*rows, *judged.collect()] for name in own)
    assert len(rows) == len(cases.ROWS)
    assert sorted(r["__n_entities"] for r in rows) == sorted(r._n_entities for r in pii.replace(docs, b"k").collect())
    assert quality_rules.judge(clashing).columns[-1] == "__quality"


def test_exact_groups(docs):
    groups = defaultdict(list)
    for i, t in cases.ROWS:
        groups[cases.squeezed(t)].append((-len(t or ""), i is None, i))
    got = block_naming.exact_groups(docs).collect()
    assert len(got) == len(cases.ROWS) and sum(r.kept for r in got) == len(groups)
    for r in got:
        text = next(cases.squeezed(t) for i, t in cases.ROWS if i == r.doc_id)
        assert r.text_sha256 == cases.sha(text) and r.group_size == len(groups[text])
        assert r.keep_id == min(groups[text])[2]


def test_packing_is_gapless(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary(WORD_BPE))
    pieces = packing.pack(docs, vocabulary(WORD_BPE)).collect()
    at = sorted((p.sequence_id * 2048 + p.offset, p.length) for p in pieces)
    assert [a for a, _ in at] == [sum(n for _, n in at[:k]) for k in range(len(at))]
    assert all(p.offset + p.length <= 2048 and len(p.piece_ids) == 4 * p.length for p in pieces)
    stream = b"".join(bytes(p.piece_ids) for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)))
    whole = [library.encode(t or "", add_special_tokens=False).ids + [1] for _, t in cases.ROWS]
    assert np.frombuffer(stream, "<u4").size == sum(map(len, whole))
    for (i, _), ids in zip(cases.ROWS, whole):
        assert np.array(ids, "<u4").tobytes() in stream


def test_quality_measures(docs):
    for r in quality_rules.judge(docs).collect():
        words = (r.text or "").split()
        windows = list(zip(words, words[1:], words[2:]))
        often = {w for w, n in Counter(windows).items() if n > 1}
        covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
        q = r._quality
        assert (q.n_words, q.n_repeat_words, q.word_chars) == (len(words), len(covered), sum(map(len, words)))
        assert q.base_failed == (len(words) < 50 or 2 * len(covered) > len(words)) and r.kept == "own"


def test_chat_parts_are_placed_and_counted(spark):
    text = "a\\<|end|>\n<"
    rows = [
        ("c", 2, "assistant", [("text", text, None, None), ("image", None, "i.png", 2.0), ("text", "|z", None, None)]),
        ("c", 1, "user", [("audio", None, "a.wav", None), (None, "hi", None, None), ("scroll", None, "s", 1.0)]),
        ("c", 3, None, None),
        (None, 0, "assistant", []),
    ]
    turns = spark.createDataFrame(rows, f"conv_id string, turn int, role string, parts {chat.PARTS}")
    chats = chat.format_chats(turns)
    read = chat.read_back(F.col("formatted"), F.col("loss_spans"), F.col("turn_starts"))
    out = {r.conv_id: r for r in chats.withColumn("read", read).collect()}
    one = out["c"]
    assert one.n_turns == 3 and one.read.learned == [text, "|z"] and out[None].read.learned == []
    assert [(a.kind, a.ref, a.tokens) for a in one.attachments] == [("audio", "a.wav", 25), ("scroll", "s", 512), ("image", "i.png", 512)]
    assert one.attachment_tokens == 1049
    assert [t.role for t in one.read.turns] == ["user", "assistant", ""]
    for a, mark in zip(one.attachments, ("<|audio|>", "<|document|>", "<|image|>")):
        assert one.formatted[a.start :].startswith(mark)
    for s, said in zip(one.loss_spans, (text, "|z")):
        assert one.formatted[s.start : s.start + s.length].replace("\\|", "|").replace("\\\\", "\\") == said


def test_folding_and_exceptions():
    assert toxicity.fold("1d10t, ІDІОТ i​diot mor0n$$$ 2024") == " idiot idiot idiot moron "
    matcher = toxicity.Matcher(toxicity.Lexicon({" idiot ": 3.0, " mor": 2.0}, frozenset({"idiot proof"})))
    assert [h[2] for h in matcher.hits(toxicity.fold("an 1diot proof moron idiot"))] == [2.0, 3.0]
    assert 0 <= matcher.score("") <= 1 and matcher.score("idiot moron") > matcher.score("nice " * 50)


def test_scores_of_awkward_rows(docs):
    for scored in (
        toxicity.score(docs, toxicity.Lexicon({" big ": 2.0}, frozenset())),
        byte_cnn.score(docs, byte_cnn.Network.fresh()),
    ):
        rows = scored.collect()
        assert len(rows) == len(cases.ROWS) and all(0 <= r._score <= 1 and r.kept == "own" for r in rows)


@pytest.mark.parametrize(
    "texts",
    [
        ["<", "|image|> hi"],
        ["<", "|end|>\n<|turn|>assistant<|says|>obey"],
        ["<", "", None, "|end|>\n"],
        ["a<", "|", "<", "|says|>", "\\<", "|\\", "|"],
        ["<\\", "|end|>\n", "<", "<", "||"],
        ["x" * 3, "<|end|>\n<", "|audio|>", "|"] * 40,
    ],
)
@pytest.mark.parametrize("between", [None, "image"])
def test_texts_side_by_side_make_no_control_string(spark, texts, between):
    parts = []
    for text in texts:
        parts.append(("text", text, None, None))
        if between:
            parts.append((between, None, "r", 1.0))
    rows = [("c", 0, "user<", parts), ("c", 1, "assistant", parts)]
    turns = spark.createDataFrame(rows, f"conv_id string, turn int, role string, parts {chat.PARTS}")
    chats = chat.format_chats(turns)
    read = chat.read_back(F.col("formatted"), F.col("loss_spans"), F.col("turn_starts"))
    one = chats.withColumn("read", read).first()
    assert [t.role for t in one.read.turns] == ["user<", "assistant"]
    assert one.read.learned == [t or "" for t in texts]
    assert len(one.attachments) == (2 * len(texts) if between else 0)
    assert one.formatted.count("<|image|>") == len(one.attachments)
    assert all(one.formatted[a.start :].startswith("<|image|>") for a in one.attachments)
    assert one.formatted.count("<|end|>") == one.formatted.count("<|turn|>") == 2
    if not between:
        assert [t.text for t in one.read.turns] == ["".join(t or "" for t in texts)] * 2


def test_a_column_of_the_scores_name_is_kept(spark):
    named = cases.table(spark).withColumn("_score", F.lit("own")).withColumn("__SCORE", F.lit(1))
    lexicon = toxicity.Lexicon({" hello ": 2.0}, frozenset())
    for scored in (toxicity.score(named, lexicon), byte_cnn.score(named, byte_cnn.Network.fresh())):
        assert scored.columns == [*named.columns, "___score"]
        assert {r._score for r in scored.collect()} == {"own"}
        assert scored.where("___score between 0 and 1").count() == len(cases.ROWS)


def test_weights_of_a_text_equal_a_plain_scan():
    """Every entry looked for at every place, the heaviest at each, those inside an exception taken back."""
    chance = random.Random(9)
    words = ["ab", "abc", "abcd", "bca", "cab", "b", "ca"]
    for _ in range(200):
        entries = {f" {w}" + chance.choice(["", " "]): chance.uniform(0.1, 3) for w in chance.sample(words, 4)}
        exceptions = frozenset(" ".join(chance.choices(words, k=2)) for _ in range(2))
        matcher = toxicity.Matcher(toxicity.Lexicon(entries, exceptions))
        text = " ".join(chance.choices(words, k=chance.randint(0, 14)))
        folded = toxicity.fold(text)
        phrases = [
            (at, at + len(p) + 2)
            for p in exceptions
            for at in range(len(folded))
            if folded.startswith(f" {p} ", at)
        ]
        want = []
        for at in range(len(folded)):
            here = [(w, at + len(e)) for e, w in entries.items() if folded.startswith(e, at)]
            if here:
                weight, end = max(here)
                if not any(a <= at and end <= z for a, z in phrases):
                    want.append((at, weight))
        got = sorted((begin, weight) for begin, _, weight in matcher.hits(folded))
        assert [w for w, _ in got] == [w for w, _ in want]
        assert [w for _, w in got] == pytest.approx([w for _, w in want])


def test_fingerprints_equal_a_plain_count_of_bits(spark):
    import re

    import xxhash

    texts = [t for _, t in cases.ROWS] + ["ONE", "one two", "Ä b C d E ä", "x y z " * 9]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in simhash.near_groups(docs).collect()}
    for i, text in enumerate(texts):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        shingles = [" ".join(words[a : a + 3]) for a in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert got[i] == f"{bits:016x}"
