"""Byte-level BPE by a trie of distinct words that share their prefixes' encodings.

The distinct new words of a batch are sorted, so that words with a common prefix
stand together, and their trie is walked level by level, all nodes of a level at
once.  Each node holds one state: the last token of its prefix's encoding.  That
token is the only one which ends the prefix and stays apart from the last token
before it, so a node needs the states above it and nothing else, and a prefix
shared by many words is encoded once.  A word's encoding is read off by jumping
from its node back over last tokens.  Long words, and levels that only a few words
reach, are not worth it; those words are walked one after another, depth first.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.packing import byte_letters
from encore.llm.tables import once_per_worker, values

# fixed value: how a byte-level vocabulary of this kind cuts a text into words; letters and
# numbers begin no contraction, so the commonest come first
WORDS = (
    r" ?\p{L}+| ?\p{N}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# words and pairs a task remembers; beyond it the memory starts anew
REMEMBERED_WORDS = 200_000
REMEMBERED_PAIRS = 400_000
LONGEST_REMEMBERED = 48
# words walked side by side, in bytes and number; levels with fewer than FEW_WORDS are not
LONGEST_TOGETHER = 256
MOST_TOGETHER = 1 << 16
FEW_WORDS = 64
# texts encoded together, so that their new words share one trie
BATCH_CHARS = 1 << 20


class Vocabulary:
    """Tokens as bytes, strings that are one token anywhere, and to encode merges as pairs of ids."""

    def __init__(self, path: str, merging: bool = True):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        plain = lambda token: bytes(byte_of[c] for c in token)
        self.ids = {plain(token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.bytes = {i: token for token, i in self.ids.items()}
        self.bytes |= {i: content.encode() for content, i in self.special.items()}
        if not merging:
            return
        self.merges = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = map(plain, merge.split(" ") if isinstance(merge, str) else merge)
            self.merges[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        # every string that begins a token; the tokens that end it are found when it is met
        self.begins: dict[bytes, list] = {token[:to]: [] for token in self.ids for to in range(1, len(token) + 1)}


class Endings:
    """Reads many strings side by side and knows the tokens that end what was read (Aho-Corasick)."""

    def __init__(self, ids: dict[bytes, int]):
        prefixes = sorted({token[:to] for token in ids for to in range(len(token) + 1)}, key=len)
        number = {prefix: state for state, prefix in enumerate(prefixes)}
        parent = np.array([number[prefix[:-1]] for prefix in prefixes])
        byte = np.array([prefix[-1] if prefix else 0 for prefix in prefixes])
        edges = parent[1:] << 8 | byte[1:]
        order = np.argsort(edges)
        self.edges, self.targets = edges[order], order + 1
        self.size = np.fromiter(map(len, prefixes), np.int64, len(prefixes))
        self.token = np.array([ids.get(prefix, -1) for prefix in prefixes])
        # the longest other state that ends a state, and the longest that is a token
        self.fail, self.shorter = np.zeros_like(parent), np.zeros_like(parent)
        starts = np.searchsorted(self.size, np.arange(2, self.size[-1] + 2))
        for level in map(slice, starts, starts[1:]):
            self.fail[level] = fail = self.step(self.fail[parent[level]], byte[level])
            self.shorter[level] = self.longest(fail)

    def step(self, states: np.ndarray, read: np.ndarray) -> np.ndarray:
        """The states after one more byte each."""
        reached = np.zeros_like(states)
        todo = np.arange(len(states))
        while len(todo):
            edges = states << 8 | read
            at = np.minimum(np.searchsorted(self.edges, edges), len(self.edges) - 1)
            found = self.edges[at] == edges
            reached[todo[found]] = self.targets[at[found]]
            rest = ~found & (states > 0)
            todo, states, read = todo[rest], self.fail[states[rest]], read[rest]
        return reached

    def longest(self, states: np.ndarray) -> np.ndarray:
        """The states of the longest tokens that end what was read."""
        return np.where(self.token[states] >= 0, states, self.shorter[states])


class TrieEncoder:
    """Encodes sets of words; remembers which neighbours stay apart."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.apart: dict[int, bool] = {}
        self.endings = Endings(vocabulary.ids)
        self.sizes = np.zeros(max(vocabulary.ids.values()) + 1, np.int64)
        for token, i in vocabulary.ids.items():
            self.sizes[i] = len(token)

    def _merged(self, text: bytes) -> list[int]:
        """The merges in order of rank, for the few bytes of one or two tokens."""
        tokens = [self.vocabulary.ids[text[i : i + 1]] for i in range(len(text))]
        merges = self.vocabulary.merges
        while len(tokens) > 1:
            pairs = list(zip(tokens, tokens[1:]))
            found = [pair for pair in pairs if pair in merges]
            if not found:
                break
            first = min(found, key=merges.__getitem__)
            at = pairs.index(first)
            tokens[at : at + 2] = [merges[first][1]]
        return tokens

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether the merges leave these two next to each other (left -1: a word's begin)."""
        key = left << 20 | right
        known = self.apart.get(key)
        if known is None:
            token_bytes = self.vocabulary.bytes
            if left < 0:
                known = self._merged(token_bytes[right]) == [right]
            elif (left, right) in self.vocabulary.merges:
                known = False
            else:
                known = self._merged(token_bytes[left] + token_bytes[right]) == [left, right]
            if len(self.apart) >= REMEMBERED_PAIRS:
                self.apart.clear()
            self.apart[key] = known
        return known

    def _tokens_of(self, tail: bytes) -> list[tuple[int, int]]:
        """Tokens that end a string, the shortest first."""
        ids = self.vocabulary.ids
        ends = (tail[at:] for at in range(len(tail)))
        found = [(len(end), ids[end]) for end in ends if end in ids][::-1]
        self.vocabulary.begins[tail] = found
        return found

    def _all_stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 20 | right).tolist()
        known = list(map(self.apart.get, keys))
        if None in known:
            known = [self._stay_apart(key >> 20, key & 0xFFFFF) if k is None else k for key, k in zip(keys, known)]
        return np.array(known, bool)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of sorted distinct words, as native 32-bit integers."""
        coded = []
        for begin in range(0, len(words), MOST_TOGETHER):
            some = words[begin : begin + MOST_TOGETHER]
            sizes = sorted(map(len, some), reverse=True)
            longest = min(sizes[FEW_WORDS - 1], LONGEST_TOGETHER) if len(some) >= FEW_WORDS else 0
            together = self._walk_together([word for word in some if len(word) <= longest])
            alone = [at for at, word in enumerate(some) if len(word) > longest]
            for at, ids in zip(alone, self.walk([some[at] for at in alone])):
                together.insert(at, ids)
            coded += together
        return coded

    def _walk_together(self, words: list[bytes]) -> list[bytes]:
        """The same, all nodes of a level at once."""
        endings = self.endings
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        read = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        # one last token for each prefix of each word, its empty prefix first
        roots = starts + np.arange(len(words))
        last = np.full(len(read) + len(words), -1, np.int32)
        going = np.arange(len(words))
        nodes, states = np.zeros_like(going), np.zeros(1, np.int64)
        for depth in range(1, sizes.max(initial=0) + 1):
            longer = sizes[going] >= depth
            going, nodes = going[longer], nodes[longer]
            byte = read[starts[going] + depth - 1].astype(np.int64)
            new = np.ones(len(going), bool)
            new[1:] = (nodes[1:] != nodes[:-1]) | (byte[1:] != byte[:-1])
            states = endings.step(states[nodes[new]], byte[new])
            nodes = np.cumsum(new) - 1
            ends, found = (roots[going] + depth)[new], np.full(len(states), -1)
            todo, tried = np.arange(len(states)), endings.longest(states)
            while len(todo):
                token = endings.token[tried]
                fits = self._all_stay_apart(last[ends[todo] - endings.size[tried]], token)
                found[todo[fits]] = token[fits]
                todo, tried = todo[~fits], endings.shorter[tried[~fits]]
                if not tried.all():
                    raise ValueError("no token ends a prefix as merged: these merges are no byte-pair encoding")
            last[roots[going] + depth] = found[nodes]
        return self._read_off(roots, sizes, last)

    def _read_off(self, roots: np.ndarray, sizes: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The ids of every word."""
        going, at, found = np.flatnonzero(sizes), sizes[sizes > 0], []
        while len(going):
            tokens = last[roots[going] + at]
            found.append((going, tokens))
            at = at - self.sizes[tokens]
            going, at = going[at > 0], at[at > 0]
        counts = np.zeros(len(roots), np.int64)
        for some, _ in found:
            counts[some] += 1
        ends = np.cumsum(counts)
        ids = np.zeros(counts.sum(), np.int32)
        for back, (some, tokens) in enumerate(found, 1):
            ids[ends[some] - back] = tokens
        coded = ids.tobytes()
        return [coded[begin:end] for begin, end in zip((4 * (ends - counts)).tolist(), (4 * ends).tolist())]

    def walk(self, words: list[bytes]) -> Iterator[bytes]:
        """The same, one word after another."""
        begins, known, ask = self.vocabulary.begins, self.apart, self._stay_apart
        token_bytes = self.vocabulary.bytes
        path, before = [-1], b""  # states from the root to the last word's node
        tails = [b""]  # and the longest end of each prefix that begins a token
        for word in words:
            shared = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                shared += 1
            del path[shared + 1 :], tails[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                tail = tails[-1] + word[end - 1 : end]
                while tail not in begins:
                    tail = tail[1:]
                tails.append(tail)
                for size, token in begins[tail] or self._tokens_of(tail):
                    left = path[end - size]
                    fits = known.get(left << 20 | token)
                    if fits or (fits is None and ask(left, token)):
                        path.append(token)
                        break
            before, ids, at = word, [], len(word)
            while at:
                ids.append(path[at])
                at -= len(token_bytes[path[at]])
            yield array("i", reversed(ids)).tobytes()


class TextEncoder:
    """Encodes whole texts, some at a time."""

    def __init__(self, path: str):
        import regex

        self.vocabulary = Vocabulary(path)
        self.trie = TrieEncoder(self.vocabulary)
        self.words = regex.compile(WORDS).findall
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = {s: array("i", [self.vocabulary.special[s]]).tobytes() for s in special}
        self.known: dict[str, bytes] = dict(self.special)
        self.split = regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split if special else None

    def _cut(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return self.words(text)
        parts = self.split(text)
        return [w for part in parts for w in ([part] if part in self.special else self.words(part))]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self._cut(text) for text in texts]
        fresh = set().union(*cut).difference(self.known)
        if len(self.known) + len(fresh) > REMEMBERED_WORDS:
            self.known = dict(self.special)
            fresh = set().union(*cut).difference(self.known)
        ordered = sorted(fresh)  # as their bytes
        self.known.update(zip(ordered, self.trie.encode([word.encode() for word in ordered]), strict=True))
        look = self.known.__getitem__
        coded = [b"".join(map(look, words)) for words in cut]
        for word in fresh:
            if len(word) > LONGEST_REMEMBERED:
                del self.known[word]
        return coded


def _encoder(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_per_worker(f"byte_bpe {path}", lambda: TextEncoder(path))

        def done(docs: list, texts: list[str]) -> pa.RecordBatch:
            coded = encoder.encode(texts)
            offsets = np.cumsum([0, *(len(ids) // 4 for ids in coded)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(coded), np.int32))
            return pa.record_batch([pa.array(docs, pa.int64()), ids], names=["doc_id", "ids"])

        for batch in batches:
            docs, texts, held = [], [], 0
            for doc, text in zip(values(batch.column(0)), values(batch.column(1), ""), strict=True):
                docs.append(doc)
                texts.append(text)
                held += len(text)
                if held >= BATCH_CHARS:
                    yield done(docs, texts)
                    docs, texts, held = [], [], 0
            if docs:
                yield done(docs, texts)

    return encode


def encode(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of every row, without special tokens added.

    A special token's string inside a text is that token, as in the vocabulary's
    own library.  A null or empty text has no ids.  Rows are encoded one by one:
    repeats alike, null ids kept, an empty table gives an empty one; other columns
    are not read.  ``vocabulary`` is the path of a byte-level vocabulary file.
    """
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        _encoder(vocabulary), "doc_id long, ids array<int>"
    )


def _decoder(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_bytes = once_per_worker(f"token_bytes {path}", lambda: Vocabulary(path, merging=False).bytes).__getitem__
        for batch in batches:
            texts = [
                b"".join(map(token_bytes, row.values.to_numpy().tolist())).decode("utf-8", "replace")
                if row.is_valid
                else ""
                for row in batch.column(1)
            ]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return decode


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` (``doc_id``, ``ids``) with ``decoded``, the text of the ids.

    Special tokens give their strings; bytes that are no UTF-8 give U+FFFD; null
    or no ids give an empty text.
    """
    return encoded.select("doc_id", "ids").mapInArrow(
        _decoder(vocabulary), "doc_id long, ids array<int>, decoded string"
    )
