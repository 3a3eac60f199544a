"""Quality classifier: a convolutional network over bytes, in numpy.

A filter is a table of weights per place and byte, so applying it to a window is
a sum of table rows.  Rectified filter values are averaged over overlapping
chunks that together cover the whole document; each filter's largest chunk and
its largest single value go, with two measures of length, into one logistic unit.
Training follows the gradient through the chunk that was the largest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from encore.llm.labelled import sample, with_score
from encore.llm.tables import values

SAMPLE_ROWS = 3_000
FILTERS = 24
WIDTH = 6
STRIDE = 2
# window places per half chunk; a chunk is two neighbouring halves
HALF = 64
# halves worked on together
STEP = 512
EPOCHS = 6


@dataclass
class Network:
    table: np.ndarray  # place, byte, filter
    bias: np.ndarray
    out: np.ndarray  # chunk means, single values, length measures, constant

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        table = rng.normal(0, 0.4, (WIDTH, 256, FILTERS)).astype(np.float32)
        return cls(table, np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS + 3, np.float32))


def _places(text: bytes) -> np.ndarray:
    """Bytes with blanks behind, so that full halves of windows cover every byte."""
    x = np.frombuffer(text, np.uint8)
    halves = max(2, -(-len(x) // (HALF * STRIDE)))
    padded = np.full(halves * HALF * STRIDE + WIDTH, 32, np.uint8)
    padded[: len(x)] = x
    return padded


def _filtered(net: Network, x: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Rectified filter values of the windows of halves ``begin`` to ``end``."""
    first, count = begin * HALF * STRIDE, (end - begin) * HALF
    values_ = np.repeat(net.bias[None, :], count, axis=0)
    for place in range(WIDTH):
        values_ += net.table[place].take(x[first + place :: STRIDE][:count], axis=0)
    return np.maximum(values_, 0, out=values_)


def features(net: Network, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs of the last unit, with the chunk and the window each maximum came from."""
    x = _places(text)
    halves = (len(x) - WIDTH) // (HALF * STRIDE)
    sums, tops, at = [], np.full(FILTERS, -1.0, np.float32), np.zeros(FILTERS, np.int64)
    for begin in range(0, halves, STEP):
        end = min(halves, begin + STEP)
        found = _filtered(net, x, begin, end)
        sums.append(np.add.reduceat(found, np.arange(0, len(found), HALF), axis=0))
        here = found.argmax(axis=0)
        top = found[here, np.arange(FILTERS)]
        at = np.where(top > tops, here + begin * HALF, at)
        tops = np.maximum(tops, top)
    sums = np.concatenate(sums)
    chunks = (sums[:-1] + sums[1:]) / (2 * HALF)
    largest = chunks.argmax(axis=0)
    length = np.float32(np.log1p(len(text)) / 10)
    inputs = np.concatenate([chunks[largest, np.arange(FILTERS)], tops / 4, [length, length * length, 1]])
    return inputs.astype(np.float32), largest, at, x


def probability(net: Network, text: bytes) -> float:
    inputs = features(net, text)[0]
    return float(1 / (1 + np.exp(-np.clip(inputs @ net.out, -30, 30))))


def train(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """A network fitted by adaptive gradient steps, classes weighted alike."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    labels = np.asarray(labels, np.float64)
    if len(labels) == 0 or labels.min() == labels.max():
        net.out[-1] = 0.0 if len(labels) == 0 else (4.0 if labels[0] else -4.0)
        return net
    weight = {1.0: 0.5 / labels.mean(), 0.0: 0.5 / (1 - labels.mean())}
    seen = {"table": np.full_like(net.table, 1e-4), "bias": np.full_like(net.bias, 1e-4), "out": np.full_like(net.out, 1e-4)}
    each = np.arange(FILTERS)
    for epoch in range(epochs):
        rate = 0.08 / (1 + epoch)
        for i in rng.permutation(len(labels)):
            inputs, largest, at, x = features(net, texts[i])
            p = 1 / (1 + np.exp(-np.clip(inputs @ net.out, -30, 30)))
            error = (p - labels[i]) * weight[labels[i]]
            slope = (error * net.out[: 2 * FILTERS]).astype(np.float32)
            step = error * inputs
            seen["out"] += step * step
            net.out -= rate * step / np.sqrt(seen["out"])
            # windows of each filter's largest chunk, where the filter is above zero
            windows = largest[None, :] * HALF + np.arange(2 * HALF)[:, None]
            share = np.broadcast_to(slope[:FILTERS] / (2 * HALF), windows.shape)
            windows = np.vstack([windows, at[None, :]])
            share = np.vstack([share, slope[None, FILTERS:] / 4])
            places = windows[None] * STRIDE + np.arange(WIDTH)[:, None, None]
            bytes_ = x[places]
            above = sum(net.table[w, bytes_[w], each[None, :]] for w in range(WIDTH)) + net.bias > 0
            share = np.where(above, share, 0)
            bias = share.sum(axis=0)
            seen["bias"] += bias * bias
            net.bias -= rate * bias / np.sqrt(seen["bias"])
            key = (np.arange(WIDTH)[:, None, None] * 256 + bytes_) * FILTERS + each
            flat = np.bincount(key.ravel(), np.broadcast_to(share, key.shape).ravel(), net.table.size)
            touched = np.flatnonzero(flat)
            step = flat[touched].astype(np.float32)
            squares = seen["table"].reshape(-1)
            squares[touched] += step * step
            net.table.reshape(-1)[touched] -= rate * step / np.sqrt(squares[touched])
    return net


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Network:
    """A network from at most ``rows`` labelled rows that are not held out."""
    known = sample(docs, labels, label, rows)
    pairs = sorted(((r["text"] or "").encode(), r["label"]) for r in known.toLocalIterator())
    return train([p[0] for p in pairs], [p[1] for p in pairs])


def score(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """``docs`` with a last column ``_score``: 0 to 1, higher for likelier good texts.

    Every byte of a text is looked at; a null or empty text is scored as blanks.
    Rows are scored one by one, repeats alike; an empty table gives an empty one;
    the caller's columns are kept, and a name of theirs is not taken: the score has
    more underscores then.
    """
    names, schema = docs.columns, with_score(docs)
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [probability(net, t.encode()) for t in values(batch.column(at), "")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)
