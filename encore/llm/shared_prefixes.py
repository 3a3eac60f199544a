"""Common prefixes of suffixes by breadth-first search on a Burrows-Wheeler transform.

An interval holds the suffixes that begin with one string.  Extending it backward
by each byte before those suffixes gives the intervals of strings one byte longer;
the first string whose interval ends at some place determines the common prefix
there, so common prefixes come out by increasing length.  The search stops at the
least length asked for: places not reached by then share at least that much.
"""

from __future__ import annotations

import numpy as np


def _order(x: np.ndarray, length: int) -> np.ndarray:
    """Rotations of ``x`` sorted by at least their first ``length`` bytes, by prefix doubling."""
    n = len(x)
    key, known = x.astype(np.uint64), 1
    while known < min(8, length):
        key = key << np.uint64(8 * known) | np.roll(key, -known)
        known *= 2
    order = np.argsort(key)
    while known < length:
        ranks = np.empty(n, np.uint64)
        fresh = np.empty(n, bool)
        fresh[0], sorted_ = True, key[order]
        np.not_equal(sorted_[1:], sorted_[:-1], out=fresh[1:])
        ranks[order] = np.cumsum(fresh)
        key = ranks << np.uint64(32) | np.roll(ranks, -known)
        known *= 2
        order = np.argsort(key)
    return order


def _shared(x: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place in the order: whether it shares less than ``length`` bytes with the one before."""
    n = len(x)
    before = x[order - 1]
    # the place of a rotation begun one byte earlier
    back = np.empty(n, np.int64)
    back[np.argsort(before, kind="stable")] = np.arange(n)
    first = x[order]
    less = np.zeros(n + 1, bool)
    less[0] = less[n] = True
    low, high = np.zeros(1, np.int64), np.full(1, n - 1, np.int64)
    for _ in range(length):
        single = low == high
        ends = [back[low[single]]]
        starts = [ends[0]]
        low, high = low[~single], high[~single]
        sizes = high - low + 1
        total = int(sizes.sum())
        if total:
            at = np.arange(total) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
            place = back[at]
            turn = np.argsort(place)
            place, owner = place[turn], np.repeat(np.arange(len(sizes)), sizes)[turn]
            letter = first[place]
            border = np.flatnonzero((owner[1:] != owner[:-1]) | (letter[1:] != letter[:-1]))
            starts.append(place[np.concatenate([[0], border + 1])])
            ends.append(place[np.concatenate([border, [total - 1]])])
        low, high = np.concatenate(starts), np.concatenate(ends)
        new = ~less[high + 1]
        low, high = low[new], high[new]
        less[high + 1] = True
        if not len(low):
            break
    return less[:n]


def least_owners(texts: list[bytes], owners: np.ndarray, length: int) -> list[np.ndarray]:
    """For every ``length``-byte window of each text, the smallest owner of an equal window.

    All texts are at least ``length`` long.  They are searched as one string; windows
    across two texts are left out afterwards.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    x = np.frombuffer(b"".join(texts), np.uint8)
    order = _order(x, length)
    classes = np.cumsum(_shared(x, order, length)) - 1
    ends = np.cumsum(sizes)
    whole = np.arange(len(x)) + length <= np.repeat(ends, sizes)
    far = np.iinfo(np.int64).max
    owner = np.where(whole, np.repeat(owners, sizes), far)
    least = np.full(int(classes[-1]) + 1, far)
    np.minimum.at(least, classes, owner[order])
    found = np.empty(len(x), np.int64)
    found[order] = least[classes]
    return [found[end - size : end - length + 1] for end, size in zip(ends, sizes, strict=True)]
