"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

The scans that induce one suffix from another run over stretches of the array at once. A
stretch ends where the first suffix that it induces into itself would stand, so every entry
is read after it is written, as in the entry-by-entry form, and the work stays linear.
"""

from __future__ import annotations

import numpy as np

#: Entries that a scan reads at once, at first and at most.
FIRST_STRETCH, MOST_STRETCH = 128, 1 << 15


def _is_small(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one; the last is."""
    n = len(text)
    here = np.where(text[:-1] != text[1:], np.arange(n - 1), n - 1)
    differs = np.minimum.accumulate(here[::-1])[::-1]  # where the run of equal characters ends
    small = np.ones(n, bool)
    known = differs < n - 1
    small[:-1][known] = text[differs[known]] < text[differs[known] + 1]
    return small


def _places(keys: np.ndarray, pointer: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, ordered keys, slot): equal keys take the slots of their bucket one after the other, from ``pointer`` on."""
    order = keys.argsort(kind="stable")
    ordered = keys[order]
    at = np.arange(len(keys), dtype=np.int32)
    first = np.where(np.concatenate((_TRUE, ordered[1:] != ordered[:-1])), at, 0)
    np.maximum.accumulate(first, out=first)
    at -= first
    return order, ordered, pointer[ordered] + (at if step > 0 else -at)


_TRUE = np.ones(1, bool)


def _scan(before: np.ndarray, array: np.ndarray, pointer: np.ndarray, step: int) -> None:
    """Put the suffix before each entry, where ``before`` names its bucket, next in that bucket.

    The array is read from its start with ``step`` 1 and from its end with -1.
    """
    n, at, stretch = len(array), 0, FIRST_STRETCH
    view = array[::step]
    while at < n:
        end = min(n, at + stretch)
        block = view[at:end]
        keys = before[block]
        where = (keys >= 0).nonzero()[0]
        if len(where):
            keys = keys[where]
            order, keys, slot = _places(keys, pointer, step)
            limit = int(slot.min()) if step > 0 else n - 1 - int(slot.max())
            if limit < end:  # beyond it this stretch writes what it would have to read
                kept = order < where.searchsorted(limit - at)
                order, keys, slot, end = order[kept], keys[kept], slot[kept], limit
                stretch = max(FIRST_STRETCH, 2 * (limit - at))
            elif stretch < MOST_STRETCH:
                stretch *= 2
            array[slot] = block[where[order]] - 1
            pointer[keys] = slot + step  # of equal keys the last one counts
        elif stretch < MOST_STRETCH:
            stretch *= 2
        at = end


def _induce(text: np.ndarray, small: np.ndarray, array: np.ndarray, ends: np.ndarray) -> None:
    """Both scans: larger suffixes from the left into bucket heads, smaller ones from the right into tails.

    ``len(text)`` in the array marks a free slot.
    """
    n = len(text)
    kind = np.int16 if len(ends) < 1 << 15 else np.int32
    before = np.full(n + 1, -1, kind)
    before[1:n] = np.where(small[:-1], -1, text[:-1].astype(kind))
    _scan(before, array, np.concatenate(([0], ends[:-1])).astype(np.int32), 1)
    array[np.append(small, False)[array]] = n
    before[1:n] = np.where(small[:-1], text[:-1].astype(kind), -1)
    _scan(before, array, (ends - 1).astype(np.int32), -1)
    array[0] = n - 1  # the end mark


def _names(text: np.ndarray, starts: np.ndarray, sorted_starts: np.ndarray) -> np.ndarray:
    """Rank of the substring from each start to the next, for ``starts`` in text order."""
    following = np.append(starts[1:], starts[-1])
    length = np.zeros(len(text), np.int32)
    length[starts] = following - starts
    left, right = sorted_starts[:-1], sorted_starts[1:]
    new = length[left] != length[right]
    open_, at = np.flatnonzero(~new), 0
    while len(open_):  # compared a character at a time, only as long as two are equal
        a, b = left[open_], right[open_]
        differs = text[a + at] != text[b + at]
        new[open_[differs]] = True
        open_ = open_[~differs & (length[a] > at)]
        at += 1
    rank = np.zeros(len(text), np.int32)
    rank[sorted_starts] = np.concatenate(([0], np.cumsum(new)))
    return rank[starts]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order; ``text`` ends with a value that is 0 there and nowhere else."""
    n = len(text)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    small = _is_small(text)
    starts = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)  # leftmost smaller suffixes
    ends = np.cumsum(np.bincount(text))
    is_start = np.zeros(n, bool)
    is_start[starts] = True

    def seeded(seeds: np.ndarray) -> np.ndarray:
        array = np.full(n, n, np.int32)
        order, _, slot = _places(text[seeds[::-1]], ends - 1, -1)
        array[slot] = seeds[::-1][order]
        _induce(text, small, array, ends)
        return array

    array = seeded(starts)
    by_substring = array[is_start[array]]
    names = _names(text, starts, by_substring)
    if names.max() + 1 < len(names):  # equal substrings: the text of names, sorted in the same way
        kind = np.uint16 if names.max() < 1 << 16 else np.int32
        by_substring = starts[suffix_array(names.astype(kind))]
    return seeded(by_substring)


def permuted_common_prefixes(text: np.ndarray, array: np.ndarray, length: int) -> np.ndarray:
    """For each position in text order, the bytes it shares with its predecessor in the array, up to ``length``.

    In text order a prefix is at most one shorter than that of the position before, so a position
    whose neighbour on the left shares ``length`` + 1 needs no comparison; the rest are compared
    eight bytes at a time.
    """
    n = len(text)
    predecessor = np.empty(n, np.int64)
    predecessor[array[1:]] = array[:-1]
    predecessor[array[0]] = n - 1
    padded = np.concatenate((text.astype(np.uint8), np.zeros(length + 8, np.uint8)))
    words = np.ndarray((n + length,), "<u8", padded, strides=(1,))
    shared = np.zeros(n, np.int64)
    open_ = np.arange(n)
    for at in range(0, length, 8):
        other = words[open_ + at] ^ words[predecessor[open_] + at]
        same = other == 0
        differs = open_[~same]
        low = other[~same] & (~other[~same] + np.uint64(1))  # the lowest bit that differs
        shared[differs] = at + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        open_ = open_[same]
    shared[open_] = length
    shared = np.minimum(shared, length)
    return np.minimum(shared, n - np.maximum(np.arange(n), predecessor))
