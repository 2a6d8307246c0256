"""Run-length index of a collection of byte strings: run-compressed Burrows-Wheeler transform, sampled at run ends.

Of the suffix order only the samples at the ends of the runs are kept: for each run, the text position of its first
row, that of the row before it (the last of the run before) and the length both have in common. They give for any
position the one before it in suffix order and their common length, the matching statistics of the collection
against itself, streamed over the text in one pass.
"""

from __future__ import annotations

import numpy as np


#: Symbols that fit one sort key at first.
PACKED = 7


def suffix_order(text: np.ndarray, longest: int) -> np.ndarray:
    """Suffix array of a text of values 0 to 256 in which no two suffixes share ``longest`` values or more.

    Sorted by seven symbols at first, then by twice as many, until every suffix has a rank of its own. The end of
    the text is less than any symbol.
    """
    n = len(text)
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(PACKED, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(PACKED):
        key = key * 258 + padded[k:k + n]
    span = PACKED
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]]) if n else 0
        if not n or span >= longest or rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[:n - span] = rank[span:] + 1
        key, span = rank * (n + 1) + after, span * 2


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Length that the suffixes at ``a`` and ``b`` share before a separator, at most ``limit``."""
    padded = np.concatenate([text, np.zeros(limit + 1, text.dtype)])
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for k in range(limit):
        x = padded[a[live] + k]
        live = live[(x == padded[b[live] + k]) & (x != 0)]
        if not len(live):
            break
        out[live] += 1
    return out


class RunIndex:
    """Index over distinct strings joined by separators. ``limit``: lengths are counted no further."""

    def __init__(self, strings: list[bytes], limit: int) -> None:
        joined = np.frombuffer(b"\x00".join(strings) + b"\x00", np.uint8).astype(np.int16)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.begins = np.cumsum(sizes + 1) - sizes - 1
        text = joined + 1
        text[self.begins + sizes] = 0
        # The strings differ, so a suffix shares less than the rest of its string and a whole other one.
        order = suffix_order(text, 2 * int(sizes.max(initial=0)) + 3)
        bwt = text[order - 1]
        # Each separator ends a run: the rows of string beginnings are always sampled.
        first = np.flatnonzero(np.r_[True, (bwt[1:] != bwt[:-1]) | (bwt[1:] == 0)])
        at = order[first]
        before = np.where(first > 0, order[first - 1], -1)
        shared = np.zeros(len(first), np.int64)
        some = before >= 0
        shared[some] = common_prefix(text, at[some], before[some], limit)
        by_text = np.argsort(at)
        self.n, self.limit = len(text), limit
        self.runs = len(first)
        self.sample, self.before, self.shared = at[by_text], before[by_text], shared[by_text]
        self._full = shared[by_text] >= limit
        self._text = text

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For every position: the position before it in suffix order, and the length both share (up to the limit).

        Along the text both follow from the last sample: the position moves on with it, the length falls by one.
        A length cut at the limit is counted again where it would fall below it.
        """
        place = np.arange(self.n)
        k = np.searchsorted(self.sample, place, side="right") - 1
        gone = place - self.sample[k]
        pointer = np.where(self.before[k] >= 0, self.before[k] + gone, -1)
        length = np.where(pointer >= 0, self.shared[k] - gone, 0)
        cut = self._full[k] & (gone > 0) & (pointer >= 0)
        if cut.any():
            length[cut] = common_prefix(self._text, place[cut], pointer[cut], self.limit)
        return pointer, length

    def classes(self) -> np.ndarray:
        """For every position, one that stands for all with the same ``limit`` bytes (itself if there are no others)."""
        pointer, length = self.statistics()
        head = np.where(length >= self.limit, pointer, np.arange(self.n))
        while True:
            further = head[head]
            if np.array_equal(further, head):
                return head
            head = further
