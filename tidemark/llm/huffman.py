"""Canonical length-limited Huffman codes of integer symbols, coded and decoded on whole arrays.

A bit stream has a checkpoint, its bit offset, at every ``CHECKPOINT``-th symbol. Decoding starts at all
checkpoints at once and reads one symbol of each lane per step from a table over the longest code.
"""

from __future__ import annotations

import numpy as np

MAX_BITS = 18
CHECKPOINT = 128


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Length of every symbol's code (0: no code), at most ``limit`` bits, least total for ``counts`` (package-merge)."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need codes of more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    merged, is_item = weights, [np.ones(len(weights), bool)]
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        is_item.append(rank < len(weights))
    take = 2 * len(weights) - 2
    for level in reversed(is_item):
        items = int(level[:take].sum())
        lengths[order[:items]] += 1
        take = 2 * (take - items)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol."""
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    code = last = 0
    for size in np.unique(lengths[order]).tolist():
        same = order[lengths[order] == size]
        code <<= size - last
        codes[same] = code + np.arange(len(same))
        code, last = code + len(same), size
    return codes


def encode(symbols: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit stream (four spare bytes at its end) and the bit offsets of its checkpoints."""
    sizes = lengths[symbols].astype(np.int64)
    ends = np.cumsum(sizes)
    at = ends - sizes
    total = int(ends[-1]) if len(ends) else 0
    # A code lies in one or two cells of 32 bits.
    value = codes[symbols].astype(np.uint64) << (64 - sizes - (at & 31)).astype(np.uint64)
    cell = at >> 5
    out = np.zeros((total + 31) // 32 + 2, np.uint32)
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]][: len(cell)])
    if len(first):
        union = np.bitwise_or.reduceat(value, first)
        out[cell[first]] = union >> np.uint64(32)
        out[cell[first] + 1] |= (union & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out.astype(">u4").tobytes()[:(total + 7) // 8 + 4], at[::CHECKPOINT].copy()


class Decoder:
    """Looks up the next ``MAX_BITS`` bits of a stream: symbol and code length."""

    def __init__(self, lengths: np.ndarray, limit: int = MAX_BITS) -> None:
        codes = canonical(lengths)
        self.limit = limit
        self.symbol = np.zeros(1 << limit, np.int32)
        self.size = np.zeros(1 << limit, np.uint8)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        spans = (1 << (limit - lengths[order].astype(np.int64)))
        filled = int(spans.sum())
        self.symbol[:filled] = np.repeat(order, spans)
        self.size[:filled] = np.repeat(lengths[order], spans)
        assert not len(order) or int(codes[order[-1]]) << (limit - int(lengths[order[-1]])) == filled - int(spans[-1])

    def decode(self, stream: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The symbols of all lanes one after another. ``starts``: bit offsets in ``stream``; ``counts``: symbols."""
        out = np.zeros(int(counts.sum()), np.int32)
        place = np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")
        bits, place, counts = starts[order].astype(np.int64), place[order], counts[order]
        shift = np.uint32(32 - self.limit)
        # The 32 bits that begin at each byte.
        wide = stream.astype(np.uint32)
        ahead = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:] if len(wide) > 3 else wide
        for step in range(int(counts[0]) if len(counts) else 0):
            live = int(np.searchsorted(-counts, -step, side="left"))
            now = bits[:live]
            peek = (ahead[now >> 3] << (now & 7).astype(np.uint32)) >> shift
            out[place[:live] + step] = self.symbol[peek]
            now += self.size[peek]
        return out
