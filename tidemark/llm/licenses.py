"""License scans: MinHash bands over overlapping text windows retrieve templates, shingle containment verifies them.

Words are runs of letters and digits in lower case, shingles five words. A template of up to ``w`` shingles (``w`` a
power of two, 4 at least) is sought in windows of ``2 w`` shingles that begin every ``w``, so each place of a
template lies whole in one of them. A band is one MinHash; the number of bands follows from the least likeness a
window with a match can have, so that one is missed with a chance of ``MISS`` at most. What a band retrieves is
verified on the words themselves: the share of the template's shingles found around the window must reach
``CONTAINMENT``.

Templates are a small table of their own (a parameter) and go to every task; documents are scanned where they lie.

Defined results: null and empty texts, and texts of fewer than five words, match nothing; repeated rows are
reported each; templates of fewer than five words are refused; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-6
LEAST_WINDOW = 4
#: Words scanned together.
SLICE_WORDS = 1 << 19
CACHE_WORDS = 200_000
_WORD = re.compile(r"[^\W_]+")

# The notices that licenses ask to put into works, and short forms in common use.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "mit": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _shingles(words: list[str]) -> list[tuple[str, ...]]:
    return list(zip(*[words[i:] for i in range(SHINGLE)], strict=False))


def bands_for(likeness: float, miss: float = MISS) -> int:
    """Bands of one MinHash that all miss a window of this likeness with a chance of ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - likeness)) if likeness < 1 else 1


@dataclass(frozen=True)
class Template:
    name: str
    shingles: frozenset
    window: int

    @property
    def need(self) -> int:
        return math.ceil(CONTAINMENT * len(self.shingles) - 1e-9)

    @property
    def likeness(self) -> float:
        """Least Jaccard likeness of the template and a window that holds a match."""
        return self.need / (2 * self.window + len(self.shingles) - self.need)


class _Hashes(dict):
    """Word hashes, at most ``CACHE_WORDS`` at a time."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Scanner:
    def __init__(self, notices: dict[str, str]) -> None:
        self.templates = []
        for name, text in sorted(notices.items()):
            shingles = _shingles(words_of(text))
            if not shingles:
                raise ValueError(f"template {name} has fewer than {SHINGLE} words")
            window = max(LEAST_WINDOW, 1 << (len(shingles) - 1).bit_length())
            self.templates.append(Template(name, frozenset(shingles), window))
        self.hashes = _Hashes()
        self.windows = sorted({t.window for t in self.templates})
        self.bands = {w: max(bands_for(t.likeness) for t in self.templates if t.window == w) for w in self.windows}
        rng = np.random.default_rng(7)
        self.odd = rng.integers(0, 1 << 63, max(self.bands.values(), default=0), np.uint64) * np.uint64(2) + np.uint64(1)
        self.keys: dict[tuple[int, int], dict[int, list[int]]] = {}
        for k, t in enumerate(self.templates):
            hashes = np.concatenate([self._hash(list(s)) for s in t.shingles])
            for b in range(self.bands[t.window]):
                self.keys.setdefault((t.window, b), {}).setdefault(int(self._permute(hashes, b).min()), []).append(k)
        self.filters = {}
        for at, keys in self.keys.items():
            table = np.zeros(1 << 16, bool)
            table[[v & 0xFFFF for v in keys]] = True
            self.filters[at] = table

    def _hash(self, words: list[str]) -> np.ndarray:
        """Hashes of the shingles of consecutive words."""
        w = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        n = len(w) - SHINGLE + 1
        out = np.zeros(max(n, 0), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(SHINGLE if n > 0 else 0):
                out = out * np.uint64(0x9E3779B97F4A7C15) + w[i:i + n]
            return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

    def _permute(self, hashes: np.ndarray, band: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((hashes * self.odd[band]) >> np.uint64(32)).astype(np.uint32)

    def scan(self, texts: list[str | None]) -> Iterator[tuple[int, str, int, int, float]]:
        """(text's index, template, first word, end, containment) of every match."""
        held: list[str] = []
        bounds = [0]
        first = 0
        for i, text in enumerate(texts):
            held += words_of(text)
            bounds.append(len(held))
            if len(held) >= SLICE_WORDS or i == len(texts) - 1:
                for doc, *rest in self._slice(held, bounds):
                    yield (first + doc, *rest)
                held, bounds, first = [], [0], i + 1

    def _slice(self, words: list[str], bounds: list[int]) -> list[tuple[int, str, int, int, float]]:
        hashes = self._hash(words)
        if not len(hashes):
            return []
        edge = np.array(bounds, np.int64)
        # Shingles over the end of a text belong to none.
        crossing = (edge[1:-1, None] - np.arange(1, SHINGLE)).ravel()
        crossing = crossing[(crossing >= 0) & (crossing < len(hashes))]
        found: set[tuple[int, int]] = set()
        for band in range(len(self.odd)):
            values = self._permute(hashes, band)
            values[crossing] = 0xFFFFFFFF
            for w in self.windows:
                if band >= self.bands[w]:
                    continue
                blocks = np.minimum.reduceat(values, np.arange(0, len(values), w))
                least = np.minimum(blocks, np.append(blocks[1:], np.uint32(0xFFFFFFFF)))
                hit = np.flatnonzero(self.filters[w, band][least & np.uint32(0xFFFF)])
                keys = self.keys[w, band]
                for at, value in zip(hit.tolist(), least[hit].tolist(), strict=True):
                    found.update((k, at * w) for k in keys.get(value, ()))
        return self._verify(words, edge, found)

    def _verify(self, words: list[str], edge: np.ndarray, found: set[tuple[int, int]]) -> list[tuple[int, str, int, int, float]]:
        spans: dict[tuple[int, int], list[tuple[int, int, float]]] = {}
        for k, at in sorted(found):
            t = self.templates[k]
            low, high = max(0, at - len(t.shingles)), at + 2 * t.window + len(t.shingles)
            last = min(int(np.searchsorted(edge, high, "left")), len(edge) - 1)
            docs = range(max(int(np.searchsorted(edge, low, "right")) - 1, 0), last)
            for doc in docs:
                a, z = max(low, int(edge[doc])), min(high + SHINGLE - 1, int(edge[doc + 1]))
                for b, e, share in self._matches(t, words[a:z]):
                    spans.setdefault((doc, k), []).append((a + b - int(edge[doc]), a + e - int(edge[doc]), share))
        out = []
        for (doc, k), parts in sorted(spans.items()):
            merged: list[list] = []
            for b, e, share in sorted(parts):
                if merged and b < merged[-1][1]:
                    merged[-1][1] = max(e, merged[-1][1])
                    merged[-1][2] = max(share, merged[-1][2])
                else:
                    merged.append([b, e, share])
            out += [(doc, self.templates[k].name, b, e, share) for b, e, share in merged]
        return out

    @staticmethod
    def _matches(t: Template, words: list[str]) -> Iterator[tuple[int, int, float]]:
        """Stretches of the words that contain enough of the template, none of them longer than it and a half."""
        hits = [(i, s) for i, s in enumerate(_shingles(words)) if s in t.shingles]
        reach = len(t.shingles) + len(t.shingles) // 2 + 1
        first = 0
        while first < len(hits):
            inside = [h for h in hits[first:] if h[0] < hits[first][0] + reach]
            share = len({s for _, s in inside}) / len(t.shingles)
            if share >= CONTAINMENT - 1e-9:
                # The stretch ends where the template is first complete again.
                seen: set = set()
                end = 0
                for i, s in inside:
                    if s in seen:
                        break
                    seen.add(s)
                    end = i
                if len(seen) >= t.need:
                    yield hits[first][0], end + SHINGLE, len(seen) / len(t.shingles)
                    first += len(seen)
                    continue
                yield inside[0][0], inside[-1][0] + SHINGLE, share
                first += len(inside)
                continue
            first += 1


def scan(docs: DataFrame, notices: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, license, first_word, end_word, containment), one row per match. ``notices``: name and text."""
    notices = dict(NOTICES if notices is None else notices)
    made: list[Scanner] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(Scanner(notices))
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[i], *rest) for i, *rest in made[0].scan(batch.column("text").to_pylist())]
            if rows:
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
                names = ["doc_id", "license", "first_word", "end_word", "containment"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, license string, first_word long, end_word long, containment double")
