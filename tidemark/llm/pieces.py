"""SentencePiece encoding by forward filtering and backward sampling over the piece lattice, and decoding.

No piece of such a vocabulary has a space behind another character, so the lattice of a text falls apart into
those of its words (with the spaces before them). Words are cut on the bytes of a slice of texts and its distinct ones
found by a dictionary encoding; they are filtered forward together, place by place: the sum of the weights of all segmentations of every prefix. Segmentations are then drawn
backward, again all together: at each place one arc is chosen by its share of the prefix sum. The random numbers are a hash of the
row's key, the word's number in the row and the step, so a row's segmentation depends on nothing else.

A piece that ranks r-th weighs ``(r + 2) ** (-1 / temperature)``; towards temperature 0 the most likely
segmentation remains. Characters without a piece, and a space sign in the text itself, become byte pieces, so
decoding gives back every text.

Defined results: null and empty texts have no pieces; a null key counts as key 0; rows with equal keys and texts
get equal segmentations; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.tokens import vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
SEED = 42
#: Characters of text sampled together.
SLICE_CHARS = 1 << 19
#: Ids decoded together.
DECODE_IDS = 1 << 20
#: First bits of a hash by which a table of pieces is entered.
ENTRY_BITS = 16
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Stands for a space sign of the text itself among the characters of words; no character has this number.
_LITERAL = 0x120000
_SIGN = SPACE.encode()


class Lattices(NamedTuple):
    """Arcs of joined words. A node is a place behind a character; nodes are numbered in the order of their arcs.

    By word: ``first`` character, ``lengths``. By character: ``rank`` of the node behind it, ``spelled``, ``width``
    in bytes. By node: ``new`` (first arc), ``counts``. By arc: ``begin`` (character), ``inner`` (the same within the
    word), ``piece`` (-1: the bytes of its character), ``reach`` (the shares of its node's arcs up to it).
    """

    first: np.ndarray
    lengths: np.ndarray
    rank: np.ndarray
    new: np.ndarray
    counts: np.ndarray
    begin: np.ndarray
    inner: np.ndarray
    piece: np.ndarray
    reach: np.ndarray
    spelled: np.ndarray
    width: np.ndarray


def _draw(x: Lattices, node: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The first arc of each node whose reach is over ``u``, its last one at the end; by halving its arcs."""
    low, span = x.new[node], x.counts[node]
    while (half := span >> 1).any():
        upper = (half > 0) & (x.reach[low + np.maximum(half, 1) - 1] <= u)
        low = np.where(upper, low + half, low)
        span = np.where(upper, span - half, half + (half == 0))
    return low


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _word_starts(docs: list[bytes], raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """By byte of the texts joined, whether a word begins there: at the first of some spaces.

    In a text that has space signs of its own, every space and every sign is a word.
    """
    space = raw == 32
    starts = np.r_[space, False]
    starts[1:-1] &= ~space[:-1]
    starts[bounds] = True
    for i, doc in enumerate(docs):
        if _SIGN in doc:
            at = np.flatnonzero(space[bounds[i]:bounds[i + 1]]) + bounds[i]
            signs = np.array([m.start() for m in re.finditer(_SIGN, doc)]) + bounds[i]
            starts[np.r_[at, at + 1, signs, signs + len(_SIGN)]] = True
    return starts


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit integers (a finalizer of multiplications and shifts)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sampler:
    def __init__(self, vocabulary: str = VOCABULARY, temperature: float = 1.0, seed: int = SEED) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(vocabulary))
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes: dict[int, int] = {}
        self.texts: list[bytes] = []
        rank = 0
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                self.texts.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.texts.append(b"")
            else:
                self.pieces[piece] = (i, math.exp(-math.log(rank + 2) / temperature))
                self.texts.append(piece.replace(SPACE, " ").encode())
                rank += 1
        #: Of characters by their bytes.
        self.byte_weights = math.exp(-math.log(rank + 2) / temperature) ** np.arange(5)
        self.longest = max(map(len, self.pieces), default=1)
        self.seed = np.uint64(seed)
        self.weights = np.zeros(len(self.texts))
        self.tables: dict[int, tuple[np.ndarray, ...]] = {}
        by_length: dict[int, list[str]] = {}
        for piece, (i, weight) in self.pieces.items():
            self.weights[i] = weight
            by_length.setdefault(len(piece), []).append(piece)
        for n, same in by_length.items():
            points = _points("".join(same)).reshape(-1, n)
            hashes = np.zeros(len(same), np.uint64)
            with np.errstate(over="ignore"):
                for k in range(n):
                    hashes = hashes * _ODD + points[:, k] + np.uint64(1)
                hashes *= _ODD  # fills the first bits also for one character
            order = np.argsort(hashes)
            ids = np.array([self.pieces[p][0] for p in same], np.int64)
            entries = np.bincount((hashes >> np.uint64(64 - ENTRY_BITS)).astype(np.int64), minlength=1 << ENTRY_BITS)
            entry = np.r_[0, np.cumsum(entries)].astype(np.int32)
            self.tables[n] = hashes[order], ids[order], points[order], entries > 0, entry
        #: By character, its piece; -1: its bytes.
        self.singles = np.full(_LITERAL + 1, -1, np.int32)
        if 1 in self.tables:
            self.singles[self.tables[1][2][:, 0]] = self.tables[1][1]
        self.byte_ids = np.array([self.bytes.get(b, 0) for b in range(256)], np.int64)

    def _found(self, n: int, hashes: np.ndarray, points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of ``at`` where a piece of ``n`` characters begins, ascending, and its id."""
        keys, pieces, spelled, there, entry = self.tables[n]
        prefix = (hashes >> np.uint64(64 - ENTRY_BITS)).astype(np.int64)
        left = np.flatnonzero(there[prefix])
        at, hashes, prefix = at[left], hashes[left], prefix[left]
        row, left = np.full(len(at), -1, np.int64), np.arange(len(at))
        here, end = entry[prefix], entry[prefix + 1]
        while len(left):
            hit = keys[here[left]] == hashes[left]
            row[left[hit]] = here[left[hit]]
            here += 1
            left = left[~hit]
            left = left[here[left] < end[left]]
        found = np.flatnonzero(row >= 0)
        at, row = at[found], row[found]
        same = np.ones(len(at), bool)
        for c in range(n):
            same &= points[at + c] == spelled[row, c]
        return at[same], pieces[row[same]]

    def _arcs(self, points: np.ndarray, left: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(begins, pieces) of the arcs of two characters, of three, and so on. ``left``: characters to the word's end."""
        hashes, at = points + np.uint64(1), np.arange(len(points))
        out = []
        for n in range(2, self.longest + 1):
            fits = left >= n
            at, left, hashes = at[fits], left[fits], hashes[fits]
            if not len(at):
                break
            with np.errstate(over="ignore"):
                hashes = hashes * _ODD + points[at + (n - 1)] + np.uint64(1)
                scattered = hashes * _ODD
            none = np.zeros(0, np.int64)
            out.append(self._found(n, scattered, points, at) if n in self.tables else (none, none))
        return out

    def lattices(self, points: np.ndarray, lengths: np.ndarray) -> Lattices:
        """Forward filtering of words, given by their characters joined: arcs in order of the place and word where they end."""
        first = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(lengths)), lengths)
        inner = np.arange(len(points)) - first[owner]
        spelled = np.where(points == _LITERAL, ord(SPACE), points)
        width = 1 + (spelled > 0x7F).astype(np.int64) + (spelled > 0x7FF) + (spelled > 0xFFFF)
        last = np.argsort(inner.astype(np.uint16) if lengths.max() < 1 << 16 else inner, kind="stable")
        rank = np.empty(len(points), np.int64)
        rank[last] = np.arange(len(points))
        arcs = self._arcs(points, lengths[owner] - inner)
        counts = np.ones(len(points), np.int64)
        for n, (at, _) in enumerate(arcs, 1):
            counts[rank[at + n]] += 1
        new = np.r_[0, np.cumsum(counts)]
        free, begin, piece = new[:-1].copy(), np.empty(new[-1], np.int64), np.empty(new[-1], np.int64)
        # Longer arcs begin earlier; arcs of one length end at different places, and one of one character everywhere.
        for n, (at, pieces) in reversed(list(enumerate(arcs, 1))):
            node = rank[at + n]
            to = free[node]
            begin[to], piece[to] = at, pieces
            free[node] = to + 1
        begin[free], piece[free] = last, self.singles[points[last]]
        weight = self.weights[piece]
        bare = np.flatnonzero(piece < 0)
        weight[bare] = self.byte_weights[width[begin[bare]]]
        inside = inner[begin]
        # The sums of all nodes, and behind them the words' beginnings.
        total = np.r_[np.zeros(len(points)), np.ones(len(lengths))]
        source = np.where(inside > 0, rank[begin - 1], len(points) + owner[begin])
        reach = np.empty(len(begin))
        steps = np.flatnonzero(np.r_[True, np.diff(inner[last]) != 0, True])
        for a, z in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
            low, high = int(new[a]), int(new[z])
            part = weight[low:high] * total[source[low:high]]
            sums = np.add.reduceat(part, new[a:z] - low)
            reach[low:high] = part / np.repeat(sums, counts[a:z])
            total[a:z] = sums
            faint = last[a:z][sums < 1e-200]
            if len(faint):
                # Kept in range: only shares within a place matter.
                for k in range(self.longest):
                    near = faint[inner[faint] >= k] - k
                    total[rank[near]] *= 1e200
                early = faint[inner[faint] < self.longest]
                total[len(points) + owner[early]] *= 1e200
        new = new[:-1]
        # Shares are added up within a node alone, so they are the same in any company.
        node = np.flatnonzero(counts > 1)
        for k in range(1, int(counts.max())):
            node = node[counts[node] > k]
            reach[new[node] + k] += reach[new[node] + k - 1]
        return Lattices(first, lengths, rank, new, counts, begin, inside, piece, reach, spelled, width)

    def encode(self, texts: list[str | None], keys: list[int | None]) -> list[np.ndarray]:
        """The ids of a sampled segmentation of every text."""
        out: list[np.ndarray] = []
        held: list[bytes] = []
        names: list[int] = []
        size = 0
        for text, key in zip(texts, keys, strict=True):
            held.append((" " + text).encode("utf-8", "surrogatepass") if text else b"")
            names.append((key or 0) & 0xFFFFFFFFFFFFFFFF)
            size += len(text or "")
            if size >= SLICE_CHARS:
                out += self._sample(held, names)
                held, names, size = [], [], 0
        return out + self._sample(held, names) if held else out

    def _words(self, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The words of all texts as numbers of distinct ones, their number per text, the distinct ones' characters and lengths."""
        bounds = np.cumsum([0, *map(len, docs)])
        data = b"".join(docs)
        at = np.flatnonzero(_word_starts(docs, np.frombuffer(data, np.uint8), bounds))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        _, ends, spelled = coded.dictionary.buffers()
        spelled = spelled.to_pybytes()
        characters = np.cumsum(np.r_[0, (np.frombuffer(spelled, np.uint8) & 0xC0) != 0x80])
        lengths = np.diff(characters[np.frombuffer(ends, np.int64, len(coded.dictionary) + 1)])
        points = _points(spelled.decode("utf-8", "surrogatepass"))
        points[points == ord(SPACE)] = _LITERAL
        points[points == ord(" ")] = ord(SPACE)
        return coded.indices.to_numpy().astype(np.int64), np.diff(np.searchsorted(at, bounds)), points, lengths

    def _sample(self, docs: list[bytes], keys: list[int]) -> list[np.ndarray]:
        if not any(docs):
            return [np.zeros(0, np.int64)] * len(docs)
        word, per_doc, points, lengths = self._words(docs)
        x = self.lattices(points, lengths)

        doc = np.repeat(np.arange(len(docs)), per_doc)
        number = np.arange(len(word)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        with np.errstate(over="ignore"):
            start = mix(np.array(keys, np.uint64) + self.seed * np.uint64(0x9E3779B97F4A7C15))
            lane_seed = mix(start[doc] + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        place = x.lengths[word]
        lane = np.arange(len(word))
        steps = []
        while len(lane):
            with np.errstate(over="ignore"):
                u = mix(lane_seed[lane] + np.uint64(len(steps) + 1) * np.uint64(0xD1B54A32D192ED03))
            node = x.rank[x.first[word[lane]] + place - 1]
            arc = _draw(x, node, (u >> np.uint64(11)).astype(np.float64) / (1 << 53))
            steps.append((lane, arc))
            place = x.inner[arc]
            lane, place = lane[place > 0], place[place > 0]
        n = np.zeros(len(word), np.int64)
        for lane, arc in steps:
            n[lane] += 1
        first = np.cumsum(n) - n
        arcs = np.zeros(int(n.sum()), np.int64)
        for step, (lane, arc) in enumerate(steps):
            arcs[first[lane] + n[lane] - 1 - step] = arc
        piece = x.piece[arcs]
        bare = piece < 0
        widths = np.where(bare, x.width[x.begin[arcs]], 1)
        ends = np.cumsum(widths)
        flat = np.repeat(piece, widths)
        if bare.any():
            raw = "".join(map(chr, x.spelled[x.begin[arcs[bare]]].tolist())).encode("utf-8", "surrogatepass")
            flat[np.repeat(bare, widths)] = self.byte_ids[np.frombuffer(raw, np.uint8)]
        bounds = np.r_[0, ends][np.r_[0, np.cumsum(n)]][np.r_[0, np.cumsum(per_doc)]]
        return [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of a segmentation (the space before its first word is not part of it)."""
        return self.decode_all(np.asarray(ids, np.int64), np.array([0, len(ids)]))[0]

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of segmentations that lie in ``ids`` between ``bounds``."""
        spelled = pa.array(self.texts, pa.large_binary()).take(pa.array(ids))
        ends = np.frombuffer(spelled.buffers()[1], np.int64, len(ids) + 1)[bounds].tolist()
        data = memoryview(spelled.buffers()[2] or b"")
        return [str(data[a:b][1:], "utf-8", "surrogatepass") for a, b in zip(ends[:-1], ends[1:], strict=True)]


_SAMPLERS: dict[tuple, Sampler] = {}


def sampler(vocabulary: str, temperature: float, seed: int) -> Sampler:
    at = (vocabulary, temperature, seed)
    if at not in _SAMPLERS:
        _SAMPLERS[at] = Sampler(*at)
    return _SAMPLERS[at]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about ``SLICE_CHARS``."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    part = ends // SLICE_CHARS
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True][: len(part) + 1]) if len(part) else []
    for a, z in zip(cuts[:-1], cuts[1:], strict=True) if len(part) else ():
        yield batch.slice(int(a), int(z - a))


def encode(
    docs: DataFrame, key: str = "doc_id", vocabulary: str = VOCABULARY, temperature: float = 1.0, seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``piece_ids``, a sampled segmentation of ``text`` for the row's ``key``."""
    names = [c for c in docs.columns if c != "piece_ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sampler(vocabulary, temperature, seed)
        for batch in batches:
            for part in _parts(batch):
                ids = sample.encode(part.column("text").to_pylist(), part.column(key).to_pylist())
                offsets = np.cumsum(np.r_[0, [len(x) for x in ids]]).astype(np.int32)
                flat = np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], lists], names=[*names, "piece_ids"])

    fields = [f for f in docs.schema.fields if f.name != "piece_ids"]
    return docs.select(*names).mapInArrow(run, T.StructType([*fields, T.StructField("piece_ids", T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``rows`` with ``decoded``, the text of their ``piece_ids``."""
    names = [c for c in rows.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sampler(vocabulary, 1.0, SEED)
        for batch in batches:
            ids = batch.column("piece_ids")
            values, bounds = ids.flatten().to_numpy(), np.cumsum(np.r_[0, ids.value_lengths().fill_null(0).to_numpy()])
            texts: list[str] = []
            while len(texts) < len(ids):
                rest = bounds[len(texts):]
                rest = rest[:max(2, int(np.searchsorted(rest, rest[0] + DECODE_IDS, side="right")))]
                texts += sample.decode_all(values[rest[0]:rest[-1]], rest - rest[0])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(texts, pa.string())], names=[*names, "decoded"])

    fields = [f for f in rows.schema.fields if f.name != "decoded"]
    return rows.select(*names).mapInArrow(run, T.StructType([*fields, T.StructField("decoded", T.StringType())]))
