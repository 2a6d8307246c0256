"""Cross-tokenizer alignment: byte ranges of two vocabularies over the same texts, and how often ids meet.

Vocabulary A reads a space and the text, vocabulary B the text, before which it sets a space itself. Where tokens
of both end at the same byte, a group ends; where the byte ranges of two tokens overlap, they are linked.

Most links join ids of the same bytes. Their A ids are looked up in an array (the identity map), so these pairs are
counted per document in a vector as long as the vocabulary. Only the other pairs are shuffled, after each task has
added up its own. To score the links, the most frequent pairs go to all tasks, at most ``TOP_PAIRS`` of them; links
of rarer pairs are joined with their counts, which no single pair can make a hot key, since it is rare.

Tokens are found once and stored; counting and scoring read the stored pairs of each document.

Defined results: a null or empty text, or one that either vocabulary does not give back byte by byte, has no tokens
and counts nowhere; every row is a document of its own, also one whose id is null or repeated; an empty table gives
an empty result; columns other than ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store
from tidemark.llm.tokens import BYTE_VOCABULARY, byte_letters, encoder, vocabulary_path

PIECE_VOCABULARY = "piece_bpe_32k.model"
#: Pairs sent to every task, 16 bytes each.
TOP_PAIRS = 1 << 19
#: Characters aligned together, and pairs a task adds up together.
SLICE_CHARS = 1 << 20
HELD_PAIRS = 1 << 21
_ROW_BITS = 33
_ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, "
    "pairs binary, times binary"
)
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``starts[i] .. starts[i] + sizes[i] - 1`` of all i, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class _Strings:
    """Byte strings that are taken by number, all at once."""

    def __init__(self, strings: list[bytes]) -> None:
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def take(self, numbers: np.ndarray) -> np.ndarray:
        return self.flat[_ragged(self.starts[numbers], self.sizes[numbers])]


class Vocabularies:
    """Both vocabularies, the bytes of their ids, and the identity map."""

    def __init__(self, a: str, b: str) -> None:
        import sentencepiece

        self.encode_a = encoder(a, special_as_text=True).encode
        self.b_model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(b))
        back = {c: i for i, c in byte_letters().items()}
        names = encoder(a, special_as_text=True).library.get_vocab()
        spelled = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            spelled[i] = bytes(back[c] for c in name) if all(c in back for c in name) else name.encode()
        model = self.b_model
        pieces = [
            bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i)
            else b"" if model.is_control(i) or model.is_unknown(i)
            else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())
        ]
        self.a, self.b = _Strings(spelled), _Strings(pieces)
        self.bits = (len(pieces) - 1).bit_length()
        # A byte has a piece of its own beside the byte's fallback; the map names the piece.
        by_bytes = {p: i for i, p in enumerate(pieces) if p and model.is_byte(i)}
        by_bytes |= {p: i for i, p in enumerate(pieces) if p and not model.is_byte(i)}
        self.same = np.array([by_bytes.get(s, -1) if s else -1 for s in spelled], np.int64)
        self.digits = _Strings([b"%d," % i for i in range(max(len(spelled), len(pieces)))])

    def split(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return pairs >> self.bits, pairs & ((1 << self.bits) - 1)

    def identical(self, pairs: np.ndarray) -> np.ndarray:
        a, b = self.split(pairs)
        return self.same[a] == b


_VOCABULARIES: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(a: str, b: str) -> Vocabularies:
    """One pair per worker process."""
    if (a, b) not in _VOCABULARIES:
        _VOCABULARIES[a, b] = Vocabularies(a, b)
    return _VOCABULARIES[a, b]


class _Tokens:
    """The tokens of one vocabulary over several documents, as flat ids and numbers per document."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, strings: _Strings) -> None:
        self.ids, self.strings = ids, strings
        self.docs = np.repeat(np.arange(len(counts)), counts)

    def faithful(self, texts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Per document, whether its tokens spell its text."""
        lengths = np.bincount(self.docs, self.strings.sizes[self.ids], len(sizes)).astype(np.int64)
        good = lengths == sizes
        spelled = self.strings.take(self.ids[good[self.docs]])
        other = np.flatnonzero(spelled != texts[np.repeat(good, sizes)])
        good[np.repeat(np.arange(len(sizes))[good], sizes[good])[other]] = False
        return good

    def keep(self, good: np.ndarray) -> None:
        kept = good[self.docs]
        self.ids, self.docs = self.ids[kept], self.docs[kept]

    def ends(self) -> np.ndarray:
        return np.cumsum(self.strings.sizes[self.ids])


def _flat(lists: list, kind: type = np.int64) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), kind, int(counts.sum())), counts


def align_texts(texts: list[str], v: Vocabularies) -> tuple[dict[str, np.ndarray], list[bytes], np.ndarray, np.ndarray]:
    """(counts per text, group strings, pairs with the text's number above them, how often each occurs in its text)."""
    n = len(texts)
    spaced = [(" " + t).encode() for t in texts]
    sizes = np.fromiter(map(len, spaced), np.int64, n)
    a_ids = list(v.encode_a([" " + t for t in texts]))
    a = _Tokens(np.concatenate([np.zeros(0, np.int64), *a_ids]).astype(np.int64), np.fromiter(map(len, a_ids), np.int64, n), v.a)
    b = _Tokens(*_flat(v.b_model.encode(texts, num_threads=1)), v.b)
    flat = np.frombuffer(b"".join(spaced), np.uint8)
    good = (sizes > 1) & a.faithful(flat, sizes) & b.faithful(flat, sizes)
    a.keep(good)
    b.keep(good)
    # Bit 1: a token of A ends at this byte, bit 2: one of B.
    marks = np.zeros(int(sizes[good].sum()) + 1, np.int8)
    marks[a.ends()] |= 1
    marks[b.ends()] |= 2
    marks = marks[np.flatnonzero(marks)]
    # Between two marks lies the overlap of one token of A with one of B, and no other overlap of the two.
    a_ends, b_ends, both = (marks & 1).astype(bool), marks > 1, marks == 3
    a_at, b_at = np.cumsum(a_ends) - a_ends, np.cumsum(b_ends) - b_ends
    docs = a.docs[a_at]
    per_doc = {
        "n_a": np.bincount(a.docs, minlength=n), "n_b": np.bincount(b.docs, minlength=n),
        "n_groups": np.bincount(docs[both], minlength=n), "n_links": np.bincount(docs, minlength=n),
    }
    shift = v.bits + len(v.a.sizes).bit_length()
    keys, times = np.unique(docs << shift | a.ids[a_at] << v.bits | b.ids[b_at], return_counts=True)
    strings = _group_strings(a, b, both, a_ends, b_ends, v, per_doc["n_a"] + per_doc["n_b"])
    return per_doc, strings, keys, times


def _group_strings(a, b, both, a_ends, b_ends, v: Vocabularies, tokens: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every document: A's ids of a group, then B's."""
    group = np.cumsum(both) - both
    n_groups = int(both.sum())
    a_group, b_group = group[a_ends], group[b_ends]
    a_upto = np.cumsum(np.bincount(a_group, minlength=n_groups))
    b_counts = np.bincount(b_group, minlength=n_groups)
    b_before = np.cumsum(b_counts) - b_counts
    ids = np.empty(len(a.ids) + len(b.ids), np.int64)
    signs = np.empty(len(ids), np.uint8)
    a_place = np.arange(len(a.ids)) + b_before[a_group]
    b_place = np.arange(len(b.ids)) + a_upto[b_group]
    ids[a_place], ids[b_place] = a.ids, b.ids
    signs[a_place] = np.where(both[a_ends], ord("|"), ord(","))
    signs[b_place] = np.where(both[b_ends], ord(";"), ord(","))
    out = v.digits.take(ids)
    ends = np.cumsum(v.digits.sizes[ids])
    out[ends - 1] = signs
    bounds = np.r_[0, ends][np.r_[0, np.cumsum(tokens)]]
    raw = out.tobytes()
    return [raw[s:max(s, e - 1)] for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def align(docs: DataFrame, a: str = BYTE_VOCABULARY, b: str = PIECE_VOCABULARY, with_groups: bool = True) -> DataFrame:
    """Per document its tokens, groups and links, and its linked pairs of ids with how often each occurs.

    ``groups`` holds the groups themselves if asked for, ``groups_sha256`` their digest ('' without tokens).
    ``row`` numbers the documents and stays the same only in a stored result.
    """

    def rows(doc_ids: list, texts: list[str], start: int) -> pa.RecordBatch:
        v = vocabularies(a, b)
        per_doc, strings, keys, times = align_texts(texts, v)
        shift = v.bits + len(v.a.sizes).bit_length()
        bounds = np.searchsorted(keys >> shift, np.arange(len(texts) + 1)).tolist()
        pairs = (keys & ((1 << shift) - 1)).astype("<i8").tobytes()
        times = times.astype("<u4").tobytes()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(start, start + len(texts)), pa.int64()), pa.array(doc_ids, pa.int64()),
                *[pa.array(per_doc[c], pa.int64()) for c in _COUNTS],
                pa.array([s.decode() if with_groups else None for s in strings], pa.string()),
                pa.array([hashlib.sha256(s).hexdigest() if s else "" for s in strings], pa.string()),
                pa.array([pairs[8 * s:8 * e] for s, e in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                pa.array([times[4 * s:4 * e] for s, e in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
            ],
            names=["row", "doc_id", *_COUNTS, "groups", "groups_sha256", "pairs", "times"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = TaskContext.get().partitionId() << _ROW_BITS
        for batch in batches:
            doc_ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                doc_ids.append(doc_id)
                texts.append(text or "")
                size += len(texts[-1])
                if size >= SLICE_CHARS:
                    yield rows(doc_ids, texts, start)
                    start += len(texts)
                    doc_ids, texts, size = [], [], 0
            if texts:
                yield rows(doc_ids, texts, start)
                start += len(texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ALIGNED)


def _held(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a batch's documents in one array, and how many each document has."""
    raw = batch.column("pairs").to_pylist()
    return np.frombuffer(b"".join(raw), "<i8"), np.fromiter(map(len, raw), np.int64, len(raw)) // 8


def _nonzero(vector: np.ndarray, identical: bool) -> pa.RecordBatch:
    at = np.flatnonzero(vector)
    return _counted(at, vector[at], identical)


def _counted(keys: np.ndarray, counts: np.ndarray, identical: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(keys), identical)), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())],
        names=["identical", "key", "n"],
    )


def pair_counts(aligned: DataFrame, a: str = BYTE_VOCABULARY, b: str = PIECE_VOCABULARY) -> DataFrame:
    """(identical, key, n): in how many documents a pair is linked.

    For pairs of the identity map the key is the A id, for all others it holds both ids (``Vocabularies.split``).
    A document's pairs are distinct, so each adds one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(a, b)
        vector = np.zeros(len(v.same), np.int64)
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            pairs, _ = _held(batch)
            same = v.identical(pairs)
            vector += np.bincount(v.split(pairs[same])[0], minlength=len(vector))
            held.append(pairs[~same])
            size += len(held[-1])
            if size >= HELD_PAIRS:
                yield _counted(*np.unique(np.concatenate(held), return_counts=True), False)
                held, size = [], 0
        if held:
            yield _counted(*np.unique(np.concatenate(held), return_counts=True), False)
        yield _nonzero(vector, True)

    rows = aligned.select("pairs").mapInArrow(count, "identical boolean, key long, n long")
    return rows.groupBy("identical", "key").agg(F.sum("n").alias("n"))


class Scores:
    """What tasks need to score links: vectors as long as the vocabulary, and the most frequent pairs."""

    def __init__(self, counts: DataFrame, v: Vocabularies, top: int) -> None:
        ids = len(v.same)
        self.identity = np.zeros(ids, np.int64)
        for r in counts.where("identical").collect():  # one row per id of A at most
            self.identity[r["key"]] = r["n"]
        self.best = self.identity.copy()
        pairs = counts.where("NOT identical")
        a = F.shiftright("key", v.bits)
        for r in pairs.groupBy(a.alias("a")).agg(F.max("n").alias("n")).collect():  # as many
            self.best[r["a"]] = max(self.best[r["a"]], r["n"])
        # The frequent pairs are those of 2^e documents or more, with the least e that keeps to the bound.
        power = F.floor(F.log2(F.col("n"))).cast("int")
        sizes = {r["e"]: r["count"] for r in pairs.groupBy(power.alias("e")).count().collect()}
        least, held = 64, 0
        for e in sorted(sizes, reverse=True):
            if held + sizes[e] > top:
                break
            least, held = e, held + sizes[e]
        self.rare = pairs.where(power < least).select("key", "n") if held < sum(sizes.values()) else None
        frequent = pairs.where(power >= least).select("key", "n").toPandas().sort_values("key")
        self.keys = np.append(frequent["key"].to_numpy(np.int64), np.iinfo(np.int64).max)
        self.counts = np.append(frequent["n"].to_numpy(np.int64), 0)


def score(aligned: DataFrame, a: str = BYTE_VOCABULARY, b: str = PIECE_VOCABULARY, top: int = TOP_PAIRS) -> DataFrame:
    """``aligned`` (a stored result of :func:`align`) with ``n_best`` and ``count_sum``, without its pairs."""
    spark = aligned.sparkSession
    v = vocabularies(a, b)
    scores = Scores(store(pair_counts(aligned, a, b), "pair-counts"), v, top)
    # The vectors have the vocabulary's length, the pairs are bounded by ``top``.
    shared = spark.sparkContext.broadcast((scores.identity, scores.best, scores.keys, scores.counts))
    kept = [c for c in aligned.columns if c not in ("pairs", "times")]
    more = "n_best long, count_sum long, rare array<struct<key: long, times: long>>"
    rare = pa.list_(pa.struct([("key", pa.int64()), ("times", pa.int64())]))

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(a, b)
        identity, best, keys, counts = shared.value
        for batch in batches:
            pairs, sizes = _held(batch)
            times = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4").astype(np.int64)
            docs = np.repeat(np.arange(len(sizes)), sizes)
            a_ids, _ = v.split(pairs)
            same = v.identical(pairs)
            at = np.searchsorted(keys, pairs)
            found = same | (keys[at] == pairs)
            n = np.where(same, identity[a_ids], np.where(found, counts[at], 0))
            # Sums over the documents' runs, in whole numbers.
            total = np.r_[0, np.cumsum(n * times)]
            highest = np.r_[0, np.cumsum(times * (found & (n == best[a_ids])))]
            ends = np.cumsum(sizes)
            left = np.flatnonzero(~found)
            left_ends = np.r_[0, np.cumsum(np.bincount(docs[left], minlength=len(sizes)))]
            rest = pa.ListArray.from_arrays(
                pa.array(left_ends, pa.int32()),
                pa.StructArray.from_arrays([pa.array(pairs[left], pa.int64()), pa.array(times[left])], fields=list(rare.value_type)),
            )
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(highest[ends] - highest[ends - sizes]),
                 pa.array(total[ends] - total[ends - sizes]), rest.cast(rare)],
                names=[*kept, "n_best", "count_sum", "rare"],
            )

    schema = ", ".join(f"{c} {kind}" for c, kind in aligned.dtypes if c in kept)
    scored = aligned.mapInArrow(lookup, f"{schema}, {more}")
    if scores.rare is None:
        return scored.drop("rare")
    scored = store(scored, "scored", "zstd")
    best = spark.createDataFrame([(i, n) for i, n in enumerate(scores.best.tolist()) if n], "a long, best long")
    links = scored.select("row", F.inline("rare")).join(scores.rare, "key")
    links = links.withColumn("a", F.shiftright("key", v.bits)).join(F.broadcast(best), "a")  # one row per id of A
    sums = links.groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"),
    )
    added = lambda c, m: (F.col(c) + F.coalesce(m, F.lit(0))).alias(c)
    return scored.join(sums, "row", "left").select(*kept, added("n_best", "more_best"), added("count_sum", "more_sum"))


def align_tokenizers(
    docs: DataFrame, a: str = BYTE_VOCABULARY, b: str = PIECE_VOCABULARY, with_groups: bool = True, top: int = TOP_PAIRS
) -> DataFrame:
    """Groups, links and scores of all documents."""
    return score(store(align(docs, a, b, with_groups), "aligned", "zstd"), a, b, top)
