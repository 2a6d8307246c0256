import random
import zlib
from unittest.mock import Mock

import numpy as np
import pyarrow as pa
import pytest
from tidemark.llm import packing, tokens

ODD = ["", None, " ", "don't STOP we'll", "x<|endoftext|>y", "naïve Straße İst ŒUVRE µm² ½ 中文", "tab\tx\x0by", "a  b \n c   d", "'s 12 a1", " lead trail "]


def rows(n=80, seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.choice([3, 20, 90, 300, 700]))) for _ in range(n)]
    return list(enumerate([*ODD, *texts, " ".join(rng.choices(words, k=4000)), texts[0], texts[0]]))


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("vocabulary", [tokens.BYTE_VOCABULARY, tokens.WORD_VOCABULARY])
def test_encoder_equals_the_library(vocabulary, as_text):
    """Also with caches that hold a few words only, and with the strings of special tokens in the texts."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.vocabulary_path(vocabulary))
    library.encode_special_tokens = as_text
    texts = [t for _, t in rows()]
    for s in ("<|endoftext|>", "<|startoftext|>"):
        texts += [s, f"a {s} b", f"a{s}b", f"  {s}  {s}x", s.upper(), s[:-1], f"don't {s}\n\n stop"]
    small = tokens.Encoder(vocabulary, as_text, cache=40_000)
    for _ in range(2):
        got = [x.tolist() for x in small.encode(texts)]
        assert got == [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_plan_covers_the_histogram_with_little_padding():
    rng = np.random.default_rng(0)
    lengths = np.r_[np.minimum(rng.lognormal(3.2, 1, 9000), 256).astype(int).clip(1), np.full(4000, 19)]
    histogram = dict(zip(*[x.tolist() for x in np.unique(lengths, return_counts=True)], strict=True))
    made = packing.plan(histogram, 256)
    covered = {}
    for pattern, n in made:
        assert sum(pattern) <= 256 and n > 0
        for b in pattern:
            covered[b] = covered.get(b, 0) + n
    assert covered == histogram
    assert sum(n for _, n in made) * 256 < lengths.sum() * 1.01


@pytest.mark.parametrize("histogram", [{}, {256: 3}, {200: 7}, {1: 1000}, {128: 5, 127: 1}])
def test_plans_of_odd_histograms(histogram):
    covered = {}
    for pattern, n in packing.plan(histogram, 256):
        assert sum(pattern) <= 256
        for b in pattern:
            covered[b] = covered.get(b, 0) + n
    assert covered == histogram


def test_nnls_fits_exactly_where_it_can():
    combos = packing.combinations(64, np.ones(65, bool))
    rng = np.random.default_rng(3)
    x = np.zeros(len(combos))
    x[rng.choice(len(combos), 20, replace=False)] = rng.integers(5, 50, 20)
    goal = np.zeros(65)
    for k in range(3):
        goal += np.bincount(combos[:, k], x, 65)
    goal[0] = 0
    y = packing.nnls(combos, goal)
    back = np.zeros(65)
    for k in range(3):
        back += np.bincount(combos[:, k], y, 65)
    back[0] = 0
    assert y.min() >= 0 and np.abs(back - goal).max() < 0.02 * goal.max()


def test_pieces_hold_every_id_once(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = packing.pack(df).collect()
    encoder = tokens.Encoder(tokens.WORD_VOCABULARY)
    ids = {d: np.append(x, 2).astype("<u4") for (d, _), x in zip(data, encoder.encode([t for _, t in data]), strict=True)}
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        piece = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(piece) == r["length"] and zlib.crc32(piece.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert by_doc.keys() == ids.keys()
    for parts, key, whole in [(p, "start", len(ids[d])) for d, p in by_doc.items()] + [(p, "offset", None) for p in by_sequence.values()]:
        end = 0
        for r in sorted(parts, key=lambda r: r[key]):
            assert r[key] == end
            end += r["length"]
        assert end <= 4096 if whole is None else end == whole
    total = sum(map(len, ids.values()))
    assert (len(by_sequence) - 1) * 4096 < total * 1.05


class Frame:
    """Stands for a frame: gives the function that it would run over Arrow batches."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):  # noqa: N802
        return run


def test_a_batch_is_tokenized_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "TaskContext", Mock(**{"get.return_value.partitionId.return_value": 0}))
    texts = [None, "", *["some words, repeated " * 20_000] * 24, "x " * 3_000_000, "last"]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    found = []
    for out in packing.token_pieces(Frame(), tokens.WORD_VOCABULARY, 4096, 16)(iter([batch, batch.slice(0, 0)])):
        docs = sorted(set(out.column("doc_id").to_pylist()))
        assert len(docs) == 1 or sum(len(texts[d] or "") for d in docs) <= 4 << 20
        found += out.to_pylist()
    library = tokens.Encoder(tokens.WORD_VOCABULARY).library
    n = [len(library.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts]
    assert [(r["doc_id"], r["start"], r["length"]) for r in found] == [
        (d, s, min(4096, n[d] - s)) for d in range(len(texts)) for s in range(0, n[d], 4096)
    ]
    ranks = {}
    for r in found:
        ranks.setdefault(r["bucket"], []).append(r["rank"])
    assert all(x == list(range(len(x))) for x in ranks.values())


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
