import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
from tidemark.llm import pieces
from tidemark.llm.queries import QUERIES

ODD = [
    None, "", " ", "  ", " a", "a ", "a  b", "a\nb\tc", "▁", "a▁b ▁ c", "naïve 中文 🎉 \U0001F469‍\U0001F4BB", "\x00\x7f", "x" * 5000,
    "é" * 300 + "a b", "ﬁ Å é", " ▁ ", "word " * 40,
]


@pytest.fixture(scope="module")
def sample():
    return pieces.Sampler()


def segmentations(sample, word):
    """All segmentations of a word with their weight, by trying every cut."""
    out = {}
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate([*cuts, 1], 1):
            if c:
                parts.append(word[at:i])
                at = i
        if all(p in sample.pieces for p in parts):
            out[tuple(sample.pieces[p][0] for p in parts)] = math.prod(sample.pieces[p][1] for p in parts)
    return out


def test_round_trip(sample):
    for temperature in (0.5, 1.0, 5.0):
        s = pieces.Sampler(temperature=temperature)
        for t, ids in zip(ODD, s.encode(ODD, list(range(len(ODD)))), strict=True):
            assert s.decode(ids.tolist()) == (t or "")


def test_draws_follow_the_lattice(sample):
    word = "▁there"
    want = segmentations(sample, word)
    total = sum(want.values())
    n = 20_000
    got = Counter(tuple(x.tolist()) for x in sample.encode(["there"] * n, list(range(n))))
    assert set(got) <= set(want)
    for ids, w in want.items():
        p = w / total
        assert abs(got[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9


def test_rows_depend_on_their_key_alone(sample):
    text = "the quick brown fox jumps over the lazy dog " * 5
    a, b, c = sample.encode([text, text, text], [1, 2, 1])
    assert np.array_equal(a, c) and not np.array_equal(a, b)
    alone = sample.encode(["other text here", text], [9, 1])[1]
    assert np.array_equal(a, alone)


def test_cold_temperature_takes_the_best(sample):
    s = pieces.Sampler(temperature=0.02)
    best = max(segmentations(s, "▁house").items(), key=lambda x: x[1])[0]
    assert all(tuple(x.tolist()) == best for x in s.encode(["house"] * 50, list(range(50))))


def test_frames(spark, small):
    rows = [(1, "some text", 5), (None, None, None), (1, "some text", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded int")
    out = pieces.decode(pieces.encode(df).select("doc_id", "text", "piece_ids"))
    got = out.collect()
    assert sorted((r["text"] or "", r["decoded"]) for r in got) == [("", ""), ("some text",) * 2, ("some text",) * 2]
    assert len({tuple(r["piece_ids"]) for r in got if r["text"]}) == 1
    assert pieces.encode(df.where("false")).count() == 0
    whole = QUERIES["op5_sampled_pieces"](spark, small).collect()
    assert len(whole) == spark.read.parquet(f"{small}/documents.parquet").count() and all(r["lossless"] for r in whole)


def test_rows_do_not_depend_on_others_when_cold():
    """Weights of rare characters that vanish stay with their own word."""
    s = pieces.Sampler(temperature=0.02)
    alone = s.encode(["house there"], [1])[0]
    assert np.array_equal(s.encode(["\U0001F469 中文", "house there"], [0, 1])[1], alone)


def test_words_are_cut_on_bytes(sample):
    texts = ["", "a", " a", "a  b ", "x\n y", "é 中  🎉", " ", "   ", "a b\tc"]
    docs = [(" " + t).encode() if t else b"" for t in texts]
    word, per_doc, points, lengths = sample._words(docs)
    starts = np.cumsum(lengths) - lengths
    names = ["".join(map(chr, points[a:a + n].tolist())) for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
    got = iter([names[w] for w in word.tolist()])
    for t, n in zip(texts, per_doc.tolist(), strict=True):
        want = re.findall("▁*[^▁]+|▁+", "▁" + t.replace(" ", "▁")) if t else []
        assert [next(got) for _ in range(n)] == want
    assert len(set(names)) == len(names)


def test_spaces_beside_space_signs_are_words(sample):
    docs = [(" " + t).encode() for t in ("a▁b ▁  c", "  a")]
    word, per_doc, points, lengths = sample._words(docs)
    assert per_doc.tolist() == [9, 1] and lengths[word].tolist() == [1] * 9 + [4]


def test_decoding_in_parts(spark, monkeypatch):
    monkeypatch.setattr(pieces, "DECODE_IDS", 7)
    rows = [(i, "some text " * (i % 5)) for i in range(40)] + [(99, None)]
    got = pieces.decode(pieces.encode(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))).collect()
    assert sorted((r["doc_id"], r["decoded"]) for r in got) == sorted((i, t or "") for i, t in rows)
