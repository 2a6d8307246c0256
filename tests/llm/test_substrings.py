import hashlib
import random

import numpy as np
import pytest
from tidemark.llm import substrings
from tidemark.llm.runindex import RunIndex, suffix_order

WIDE = "doc_id long, text string"


def brute(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, sha) by a dictionary of all windows."""
    first = {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for d, t in order:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            place = (d is not None, d or 0, i)
            w = raw[i:i + length]
            first[w] = min(first.get(w, place), place)
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < (d is not None, d or 0, i):
                gone[i:i + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((d, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    rows = substrings.dedup_substrings(df).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows), key=str)


def make_rows(seed, n=60):
    rng = random.Random(seed)

    def words(k):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 9))) for _ in range(k))

    passages = [words(rng.randint(15, 60)) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [words(rng.randint(0, 30)), rng.choice(passages), words(rng.randint(0, 30)), rng.choice(passages)]
        t = "\n".join(parts)
        if rng.random() < 0.3 and rows:
            t = rng.choice(rows)[1] or ""
            if rng.random() < 0.5 and len(t) > 50:
                k = rng.randrange(len(t))
                t = t[:k] + "ß" + t[k + 1:]
        rows.append((i * 7 % 61, t))
    rows += [(100, None), (101, ""), (102, "x" * 99), (103, "y" * 450), (104, "ab" * 300), (105, "z" * 100), (106, "z" * 101),
             (107, rows[0][1]), (None, rows[1][1]), (107, rows[0][1])]
    return rows


def test_suffix_order_and_statistics():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab\xff\x00") for _ in range(rng.randint(1, 40))) for _ in range(12)] + [b"abab" * 9, b"abab" * 8]
    strings = list(dict.fromkeys(strings))
    index = RunIndex(strings, 5)
    places = {int(b) + i: s[i:i + 5] for b, s in zip(index.begins, strings, strict=True) for i in range(len(s))}
    heads = index.classes()
    by_bytes = {}
    for at, w in places.items():
        if len(w) == 5:
            by_bytes.setdefault(w, set()).add(int(heads[at]))
    assert all(len(v) == 1 for v in by_bytes.values())
    assert len(set().union(*by_bytes.values())) == len(by_bytes)
    for _ in range(20):
        text = np.array([rng.choice([0, 1, 2, 256]) for _ in range(rng.randint(1, 60))], np.int16)
        plain = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffix_order(text, len(text)).tolist() == plain


@pytest.mark.parametrize("chunk", [1 << 19, 64])
def test_segments_cover_windows_by_content(monkeypatch, chunk):
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    raw = make_rows(2)[3][1].encode() * 2 + b"q" * 600
    seen, where = {}, []
    for a, n, h in substrings.segments(raw):
        for s, k, key in zip(a.tolist(), n.tolist(), h.tolist(), strict=True):
            where += range(s, s + k)
            for i in range(s, s + k):
                assert seen.setdefault(raw[i:i + 100], key) == key
    assert where == list(range(len(raw) - 99))


@pytest.mark.parametrize("crowded", [2_048, 1])
def test_equals_brute_force(spark, monkeypatch, crowded):
    """Repeated passages, near copies, periodic texts, odd rows; once with every mixed hash on the crowded way."""
    monkeypatch.setattr(substrings, "CROWDED", crowded)
    rows = make_rows(5)
    df = spark.createDataFrame(rows, WIDE).repartition(5)
    assert got(df) == brute(rows)


def test_columns_pass_and_empty(spark):
    df = spark.createDataFrame([(1, "a" * 150, "k"), (2, "a" * 150, "l")], WIDE + ", kept string")
    out = substrings.dedup_substrings(df)
    assert out.columns == ["doc_id", "text", "kept", "n_bytes", "n_removed", "n_spans"]
    assert substrings.dedup_substrings(df.where("false")).count() == 0


def test_whole_table(spark, small):
    from tidemark.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op9_run_index_dedup"](spark, small).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out), key=str) == brute(rows)
