import random

import pytest
import xxhash
from tidemark.llm import simhash
from tidemark.llm.graphs import components

MASK = (1 << 64) - 1


def brute_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    """Smallest id reachable over links of at most two bits. ``prints``: list of (id, print)."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if ((prints[i][1] ^ prints[j][1]) & MASK).bit_count() <= 2:
                a, b = find(i), find(j)
                if a != b:
                    if prints[a][0] > prints[b][0]:
                        a, b = b, a
                    parent[b] = a
    return sorted((d, prints[find(i)][0]) for i, (d, _) in enumerate(prints))


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_fingerprints_equal_brute_force():
    texts = [None, "", " \t ", "One", "one TWO", "a b c", "Á b\tc d\x0be É f", "x " * 50, " ".join(map(str, range(300)))]
    for t in texts:
        assert simhash.fingerprint(t) == brute_print(t)


def test_chunks_do_not_change_the_fingerprint(monkeypatch):
    text = " ".join(f"w{i * 7 % 91}" for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == whole


@pytest.mark.parametrize("crowded", [64, 1])
def test_classes_equal_brute_force(spark, monkeypatch, crowded):
    """Chains, stars and copies; with ``crowded`` 1 nearly all go the way of crowded buckets."""
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(1)
    prints = [0, 0, MASK, 1 << 63]
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 12])):
            prints.append(at)
            for b in rng.sample(range(64), rng.choice([1, 2, 3])):
                at ^= 1 << b
    hub = rng.getrandbits(64)
    prints += [hub ^ (1 << b) for b in range(0, 64, 3)] + [hub] * 3
    rng.shuffle(prints)
    rows = [(i * 3, p) for i, p in enumerate(prints)]
    df = spark.createDataFrame([(i, signed(p)) for i, p in rows], "doc_id long, fp long")
    got = simhash.with_class(df, simhash.classes(df), "fp")
    assert sorted((r["doc_id"], r["component_id"]) for r in got.collect()) == brute_classes(rows)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(-5, 200), (200, 201), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 130))
    assert got[200] == got[201] == got[-5] == -5


def test_operator_on_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(5, text, "x"), (3, text, "y"), (5, text, "z"), (None, text, None), (9, None, "n"), (8, "", "e"), (7, "other thing", "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(5, 3), (3, 3), (None, 3), (9, 8), (8, 8), (7, 7)}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["fp"]) for r in kept.collect()) == [(3, "y"), (7, "o"), (8, "e")]
    assert simhash.near_duplicates(docs.where("false")).count() == 0
    assert simhash.keep_one(docs.where("false")).count() == 0


def test_every_component_keeps_a_row(spark):
    """Rows without id, and components whose smallest id is the same."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(None, a), (None, b), (None, b), (5, c), (9, c), (5, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one(docs).collect()), key=lambda r: r[1])
    assert kept == [(None, a), (None, b), (5, c), (5, d)]


def test_whole_table(spark, small):
    from tidemark.llm.queries import QUERIES

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r["doc_id"], brute_print(r["text"])) for r in docs]
    got = QUERIES["op2_simhash"](spark, small).collect()
    assert sorted((r["doc_id"], r["fingerprint"]) for r in got) == sorted((d, f"{p:016x}") for d, p in prints)
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == brute_classes(prints)
