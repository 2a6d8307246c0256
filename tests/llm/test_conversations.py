import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from check_oracles import compare, connect
from pyspark.sql import functions as F
from tidemark.llm import conversations, scans
from tidemark.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Every node as a tuple of turns, its members as a set."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    turns = {c: [t for _, t in sorted(x)] for c, x in turns.items()}
    built, members = {}, defaultdict(set)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(turns.get(c - c % 100, [])[:h] + own[h:])
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].add(c)
    out = []
    for node, those in members.items():
        below = [n for n in members if n[:len(node)] == node]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[:-1] == n for m in below)]
        ends = ",".join(str(c) for c in sorted(those) if built[c] == node)
        out.append((
            min(those), len(node), min(members[node[:-1]]) if node else None, len(those),
            sum(len(n) == len(node) + 1 for n in below), len(leaves),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def got(spark, rows, tmp_path, parts=3):
    folder = str(tmp_path)
    extra = "node string, depth int"  # names the operator uses itself
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, {extra}").repartition(parts)
    df.write.parquet(f"{folder}/conversations.parquet")
    found = QUERIES["op12_conversation_trie"](spark, folder)
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=str)


def shared(n, heads=(0, 100)):
    """Conversations that share first turns, stop early, repeat others or have no head."""
    rows = []
    for c in range(n):
        for t in range(c % 9):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of kind {c % 3 if t > 1 else 0}"))
    return rows


def test_equals_brute_force(spark, tmp_path):
    rows = shared(130) + [(c, t, "user", f"no head {t}") for c in (205, 206, 207, 331) for t in range(3)]
    rows += [(400, None, None, None), (400, 0, None, "a"), (400, 0, "b", None), (400, 0, "b", None), (401, 5, "", "é 漢")]
    rows += [(None, 1, "user", "nobody"), (-7, 1, "user", "negative"), (-7, 2, "user", "x" * 2000), (9_000_000_005, 1, "u", "far")]
    assert got(spark, rows, tmp_path) == brute(rows)


def test_one_conversation_over_many_ranges(spark, tmp_path):
    """A third of all rows under one id, and equal rows."""
    rows = shared(60) + [(100, t, "user", f"step {t}") for t in range(150)] + [(106, 0, "user", "same")] * 60
    rows += [(108, t, "user", f"step {t}") for t in range(100)]
    assert got(spark, rows, tmp_path, 8) == brute(rows)


def test_large_group_of_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conversations, "SLICE_IDS", 16)
    rows = [(c, t, "user", f"t{t}") for c in range(300) for t in range(3)]
    assert got(spark, rows, tmp_path) == brute(rows)


def test_empty(spark, tmp_path):
    assert got(spark, [], tmp_path) == []


def test_long_text(spark, tmp_path):
    rows = [(c, t, "user", "é" * (1_200_000 + t)) for c in (100, 101, 102, 103) for t in range(2)]
    assert got(spark, rows, tmp_path) == brute(rows)


def test_whole_table_equals_its_statement(spark, small):
    name = "op12_conversation_trie"
    assert compare(spark, connect(small), small, name).startswith("ok")


@pytest.mark.parametrize("seed", range(3))
def test_running_equals_plain_loops(spark, seed):
    """Counts, sums and prefix numbers whatever the ranges of rows."""
    rng = np.random.default_rng(seed)
    rows = [(int(k), i, int(v), int(m)) for i, (k, v, m) in enumerate(zip(
        np.minimum(rng.zipf(1.4, 2000), 40), rng.integers(-9, 9, 2000), rng.integers(-2**62, 2**62, 2000), strict=True))]
    df = spark.createDataFrame(rows, "k long, i long, v long, m long").repartition(5)
    out = scans.running(df, "k", [F.col("i")], sums=["v"], marks=["m"])
    state, want = {}, []
    for k, i, v, m in rows:
        n, s, p = state.get(k, (0, 0, 0))
        state[k] = (n + 1, s + v, (p * scans.FACTORS[0] + m) % 2**64)
        want.append((k, i, *state[k][:2], state[k][2], p))
    found = [(r["k"], r["i"], r["n"], r["v_run"], r["m_prefix"] % 2**64, r["m_before"] % 2**64) for r in out.collect()]
    assert sorted(found) == sorted(want)
