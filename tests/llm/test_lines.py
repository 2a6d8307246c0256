import hashlib

import numpy as np
import pyarrow as pa
import pytest
from tidemark.llm import lines, repeats
from tidemark.llm.common import PART_BYTES


def key(line):
    k = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)


def brute(rows):
    held = {}
    for d, t, *_ in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                held.setdefault(k, set()).add(d)
    out = []
    for d, t, *_ in rows:
        ls = (t or "").split("\n")
        kept = []
        for x in ls:
            docs = held.get(key(x), set())
            if len(docs) < 5 or (d is not None and d == max(v for v in docs if v is not None)):
                kept.append(x)
        out.append((d, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    out = lines.dedup_lines(df).collect()
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in out), key=str)


COMMON = "A Line that many of the Documents hold, with É and more"
RARE = "a line that only four of the documents hold, which is too few"


def rows():
    out = [(i, f"own {i}\n  {COMMON.upper() if i % 2 and 'É' in COMMON else COMMON}\t\nshort\n\n{'x' * 39}", "s") for i in range(9)]
    out += [(20 + i, f"{RARE}\n{RARE}\nown words {i}", "s") for i in range(4)]
    out += [(8, f"{COMMON}\nagain", None), (None, COMMON, "n"), (50, None, "n"), (51, "", "n"), (52, "\n", "n"), (0, COMMON, "t")]
    out += [(60, "word " * 20_000 + "\n" + COMMON, "long")]
    return out


@pytest.mark.parametrize("bits", [28, 10])
def test_equals_brute_force(spark, monkeypatch, bits):
    """With 2**10 bits nearly every line is suspected: the exact part alone decides."""
    monkeypatch.setattr(repeats, "MAX_BITS", bits)
    monkeypatch.setattr(repeats, "MIN_BITS", min(bits, 16))
    df = spark.createDataFrame(rows(), "doc_id long, text string, n_lines string").repartition(4)
    assert got(df) == brute(rows())


def test_empty_and_columns(spark):
    df = spark.createDataFrame(rows()[:2], "doc_id long, text string, _marks string")
    assert lines.dedup_lines(df).columns == ["doc_id", "text", "_marks", "n_lines", "n_dropped"]
    assert lines.dedup_lines(df.where("false")).count() == 0


def test_twice_filter_misses_no_repeat():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 5_000, np.uint64)
    pair, other = repeats.Pair(16), repeats.Pair(16)
    pair.add(hashes[:3000])
    pair.add(hashes[2500:3000])
    other.add(np.r_[hashes[2900:], hashes[4000:4100]])
    twice = pair.twice | other.twice | (pair.once & other.once)
    hit = repeats.suspected(hashes, twice, 16)
    assert hit[2500:3000].all() and hit[4000:4100].all()
    assert hit.mean() < 0.5


def test_filters_take_batches_in_parts():
    """A batch above the size of a part is hashed in parts, with the filters of the whole batch."""
    texts = [f"{'word ' * 60_000}{i % 7}" for i in range(40)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    sizes = []

    def hashes_of(part):
        sizes.append(sum(len(t or "") for t in part.column("text").to_pylist()))
        return lines._hashes([k for ks in lines._distinct(part, "text", 40) for k in ks])

    got = pa.Table.from_batches(repeats.states_of(iter([batch]), "text", hashes_of, 16))
    assert len(sizes) > 1 and max(sizes) <= PART_BYTES
    pair = repeats.Pair(16)
    pair.add(hashes_of(batch))
    assert got.equals(pa.Table.from_batches(pair.rows()))
