import random

import pytest
from tidemark.llm import licenses
from tidemark.llm.licenses import NOTICES, Scanner, _shingles, words_of


@pytest.fixture(scope="module")
def scanner():
    return Scanner(NOTICES)


def contained(scanner, text):
    """Templates whose shingles the whole text contains to the limit."""
    shingles = set(_shingles(words_of(text)))
    return {t.name for t in scanner.templates if len(t.shingles & shingles) >= t.need}


def texts(n=300):
    rng = random.Random(4)
    filler = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(500)]
    out = []
    for _ in range(n):
        words = rng.choices(filler, k=rng.choice([0, 3, 40, 400]))
        for name in rng.sample(sorted(NOTICES), rng.choice([0, 1, 2])):
            notice = NOTICES[name].split()
            if rng.random() < 0.3 and len(notice) > 12:
                notice[rng.randrange(len(notice))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = notice
        out.append(" ".join(words))
    return out


def test_every_contained_template_is_found(scanner, monkeypatch):
    data = texts()
    want = {(i, n) for i, t in enumerate(data) for n in contained(scanner, t)}
    assert len(want) > 200
    for size in (1 << 19, 500):
        monkeypatch.setattr(licenses, "SLICE_WORDS", size)
        got = {(i, n) for i, n, *_ in scanner.scan(data)}
        # Edits may leave a template's shingles together only in part; a whole one must be found.
        assert got <= want
        assert len(want - got) <= len(want) // 50
        assert not {(i, n) for i, n in want - got if words_of(NOTICES[n]) in [words_of(data[i])[k:k + len(words_of(NOTICES[n]))] for k in range(len(words_of(data[i])))]}


def test_places_and_counts(scanner):
    text = f"a b c {NOTICES['mit']} d e {NOTICES['mit']} {NOTICES['gpl-3.0']}"
    got = sorted(x[1:] for x in scanner.scan([text]))
    assert got == [("gpl-3.0", 15, 27, 1.0), ("mit", 3, 8, 1.0), ("mit", 10, 15, 1.0)]


def test_bands_keep_the_chance(scanner):
    for t in scanner.templates:
        assert (1 - t.likeness) ** scanner.bands[t.window] <= licenses.MISS * 1.0001


def test_odd_texts(scanner):
    assert list(scanner.scan([None, "", "one two", "é" * 10, "word " * 30_000])) == []
    assert list(scanner.scan([])) == []
    with pytest.raises(ValueError):
        Scanner({"short": "too short"})


def test_frames(spark, small):
    from tidemark.llm.queries import QUERIES

    rows = [(1, NOTICES["mit"], "x"), (1, NOTICES["mit"], "x"), (None, NOTICES["mpl-2.0"], None), (2, None, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = sorted(((r["doc_id"], r["license"]) for r in licenses.scan(df).collect()), key=str)
    assert got == [(1, "mit"), (1, "mit"), (None, "mpl-2.0")]
    assert licenses.scan(df.where("false")).count() == 0
    found = {(r["doc_id"], r["license"]) for r in QUERIES["op8_license_scan"](spark, small).collect()}
    scan = Scanner(NOTICES)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert found == {(r["doc_id"], n) for r in docs for n in contained(scan, r["text"])}
