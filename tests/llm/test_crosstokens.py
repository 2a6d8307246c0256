import hashlib
import itertools
from collections import Counter, defaultdict

import pytest
import sentencepiece
from public_tokenizers import path
from tidemark.llm import crosstokens
from tidemark.llm.tokens import byte_letters
from tokenizers import Tokenizer

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spelled(text):
    """(id, bytes) of both vocabularies, straight from the libraries."""
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    back = {c: b for b, c in byte_letters().items()}
    coded = library.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(back[c] for c in library.id_to_token(i))) for i in coded.ids]
    b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        b.append((i, bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
    return a, b


def brute(rows):
    """Every text token by token; links by comparing all byte ranges of a group."""
    documents, held = [], defaultdict(int)
    for doc_id, text in rows:
        a, b = spelled(text) if text else ([], [])
        want = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            documents.append((doc_id, [], [], [], []))
            continue
        place, ranges = 0, {"a": [], "b": []}
        for name, tokens in (("a", a), ("b", b)):
            place = 0
            for i, x in tokens:
                ranges[name].append((place, place + len(x), i))
                place += len(x)
        cuts = sorted({e for _, e, _ in ranges["a"]} & {e for _, e, _ in ranges["b"]})
        groups, links = [], []
        for cut in cuts:
            mine = {k: list(itertools.takewhile(lambda r: r[1] <= cut, v)) for k, v in ranges.items()}  # noqa: B023
            ranges = {k: v[len(mine[k]):] for k, v in ranges.items()}
            groups.append(",".join(str(i) for *_, i in mine["a"]) + "|" + ",".join(str(i) for *_, i in mine["b"]))
            links += [(i, j) for s, e, i in mine["a"] for t, f, j in mine["b"] if s < f and t < e]
        documents.append((doc_id, a, b, groups, links))
        for pair in set(links):
            held[pair] += 1
    best = Counter()
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    out = []
    for doc_id, a, b, groups, links in documents:
        text = ";".join(groups)
        out.append((
            doc_id, len(a), len(b), len(groups), len(links), sum(held[p] == best[p[0]] for p in links),
            sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else "",
        ))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def texts():
    rows = [(i, f"Thtion number {i} ouened, the words of aaaaaaa " * (1 + i % 4)) for i in range(40)]
    return rows + [
        (50, None), (51, ""), (52, " "), (53, "  two  spaces\n\n"), (54, "<s> and </s> and <|endoftext|> <unk>"),
        (55, "a ▁ sign of its own"), (56, "é ü 漢字 😀   mixed"), (57, "x"), (57, "x"), (None, "no id"),
        (None, None), (-3, "\t\x00 tab and zero"), (60, "0123456789 " * 3), (61, "aaaa aaaaaaaaaaaaaaaaaaaaaaaa"),
    ]


@pytest.mark.parametrize("top", [crosstokens.TOP_PAIRS, 40, 0])
def test_equals_brute_force(spark, monkeypatch, top):
    """Also with few or none of the pairs sent to the tasks, and with small slices."""
    monkeypatch.setattr(crosstokens, "SLICE_CHARS", 300)
    monkeypatch.setattr(crosstokens, "HELD_PAIRS", 50)
    rows = [(*r, "clash", 1) for r in texts()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string, row int").repartition(3)
    assert got(crosstokens.align_tokenizers(docs, top=top)) == brute([r[:2] for r in rows])


def test_groups_are_the_text_of_the_digest(spark):
    docs = spark.createDataFrame([(1, "Thtion is ouened."), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in crosstokens.align_tokenizers(docs).collect()}
    assert hashlib.sha256(rows[1]["groups"].encode()).hexdigest() == rows[1]["groups_sha256"]
    a, b = spelled("Thtion is ouened.")
    sides = [g.split("|") for g in rows[1]["groups"].split(";")]
    assert [int(i) for x, _ in sides for i in x.split(",")] == [i for i, _ in a]
    assert [int(i) for _, x in sides for i in x.split(",")] == [i for i, _ in b]
    assert (rows[2]["groups"], rows[2]["groups_sha256"], rows[2]["n_links"]) == ("", "", 0)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert crosstokens.align_tokenizers(docs).collect() == []


def test_very_long_text(spark):
    """Over a megabyte in one text: the counts follow from the libraries' own ids."""
    text = "Thtion ouened ereat, whreble.\n" * 40_000
    row = crosstokens.align_tokenizers(spark.createDataFrame([(1, text)], "doc_id long, text string"), with_groups=False).first()
    a, b = spelled(text)
    assert (row["n_a"], row["n_b"], row["groups"]) == (len(a), len(b), None)
    # Only one document: every pair is held once, and all are the highest.
    assert row["count_sum"] == row["n_best"] == row["n_links"]


def test_whole_table(spark, small):
    from tidemark.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    rows = sorted(rows, key=lambda r: len(r[1] or ""))
    assert got(QUERIES["op11_cross_tokens"](spark, small)) == brute(rows)
