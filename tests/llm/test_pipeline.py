import zlib

import corpus_pipeline
import numpy as np
import test_lines
import test_quality
import test_simhash
import test_substrings
from tidemark.llm import tokens


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_every_stage_equals_brute_force(spark, small, tmp_path):
    """The stages one after another over the whole table, each against the plain way on its own input."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
        if name != "packing":
            assert docs.columns == columns
    source = spark.read.parquet(f"{small}/documents.parquet")
    before, good, lined, single, cut = rows(source), *[rows(d) for d in out[:4]]

    # All hosts of this table are good, so the base rules decide.
    assert good.keys() == {d for d, r in before.items() if not test_quality.brute(r["text"])[-1]}
    pairs = lambda x: [(d, r["text"]) for d, r in x.items()]
    assert test_lines.got(out[0].select("doc_id", "text")) == test_lines.brute(pairs(good))
    assert lined.keys() == good.keys() and all(len(r["text"]) == r["n_chars"] for r in lined.values())
    prints = sorted((d, test_simhash.brute_print(t)) for d, t in pairs(lined))
    assert single.keys() == {c for _, c in test_simhash.brute_classes(prints)}
    assert all(single[d]["text"] == lined[d]["text"] for d in single)
    want = {d: n for d, _, n, _, _ in test_substrings.brute(pairs(single))}
    assert cut.keys() == single.keys()
    for d, r in cut.items():
        assert len(single[d]["text"].encode()) - len(r["text"].encode()) >= want[d]
        assert (r["text"] == single[d]["text"]) == (want[d] == 0)

    encoder = tokens.Encoder(tokens.WORD_VOCABULARY)
    ids = {d: np.append(x, 2).astype("<u4") for d, x in zip(cut, encoder.encode([r["text"] for r in cut.values()]), strict=True)}
    packed = out[4].collect()
    assert sum(r["length"] for r in packed) == sum(map(len, ids.values()))
    for r in packed:
        piece = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(piece.tobytes()) == r["ids_crc32"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0
