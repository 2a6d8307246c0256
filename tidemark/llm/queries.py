"""The registered queries of the text operators, with DuckDB statements where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import (
    conversations, crosstokens, idfiles, licenses, lines, packing, pages, pieces, quality, simhash, sketches, substrings, urls,
)
from tidemark.llm.common import Query, store, table
from tidemark.session import run_dir

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


_WORD = r"[^\x20\x09-\x0D]+"

#: The published base rules and the host verdict, over whole texts.
QUALITY_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, regexp_extract_all(text, '{_WORD}') AS w FROM docs),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM windows) WHERE n >= 2),
repeats AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS l FROM docs),
dups AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM lines WHERE regexp_matches(l, '{_WORD}') GROUP BY r),
base AS (
  SELECT d.doc_id, d.source, len(w.w)::BIGINT AS n_words,
    length(array_to_string(w.w, ''))::BIGINT AS word_chars,
    (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(u.n, 0)::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words
  FROM docs d JOIN words w USING (r) LEFT JOIN dups u USING (r) LEFT JOIN repeats p USING (r)
),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS f FROM judged
  WHERE source IS NOT NULL GROUP BY source),
sums AS (SELECT sum(n) AS n, sum(f) / sum(n) AS mean, count(*) AS h, sum(f * f / n) AS ff FROM hosts),
prior AS (SELECT mean, least(greatest(mean * (1 - mean)
  / greatest((ff - n * mean * mean) / n - mean * (1 - mean) * h / n, 1e-12) - 1, 2), 10000) AS strength FROM sums),
rejected AS (SELECT source FROM hosts, prior WHERE (f + mean * strength) / (n + strength) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM rejected)) AS kept
FROM judged
"""


LINES_SQL = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS i FROM docs),
keyed AS (
  SELECT *, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
),
losers AS (SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT a.*, b.k IS NOT NULL AND a.doc_id <> b.holder AS gone FROM keyed a LEFT JOIN losers b USING (k))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""


@query(LINES_SQL)
def op1_line_dedup(spark, d):
    kept = lines.dedup_lines(table(spark, d, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(QUALITY_SQL)
def op3_quality_rules(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    metrics = store(quality.with_metrics(docs).drop("text"), "metrics")
    judged = quality.with_verdicts(metrics, quality.host_rates(metrics))
    return judged.select("doc_id", *quality.METRICS, "kept")


@query()
def op4_packing(spark, d):
    return packing.pack(table(spark, d, "documents"))


@query()
def op6_id_files(spark, d):
    folder = run_dir(spark, "id-files")
    idfiles.write(table(spark, d, "documents"), folder)
    return idfiles.read(spark, folder, with_ids=False).drop("ids")


@query()
def op10_fingerprints(spark, d):
    found = sketches.fingerprints(table(spark, d, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        "n_differs_edited", "n_differs_next",
    )


@query()
def op2_simhash(spark, d):
    near = simhash.near_duplicates(table(spark, d, "documents").select("doc_id", "text"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op9_run_index_dedup(spark, d):
    kept = substrings.dedup_substrings(table(spark, d, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op5_sampled_pieces(spark, d):
    """Per document: ids of a sampled segmentation seeded by its id, and whether decoding gives the text back."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    # Stored in between: a task then runs one Python worker, not two.
    coded = pieces.decode(store(pieces.encode(docs), "pieces", "zstd"))
    ids = F.col("piece_ids")
    return coded.select(
        "doc_id", F.size(ids).cast("long").alias("n_pieces"), F.sha2(F.array_join(ids, " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


@query()
def op7_html_text(spark, d):
    text = pages.extract_text(table(spark, d, "pages").select("page_id", "url", "html"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op8_license_scan(spark, d):
    """Per document and license: number of matches, the best containment and the first place."""
    found = licenses.scan(table(spark, d, "documents"))
    return found.groupBy("doc_id", "license").agg(
        F.count(F.lit(1)).alias("n_matches"), F.max("containment").alias("containment"), F.min("first_word").alias("first_word")
    )


@query()
def op11_cross_tokens(spark, d):
    found = crosstokens.align_tokenizers(table(spark, d, "documents"), with_groups=False)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


#: Prefix nodes as lists of (role, text); h is the crc32 of the decimal id, byte by byte and bit by bit.
TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))
  ), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
),
rows AS (
  SELECT c.conv_id, 1 AS kind, t.pos, t.t FROM convs c JOIN turns t ON t.conv_id = c.head AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 2, t.pos, t.t FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
),
seqs AS (
  SELECT c.conv_id, coalesce(s.s, []) AS s FROM convs c
  LEFT JOIN (SELECT conv_id, list(t ORDER BY kind, pos) AS s FROM rows GROUP BY conv_id) s USING (conv_id)
),
members AS (
  SELECT conv_id, d, CASE WHEN d = 0 THEN [] ELSE s[1:d] END AS k
  FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM seqs)
),
nodes AS (
  SELECT min(conv_id) AS conv_id, d, k, count(*) AS n,
    (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE length(k[d].text) END AS own
  FROM members GROUP BY d, k
),
families AS (SELECT d - 1 AS d, CASE WHEN d = 1 THEN [] ELSE k[1:d - 1] END AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
marked AS (SELECT n.*, coalesce(f.n, 0) AS n_children FROM nodes n LEFT JOIN families f USING (d, k)),
above AS (
  SELECT a AS d, CASE WHEN a = 0 THEN [] ELSE k[1:a] END AS k, own, n_children = 0 AS leaf
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM marked)
),
trees AS (SELECT d, k, sum(own) AS saved, count(*) FILTER (WHERE leaf) AS n_leaves FROM above GROUP BY d, k),
ends AS (SELECT s AS k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS h FROM seqs GROUP BY s)
SELECT m.conv_id, m.d::BIGINT AS depth, p.conv_id AS parent_conv_id, m.n::BIGINT AS n_convs,
  m.n_children::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens,
  coalesce(e.h, sha256('')) AS ends_sha256
FROM marked m JOIN trees t USING (d, k) LEFT JOIN ends e ON e.k = m.k
LEFT JOIN nodes p ON p.d = m.d - 1 AND p.k = CASE WHEN m.d = 1 THEN [] ELSE m.k[1:m.d - 1] END
"""


@query(TRIE_SQL)
def op12_conversation_trie(spark, d):
    trie = conversations.conversation_trie(table(spark, d, "conversations"))
    found = trie.nodes.join(conversations.end_digests(trie.ends), "node", "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(conversations.NO_ENDS)).alias("ends_sha256"),
    )


#: The rules of the url filter.
URL_RULES = [
    urls.rule("allow", "org/"), urls.rule("block", "example.org/es/"), urls.rule("block", "example.org/en/1"),
    urls.rule("allow", "com/fr/"), urls.rule("block", "com/de/"),
]


@query()
def op13_url_filter(spark, d):
    """The tables label no pages, so a page takes the labels that ``labels`` has under its id."""
    clean = ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("clean")
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("page_id"), clean).where("clean IS NOT NULL")
    judged = urls.judge(table(spark, d, "pages"), labels, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")
