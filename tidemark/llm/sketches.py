"""Document fingerprints: invertible Bloom lookup sketches over paragraph digests.

A text is the set of its paragraphs, lines cut at every 256 code points. Each digest enters one cell in each of
three tables; a cell holds a count, the xor of its digests and the xor of their checks. The sketch of one
version subtracted from that of another holds the difference alone; a cell with a single digest gives it away,
and taking it out of its other cells frees more. When cells stay, the comparison is retried with a larger
sketch under other hash functions, until every difference is recovered.

Only DataFrame functions. The fingerprints themselves are peeled inside the row, so only versions that need a
larger sketch are shuffled; the cells of a document are brought together once a retry, and all its peeling rounds
run inside that partitioning.

Defined results: a null text is empty; an empty text has an all-zero sketch; equal paragraph sets have equal
fingerprints and likeness 1. Rows with equal ids follow each other in order of their text.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small, store, text_of

PARAGRAPH_CHARS = 256
TABLES = 3
#: Cells of the fingerprint itself.
CELLS = 12
BUCKET_BYTES = 8 << 20


def paragraphs(text: Column) -> Column:
    """Distinct digests of the paragraphs of a text."""
    pieces = F.regexp_extract_all(text, F.lit(f"[^\n]{{1,{PARAGRAPH_CHARS}}}"), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(0x5EED))


def cell(digest: Column, t: int, cells: Column, seed: int) -> Column:
    """The digest's cell in table ``t`` of a sketch of ``cells`` cells, a multiple of the tables."""
    width = (cells / TABLES).cast("int")
    return (F.pmod(F.xxhash64(digest, F.lit(t), F.lit(seed)), width) + width * t).cast("int")


def sketch(digests: Column) -> Column:
    """The fingerprint's cells as an array of (n, k, c)."""
    size = F.lit(CELLS)
    placed = F.transform(digests, lambda d: F.struct(
        d.alias("d"), check(d).alias("c"), F.array(*[cell(d, t, size, 0) for t in range(TABLES)]).alias("at")
    ))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("c"))

    def at(j: int) -> Column:
        return F.aggregate(placed, zero, lambda a, x: F.when(
            x["at"][j * TABLES // CELLS] == j,
            F.struct((a["n"] + 1).alias("n"), a["k"].bitwiseXOR(x["d"]).alias("k"), a["c"].bitwiseXOR(x["c"]).alias("c")),
        ).otherwise(a))

    return F.array(*[at(j) for j in range(CELLS)])


def as_text(cells: Column) -> Column:
    """Count (16 bits), digests and checks (64 bits each) of every cell in hexadecimal digits."""
    return F.array_join(F.transform(cells, lambda x: F.concat(
        F.lpad(F.hex(x["n"]), 4, "0"), F.lpad(F.hex(x["k"]), 16, "0"), F.lpad(F.hex(x["c"]), 16, "0")
    )), "")


def _round(cells: DataFrame, keys: list[str], table_no: int, seed: int) -> DataFrame:
    """Takes the lone digests of one table out of all tables. A digest has one cell there, so it is taken once."""
    k = F.col("k")
    width = (F.col("m") / TABLES).cast("int")
    lone = (
        (F.abs("n") == 1) & (F.col("c") == check(k)) & (F.col("j") >= width * table_no)
        & (F.col("j") == cell(k, table_no, F.col("m"), seed))
    )
    none = F.lit(0).cast("long")

    def row(j: Column, n: Column, key: Column, c: Column, found: Column) -> Column:
        return F.struct(j.alias("j"), n.alias("n"), key.alias("k"), c.alias("c"), found.alias("found"))

    own = row(F.col("j"), F.col("n"), k, F.col("c"), F.col("found"))
    out = [row(cell(k, t, F.col("m"), seed), -F.col("n"), k, F.col("c"), none) for t in range(TABLES)]
    taken = row(F.lit(-1), F.col("n"), none, none, k)
    spread = cells.select(*keys, "m", F.explode(F.when(lone, F.array(own, *out, taken)).otherwise(F.array(own))).alias("x"))
    grouped = spread.groupBy(*keys, "m", F.col("x.j").alias("j"), F.col("x.found").alias("found"))
    return grouped.agg(F.sum("x.n").alias("n"), F.bit_xor("x.k").alias("k"), F.bit_xor("x.c").alias("c"))


def peel(cells: DataFrame, keys: list[str], seed: int, sweeps: int) -> DataFrame:
    """Per comparison: the digests found with their sign, and the number of cells that stay filled.

    ``cells``: keys, m, j, n, k, c of a subtracted sketch, in a partitioning that keeps each comparison together.
    """
    frame = cells.withColumn("n", F.col("n").cast("long")).withColumn("found", F.lit(0).cast("long"))
    for _ in range(sweeps):
        for t in range(TABLES):
            frame = _round(frame, keys, t, seed)
    is_found = F.col("j") == -1
    left = (F.col("j") >= 0) & ((F.col("n") != 0) | (F.col("k") != 0))
    return frame.groupBy(*keys).agg(
        F.collect_list(F.when(is_found, F.struct("found", "n"))).alias("digests"),
        F.sum(left.cast("int")).alias("left"),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def first_peel(sa: Column, sb: Column) -> Column:
    """Digests in which two fingerprints differ, with their sign, peeled inside the row; null if cells stay filled."""
    none = F.lit(0).cast("long")
    cells = F.transform(F.arrays_zip(sa.alias("sa"), sb.alias("sb")), lambda x: F.struct(
        (x["sa"]["n"] - x["sb"]["n"]).cast("long").alias("n"),
        x["sa"]["k"].bitwiseXOR(x["sb"]["k"]).alias("k"), x["sa"]["c"].bitwiseXOR(x["sb"]["c"]).alias("c"),
    ))
    width, size = CELLS // TABLES, F.lit(CELLS)

    def without_lone(state: Column, t: int) -> Column:
        lone = F.transform(F.filter(
            F.slice(state["cells"], t * width + 1, width),
            lambda x, j: (F.abs(x["n"]) == 1) & (x["c"] == check(x["k"])) & (cell(x["k"], t, size, 0) == j + t * width),
        ), lambda x: F.struct(
            x["n"].alias("n"), x["k"].alias("k"), x["c"].alias("c"),
            F.array(*[cell(x["k"], i, size, 0) for i in range(TABLES)]).alias("at"),
        ))

        def without(x: Column, j: Column, taken: Column) -> Column:
            return F.aggregate(taken, x, lambda a, y: F.when(F.array_contains(y["at"], j), F.struct(
                (a["n"] - y["n"]).alias("n"), a["k"].bitwiseXOR(y["k"]).alias("k"), a["c"].bitwiseXOR(y["c"]).alias("c"),
            )).otherwise(a))

        return _let(lone, lambda taken: F.when(F.size(taken) == 0, state).otherwise(F.struct(
            F.transform(state["cells"], lambda x, j: without(x, j, taken)).alias("cells"),
            F.concat(state["found"], F.transform(taken, lambda y: F.struct(y["k"].alias("found"), y["n"].alias("n")))).alias("found"),
        )))

    def one_table(t: int) -> Callable[[Column], Column]:
        # Spark takes a second parameter, even one with a default, for the index.
        return lambda state: without_lone(state, t)

    state = F.struct(
        cells.alias("cells"), F.filter(F.array(F.struct(none.alias("found"), none.alias("n"))), lambda x: F.lit(False)).alias("found")
    )
    for _ in range(2):
        for t in range(TABLES):
            state = _let(state, one_table(t))
    return _let(state, lambda s: F.when(
        ~F.exists(s["cells"], lambda x: (x["n"] != 0) | (x["k"] != 0))
        & (F.size(F.array_distinct(s["found"]["found"])) == F.size(s["found"])), s["found"],
    ))


def differences(sets: DataFrame, keys: list[str], kinds: list[str], name: str) -> DataFrame:
    """(keys, kind, digests): digests in which a row's set ``own`` and the set named by a kind differ, with their sign.

    ``sets``: keys, the sets, and ``open``, the kinds that the fingerprints alone did not settle. Each is tried with
    a sketch of twice as many cells as both versions have digests, then with twice as many again and so on. A row's
    sets move once a round, for all its kinds.
    """
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base, todo, found, seed = sets.drop("open"), sets.where(F.size("open") > 0), None, 1
    each = [*keys, "kind"]
    signs = {kind: F.concat(
        F.transform("own", lambda d: F.struct(d.alias("d"), F.lit(1).alias("s"))),
        F.transform(kind, lambda d: F.struct(d.alias("d"), F.lit(-1).alias("s"))),
    ) for kind in kinds}
    while True:
        rows = todo.repartition(parts, *keys)
        again = rows.select(*keys, F.explode(F.filter(F.array(*[
            F.when(F.array_contains("open", kind), F.struct(F.lit(kind).alias("kind"), signed.alias("signed")))
            for kind, signed in signs.items()
        ]), lambda x: x.isNotNull())).alias("x")).select(*keys, "x.*")
        need = ((F.size("signed") + F.lit(2)) * F.lit(2 ** seed / TABLES)).cast("int") * TABLES + TABLES
        flat = again.select(*each, need.cast("int").alias("m"), F.explode("signed").alias("x"))
        flat = flat.select(*each, "m", "x.d", "x.s", check(F.col("x.d")).alias("c"))
        placed = flat.select(*each, "m", "d", "s", "c", F.explode(
            F.array(*[cell(F.col("d"), t, F.col("m"), seed) for t in range(TABLES)])
        ).alias("j"))
        cells = placed.groupBy(*each, "m", "j").agg(F.sum("s").alias("n"), F.bit_xor("d").alias("k"), F.bit_xor("c").alias("c"))
        done = store(peel(cells, each, seed, 2 + seed), name)
        settled = done.where("left = 0").select(*each, "digests")
        found = settled if found is None else found.unionByName(settled)
        failed, seed = done.where("left > 0").select(*each), seed + 1
        if failed.isEmpty():
            return found
        left = small(failed).groupBy(*keys).agg(F.collect_set("kind").alias("open"))
        todo = base.join(left, keys)


def likeness(size_a: Column, size_b: Column, differing: Column) -> Column:
    """Shared share of the digests of both, from the number in which they differ."""
    both = size_a + size_b
    return F.when(both == 0, F.lit(1.0)).otherwise((both - differing) / (both + differing))


def range_bucket(value: Column, edges: list[int]) -> Column:
    """Index of the last edge not above the value, found in two steps of about sqrt(n) comparisons."""
    step = max(1, math.isqrt(len(edges)))
    chunks = [edges[i:i + step] for i in range(0, len(edges), step)]
    as_array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    top = F.greatest(F.size(F.filter(as_array([c[0] for c in chunks]), lambda e: e <= value)) - 1, F.lit(0))
    inner = F.get(F.array(*[as_array(c) for c in chunks]), top)
    return top * step + F.greatest(F.size(F.filter(inner, lambda e: e <= value)) - 1, F.lit(0))


def with_next(docs: DataFrame) -> DataFrame:
    """(bucket, place, doc_id, text, next_text): each text with the next in order of id, after the last the first.

    Ids are cut into ranges of about 8 MB of text, one per shuffle partition at least. Each range also gets a copy of the first row of the following
    one, so the order needs one shuffle and no task sees more than a range.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n"),
                    F.count("doc_id").alias("ids")).first()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(parts, -(-((size["b"] or 0) + 64 * size["n"]) // BUCKET_BYTES))
    ids = rows.select("doc_id").where(F.col("doc_id").isNotNull()).repartitionByRange(wanted, "doc_id")
    # Each range is a file of its own.
    least = store(ids, "id-ranges").groupBy(F.input_file_name()).agg(F.min("doc_id").alias("low"))
    edges = sorted(r["low"] for r in least.collect()) or [0]
    bucket = F.coalesce(range_bucket(F.col("doc_id"), edges), F.lit(0))
    placed = rows.select(bucket.alias("g"), F.lit(False).alias("guest"), "doc_id", "text")
    has_null = size["ids"] < size["n"]
    first = F.col("doc_id").isNull() if has_null else F.col("doc_id") == edges[0]
    later = F.col("doc_id").isin(edges[1:]) if len(edges) > 1 else F.lit(False)
    guests = rows.where(first | later).select(
        F.when(first, F.lit(len(edges) - 1)).otherwise(bucket - 1).alias("g"), F.lit(True).alias("guest"), "doc_id", "text"
    )
    order = Window.partitionBy("g").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    both = placed.unionByName(guests)
    return both.withColumn("next_text", F.lead("text").over(order)).withColumn(
        "place", F.row_number().over(order)).where(~F.col("guest")).drop("guest")


def edit(text: Column, following: Column) -> Column:
    """The text with its last half replaced by the beginning of the following one."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


KINDS = ["edited", "next"]


def versions(docs: DataFrame) -> DataFrame:
    """Digest sets of each text, its edited version and the next text, sketches of the first two, and the differences
    that the sketches alone give away (``first_edited``, ``first_next``).
    """
    pairs = with_next(docs).withColumn("edited", edit(F.col("text"), F.col("next_text")))
    sets = pairs.select(
        "g", "place", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        paragraphs(F.col("text")).alias("own"), paragraphs(F.col("edited")).alias("edited"),
        paragraphs(F.col("next_text")).alias("next"),
    )
    drawn = sets.select("*", *[sketch(F.col(c)).alias(f"s_{c}") for c in ("own", *KINDS)])
    return drawn.select(
        *[c for c in drawn.columns if c != "s_next"],
        *[first_peel(F.col("s_own"), F.col(f"s_{kind}")).alias(f"first_{kind}") for kind in KINDS],
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: fingerprint, edited fingerprint, likeness to both, the digests in which they differ, and their number.

    What is joined at the end holds sizes instead of sets, and the differences themselves only if they are asked for.
    """
    kept = store(versions(docs), "versions")
    keys = ["g", "place"]
    open_kinds = F.filter(F.array(*[F.when(F.col(f"first_{kind}").isNull(), kind) for kind in KINDS]), lambda x: x.isNotNull())
    found = differences(kept.select(*keys, "own", *KINDS, open_kinds.alias("open")), keys, KINDS, "differences")
    later = found.select(*keys, "kind", F.size("digests").alias("n"), "digests")

    def of(kind: str, column: str) -> Column:
        return F.first(F.when(F.col("kind") == kind, F.col(column)), ignorenulls=True)

    wide = later.groupBy(*keys).agg(
        *[of(kind, "n").alias(f"n_later_{kind}") for kind in KINDS], *[of(kind, "digests").alias(f"later_{kind}") for kind in KINDS]
    )
    slim = kept.select(
        *keys, "doc_id", "n_chars", "edited_sha256", "s_own", "s_edited",
        *[F.size(c).alias(f"size_{c}") for c in ("own", *KINDS)],
        *[F.array_size(f"first_{kind}").alias(f"n_first_{kind}") for kind in KINDS], *[f"first_{kind}" for kind in KINDS],
    )
    either = {kind: F.coalesce(F.col(f"n_first_{kind}"), F.col(f"n_later_{kind}")) for kind in KINDS}
    return slim.join(wide, keys, "left").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("s_own")).alias("fingerprint"),
        as_text(F.col("s_edited")).alias("edited_fingerprint"),
        *[likeness(F.col("size_own"), F.col(f"size_{kind}"), n).alias(f"near_{kind}") for kind, n in either.items()],
        *[F.coalesce(f"first_{kind}", f"later_{kind}").alias(f"differs_{kind}") for kind in KINDS],
        *[n.alias(f"n_differs_{kind}") for kind, n in either.items()],
    )
