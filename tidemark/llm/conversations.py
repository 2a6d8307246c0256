"""The prefix trie of rebuilt conversations, from whole sequences that are collapsed first.

A conversation is rebuilt from the first turns of the head of its hundred and its own later turns. Identical rebuilt
conversations become one weighted sequence with a list of the conversations that end there. Sequences that are proper
prefixes of others are found by an anti-join; the rest are the leaves. Only the distinct sequences are then spread
over their prefixes, whose weights add up to the nodes of the trie.

A prefix is known by its depth and two 64-bit prefix numbers over 128-bit digests of (role, text), which a scan carries
over ranges of rows (``scans``), so that no conversation, however long, is gathered in one place. A node's conversation
is its smallest member. As the members of a node are among those of its parent, a sequence is the smallest member of
its deepest nodes down from some depth; it carries their savings up its path, and sums over sequences give the
subtrees.

Defined results: a null role or text is empty; turns follow by number, null first, and equal numbers by the digest of
role and text; repeated rows are turns of their own; rows without conv_id form no conversation; columns other than the
four are left out; an empty table gives no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_weighted, store
from tidemark.llm.scans import running

#: Conversations share the head of their hundred, up to so many of its turns less one.
GROUP = 100
HEADS = 6
#: End lists are cut into slices of the ids' range, so no list is longer.
SLICE_IDS = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Trie(NamedTuple):
    """``nodes``: one row per node; ``ends``: the ids that end at a node in slices, ``slice`` and ``ids`` ascending."""

    nodes: DataFrame
    ends: DataFrame


def _long(hexed: Column, start: int) -> Column:
    return F.conv(F.substring(hexed, start, 16), 16, -10).cast("long")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, n_chars): the turns from 1, with their digest in two halves."""
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")]
    digest = F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.substring(digest, 1, 32).alias("digest"), F.length(text).cast("long").alias("n_chars"),
    )
    turns = turns.withColumns({"a": _long(F.col("digest"), 1), "b": _long(F.col("digest"), 17)})
    # The last key only spreads equal rows, whose order is the same either way.
    spread = F.monotonically_increasing_id()
    numbered = running(
        turns.withColumn("spread", spread), "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("spread")]
    )
    return numbered.select("conv_id", F.col("n").alias("pos"), "a", "b", "n_chars")


def head_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the head of its hundred."""
    return F.crc32(conv_id.cast("string")) % HEADS


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, n_chars, a_prefix, b_prefix, a_before, b_before), with a row of depth 0 for each one."""
    convs = turns.select("conv_id").distinct()
    heads = turns.where(F.col("pos") < HEADS).withColumnRenamed("conv_id", "head")
    wanted = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("head"))
    # A head has fewer than HEADS rows here, and at most 2 * GROUP conversations ask for it.
    taken = wanted.join(heads, "head").where(F.col("pos") <= head_turns(F.col("conv_id")))
    zero = F.lit(0).cast("long")
    rows = convs.select("conv_id", F.lit(0).alias("kind"), *[zero.alias(c) for c in ("pos", "a", "b", "n_chars")])
    rows = rows.unionByName(taken.select("conv_id", F.lit(1).alias("kind"), "pos", "a", "b", "n_chars"))
    own = turns.where(F.col("pos") > head_turns(F.col("conv_id")))
    rows = rows.unionByName(own.select("conv_id", F.lit(2).alias("kind"), "pos", "a", "b", "n_chars"))
    paths = running(rows, "conv_id", [F.col("kind"), F.col("pos")], marks=["a", "b"])
    return paths.withColumn("depth", F.col("n") - 1).drop("kind", "pos", "n")


def _node(depth: Column | str = "depth", a: str = "a_prefix", b: str = "b_prefix") -> Column:
    depth = F.col(depth) if isinstance(depth, str) else depth
    return F.struct(depth.alias("depth"), F.col(a).alias("a"), F.col(b).alias("b")).alias("node")


def prefix_trie(paths: DataFrame) -> Trie:
    """The trie of stored ``paths``, as :func:`rebuilt` gives them.

    Nodes have node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves and saved_tokens.
    """
    # Whole sequences, each with its weight and the ids that end there.
    whole = store(paths.groupBy("conv_id").agg(F.max_by(_node(), "depth").alias("node")), "sequences")
    ends = whole.groupBy("node", F.floor(F.col("conv_id") / SLICE_IDS).alias("slice")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids")  # SLICE_IDS at most, as ids are distinct
    )
    sequences = whole.groupBy("node").agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"))
    sequences = sequences.withColumnRenamed("node", "whole")
    spread = store(paths.join(sequences, "conv_id").withColumn("node", _node()), "prefixes")
    # Leaves: sequences that are no proper prefix of another one.
    inner = spread.where(F.col("depth") < F.col("whole.depth")).select("node").distinct()
    leaves = spread.where("node = whole").join(inner, "node", "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    weighted = spread.join(leaves, "conv_id", "left")
    nodes = weighted.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.count("leaf").alias("n_leaves"),
        F.max("n_chars").alias("n_chars"),
        F.max(_node(F.col("depth") - 1, "a_before", "b_before")).alias("parent"),
    )
    nodes = store(nodes.withColumn("depth", F.col("node.depth")), "nodes")
    saved = _saved(spread, nodes)
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = store(
        nodes.join(children, "node", "left").join(saved, "node", "left").fillna(0, ["n_children", "saved_tokens"]), "counted"
    )
    # A node has any number of children, so those of the largest families get their parent by broadcast.
    parents = counted.where("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("family")
    )
    done = join_weighted(counted, parents, "parent", "family", counted.count(), "left")
    return Trie(done.drop("parent", "family", "n_chars"), ends)


def _saved(spread: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, saved_tokens): characters of shared turns in the subtree, times one less than their conversations."""
    own = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_chars")).alias("own")).where("own > 0")
    # Paths of the sequences that any such node is named after; all others carry nothing.
    owners = own.select("conv_id").distinct()
    rows = spread.select("conv_id", "depth", "node").join(owners, "conv_id", "left_semi")
    rows = rows.join(own, ["conv_id", "depth"], "left").fillna(0, ["own"])
    carried = running(rows, "conv_id", [F.col("depth").desc()], sums=["own"])
    return carried.groupBy("node").agg(F.sum("own_run").alias("saved_tokens"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): the digest of a node's ids, ascending and joined by commas.

    A digest reads its input from front to back, so one task reads all of a node's slices, but holds one at a time.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                text = ",".join(map(str, ids)).encode()
                if node == now:
                    state.update(b"," + text)
                else:
                    if state is not None:
                        out.append((now, state.hexdigest()))
                    now, state = node, hashlib.sha256(text)
            yield _digested(out, batch.schema.field("node").type)
        if state is not None:
            yield _digested([(now, state.hexdigest())], batch.schema.field("node").type)

    placed = ends.repartition("node").sortWithinPartitions("node", "slice").select("node", "ids")
    return placed.mapInArrow(digest, f"node {dict(ends.dtypes)['node']}, ends_sha256 string")


def _digested(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([n for n, _ in rows], kind), pa.array([d for _, d in rows], pa.string())], names=["node", "ends_sha256"]
    )


def conversation_trie(conversations: DataFrame) -> Trie:
    """The trie of all rebuilt conversations."""
    turns = store(numbered_turns(conversations), "turns")
    return prefix_trie(store(rebuilt(turns), "paths"))
