"""Prefixes that conversations share: a z-fast trie over their turns, built in batches.

A conversation is a sequence of turns (role and text); the trie's symbols are turns.  ``describe`` gives each conversation
the key of each of its prefixes, a 128-bit sum of hashes of (turn, place).  The trie is compacted: a
node stands for an edge ``top < depth`` whose inner prefixes have one child and no conversation that ends there, and holds the keys
of the edge.  It is found by its handle, the key of the prefix whose length is the two-fattest number in (top, depth]:
the one that the highest power of two divides.

``insert`` takes a batch: each conversation searches its exit node by fat binary search, one join on handles for
each halving of the lengths still possible.  Where it leaves the exit node's edge, the edge is split.
Of the conversations of the batch that leave at one place with the same turn, one (by hash) gets a
leaf, and the others search on from there in the next round.  As that one is random among them, the rounds grow with the logarithm of
the batch, as the depth of a random search tree does, and are no more than the longest conversation has turns.

Equal conversations are one sequence with a count; all sums over subtrees are made on the compacted nodes by pointer doubling,
in as many steps as the height has bits, and the edges are expanded last.  Many conversations that meet in one node are joined
by `scaling.lookup`, and a node's conversation list is hashed as a stream, in blocks that range partitions prepare.

Result: one row per node and depth, as `trie` says.  Null roles and texts are empty; a null turn number comes first; equal
turn numbers stand in the order of their hashes, so repeated rows are repeated turns.  A null conv_id is a conversation like others;
it is counted, but it is no smallest member where there is another, and not in ``ends``.  A conversation without turns ends at the root.
Empty tables give empty results.  Extra columns are dropped.  A conversation is one row of forty bytes a turn, texts not included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogproof.llm import words
from catalogproof.operators import scaling

#: shares of the sequences that are in the trie after each batch
BATCHES = (1 / 16, 1.0)
#: ids joined to one piece of text before a list is hashed
IDS = 4096
#: key of the prefix without turns
ROOT = b""


def listed(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (a, b, bytes): two hashes, and the bytes of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(
        "turn",
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    rows = conversations.select("conv_id", turn.alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["bytes"].alias("bytes"))).alias("turns")
    )


def describe(conversations: DataFrame) -> DataFrame:
    """(conv_id, keys, upto): the key of each prefix, and the bytes of the texts of the first 0, 1, 2, ... turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.column("turns")
            sizes = pc.list_value_length(turns).to_numpy(zero_copy_only=False).astype(np.int64)
            a, b, size = (turns.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(3))
            ends = np.cumsum(sizes)
            begin = np.repeat(ends - sizes, sizes)
            place = (np.arange(len(a)) - begin + 1).astype(np.uint64)

            def along(values: np.ndarray) -> np.ndarray:
                """Running sums inside each conversation."""
                total = np.cumsum(values)
                return total - np.where(begin > 0, total[begin - 1], values.dtype.type(0))

            lanes = [
                words.mix(along(words.mix(words.mix(place * np.uint64(odd)) ^ x.view(np.uint64))))
                for x, odd in ((a, 0x9E3779B97F4A7C15), (b, 0xC2B2AE3D27D4EB4F))
            ]
            data = np.stack(lanes, 1).tobytes() if len(a) else b""
            at = pa.py_buffer(np.arange(0, 16 * len(a) + 1, 16, dtype=np.int32).tobytes())
            keys = pa.Array.from_buffers(pa.binary(), len(a), [None, at, pa.py_buffer(data)])
            offsets = np.append(0, ends)
            upto = np.zeros(len(a) + len(sizes), np.int64)
            upto[np.arange(len(a)) + np.repeat(np.arange(len(sizes)), sizes) + 1] = along(size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), keys),
                    pa.ListArray.from_arrays(pa.array((offsets + np.arange(len(offsets))).astype(np.int32)), pa.array(upto)),
                ],
                ["conv_id", "keys", "upto"],
            )

    kind = dict(conversations.dtypes)["conv_id"]
    return conversations.select("conv_id", "turns").mapInArrow(run, f"conv_id {kind}, keys array<binary>, upto array<bigint>")


def _end(keys: Column) -> Column:
    """The key of the whole sequence; that of the root is empty."""
    return F.coalesce(F.get(keys, F.size(keys) - 1), F.lit(ROOT))


def sequences(described: DataFrame) -> DataFrame:
    """(id, keys, upto, copies, conv): each distinct sequence, how often it occurs, and its smallest conv_id."""
    return described.groupBy(_end(F.col("keys")).alias("id")).agg(
        F.first("keys").alias("keys"), F.first("upto").alias("upto"), F.count(F.lit(1)).alias("copies"), F.min("conv_id").alias("conv")
    )


# --- the trie -----------------------------------------------------------------------------


def _fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    return F.expr(f"{high} & shiftleft(-1, length(bin({low} ^ {high})) - 1)")


def _nodes(frame: DataFrame) -> DataFrame:
    """Complete (top, depth, parent, edge, upto) by what a node is found by."""
    edge = F.col("edge")
    return frame.select(
        _end(edge).alias("id"),
        "parent",
        "top",
        "depth",
        "edge",
        "upto",
        F.get(edge, F.lit(0)).alias("first"),
        F.when(F.col("depth") > F.col("top"), F.get(edge, _fattest("top", "depth") - F.col("top") - 1)).alias("handle"),
    )


def empty_trie(some: DataFrame) -> DataFrame:
    """The root alone."""
    zero = F.lit(0)
    root = some.sparkSession.range(1).select(
        F.lit(None).cast("binary").alias("parent"),
        zero.alias("top"),
        zero.alias("depth"),
        F.expr("cast(array() AS array<binary>)").alias("edge"),
        F.expr("array(0L)").alias("upto"),
    )
    return scaling.materialize(_nodes(root), "trie")


def locate(nodes: DataFrame, pending: DataFrame, steps: int, hot: DataFrame) -> DataFrame:
    """(id, keys, upto, size, lcp, edge_id, edge_depth): where sequences leave the trie.

    ``pending``: (id, keys, upto, low), low being the depth of a node that is known to be on the sequence's path.
    ``hot``: the prefixes of many sequences, as `scaling.hot_keys` gives them.  ``lcp`` turns are in the trie; edge_id is the node on whose edge the sequence leaves it, null if it leaves at a node.
    """
    handles = nodes.filter("handle IS NOT NULL").select(
        F.col("handle").alias("probe"), F.col("id").alias("met"), F.col("top").alias("met_top"), F.col("depth").alias("met_depth")
    )
    size = F.size("keys")
    state = pending.select("id", "keys", "upto", "low", size.alias("high"), F.lit(None).cast("int").alias("leaves_at"))
    for _ in range(steps):
        searching = F.col("leaves_at").isNull() & (F.col("low") < F.col("high"))
        middle = state.withColumn("middle", F.when(searching, _fattest("low", "high")))
        probing = middle.withColumn("probe", F.get("keys", F.col("middle") - 1))
        met = scaling.lookup(probing, handles, ["probe"], "id", hot=hot)
        found = F.col("met").isNotNull()
        whole = found & (F.col("met_depth") <= size) & F.coalesce(F.get("keys", F.col("met_depth") - 1) == F.col("met"), F.lit(False))
        state = met.select(
            "id",
            "keys",
            "upto",
            F.when(whole, F.col("met_depth")).otherwise(F.col("low")).alias("low"),
            F.when(F.col("middle").isNotNull() & ~found, F.col("middle") - 1).otherwise(F.col("high")).alias("high"),
            F.when(found & ~whole, F.col("met_top")).otherwise(F.col("leaves_at")).alias("leaves_at"),
        )
    edges = nodes.filter("first IS NOT NULL").select(
        F.col("first").alias("next"), F.col("id").alias("edge_id"), F.col("top").alias("edge_top"), F.col("depth").alias("edge_depth"), "edge"
    )
    met = scaling.lookup(state.withColumn("next", F.get("keys", F.coalesce("leaves_at", "low"))), edges, ["next"], "id", hot=hot)
    own = F.slice("keys", F.col("edge_top") + 1, F.col("edge_depth") - F.col("edge_top"))
    same = F.size(F.filter(F.zip_with("edge", own, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda x: x))
    return met.select(
        "id",
        "keys",
        "upto",
        size.alias("size"),
        F.when(F.col("edge_id").isNull(), F.col("low")).otherwise(F.col("edge_top") + same).alias("lcp"),
        "edge_id",
        "edge_depth",
    )


def _cut(nodes: DataFrame, splits: DataFrame) -> DataFrame:
    """The nodes, those of ``splits`` (edge_id, cuts) as one for each part."""
    joined = nodes.join(splits, nodes["id"] == splits["edge_id"], "left")
    cuts = F.when(F.col("cuts").isNull(), F.array("depth")).otherwise(F.array_append(F.sort_array("cuts"), F.col("depth")))
    parts = joined.withColumn("cuts", cuts).select("*", F.posexplode("cuts").alias("nth", "until"))
    since = F.when(F.col("nth") > 0, F.get("cuts", F.col("nth") - 1)).otherwise(F.col("top"))
    parts = parts.withColumn("since", since)
    place = F.col("since") - F.col("top")
    return parts.select(
        F.when(F.col("nth") > 0, F.get("edge", place - 1)).otherwise(F.col("parent")).alias("parent"),
        F.col("since").alias("top"),
        F.col("until").alias("depth"),
        F.slice("edge", place + 1, F.col("until") - F.col("since")).alias("edge"),
        F.slice("upto", place + 1, F.col("until") - F.col("since") + 1).alias("upto"),
    )


def insert(nodes: DataFrame, batch: DataFrame) -> DataFrame:
    """The trie with the sequences (id, keys, upto) of ``batch``, which may be in it already."""
    pending = scaling.materialize(batch.filter(F.size("keys") > 0).select("id", "keys", "upto", F.lit(0).alias("low")), "pending")
    longest = pending.agg(F.max(F.size("keys"))).first()[0] or 0
    hot = scaling.hot_keys(pending.select(F.explode("keys").alias("key")), ["key"])
    while longest:
        placed = scaling.materialize(locate(nodes, pending, longest.bit_length(), hot), "placed")
        on_edge = placed.filter(F.col("lcp") < F.col("edge_depth"))
        splits = on_edge.groupBy("edge_id").agg(F.collect_set("lcp").alias("cuts"))
        leaving = placed.filter(F.col("lcp") < F.col("size"))
        # at the end of its edge a sequence is not outside: it searches on from that node
        outside = leaving.filter(F.col("edge_depth").isNull() | (F.col("lcp") < F.col("edge_depth")))
        chance = W.partitionBy(F.get("keys", F.col("lcp"))).orderBy(F.xxhash64("id"), "id")
        first = scaling.materialize(outside.withColumn("nth", F.row_number().over(chance)).filter("nth = 1"), "leaves")
        leaves = first.select(
            F.when(F.col("lcp") > 0, F.get("keys", F.col("lcp") - 1)).otherwise(F.lit(ROOT)).alias("parent"),
            F.col("lcp").alias("top"),
            F.col("size").alias("depth"),
            F.slice("keys", F.col("lcp") + 1, F.col("size") - F.col("lcp")).alias("edge"),
            F.slice("upto", F.col("lcp") + 1, F.col("size") - F.col("lcp") + 1).alias("upto"),
        )
        nodes = scaling.materialize(_nodes(_cut(nodes, splits).unionByName(leaves)), "trie")
        rest = leaving.join(first.select("id"), "id", "left_anti")
        pending = scaling.materialize(rest.select("id", "keys", "upto", F.col("lcp").alias("low")), "pending")
        if pending.isEmpty():
            break
    return nodes


def build(found: DataFrame, shares: tuple[float, ...] = BATCHES) -> DataFrame:
    """The trie of all sequences, batch by batch."""
    nodes, low = empty_trie(found), 0
    place = F.pmod(F.xxhash64(F.lit("batch"), "id"), F.lit(1 << 20))
    for share in shares:
        high = round(share * (1 << 20))
        nodes = insert(nodes, found.filter((place >= low) & (place < high)))
        low = high
    return nodes


# --- what the nodes hold ------------------------------------------------------------------


def totals(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """(id, n_convs, conv, bytes, leaves, edge_bytes, n_children): sums over the subtree of each node, itself included.

    ``bytes`` are those of all members' texts, ``edge_bytes`` those of all edges, each once.
    """
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    own = found.select("id", "copies", "conv", (F.col("copies") * F.element_at("upto", -1)).alias("bytes"))
    joined = nodes.join(own, "id", "left").join(children, "id", "left")
    n_children = F.coalesce("n_children", F.lit(0)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    table = scaling.materialize(
        joined.select(
            "id",
            F.col("parent").alias("above"),
            F.coalesce("copies", zero).alias("n_convs"),
            "conv",
            F.coalesce("bytes", zero).alias("bytes"),
            (n_children == 0).cast("bigint").alias("leaves"),
            (F.element_at("upto", -1) - F.element_at("upto", 1)).alias("edge_bytes"),
            n_children.alias("n_children"),
        ),
        "totals",
    )
    sums = ["n_convs", "bytes", "leaves", "edge_bytes"]
    # ``above`` is the node 1, 2, 4, ... steps up, and the sums reach as far down
    while not table.filter("above IS NOT NULL").isEmpty():
        below = table.filter("above IS NOT NULL").groupBy(F.col("above").alias("id")).agg(
            *[F.sum(c).alias(f"_{c}") for c in sums], F.min("conv").alias("_conv")
        )
        higher = scaling.lookup(table, table.select(F.col("id").alias("above"), F.col("above").alias("next")), ["above"], "id")
        table = scaling.materialize(
            higher.join(below, "id", "left").select(
                "id",
                F.col("next").alias("above"),
                *[(F.col(c) + F.coalesce(f"_{c}", zero)).alias(c) for c in sums],
                F.least("conv", "_conv").alias("conv"),
                "n_children",
            ),
            "totals",
        )
    return table.drop("above")


def ends(described: DataFrame) -> DataFrame:
    """(id, ends_sha256): the digest of the conv_ids of each sequence, ascending, joined by commas.

    Range partitions join up to ``IDS`` neighbours of one sequence to a text; the texts of a sequence, in order,
    are hashed as they stream by.
    """
    pairs = described.filter("conv_id IS NOT NULL").select(_end(F.col("keys")).alias("id"), "conv_id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ids = batch.column("id").to_pylist(), batch.column("conv_id").to_pylist()
            rows, low = [], 0
            for k in range(1, len(ids) + 1):
                if k == len(ids) or names[k] != names[low] or k - low == IDS:
                    rows.append((names[low], ids[low], ",".join(map(str, ids[low:k]))))
                    low = k
            columns = zip(*rows) if rows else ((), (), ())
            types = (pa.binary(), batch.schema.field("conv_id").type, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["id", "conv_id", "text"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            out = []
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                if key == name:
                    state.update(b",")
                else:
                    if state is not None:
                        out.append((name, state.hexdigest()))
                    name, state = key, hashlib.sha256()
                state.update(text.as_buffer())
            yield _digests(out)
        if state is not None:
            yield _digests([(name, state.hexdigest())])

    kind = dict(described.dtypes)["conv_id"]
    pieces = pairs.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id").mapInArrow(join, f"id binary, conv_id {kind}, text string")
    streamed = pieces.repartition("id").sortWithinPartitions("id", "conv_id").select("id", "text")
    return streamed.mapInArrow(digest, "id binary, ends_sha256 string")


def _digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["id", "ends_sha256"])


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the expanded trie, from (conv_id, turns) as `listed` gives them.

    conv_id: smallest member; depth; parent_conv_id: that of the parent; n_convs: members; n_children; n_leaves: childless nodes below or at it;
    saved_tokens: what sharing saves in the subtree, each node's (n_convs - 1) times the bytes of its text; ends_sha256: of
    the conversations that end here; key: the prefix's.
    """
    described = scaling.materialize(describe(conversations), "described")
    found = scaling.materialize(sequences(described), "sequences")
    nodes = build(found)
    summed = totals(nodes, found)
    parents = summed.select(F.col("id").alias("parent"), F.col("conv").alias("parent_conv"))
    whole = nodes.join(summed, "id").join(ends(described), "id", "left")
    whole = scaling.lookup(scaling.materialize(whole, "whole"), parents, ["parent"], "id").filter("n_convs > 0")
    expanded = whole.withColumn("d", F.explode(F.when(F.col("depth") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.col("top") + 1, F.col("depth")))))
    last = F.col("d") == F.col("depth")
    start = F.element_at("upto", 1)
    before = F.when(F.col("d") > 0, F.get("upto", F.col("d") - 1 - F.col("top"))).otherwise(F.lit(0))
    return expanded.select(
        F.col("conv").alias("conv_id"),
        F.col("d").cast("bigint").alias("depth"),
        F.when(F.col("d") > F.col("top") + 1, F.col("conv")).when(F.col("d") > 0, F.col("parent_conv")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(F.lit(1).cast("bigint")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("bytes") - F.col("n_convs") * before - (F.col("edge_bytes") - (before - start))).alias("saved_tokens"),
        F.when(last & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        F.when(F.col("d") > 0, F.get("edge", F.col("d") - F.col("top") - 1)).otherwise(F.lit(ROOT)).alias("key"),
    )
