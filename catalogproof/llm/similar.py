"""Shared by the operators on similar texts: texts by content, buckets of signatures, components, the exact check.

A signature is one byte for each of ``BINS`` samples of a text's shingle set, 0 where there is none; the share of equal bytes
estimates the Jaccard similarity.  A limit on the similarity is a fraction, for exact comparison of counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogproof.llm import words
from catalogproof.operators import scaling

SHINGLE = 5
#: sets of a bucket up to which all are compared with all
SMALL = 128
#: so many times as many in buckets that were split a few times: what they share, further splits would hardly part
DEEP_TIMES = 32
#: sets, and shingles, of a block of the exact check; a text of a group of n sets is sent n / BLOCK times at most
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000
#: rings from a group's root to the greatest distance of linked sets
RINGS = 64
#: edges up to which one task contracts what is left of them
LAST = 100_000
#: large buckets up to which their pivots and cuts are broadcast, a few hundred bytes each
FEW_PIVOTS = 10_000
#: bytes of a signature
BINS = 128
#: distance steps, and steps of a gap that no similar pair spans
STEPS, GAP = 64, 20


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, key, text): a text is found again by the digest of its whole content."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.md5(whole)).alias("key"), whole.alias("text"))


def fetch(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (written; any number of rows for a key) with the text of each key; of equal texts one is sent."""
    keys = wanted.select("key")
    if not (small := scaling.counted_few(keys)):
        keys = scaling.materialize(keys.distinct(), "keys")
        small = scaling.counted_few(keys)
    few = F.broadcast(keys) if small else keys
    found = texts.select("key", "text").join(few, "key", "left_semi")
    return found.groupBy("key").agg(F.first("text").alias("text")).join(wanted, "key")


def classes(described: DataFrame, **more: Column) -> tuple[DataFrame, DataFrame]:
    """(d1, d2, n, rep, copies, more) for each distinct set, and the rows (of ``described``, written) that stand for one."""
    key = F.struct("d1", "d2", "n").alias("_set")
    found = scaling.materialize(
        described.filter("n > 0")
        .groupBy("d1", "d2", "n")
        .agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("copies"), *[c.alias(name) for name, c in more.items()]),
        "classes",
    )
    several = found.filter("copies > 1").select(key, "rep", "copies")
    rows = described.filter("n > 0").select("row", key)
    copies = scaling.attach_stats(rows, several, ["_set"], "copies", "row").filter("rep != row").select("row")
    copies = scaling.materialize(copies, "copies")
    own = described.filter("n > 0").drop("d1", "d2", "doc_id")
    few = F.broadcast(copies) if scaling.counted_few(copies) else copies
    return found, scaling.materialize(own.join(few, "row", "left_anti"), "reps")


def buckets(level: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (node, row, ...) of shared buckets with ``size`` and ``pivot`` of the bucket, and the buckets (written)."""
    stats = level.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("row").alias("pivot"))
    stats = scaling.materialize(stats.filter("size > 1"), "buckets")
    if scaling.counted_few(stats):
        return level.join(F.broadcast(stats), "node"), stats
    # most nodes have one row: it is sent as it is, without the second key of a lookup; hot buckets, one for HOT_ROWS rows at most, are not sent
    hot = F.broadcast(stats.filter(F.col("size") >= scaling.HOT_ROWS))
    others = level.join(hot.select("node"), "node", "left_anti").join(stats.filter(F.col("size") < scaling.HOT_ROWS), "node")
    return level.join(hot, "node").unionByName(others), stats


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of signatures, by row."""
    some = ((a != 0) | (b != 0)).sum(-1)
    return ((a == b) & (a != 0)).sum(-1) / np.maximum(some, 1)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows with equal keys, which arrive one after the other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        if held and any(held[0].column(k)[0].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            if low:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


def forest(n: int, pairs: np.ndarray) -> np.ndarray:
    """Root of each of n members: the least index that ``pairs`` connect it with."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs.tolist():
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)], np.int64)


def connected(linked: np.ndarray) -> np.ndarray:
    """The same from a symmetric matrix of links, each row of which is looked at once."""
    root = np.full(len(linked), -1, np.int64)
    for i in range(len(linked)):
        front = np.array([i]) if root[i] < 0 else np.zeros(0, np.int64)
        root[front] = i
        while len(front):
            front = np.flatnonzero(linked[front].any(0) & (root < 0))
            root[front] = i
    return root


def alike_all(sig: np.ndarray, likely: float) -> np.ndarray:
    """Which signatures have an estimated similarity of ``likely`` with which, byte by byte of the signatures, some hundred rows at a time."""
    columns, has = np.ascontiguousarray(sig.T), (sig != 0).astype(np.float32)
    out, count = np.empty((len(sig), len(sig)), bool), has.sum(1)
    for low in range(0, len(sig), 512):
        part = slice(low, low + 512)
        same = np.zeros((len(sig[part]), len(sig)), np.uint8)
        for c in columns:
            same += (c[part, None] == c) & (c != 0)
        some = count[part, None] + count - has[part] @ has.T
        out[part] = same / np.maximum(some, 1).astype(np.float64) >= likely
    return out


def brute_force(small: DataFrame, reps: DataFrame, limit: tuple[int, int], likely: float) -> DataFrame:
    """Edges (a, b) among the members of buckets of at most SMALL * DEEP_TIMES; equal buckets are searched once."""
    buckets = small.groupBy("node").agg(F.array_sort(F.collect_list("row")).alias("members")).select("members").distinct()
    members = buckets.select(F.xxhash64("members").alias("bucket"), F.explode("members").alias("row"))
    signed = members.join(reps.select("row", "n", "signature"), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in groups(batches, ["bucket"]):
            row, n = (group.column(c).to_numpy() for c in ("row", "n"))
            sig = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint8).reshape(len(row), BINS)
            near = np.minimum(n[:, None], n) * limit[1] >= np.maximum(n[:, None], n) * limit[0]
            if len(row) > SMALL:
                root = connected(alike_all(sig, likely) & near)
            else:
                root = forest(len(row), np.argwhere(np.triu((alike(sig[:, None], sig[None]) >= likely) & near, 1)))
            moved = root != np.arange(len(row))
            a.append(row[root[moved]])
            b.append(row[moved])
            if len(a) >= 5000:
                yield edge_batch(a, b)
                a, b = [], []
        yield edge_batch(a, b)

    ordered = signed.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(words.returning(run), "a long, b long")


def edge_batch(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    none = np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *x])) for x in (a, b)], ["a", "b"])


def by_pivot(large: DataFrame, reps: DataFrame, stats: DataFrame) -> DataFrame:
    """(node, row, pivot, near): whether a member of a large bucket goes with the bucket's pivot.

    ``stats``: (node, pivot, ...) of the large buckets, cheap to count.
    """
    signed = large.join(reps.select("row", "signature"), "row")
    pivots = reps.select(F.col("row").alias("pivot"), F.col("signature").alias("_pivot_signature"))
    few = scaling.counted_few(stats.select("node", "pivot"), FEW_PIVOTS)
    if few:
        pivots = pivots.join(F.broadcast(stats.select("pivot")), "pivot", "left_semi")
        both = signed.join(F.broadcast(pivots), "pivot")
    else:
        both = scaling.lookup(signed, pivots, ["pivot"], "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS)
                for c in ("signature", "_pivot_signature")
            )
            distance = np.rint((1 - alike(a, b)) * STEPS).astype(np.int64)
            kept = [batch.column(c) for c in ("node", "row", "pivot")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(distance)], ["node", "row", "pivot", "distance"])

    measured = scaling.materialize(both.mapInArrow(words.returning(run), "node long, row long, pivot long, distance long"), "distances")
    # at most STEPS + 1 rows a bucket
    steps = measured.groupBy("node", "distance").count()
    found = steps.groupBy("node").agg(F.array_sort(F.collect_list("distance")).alias("d"))
    first_gap = F.filter(
        F.sequence(F.lit(1), F.size("d")),
        lambda i: (i == F.size("d")) | (F.get("d", i) - F.get("d", i - 1) > GAP),
    )
    cuts = found.select("node", F.get("d", F.get(first_gap, F.lit(0)) - 1).alias("cut"))
    placed = measured.join(F.broadcast(cuts), "node") if few else scaling.lookup(measured, cuts, ["node"], "row")
    return placed.select("node", "row", "pivot", (F.col("distance") <= F.col("cut")).alias("near"))


def components(edges: DataFrame) -> DataFrame:
    """(row, root) for every end of an edge (a, b): the same root throughout a connected component.

    Each round hooks a vertex to the neighbour of the least random rank and contracts; as ranks are
    random, long chains shrink as fast as stars.  The hooks of all rounds are followed at the end, so a round
    writes its hooks and what is left of the edges only.  The last ``LAST`` edges, which would take most of the
    rounds, are contracted in one task; ``edges``, which should be cheap to count, at once if there are no more.
    """
    edges = edges.filter("a != b")
    if edges.count() <= LAST:
        return _at_once(edges).select(F.col("v").alias("row"), F.col("to").alias("root"))
    edges = scaling.materialize(edges.distinct(), "edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("row")).distinct().withColumn("root", F.col("row"))

    def followed(hooks: DataFrame) -> DataFrame:
        to = hooks.select(F.col("v").alias("root"), "to")
        return labels.join(to, "root", "left").select("row", F.coalesce("to", "root").alias("root"))

    turn = 0
    while (left := edges.count()) > LAST:
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("rank"), F.col(c).alias("id"))  # noqa: B023, E731
        least = F.least(rank("a"), rank("b")).alias("to")
        ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), least), F.struct(F.col("b").alias("v"), least))).alias("e"))
        hooks = scaling.materialize(ends.groupBy(F.col("e.v").alias("v")).agg(F.min("e.to")["id"].alias("to")), "hooks")
        labels = followed(hooks)
        contracted = edges.join(hooks.select(F.col("v").alias("a"), F.col("to").alias("_a")), "a").join(
            hooks.select(F.col("v").alias("b"), F.col("to").alias("_b")), "b"
        )
        edges = scaling.materialize(
            contracted.filter("_a != _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges"
        )
        turn += 1
    if left:
        labels = followed(_at_once(edges))
    return scaling.materialize(labels, "labels")


def _at_once(edges: DataFrame) -> DataFrame:
    """(v, to) for every end of an edge, from one task."""
    return scaling.materialize(edges.coalesce(1).mapInArrow(words.returning(_contracted), "v long, to long"), "hooks")


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, to): the least vertex that the edges (a, b) connect each with."""
    ends = [np.stack([batch.column(c).to_numpy() for c in ("a", "b")], 1) for batch in batches]
    ids, pairs = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *ends]), return_inverse=True)
    root = forest(len(ids), pairs.reshape(-1, 2))
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root])], ["v", "to"])


# --- the exact check ---------------------------------------------------------------------


def shared(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many shingles any two of the sets have in common."""
    docs = np.repeat(np.arange(len(sizes)), sizes)
    _, place, times = np.unique(shingles, return_inverse=True, return_counts=True)
    often = times[place] > 1
    docs, place = docs[often], np.unique(place[often], return_inverse=True)[1]
    order = np.argsort(place, kind="stable")
    docs, place = docs[order], place[order]
    out = np.zeros((len(sizes), len(sizes)), np.float64)
    width, top = 2048, int(place[-1]) + 1 if len(place) else 0
    for low in range(0, top, width):
        a, b = np.searchsorted(place, [low, low + width])
        matrix = np.zeros((len(sizes), min(width, top - low)), np.float32)
        matrix[docs[a:b], place[a:b] - low] = 1
        out += matrix @ matrix.T
    return out


def _sets(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    column = group.column("text").combine_chunks()
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return words.shingled(*words.hashed(column), SHINGLE)


def _parts(size: str, shingles: str) -> Column:
    """Over how many blocks so many sets with so many shingles are dealt."""
    return F.greatest(F.ceil(F.col(size) / BLOCK), F.ceil(F.col(shingles) / BLOCK_SHINGLES)).cast("int")


def against_root(texts: DataFrame, members: DataFrame) -> DataFrame:
    """(row, root, common, either): shingles that a member shares with its group's root, and that either has.

    ``members``: (row, key, root, parts), parts being those of the group, written; a root is a row of its group.
    """
    # a member goes to one part of its group, the root to all
    part = F.when(F.col("row") == F.col("root"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    )
    dealt = scaling.materialize(members.select("row", "key", "root", F.explode(part).alias("part")), "parts")
    sent = fetch(texts, dealt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["root", "part"]):
            row, root = (group.column(c).to_numpy() for c in ("row", "root"))
            shingles, sizes = _sets(group)
            at = int(np.flatnonzero(row == root)[0])
            ends = np.cumsum(sizes)
            own = shingles[ends[at] - sizes[at] : ends[at]]
            docs = np.repeat(np.arange(len(sizes)), sizes)
            common = np.bincount(docs[np.isin(shingles, own)], minlength=len(sizes))
            columns = [row, root, common, sizes + sizes[at] - common]
            yield pa.RecordBatch.from_arrays([pa.array(np.delete(c, at).astype(np.int64)) for c in columns], ["row", "root", "common", "either"])

    ordered = sent.repartition("root", "part").sortWithinPartitions("root", "part")
    return ordered.mapInArrow(words.returning(run), "row long, root long, common long, either long")


def undecided(a, b, counts: bool):
    """Whether the rings of two sets (columns or arrays) leave open what has to be known of them."""
    found = (a + b > RINGS - 2) & (a - b <= RINGS + 1) & (b - a <= RINGS + 1)
    return found if counts else found & ((a >= RINGS) | (b >= RINGS))


def _rings(texts: DataFrame, limit: tuple[int, int], members: DataFrame, counts: bool) -> tuple[DataFrame, DataFrame]:
    """What the distances from the root decide in large groups: cells that stay open, and (a, b, links) that are sure.

    Distances are cut into rings, ``RINGS`` to the greatest distance of linked sets.  By the triangle inequality two sets are linked
    if their rings add up to less than ``RINGS``, and not linked if these are further apart.  A group of copies that
    are all within half that distance of the root needs no comparison of pairs; otherwise a ring meets the rings it is undecided with;
    without ``counts``, only if one of them is not linked to the root already.  Blocks are cut from the members in the order
    of their rings, so a member is sent as often as its group has blocks, not rings.
    """
    common = against_root(texts, members)
    root = members.filter("row = root").select("row", "root", F.col("n").alias("common"), F.col("n").alias("either"))
    ring = F.expr(f"(either - common) * {limit[1] * RINGS} div (either * {limit[1] - limit[0]})").cast("int")
    measured = scaling.materialize(
        common.unionByName(root).withColumn("ring", ring).join(members.select("row", "key", "n", "copies"), "row"), "rings"
    )
    # a few hundred rows for each large group
    stats = measured.groupBy("root", "ring").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"), F.sum("copies").alias("all_copies")
    )
    order = W.partitionBy("root").orderBy("ring")
    before = F.sum("width").over(order.rowsBetween(W.unboundedPreceding, -1))
    stats = stats.withColumn("width", F.greatest(F.col("size") / BLOCK, F.col("shingles") / BLOCK_SHINGLES))
    stats = scaling.materialize(stats.withColumn("begin", F.coalesce(before, F.lit(0.0))).drop("shingles"), "ring_stats")
    other = stats.select("root", *[F.col(c).alias(f"_{c}") for c in ("ring", "begin", "width", "all_copies")])
    unsure = undecided(F.col("ring"), F.col("_ring"), counts)
    few = scaling.counted_few(stats)
    decided = stats.join(F.broadcast(other) if few else other, "root").groupBy("root", "ring", "size", "begin", "width").agg(
        F.coalesce(F.sum(F.when(F.col("ring") + F.col("_ring") <= RINGS - 2, F.col("_all_copies"))), F.lit(0)).alias("sure"),
        F.min(F.when(unsure, F.floor("_begin").cast("int"))).alias("from"),
        F.max(F.when(unsure, F.floor(F.col("_begin") + F.col("_width")).cast("int"))).alias("to"),
    )
    keyed = F.struct("root", "ring")
    if few:
        placed = measured.join(F.broadcast(decided), ["root", "ring"], "left")
    else:
        placed = scaling.attach_stats(
            measured.withColumn("_at", keyed), decided.withColumn("_at", keyed).drop("root", "ring"), ["_at"], "size", "row"
        )
    # a place within the ring's share of the blocks
    place = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / (1 << 20)
    block = F.floor(F.col("begin") + F.col("width") * place).cast("int")
    placed = scaling.materialize(
        placed.select("row", "key", "root", "copies", "common", "either", "ring", "sure", "from", "to", block.alias("block")), "placed"
    )
    cells = placed.filter("from IS NOT NULL").withColumn("other", F.explode(F.sequence("from", "to")))
    itself = F.when(2 * F.col("ring") <= RINGS - 2, F.col("copies")).otherwise(F.lit(0))
    none = F.lit(None).cast("bigint")
    counted = placed.select(F.col("row").alias("a"), none.alias("b"), (F.col("sure") - itself).cast("bigint").alias("links"))
    linked = placed.filter((F.col("common") * limit[1] >= F.col("either") * limit[0]) & (F.col("row") != F.col("root")))
    edges = linked.select(F.col("row").alias("a"), F.col("root").alias("b"), none.alias("links"))
    return cells.select(*CELL), counted.unionByName(edges)


#: a set in a pair of blocks
CELL = ["row", "key", "root", "copies", "ring", "block", "other"]


def verify(texts: DataFrame, limit: tuple[int, int], grouped: DataFrame, counts: bool = True) -> DataFrame:
    """(a, b, links): links of ``a`` counted in one place (b null), or that a and b are connected (links null).

    ``grouped``: (row, key, root, n, copies), candidates that share a root, which is one of them.  A group of one block is compared in one
    task; a larger one is cut into rings around its root first.  Without ``counts`` only the connections are complete.
    """
    totals = grouped.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    counted = scaling.attach_stats(grouped, totals, ["root"], "size", "row").withColumn("parts", _parts("size", "shingles"))
    counted = scaling.materialize(counted.select("row", "key", "root", "n", "copies", "parts"), "counted")
    zero = F.lit(0)
    # a ring that is undecided with itself
    cells = counted.filter("parts = 1").select("row", "key", "root", "copies", F.lit(RINGS).alias("ring"), zero.alias("block"), zero.alias("other"))
    sure = None
    if not counted.filter("parts > 1").isEmpty():
        large = scaling.materialize(counted.filter("parts > 1"), "large")
        rings, sure = _rings(texts, limit, large, counts)
        cells = cells.unionByName(rings)
    cells = scaling.materialize(
        cells.select("row", "key", "root", "copies", "ring", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")),
        "cells",
    )
    sent = fetch(texts, cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["root", "low", "high"]):
            row, copies, ring, block, low, high = (group.column(c).to_numpy() for c in ("row", "copies", "ring", "block", "low", "high"))
            shingles, sizes = _sets(group)
            common = shared(shingles, sizes)
            union = sizes[:, None] + sizes - common
            linked = (common * limit[1] >= union * limit[0]) & undecided(ring[:, None], ring, counts)
            np.fill_diagonal(linked, False)
            if low[0] != high[0]:
                linked &= block[:, None] != block
            links = (linked * copies).sum(1)
            root = connected(linked)
            moved = root != np.arange(len(row))
            a = np.concatenate([row, row[moved]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(a),
                    pa.array([*[None] * len(row), *row[root[moved]].tolist()], pa.int64()),
                    pa.array([*links.astype(np.int64).tolist(), *[None] * int(moved.sum())], pa.int64()),
                ],
                ["a", "b", "links"],
            )

    ordered = sent.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
    checked = ordered.mapInArrow(words.returning(run), "a long, b long, links long")
    return checked if sure is None else checked.unionByName(sure)
