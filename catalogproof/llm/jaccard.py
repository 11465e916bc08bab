"""All pairs of texts whose five-word shingles have a Jaccard similarity of 0.8 or more: chosen-path join.

Texts of equal shingle sets are one class and stand in for each other by one member.  Each run
splits the sets on sampled shared shingles: a set goes into the bucket of each of its n shingles whose hash,
salted by the bucket it comes from, is below 1 / (0.8 n).  Two sets of similarity 0.8 or more share one
such shingle on average, others fewer, level by level.  From level ``DEPTH`` on a bucket of at most ``SMALL * DEEP_TIMES`` sets is searched
by brute force on signatures, before that one of at most ``SMALL``: a long passage that many short texts share keeps
them together level after level, in most runs.  In a larger one all sets are compared with one pivot: by the
triangle inequality, no similar pair lies across a gap in the distances from the pivot that is wider than 0.2 (0.3, as
signatures are estimates), so those before the first gap go together and the rest is split
again.  ``runs`` makes runs enough that a pair of similarity 0.8 at the depth reached is met with probability
``RECALL``: sets whose buckets go deeper than ``MADE_FOR`` get more of them.  Higher similarities are met more often.

What goes together are candidates only.  Their connected components are then checked exactly, on whole texts:
a group of at most ``BLOCK`` sets in one task that counts shared shingles by
matrix products; in a larger one each set is compared with the group's root, which by the triangle inequality decides most pairs of
near copies, and the others are compared in pairs of blocks.  The pairs of a large group are counted but never written.  Links and classes
come from that check alone.

Result: one row per input row with ``class_id``, the least doc_id of its connected component, and
``n_links``, the number of other rows of similarity 0.8 or more, copies included.

A text of one to four words has one shingle, all of it.  Null, empty and blank texts have none: no links, and a
class of their own.  Null doc_ids are rows like others; a class of nothing but null ids has a null
class_id.  Repeated rows are copies.  Work per text needs memory of some sixty bytes a word.
Empty tables give empty results.  `join` drops all columns but the two it is told of; `keep_one` keeps
all, whatever they are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogproof.llm import similar, words
from catalogproof.llm.similar import BINS, DEEP_TIMES, SHINGLE, SMALL
from catalogproof.operators import scaling

#: similarity as a fraction, for exact comparison of counts
SIMILAR = (4, 5)
#: estimated similarity from which on a pair is a candidate: five standard deviations below 0.8
LIKELY = 0.62
#: the target, and the depth of splitting that the first runs are made for
RECALL, MADE_FOR = 0.999, 3
#: level from which on buckets of some thousand sets are compared instead of being split
DEPTH = 1


def runs(recall: float = RECALL, depth: int = MADE_FOR) -> int:
    """Runs after which a pair of just the wanted similarity was together at ``depth`` once."""
    met = 1.0
    for _ in range(depth):
        met = 1 - math.exp(-met)
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


def _limits(sizes: np.ndarray) -> np.ndarray:
    """Hashes below this choose a shingle, for each text."""
    share = np.minimum(1.0, SIMILAR[1] / (SIMILAR[0] * np.maximum(sizes, 1)))
    return np.where(share < 1, (share * 2.0**64).clip(0, 2.0**64 - 2048), 2.0**64 - 2048).astype(np.uint64)


def _children(shingles: np.ndarray, node: np.ndarray | np.uint64, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which shingles are chosen in a bucket, and the buckets they lead to."""
    g = words.mix(shingles ^ node)
    chosen = np.flatnonzero(g <= limits)
    return chosen, words.mix(g[chosen] + np.uint64(1))


def _signatures(shingles: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """For each text and bin a byte of its least shingle, 0 where it has none.  Shingles are sorted."""
    bins = (shingles >> np.uint64(57)).astype(np.int64)
    spot = docs * BINS + bins
    first = np.ones(len(spot), bool)
    first[1:] = spot[1:] != spot[:-1]
    out = np.zeros(n * BINS, np.uint8)
    out[spot[first]] = (words.mix(shingles[first]) % np.uint64(255)).astype(np.uint8) + 1
    return out.reshape(n, BINS)


def _lists(owner: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    order = np.argsort(owner, kind="stable")
    offsets = np.searchsorted(owner[order], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[order].view(np.int64)))


def describe(texts: DataFrame, n_runs: int) -> DataFrame:
    """(doc_id, key, d1, d2, n, signature, nodes) from (doc_id, key, text)."""
    roots = words.mix(np.arange(1, n_runs + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.portions(batch, "text", 2 << 20):
                shingles, sizes = words.shingled(*words.hashed(part.column("text")), SHINGLE)
                docs = np.repeat(np.arange(len(sizes)), sizes)
                limits = _limits(sizes)[docs]
                ends = np.cumsum(sizes)
                digests = []
                for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                    total = np.append(np.uint64(0), np.cumsum(words.mix(shingles ^ np.uint64(salt))))
                    digests.append(pa.array((total[ends] - total[ends - sizes]).view(np.int64)))
                found = [_children(shingles, root, limits) for root in roots]
                nodes = _lists(docs[np.concatenate([f[0] for f in found])], np.concatenate([f[1] for f in found]), len(sizes))
                signature = pa.array([s.tobytes() for s in _signatures(shingles, docs, len(sizes))], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), *digests, pa.array(sizes.astype(np.int64)), signature, nodes],
                    ["doc_id", "key", "d1", "d2", "n", "signature", "nodes"],
                )

    kind = dict(texts.dtypes)["doc_id"]
    schema = f"doc_id {kind}, key binary, d1 long, d2 long, n long, signature binary, nodes array<long>"
    return texts.mapInArrow(words.returning(run), schema)


def _split_again(texts: DataFrame, reps: DataFrame, rest: DataFrame) -> DataFrame:
    """(node, row) one level deeper, from (node, row)."""
    gathered = rest.groupBy("row").agg(F.collect_list("node").alias("from"))
    wanted = scaling.materialize(gathered.join(reps.select("row", "key"), "row"), "rest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.portions(batch, "text", 2 << 20):
                shingles, sizes = words.shingled(*words.hashed(part.column("text")), SHINGLE)
                ends, limits = np.cumsum(sizes), _limits(sizes)
                rows, nodes = [], []
                for i, (row, before) in enumerate(zip(part.column("row").to_pylist(), part.column("from").to_pylist())):
                    own = shingles[ends[i] - sizes[i] : ends[i]]
                    for node in np.array(before, np.int64).view(np.uint64):
                        _, found = _children(own, node, limits[i])
                        nodes.append(found)
                        rows.append(np.full(len(found), row, np.int64))
                none = np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([none.view(np.uint64), *nodes]).view(np.int64)),
                        pa.array(np.concatenate([none, *rows])),
                    ],
                    ["node", "row"],
                )

    return similar.fetch(texts, wanted).select("row", "from", "text").mapInArrow(words.returning(run), "node long, row long")


# --- candidates -----------------------------------------------------------------------


def _search(texts: DataFrame, reps: DataFrame, level: DataFrame) -> tuple[list[DataFrame], int, DataFrame | None]:
    """Edges from the buckets (node, row) of some runs, the depth reached, and the rows that went deeper than ``MADE_FOR``."""
    edges, depth, deep = [], 0, None
    while True:
        depth += 1
        if depth > 1:
            level = scaling.materialize(level, "level")
        if depth == MADE_FOR + 1:
            deep = level.select("row").distinct()
        sized, stats = similar.buckets(level)
        # one more level costs a set about as much as its comparison with a few thousand others
        searched = SMALL if depth < DEPTH else SMALL * DEEP_TIMES
        edges.append(scaling.materialize(similar.brute_force(sized.filter(F.col("size") <= searched), reps, SIMILAR, LIKELY), "edges"))
        large = stats.filter(F.col("size") > searched)
        if large.isEmpty():
            return edges, depth, deep
        split = scaling.materialize(similar.by_pivot(sized.filter(F.col("size") > searched).drop("size"), reps, large), "split")
        edges.append(split.filter(F.col("near") & (F.col("row") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("row").alias("b")))
        rest = split.filter(~F.col("near")).select("node", "row")
        if rest.isEmpty():
            return edges, depth, deep
        level = _split_again(texts, reps, rest)


def candidates(texts: DataFrame, reps: DataFrame, recall: float = RECALL) -> DataFrame:
    """Edges (a, b) whose connected components hold every pair that is met.

    The first runs are enough for ``MADE_FOR`` levels.  Sets whose buckets were split deeper make more runs,
    until these are enough for the depth that any run reached.
    """
    made = runs(recall)
    edges, depth, deep = _search(texts, reps, reps.select(F.explode("nodes").alias("node"), "row"))
    while deep is not None and runs(recall, depth) > made:
        more = runs(recall, depth)
        roots = words.mix(np.arange(made + 1, more + 1, dtype=np.uint64)).view(np.int64).tolist()
        begun = deep.select(F.explode(F.array(*map(F.lit, roots))).alias("node"), "row")
        found, reached, _ = _search(texts, reps, _split_again(texts, reps, begun))
        edges, depth, made = edges + found, max(depth, reached), more
    return reduce(DataFrame.union, edges)


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """(row, doc_id, class_id, n_links, first): one row per input row; ``first`` marks one row of each class."""
    texts = similar.keyed(docs, doc_id, text)
    described = describe(texts, runs(recall)).withColumn("row", F.monotonically_increasing_id())
    described = scaling.materialize(described, "sets")
    lead = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    classes, reps = similar.classes(described, lead=F.min(lead))
    copies = classes.select(F.col("rep").alias("row"), "copies")

    near = similar.components(candidates(texts, reps, recall))
    hint = F.broadcast if scaling.counted_few(near) else lambda df: df
    # the table that has every set is not sent for a few labels
    grouped = reps.select("row", "key", "n").join(hint(copies.join(hint(near), "row")), "row")
    checked = scaling.materialize(similar.verify(texts, SIMILAR, scaling.materialize(grouped, "grouped")), "checked")
    links = checked.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = similar.components(checked.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("row", "rep")

    labelled = (
        classes.join(links, "rep", "left")
        .join(roots, "rep", "left")
        .withColumns({"root": F.coalesce("root", "rep"), "links": F.coalesce("links", F.lit(0))})
    )
    heads = labelled.groupBy("root").agg(F.min("lead").alias("head"))
    found = scaling.materialize(
        labelled.join(heads, "root").select(
            F.struct("d1", "d2", "n").alias("_set"), "copies", (F.col("copies") - 1 + F.col("links")).alias("links"), "head"
        ),
        "found",
    )
    bare = described.select("row", "doc_id", F.when(F.col("n") > 0, F.struct("d1", "d2", "n")).alias("_set"))
    attached = scaling.attach_stats(bare, found, ["_set"], "copies", "row")
    return attached.select(
        "row",
        "doc_id",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        (F.col("head").isNull() | (F.col("head.row") == F.col("row"))).alias("first"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` without all but one of each class: that of the least doc_id.

    ``docs`` is written first, so the rows are numbered once for the join and the result.
    """
    row = words.free_name(docs, "row")
    numbered = scaling.materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    marked = join(numbered.select(F.struct(F.col(doc_id).alias("id"), F.col(row).alias("row")).alias("doc_id"), F.col(text).alias("text")), recall=recall)
    gone = scaling.materialize(marked.filter(~F.col("first")).select(F.col("doc_id.row").alias(row)), "gone")
    if scaling.counted_few(gone):
        gone = F.broadcast(gone)
    return numbered.join(gone, row, "left_anti").drop(row)
