"""Near duplicates by SuperMinHash: one document of each group stays.

The words of a text, A to Z in lower case, give its set of hashed five-word shingles.  For its signature each shingle draws a random
permutation of the ``BINS`` components, one place after the other, and offers (place + a random fraction) to the component that stands
there; a component keeps the least offer.  The ranks of one shingle are so correlated that the components spread over
the set more evenly than independent minima, which lowers the variance; and a text is done as soon as the greatest component is below the
place reached, after a few places for most texts.

``BANDS`` bands of ``ROWS`` components are the buckets.  Two sets of similarity 0.85 share none with probability 5e-5, of 0.87 with 7e-6, of 0.9 with 1e-7.
A bucket of at most ``SMALL`` sets is compared by signatures; in a larger one all are compared with one pivot as far as
the first wide gap in the distances, and the rest meets again in the buckets of that bucket and one more band, as two such sets
share eight bands on average.  So no pairs of a large bucket are written.

Candidates only are grouped that way.  `similar.verify` then counts shared shingles of whole texts: a small group in one task; in a
larger one every member is compared with the group's root, and members that this leaves undecided, as they are not linked to the root,
in blocks with those that the triangle inequality does not exclude.
Exact links are joined to components by union-find, hooking and contracting until no link is left.

Result: one row per input row with ``n_shingles``, ``component_id``, the smallest doc_id that links lead to, and ``kept``, whether that is the
row's own.  Null, empty and blank texts have no shingles and no links.  A row without a doc_id is a row like others: it may link two
documents, and stands for a component only if no member has an id; it is kept then.  Repeated rows are linked; rows that repeat a kept doc_id are
kept with it.  Empty tables give empty results.  Extra columns are dropped.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogproof.llm import similar, words
from catalogproof.llm.similar import BINS, SHINGLE, SMALL
from catalogproof.operators import scaling

#: similarity from which on two texts are linked, as a fraction
SIMILAR = (85, 100)
#: estimated similarity from which on a pair is a candidate: five standard deviations below
LIKELY = 0.69
BANDS, ROWS = 21, 6
#: bytes of text that are worked on together
PORTION = 1 << 20

#: above every offer
_NONE = np.uint64(2**64 - 1)


def super_minhash(shingles: np.ndarray, docs: np.ndarray, n: int, m: int = BINS) -> np.ndarray:
    """The m components of each of n sets, place in the upper 8 bits.  ``docs``: the set of each shingle."""
    least = np.full(n * m, _NONE)
    element, doc = shingles, docs
    order: np.ndarray | None = None  # the permutation of each shingle, as far as it is drawn
    for place in range(m):
        if not len(element):
            break
        drawn = words.mix(element ^ words.mix(np.uint64(place + 1)[None])[0])
        offer = np.uint64(place << 56) | drawn >> np.uint64(8)
        other = place + (words.mix(drawn + np.uint64(1)) % np.uint64(m - place)).astype(np.int64)
        if order is None:
            here = other
        else:
            rows = np.arange(len(element))
            here = order[rows, other].astype(np.int64)
            order[rows, other] = order[:, place]
        np.minimum.at(least, doc * m + here, offer)
        worst = least.reshape(n, m).max(1) >> np.uint64(56)
        going = np.flatnonzero(worst[doc] > place)
        if order is None:
            order = np.tile(np.arange(m, dtype=np.uint8), (len(going), 1))
            order[np.arange(len(going)), other[going]] = 0
            element, doc = element[going], doc[going]
        elif len(going) < len(element):
            element, doc, order = element[going], doc[going], order[going]
    return least.reshape(n, m)


def bands(components: np.ndarray) -> np.ndarray:
    """The bucket of each set and band."""
    parts = components[:, : BANDS * ROWS].reshape(len(components), BANDS, ROWS)
    key = np.broadcast_to(words.mix(np.arange(1, BANDS + 1, dtype=np.uint64)), parts.shape[:2])
    for k in range(ROWS):
        key = words.mix(key ^ words.mix(parts[:, :, k] + np.uint64(k)))
    return key


def describe(texts: DataFrame) -> DataFrame:
    """(doc_id, key, d1, d2, n, signature, bands) from (doc_id, key, text).  d1 and d2 digest the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.portions(batch, "text", PORTION):
                shingles, sizes = words.shingled(*words.hashed(part.column("text")), SHINGLE)
                docs = np.repeat(np.arange(len(sizes)), sizes)
                ends = np.cumsum(sizes)
                digests = []
                for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                    total = np.append(np.uint64(0), np.cumsum(words.mix(shingles ^ np.uint64(salt))))
                    digests.append(pa.array((total[ends] - total[ends - sizes]).view(np.int64)))
                components = super_minhash(shingles, docs, len(sizes))
                signature = (words.mix(components) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
                has = sizes > 0
                offsets = np.append(0, np.cumsum(has * BANDS)).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands(components)[has].reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", "key")),
                        *digests,
                        pa.array(sizes.astype(np.int64)),
                        pa.array([s.tobytes() for s in signature], pa.binary()),
                        keys,
                    ],
                    ["doc_id", "key", "d1", "d2", "n", "signature", "bands"],
                )

    kind = dict(texts.dtypes)["doc_id"]
    return texts.mapInArrow(words.returning(run), f"doc_id {kind}, key binary, d1 long, d2 long, n long, signature binary, bands array<long>")


def candidates(reps: DataFrame) -> DataFrame:
    """Edges (a, b) whose connected components hold every pair that shares buckets and looks similar."""
    level = reps.select("row", F.posexplode("bands").alias("band", "node"))
    edges = []
    for depth in range(BANDS):
        level = scaling.materialize(level, "level") if depth else level
        sized, stats = similar.buckets(level)
        small = sized.filter(F.col("size") <= SMALL)
        edges.append(scaling.materialize(similar.brute_force(small, reps, SIMILAR, LIKELY), "edges"))
        large = sized.filter(F.col("size") > SMALL)
        hot = stats.filter(F.col("size") > SMALL)
        if hot.isEmpty():
            break
        split = scaling.materialize(similar.by_pivot(large.select("node", "row", "pivot"), reps, hot), "split")
        edges.append(split.filter(F.col("near") & (F.col("row") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("row").alias("b")))
        rest = split.filter(~F.col("near")).select("node", "row")
        if rest.isEmpty():
            break
        # the bands behind the bucket's own: each set of bands is a bucket once
        own = large.groupBy("node").agg(F.first("band").alias("own"))
        again = scaling.lookup(rest, own, ["node"], "row").join(reps.select("row", F.posexplode("bands").alias("band", "next")), "row")
        level = again.filter(F.col("band") > F.col("own")).select("row", "band", F.xxhash64("node", "next").alias("node"))
    return reduce(DataFrame.union, edges)


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n_shingles, component_id, kept), one row per input row."""
    lower = F.translate(F.col(text).cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    texts = similar.keyed(docs.select(F.col(doc_id).alias("doc_id"), lower.alias("text")), "doc_id", "text")
    described = scaling.materialize(describe(texts).withColumn("row", F.monotonically_increasing_id()), "sets")
    classes, reps = similar.classes(described, least=F.min("doc_id"))
    near = similar.components(candidates(reps)).join(reps.select("row", "key", "n"), "row").withColumn("copies", F.lit(1))
    links = similar.verify(texts, SIMILAR, scaling.materialize(near, "members"), counts=False)
    links = scaling.materialize(links.filter("b IS NOT NULL").select("a", "b"), "links")
    roots = similar.components(links).withColumnRenamed("row", "rep")
    labelled = classes.join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    heads = labelled.groupBy("root").agg(F.min("least").alias("least"))
    found = scaling.materialize(
        labelled.drop("least").join(heads, "root").select(F.struct("d1", "d2", "n").alias("_set"), "copies", "least"), "found"
    )
    bare = described.select("row", "doc_id", "n", F.when(F.col("n") > 0, F.struct("d1", "d2", "n")).alias("_set"))
    attached = scaling.attach_stats(bare, found, ["_set"], "copies", "row")
    component = F.when(F.col("_set").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return attached.select("row", "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
