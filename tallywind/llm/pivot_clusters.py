"""Centroid clustering of integer vectors, with Ptolemy's inequality saving exact distances.

A few pivots are fixed once. Every vector keeps its distances to them beside its components; every round measures the
centroids against them anew. For two pivots p and s, Ptolemy's inequality gives

    d(x, c) >= |d(x, p) * d(c, s) - d(x, s) * d(c, p)| / d(p, s),

so the largest value over all pivot pairs is a lower bound that needs no component of x. A vector is first compared
exactly with the centroid of the least bound; centroids whose bound lies strictly above that distance cannot win and are
left out; all others, ties included, are compared exactly. Distances between integer vectors are integers, the bounds are
floating point: they are lowered by more than their rounding error before they are compared, so no centroid is lost.

Every round is one pass over the written vectors: tasks give component sums and counts per centroid, so what is shuffled
and what reaches the driver is a row per centroid and task, whatever a cluster holds.

Defined results: vectors that are null, have another number of components or a null or non-finite one take no part; a
component whose product with ``scale`` reaches 2**24 raises an error; repeated rows are vectors of their own; a vector
without id comes behind all others in the choice of starts; with fewer vectors than centroids every vector starts one;
equal starts are all kept, ties going to the smaller number; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.llm import text as X
from tallywind.llm import vectors as V
from tallywind.llm.components import shared
from tallywind.storage import store

CENTROIDS = 16
ROUNDS = 3
DIMENSIONS = 64
SCALE = 64
PIVOTS = 8
#: Vectors a task works on at once.
_BLOCK = 1 << 13
#: Bounds are lowered by this share, and by this much: far more than the rounding of a few products and one quotient.
_SHARE, _STEP = 1e-9, 1e-6


def distances(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances, one row per vector and one column per point."""
    out = np.empty((len(vectors), len(points)), dtype=np.int64)
    for k, point in enumerate(points):
        apart = vectors - point
        out[:, k] = np.einsum("ij,ij->i", apart, apart)
    return out


def pivot_pairs(pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of different pivots and how far they are apart."""
    apart = np.sqrt(distances(pivots, pivots).astype(np.float64))
    p, s = np.nonzero(np.triu(apart > 0, 1))
    return p, s, apart[p, s]


def lower_bounds(to_pivots: np.ndarray, centroid_to_pivots: np.ndarray, pairs) -> np.ndarray:
    """Ptolemaic lower bounds of the squared distances, surely not above them: one column per centroid."""
    p, s, apart = pairs
    out = np.zeros((len(to_pivots), len(centroid_to_pivots)))
    for a, b, d in zip(p, s, apart, strict=True):
        left = np.multiply.outer(to_pivots[:, a], centroid_to_pivots[:, b])
        right = np.multiply.outer(to_pivots[:, b], centroid_to_pivots[:, a])
        # What rounding may add grows with the products, not with their difference.
        slack = (left + right) * _SHARE + _STEP
        np.maximum(out, (np.abs(left - right) - slack) / d, out=out)
    return np.square(out * (1 - _SHARE))


def nearest(vectors: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray, pairs) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, exact squared distance, how many exact distances were measured)."""
    n = len(vectors)
    bounds = lower_bounds(to_pivots, np.sqrt(distances(centroids, pivots).astype(np.float64)), pairs)
    first = np.argmin(bounds, axis=1)
    apart = vectors - centroids[first]
    cluster, distance = first, np.einsum("ij,ij->i", apart, apart)
    measured = n
    open_ = bounds <= distance[:, None]
    open_[np.arange(n), first] = False
    for k in range(len(centroids)):
        at = np.flatnonzero(open_[:, k] & (bounds[:, k] <= distance))
        if len(at):
            apart = vectors[at] - centroids[k]
            found = np.einsum("ij,ij->i", apart, apart)
            better = (found < distance[at]) | ((found == distance[at]) & (k < cluster[at]))
            cluster[at[better]], distance[at[better]] = k, found[better]
            measured += len(at)
    return cluster, distance, measured


def _measured(kept: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The vectors with their distances to the pivots, squared."""
    schema = T.StructType([kept.schema["id"], kept.schema["q"], T.StructField("to_pivots", T.ArrayType(T.LongType()))])

    def measure(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in V.chunks(batch.num_rows, _BLOCK):
            piece = batch.slice(part.start, part.stop - part.start)
            found = distances(V.matrix_of(piece.column(1)).astype(np.int64), pivots)
            yield {"id": piece.column(0), "q": piece.column(1), "to_pivots": V.lists(found, pa.int64())}

    return X.map_batches(kept, measure, schema)


def _assigned(batch: pa.RecordBatch, model) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    centroids, pivots, pairs = model
    for part in V.chunks(batch.num_rows, _BLOCK):
        piece = batch.slice(part.start, part.stop - part.start)
        q = V.matrix_of(piece.column(1)).astype(np.int64)
        cluster, distance, _ = nearest(q, np.sqrt(V.matrix_of(piece.column(2)).astype(np.float64)), centroids, pivots, pairs)
        yield piece, q, cluster, distance


def _sums(rows: DataFrame, model) -> DataFrame:
    """(cluster, n, sums) over all vectors: every task adds up its own before anything is shuffled."""
    schema = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType()))])
    count, width = model.value[0].shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(count, dtype=np.int64), np.zeros((count, width), dtype=np.int64)
        for batch in batches:
            for _, q, cluster, _ in _assigned(batch, model.value):
                for k in np.unique(cluster):
                    mine = cluster == k
                    n[k] += mine.sum()
                    sums[k] += q[mine].sum(axis=0)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(n[met]), V.lists(sums[met], pa.int64())], names=["cluster", "n", "sums"])

    partial = rows.mapInArrow(add, schema).select("cluster", "n", F.posexplode("sums").alias("i", "x"))
    by_component = partial.groupBy("cluster", "i").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    return by_component.groupBy("cluster").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "x"))).alias("sums"))


def _moved(rows: DataFrame, centroids: np.ndarray, pivots: np.ndarray, pairs) -> np.ndarray:
    """The centroids after one round: exact floors of the means, empty ones as they were. A row each reaches the driver."""
    out = centroids.copy()
    for r in _sums(rows, shared(rows.sparkSession, (centroids, pivots, pairs))).collect():
        out[r["cluster"]] = [s["x"] // r["n"] for s in r["sums"]]
    return out


def _first(kept: DataFrame, salt: str, most: int) -> np.ndarray:
    """The vectors with the least SHA-256 of salt and id, in that order, at most ``most`` of them."""
    ranked = kept.select("q", "id", F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256).alias("h"))
    return [r["q"] for r in ranked.orderBy(F.col("h").isNull(), "h", "q").limit(most).select("q").collect()]


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    dimensions: int = DIMENSIONS,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray]:
    """(one row per vector: vec_id, cluster, distance; the final centroids)."""
    kept = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("v")).where((F.size("v") == dimensions) & V.finite(F.col("v")))
    kept = kept.select("id", V.scaled(F.col("v"), scale).alias("q"))
    kind = T.StructType([T.StructField(vec_id, kept.schema["id"].dataType), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    starts = _first(kept, "1:", centroids)
    if not starts:
        return vectors.sparkSession.createDataFrame([], kind), np.zeros((0, dimensions), dtype=np.int64)
    at = np.array(starts, dtype=np.int64).reshape(len(starts), dimensions)
    fixed = np.array(_first(kept, "pivot:", pivots), dtype=np.int64).reshape(-1, dimensions)
    pairs = pivot_pairs(fixed)
    rows = store(_measured(kept, fixed)).df
    for _ in range(rounds):
        at = _moved(rows, at, fixed, pairs)
    model = shared(vectors.sparkSession, (at, fixed, pairs))

    def final(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece, _, found, distance in _assigned(batch, model.value):
            yield {vec_id: piece.column(0), "cluster": found.astype(np.int32), "distance": distance}

    return X.map_batches(rows, final, kind), at


def clusters_with_inertia(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """Per vector: vec_id, cluster, distance, the inertia of its cluster and of all, and a digest of its centroid."""
    found, centroids = cluster(vectors, vec_id, vector, **options)
    found = store(found).df
    # One row per centroid.
    per_cluster = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    total = sum(per_cluster.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    known = [(k, per_cluster[k], total, digests[k]) for k in sorted(per_cluster)]
    table = vectors.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(vec_id, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
