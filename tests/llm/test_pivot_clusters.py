from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import types as T

from llm_fixtures import _importable  # noqa: F401

from tallywind.llm import pivot_clusters as C

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("cluster", T.StringType()),
        T.StructField("distance", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("q", T.StringType()),
    ]
)


def brute(rows, k, rounds, scale, width):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    at = [q for _, q in sorted(kept, key=key)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(at)) for _, q in kept]

    for _ in range(rounds):
        found = assign()
        for j in range(len(at)):
            mine = [q for (_, q), (_, c) in zip(kept, found) if c == j]
            if mine:
                at[j] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    inertia = {j: sum(d for d, c in found if c == j) for j in range(len(at))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (d, c) in zip(kept, found)), key=str)


def result(df, **options):
    return sorted((tuple(r) for r in C.clusters_with_inertia(df, **options).collect()), key=str)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_same_as_every_distance(spark, spread):
    rng = np.random.default_rng(int(spread * 100))
    centres = rng.normal(size=(6, 5))
    rows = [(i, [float(x) for x in centres[i % 6] + spread * rng.normal(size=5)]) for i in range(300)]
    rows += [(i, [0.25] * 5) for i in range(300, 360)] + [(7, rows[7][1]), (7, rows[8][1])]
    df = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA).repartition(3)
    options = {"dimensions": 5, "centroids": 7, "rounds": 3, "scale": 64, "pivots": 4}
    assert result(df, **options) == brute(rows, 7, 3, 64, 5)


def test_odd_rows(spark):
    rows = [
        (1, [1.0, -2.5]), (1, [1.0, -2.5]), (None, [0.5, 0.5]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [-0.001, 0.001]), (None, None),
    ]
    df = spark.createDataFrame([(*r, "a", None, "c", "d") for r in rows], SCHEMA)
    assert result(df, dimensions=2) == brute(rows, 16, 3, 64, 2)
    assert C.clusters_with_inertia(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="reaches 2"):
        C.clusters_with_inertia(spark.createDataFrame([(1, [1e30, 1.0], None, None, None, None)], SCHEMA), dimensions=2).collect()


def test_bounds_stay_below_the_distance_and_save_work():
    rng = np.random.default_rng(3)
    for scale in (1, 1000, 1 << 20):
        points = (rng.normal(size=(12, 6)) * scale).astype(np.int64)
        vectors = (points[rng.integers(0, 12, 2000)] + rng.normal(size=(2000, 6)) * scale / 50).astype(np.int64)
        pivots = vectors[:8]
        pairs = C.pivot_pairs(pivots)
        to_pivots = np.sqrt(C.distances(vectors, pivots).astype(np.float64))
        exact = C.distances(vectors, points)
        bounds = C.lower_bounds(to_pivots, np.sqrt(C.distances(points, pivots).astype(np.float64)), pairs)
        assert (bounds <= exact).all()
        cluster, distance, measured = C.nearest(vectors, to_pivots, points, pivots, pairs)
        assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
        assert scale == 1 or measured < 0.5 * exact.size


def test_ties_go_to_the_smaller_number():
    vectors = np.array([[0, 0], [4, 0], [2, 0]])
    points = np.array([[4, 0], [0, 0], [0, 0]])
    pivots = np.array([[0, 0], [4, 0]])
    cluster, distance, _ = C.nearest(vectors, np.sqrt(C.distances(vectors, pivots)), points, pivots, C.pivot_pairs(pivots))
    assert cluster.tolist() == [1, 0, 0] and distance.tolist() == [0, 0, 4]
