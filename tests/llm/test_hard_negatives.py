from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm_fixtures import _importable  # noqa: F401

from tallywind.llm import hard_negatives as H

SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in ("row", "rank", "tile", "q", "anchor", "score")]
)


def brute(rows, every, positives=5, negatives=5, percent=80):
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], y) for i, v, y in rows if v is not None and y is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, q, y) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, p)), j is None, j or 0, m, z == y) for m, (j, p, z) in enumerate(kept) if m != n]
        same = sorted(s for s in scored if s[4])[:positives]
        for ps, none, j, _, _ in same:
            window = sorted(s for s in scored if not s[4] and percent * -ps <= 100 * -s[0] <= 100 * -ps)[:negatives]
            for r, s in enumerate(window, 1):
                out.append((i, None if none else j, r, None if s[1] else s[2], -ps, -s[0]))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", None, "c", "d", None, "f") for r in rows], SCHEMA).repartition(3)


def result(df, every, **options):
    return sorted((tuple(r) for r in H.mine(df, F.col("vec_id") % every == 0, **options).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_scores(spark, seed):
    """Clustered vectors with many equal ones, searched over one tile and over many in several waves."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 6)) / 2
    rows = [(i, [float(x) for x in np.round(centres[rng.integers(5)] + rng.normal(size=6) / 8, 2)], int(rng.integers(3))) for i in range(900)]
    rows += [(i, [0.5] * 6, i % 2) for i in range(900, 1200)]
    want = brute(rows, 60)
    assert len(want) > 100
    df = frame(spark, rows)
    assert result(df, 60) == want
    assert result(df, 60, least_rows=16) == want
    assert result(df, 60, most_rows=10, least_rows=8) == want


def test_odd_rows(spark):
    one = [0.5, 0.25]
    rows = [
        (0, one, 1), (0, one, 1), (None, one, 1), (None, one, 2), (1, one, 2), (2, [0.5], 2), (3, [], 1), (4, None, 1), (5, one, None),
        (6, [None, 1.0], 1), (7, [float("nan"), 1.0], 2), (8, [float("-inf"), 1.0], 2), (10, [-0.5, -0.25], 3), (20, [0.0, 0.0], 3), (9, [0.5, 0.25, 0.125], 2),
    ]
    df = frame(spark, rows)
    # Of equal rows without an id any may come first, so ids and scores are what is compared.
    assert result(df, 10) == brute(rows, 10)
    assert result(df.limit(0), 10) == []
    assert result(frame(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]), 10) == [(0, 1, 1, 2, 0, 0)]


def test_boxes_hold_what_they_bound():
    rng = np.random.default_rng(0)
    q = rng.integers(-100, 100, (1000, 7)).astype(np.float64)
    tree = H.RTree(np.arange(1000), np.arange(1000), np.zeros(1000, dtype=np.int64), q, leaf=8)
    assert sorted(tree.row.tolist()) == list(range(1000))
    a = rng.integers(-100, 100, 7).astype(np.float64)
    lower, upper = H.interval(a, *tree.levels[0])
    scores = (tree.q @ a).reshape(-1, 8)
    assert (lower <= scores.min(axis=1)).all() and (scores.max(axis=1) <= upper).all()
    far = np.array([1 << 62])
    best = tree.search(-1, a, 0, True, -far, far, -far, 5)[0]
    assert [s for s, _, _ in best] == sorted((q @ a).astype(int).tolist(), reverse=True)[:5]


def test_large_components_are_exact(spark):
    rows = [(0, [60000.0] * 3, 1), (1, [59999.99609375] * 3, 1), (2, [60000.0, 60000.0, 59999.99609375], 2), (3, [60000.0, 60000.0, 59000.0], 2)]
    assert result(frame(spark, rows), 100) == brute(rows, 100)
