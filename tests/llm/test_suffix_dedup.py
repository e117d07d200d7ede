from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from llm_fixtures import ROWS, _importable, hostile, nothing  # noqa: F401

from tallywind.llm import suffix_dedup as S
from tallywind.llm import suffix_runs as R


def brute(rows, width=50):
    """Per row (id, text): bytes, removed bytes, spans, digest of the rest."""
    rank = lambda i: (i is None, i or 0)
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            if w not in least or rank(i) < least[w]:
                least[w] = rank(i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - width + 1):
            if least[b[p : p + width]] < rank(i):
                gone[p : p + width] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed: int, n: int):
    """Texts put together from shared passages of 40 to 90 bytes, common lines, copies with changes and long repeats."""
    rng = random.Random(seed)
    letters = "abcdefgh é中\x00"
    make = lambda k: "".join(rng.choice(letters) for _ in range(k))
    passages = [make(rng.randint(40, 90)) for _ in range(12)]
    common = make(60)
    rows = []
    while len(rows) < n:
        parts = [rng.choice([make(rng.randint(0, 60)), rng.choice(passages), common, "ab" * rng.randint(1, 80), " " * rng.randint(1, 120)]) for _ in range(rng.randint(0, 8))]
        text = "".join(parts)
        rows.append((rng.choice([len(rows), len(rows), rng.randint(0, n), None]), text))
        for _ in range(rng.choice([0, 0, 1, 4])):
            at = rng.randint(0, len(text))
            rows.append((len(rows), text[:at] + make(rng.randint(0, 3)) + text[at:]))
    return rows[:n] + [(5, None), (None, None), (6, "")]


def result(df, **options):
    return sorted((tuple(r) for r in S.digests(df, **options).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_as_every_window(spark, seed):
    rows = corpus(seed, 220)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    assert sum(r[2] for r in want) > 1000
    assert result(df) == want
    # Many runs and parts, and windows of frequent strings one by one.
    assert result(df, run_keys=100, parts=9, heavy=4) == want


def test_odd_texts(spark, hostile, nothing):
    want = brute([(r[0], r[1]) for r in ROWS if r[0] not in (9, 10)])
    got = [r for r in result(hostile) if r[0] not in (9, 10)]
    assert got == want
    assert S.digests(nothing).count() == 0


def test_a_very_long_text_and_its_copy(spark):
    words = random.Random(4)
    long = " ".join(f"w{words.randint(0, 10**9)}" for _ in range(150_000))
    df = spark.createDataFrame([(2, long), (1, "x" + long[100_000:600_000])], "doc_id long, text string")
    by_id = {r["doc_id"]: r for r in S.digests(df).collect()}
    assert (by_id[2]["n_removed"], by_id[2]["n_spans"]) == (500_000, 1)
    assert by_id[2]["kept_sha256"] == hashlib.sha256((long[:100_000] + long[600_000:]).encode()).hexdigest()
    assert by_id[1]["n_removed"] == 0


@pytest.mark.parametrize("count", [1, 2, 3, 7, 16])
def test_merge_of_front_coded_runs(count):
    rng = np.random.default_rng(count)
    runs, whole = [], []
    for r in range(count):
        keys = np.unique(rng.integers(97, 99, (rng.integers(0, 300), 12), dtype=np.uint8), axis=0)
        known, rest = R.front_coded(keys) if len(keys) else (np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.uint8))
        runs.append((known, rest.tobytes()))
        whole += [(k.tobytes(), r, i) for i, k in enumerate(keys)]
    got = list(R.merged(runs, 12))
    assert sorted((k, r, i) for _, r, i, k in got) == sorted(whole)
    assert [k for *_, k in got] == sorted(k for k, _, _ in whole)
    for (_, _, _, a), (same, _, _, b) in zip(got, got[1:]):
        assert same == next((i for i in range(12) if a[i] != b[i]), 12)


def test_packed_arrays():
    arrays = [np.arange(5, dtype=np.uint8), np.zeros(0, dtype=np.int64), np.arange(3, dtype=np.uint32)]
    assert [a.tolist() for a in R.unpacked(R.packed(*arrays), "u1", "i8", "u4")] == [a.tolist() for a in arrays]
