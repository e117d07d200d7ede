from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import _importable, frame, hostile, nothing  # noqa: F401

from tallywind.llm import ngram_join as J
from tallywind.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(texts: dict, percent=75):
    sets = {k: shingles(t) for k, t in texts.items()}
    holders = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            holders[x].append(k)
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in sets.items():
        for other, n in Counter(o for x in s for o in holders[x] if o < k).items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                a, b = sorted((root(k), root(other)))
                parent[b] = a
    return {k: (len(sets[k]), root(k)) for k in sets}


def texts_with_copies(seed: int, n: int):
    """Groups of copies with some words changed, so that many pairs are near the threshold; and shared passages."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnop") + rng.choice("xyzuvw")
    passage = " ".join(word() for _ in range(30))
    out = []
    while len(out) < n:
        base = [word() for _ in range(rng.choice([3, 4, 5, 8, 20, 60, 120]))]
        if rng.random() < 0.3:
            base += passage.split()
        for _ in range(rng.choice([1, 1, 2, 5, 25])):
            copy = [word() if rng.random() < 0.03 else w for w in base]
            out.append((" " if rng.random() < 0.5 else "\n").join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    return dict(enumerate(out[:n]))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_are_those_of_all_pairs(frame, seed):
    texts = texts_with_copies(seed, 260)
    rows = J.similarity_groups(frame([texts[i] for i in range(len(texts))]), frequent=50 * seed).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute(texts)


def test_pairs_after_the_pivots_are_not_lost(frame, monkeypatch):
    monkeypatch.setattr(J, "PIVOT_TURNS", 0)
    texts = texts_with_copies(9, 200)
    rows = J.similarity_groups(frame([texts[i] for i in range(len(texts))])).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute(texts)


def test_blocked_overlap():
    rng = np.random.default_rng(0)
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 60, dtype=np.int64).astype(np.uint64) * np.uint64(2)
        a = np.unique(rng.choice(pool, rng.integers(1, 60)))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.choice(pool, 4)]))
        n = len(np.intersect1d(a, b))
        assert J.overlap_reaches(a.view(np.int64), b.view(np.int64), 75) == (100 * n >= 75 * (len(a) + len(b) - n))


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 700)]
    links = spark.createDataFrame([*path, *star, (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["comp"] for r in components(links).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 500 for i in range(500, 700)}


def test_odd_texts(hostile, nothing):
    rows = J.similarity_groups(hostile).collect()
    assert len(rows) == hostile.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[1]["component_id"] == by_id[2]["component_id"] == 1
    assert [(by_id[i]["n_shingles"], by_id[i]["component_id"]) for i in (3, 4, 5, 7)] == [(0, 3), (0, 4), (0, 5), (1, 7)]
    none = sorted((r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is None)
    assert none[0] == (0, None) and none[1][1] == 1
    assert J.similarity_groups(nothing).count() == 0


def test_buckets_leave_out_no_link(spark, frame):
    texts = texts_with_copies(5, 200)
    docs = frame([texts[i] for i in range(200)])
    rows = J.prefixes(docs, "doc_id", "text", 5, 75).cache()
    sets = {i: shingles(t) for i, t in texts.items()}
    node = {r["id"]: r["node"] for r in rows.collect()}
    by_node = {node[i]: s for i, s in sets.items() if s}
    some = sorted(by_node)
    pairs = [(a, b) for n, a in enumerate(some) for b in some[n + 1 :]]
    kept = {(r["a"], r["b"]) for r in J.likely_links(spark.createDataFrame(pairs, "a long, b long"), rows, 75).collect()}
    links = {(a, b) for a, b in pairs if 100 * len(by_node[a] & by_node[b]) >= 75 * len(by_node[a] | by_node[b])}
    assert links and links <= kept and len(kept) < len(pairs) / 2


def test_sketches_never_bound_an_overlap_too_low():
    rng = np.random.default_rng(3)
    for n, more, common in ((1, 1, 1), (5, 9, 0), (60, 70, 55), (300, 4000, 200), (1000, 1030, 0), (9000, 9000, 8000)):
        drawn = np.unique(rng.integers(0, 1 << 63, n + more, dtype=np.uint64))
        a, b = drawn[:n], np.concatenate([drawn[:common], drawn[n : n + more - common]])
        bound = J.most_shared(*(np.frombuffer(J.sketch(x), np.uint8) for x in (a, b)))
        assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))
        assert common or n < 1000 or bound < 0.8 * n
    assert J.sketch(np.arange(2000, dtype=np.uint64) << np.uint64(32)) is None


def test_counting_a_chunk_takes_little_beside_it():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 500):
        parts = [rng.integers(0, 90, n).astype(np.uint64), np.zeros(0, np.uint64), rng.integers(0, 90, n).astype(np.uint64)]
        s, times = np.unique(np.concatenate(parts), return_counts=True)
        got = J.met_again(parts)
        assert got[0].tolist() == s[times > 1].tolist() and got[1].tolist() == times[times > 1].tolist()
    held = [rng.integers(0, 1 << 63, 1 << 18, dtype=np.uint64)]
    tracemalloc.start()
    J.met_again(held)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.6 * 8 * (1 << 18)
