from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from llm_fixtures import _importable, frame, hostile, nothing  # noqa: F401
from pyspark.sql import functions as F

from tallywind.llm import paragraph_dedup as P
from tallywind.llm import text as X
from tallywind.llm.queries import QUERIES


def prose(rng, n):
    return [rng.choice("bcdfglmnprst") + rng.choice("aeiou") + rng.choice("bcdfglmnprst") + rng.choice(["", "ing", "ed", "a"]) for _ in range(n)]


def test_bands_reach_the_recall():
    for similarity in (0.5, 0.75, 0.9):
        bands, rows = P.tuned_bands(similarity)
        assert 1 - (1 - similarity**rows) ** bands >= P.RECALL


def test_winnowing_guarantee():
    """Texts that share PASSAGE + REACH - 1 words in a row share a chosen window."""
    rng = random.Random(1)
    for _ in range(50):
        passage = prose(rng, P.PASSAGE + P.REACH - 1)
        texts = [" ".join([*prose(rng, rng.randint(0, 60)), *passage, *prose(rng, rng.randint(0, 60))]) for _ in range(2)]
        chosen = [set(P.winnowed(next(X.slices(pa.array([t]))))[2].tolist()) for t in texts]
        assert chosen[0] & chosen[1]


def test_winnowing_by_hand():
    rng = random.Random(2)
    text = " ".join(prose(rng, 200))
    row, first, h = P.winnowed(next(X.slices(pa.array(["short", text, text]))), 5, 7)
    piece = next(X.slices(pa.array([text])))
    found = X.words(piece)
    all_h, _, _ = X.windows(X.span_hashes(piece.data, found, True), found.bounds, 5, False)
    want = set()
    for i in range(len(all_h) - 6):
        part = all_h[i : i + 7]
        want.add(i + 6 - int(np.argmin(part[::-1])))
    assert first[row == 1].tolist() == sorted(want) == first[row == 2].tolist() and 0 not in row


def test_inline_passages_near_paragraphs_and_clean_texts(frame):
    rng = random.Random(3)
    passage = " ".join(prose(rng, 55))
    line = prose(rng, 60)
    near = [w if i % 40 else "changed" for i, w in enumerate(line)]
    own = prose(rng, 50)
    texts = [
        " ".join(prose(rng, 70)) + " " + passage + " " + " ".join(prose(rng, 10)),
        " ".join(prose(rng, 5)) + " " + passage.upper() + " " + " ".join(prose(rng, 90)),
        "top\n" + " ".join(line) + "\nend",
        "\n".join([" ".join(prose(rng, 30)), " ".join(near)]),
        " ".join(own) + "\n" + " ".join(own),  # its own repeat only
        " ".join(prose(rng, 200)),
    ]
    rows = P.repeats(frame(texts)).collect()
    # The near paragraphs share 39 words in a row, which may give a passage too.
    assert {0, 1} <= {r["doc_id"] for r in rows if r["kind"] == "passage"} <= {0, 1, 2, 3}
    pairs = defaultdict(set)
    for r in rows:
        if r["kind"] == "paragraph":
            pairs[r["cluster_id"]].add((r["doc_id"], r["removed"], r["start_word"]))
    assert list(pairs.values()) == [{(2, False, 1), (3, True, 30)}]
    assert {(r["doc_id"], r["removed"]) for r in rows if r["kind"] == "passage" and r["doc_id"] < 2} == {(0, False), (1, True)}


def test_near_paragraphs_against_all_pairs(spark, frame):
    rng = random.Random(4)
    lines = []
    for _ in range(40):
        base = prose(rng, rng.randint(25, 90))
        lines += [[w if rng.random() > 0.03 else "new" + w for w in base] for _ in range(rng.choice([1, 2, 4]))]
    rng.shuffle(lines)
    texts = [" ".join(line) for line in lines]
    sets = [set(zip(*[line[i:] for i in range(5)], strict=False)) for line in lines]
    want = {(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    clusters = {r["doc_id"]: r["cluster_id"] for r in P.repeats(frame(texts)).where("kind = 'paragraph'").collect()}
    met = [p for p in want if clusters.get(p[0]) is not None and clusters[p[0]] == clusters.get(p[1])]
    assert len(met) >= 0.98 * len(want)
    linked = {i for p in want for i in p}
    assert set(clusters) <= linked


def test_lines_of_one_template(frame, monkeypatch):
    """Most pairs of such lines share bands and shingles and do not link; they are known before they are pairs. Links are all found."""
    rng = random.Random(6)
    words = prose(rng, 40)
    values = [prose(rng, 30) for _ in range(4)]
    lines = [list(words) for _ in range(400)]
    for line in lines:
        for at, value in zip((6, 15, 24, 33), values, strict=True):
            line[at] = rng.choice(value)
    sets = [set(zip(*[line[i:] for i in range(5)], strict=False)) for line in lines]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    made, exact = [], P.J.exact_links
    monkeypatch.setattr(P.J, "exact_links", lambda pairs, *rest: made.append(pairs.count()) or exact(pairs, *rest))
    clusters = {r["doc_id"]: r["cluster_id"] for r in P.repeats(frame([" ".join(line) for line in lines])).where("kind = 'paragraph'").collect()}
    assert all(clusters[i] == clusters[j] for i, j in links)
    assert set(clusters) == {i for pair in links for i in pair}
    # Beyond the turns of pivots only pairs close to a link are left.
    assert sum(made[2:]) <= len(links)


def test_marks_bound_every_overlap(spark):
    """The bound is never below the shingles two sets share, also where several fall on one bit."""
    rng = random.Random(7)
    pool = [rng.getrandbits(64) - (1 << 63) for _ in range(900)]
    sets = {i: set(rng.sample(pool, rng.choice([3, 30, 300, 700]))) for i in range(24)}
    rows = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "node long, row array<long>")
    marks = P.marked(rows).cache()
    other = marks.select(*[F.col(c).alias(f"x{c}") for c in marks.columns])
    got = marks.join(other, F.col("xnode") < F.col("node")).select("xnode", "node", P._most_shared().alias("most")).collect()
    assert len(got) == 24 * 23 // 2
    assert all(r["most"] >= len(sets[r["xnode"]] & sets[r["node"]]) for r in got)


@pytest.mark.parametrize("words", [51])
def test_no_repeated_passage_is_missed(spark, words):
    texts = {r["doc_id"]: r["text"].lower().split() for r in spark.read.parquet(SF_DIR + "/documents.parquet").collect()}
    holders = defaultdict(set)
    for k, w in texts.items():
        for i in range(len(w) - words + 1):
            holders[tuple(w[i : i + words])].add(k)
    want = set().union(*[v for v in holders.values() if len(v) > 1])
    got = {r["doc_id"] for r in QUERIES["op10_substring_dedup"](spark, SF_DIR).select("doc_id").collect()}
    assert want <= got


def test_odd_texts(hostile, nothing):
    rows = P.repeats(hostile).collect()
    assert {r["doc_id"] for r in rows} == {1, 2, None}
    assert sum(not r["removed"] for r in rows if r["kind"] == "paragraph") == 1
    assert P.repeats(nothing).count() == 0


def test_every_occurrence_and_only_later_copies(frame):
    """All words of later copies are removed but those of units that stay, also where texts repeat themselves and spans overlap."""
    rng = random.Random(5)
    long = prose(rng, 160)
    said = prose(rng, 60)
    texts = [
        long[:70] + prose(rng, 9) + said + prose(rng, 30) + said,
        prose(rng, 12) + long[:110] + prose(rng, 5) + said + prose(rng, 40) + said + prose(rng, 3) + said,
        long[40:] + prose(rng, 20) + said,
        long[75:120] + long[60:] + prose(rng, 20),
    ]
    texts = [" ".join(t) for t in texts]
    places = defaultdict(list)
    for doc, text in enumerate(texts):
        _, first, h = P.winnowed(next(X.slices(pa.array([text]))))
        for start, one in zip(first.tolist(), h.tolist(), strict=True):
            places[one].append((doc, start))
    shared = [sorted(p) for p in places.values() if len({doc for doc, _ in p}) > 1]
    words = lambda units: {(doc, start + i) for doc, start in units for i in range(P.PASSAGE)}
    stay, later = words(p[0] for p in shared), words(u for p in shared for u in p[1:])
    assert stay & later
    rows = P.repeats(frame(texts)).where("kind = 'passage'").collect()
    got = {flag: [(r["doc_id"], r["start_word"] + i) for r in rows if r["removed"] == flag for i in range(r["n_words"])] for flag in (False, True)}
    assert all(len(g) == len(set(g)) for g in got.values())
    assert set(got[False]) == stay and set(got[True]) == later - stay
    assert {doc for doc, _ in got[True]} == {0, 1, 2, 3}
