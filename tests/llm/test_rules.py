from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from conftest import SF_DIR
from llm_fixtures import _importable, hostile, nothing  # noqa: F401

from tallywind.llm import rules as R
from tallywind.llm import text as X


def plain(text):
    words = [w for w in text.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    cover = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(cover)]


def test_base_measures():
    texts = ["a b c a b c", "x\nx\n\n \n x\nx", "", "é ü 😀 # <>", "a b c d\na b c d\n", "one", "a a a a a", "\r\n\x0b", "a\n", "\n\n"]
    piece = next(X.slices(pa.array(texts)))
    got = R.base_measures(piece)
    assert [[int(got[k][i]) for k in R.BASE] for i in range(len(texts))] == [plain(t) for t in texts]


def test_order_changes_no_verdict(spark):
    docs = spark.read.parquet(SF_DIR + "/documents.parquet")
    orders = [R.RULES, R.RULES[::-1], R.ordered_rules(docs)]
    verdicts = [{r["doc_id"]: r["kept"] for r in R.judge(docs, order).select("doc_id", "kept").collect()} for order in orders]
    assert all(a == b for a, b in itertools.pairwise(verdicts))
    assert {r.name for r in orders[2]} == {r.name for r in R.RULES}


def test_cascade_order_is_by_rejections_per_cost():
    estimates = {r.name: (1.0, 0.0) for r in R.RULES} | {"digits_of_bytes": (0.1, 0.2), "mean_word_length": (1.0, 0.9)}
    assert [r.name for r in R.cascade_order(estimates)][:2] == ["digits_of_bytes", "mean_word_length"]


def test_later_rules_see_only_what_is_left(spark):
    seen = []

    def count(piece):
        seen.append(piece.rows)
        return np.ones(piece.rows, dtype=np.int64), np.ones(piece.rows, dtype=np.int64)

    piece = next(X.slices(pa.array(["abc def", "ghi", "jkl mno"])))
    left = R.subset(piece, np.array([0, 2]))
    R.Rule("all", count).passes(left)
    assert seen == [2] and [left.text(i) for i in range(2)] == ["abc def", "jkl mno"]


def test_odd_texts(hostile, nothing):
    rows = R.judge(hostile, R.ordered_rules(hostile)).collect()
    assert len(rows) == hostile.count()
    assert all(r["base_failed"] and not r["kept"] and r["n_words"] == 0 for r in rows if r["doc_id"] in (3, 4, 5))
    assert R.judge(nothing, R.ordered_rules(nothing)).count() == 0
