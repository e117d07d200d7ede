from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_DIR
from llm_fixtures import _importable, frame, hostile, nothing  # noqa: F401
from pyspark.sql import functions as F

from tallywind.llm import lm, rnn
from tallywind.llm.components import shared
from tallywind.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), "\n"]


def test_gradients_by_differences(monkeypatch):
    monkeypatch.setattr(rnn, "FLOAT", np.float64)
    net = rnn.Net(5, 3, 4, 1)
    net.params = {k: p.astype(float) for k, p in net.params.items()}
    rng = np.random.default_rng(0)
    window = rng.integers(0, 14, (6, 3)), rng.random((6, 3)) < 0.2, rng.integers(0, 13, (6, 3)), rng.random((6, 3)) < 0.9, rng.standard_normal((3, 5))
    grads = net.gradient(*window)[2]
    for name, p in net.params.items():
        for i in rng.integers(0, p.size, 6):
            old = p.flat[i]
            p.flat[i] = old + 1e-5
            more = net.gradient(*window)[0]
            p.flat[i] = old - 1e-5
            less = net.gradient(*window)[0]
            p.flat[i] = old
            assert abs((more - less) / 2e-5 - grads[name].flat[i]) < 1e-6


def plain_score(net: rnn.Net, words) -> float:
    """One text, one token at a time."""
    p, n = {k: v.astype(float) for k, v in net.params.items()}, net.hidden
    h, total, at = np.zeros(n), 0.0, net.opening
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for w in words:
        x, a = p["x"][at], h @ p["u"]
        z, r = sigmoid(x[:n] + a[:n]), sigmoid(x[n : 2 * n] + a[n : 2 * n])
        c = np.tanh(x[2 * n :] + r * a[2 * n :])
        h = (1 - z) * c + z * h
        group = min(w // net.width, net.classes)
        logits = h @ p["wc"] + p["bc"]
        total += logits[group] - np.log(np.exp(logits).sum())
        if group < net.classes:
            logits = h @ p["ww"][group] + p["bw"][group]
            total += logits[w % net.width] - np.log(np.exp(logits).sum())
        at = w
    return total


def test_lanes_carry_states_through_whole_texts():
    net = rnn.Net(6, 3, 5, 2)
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 16, n) for n in [1, 2, 300, 7, 31, 32, 33, 5, 1, 64, 150, 3]]
    got = dict(rnn.score(net, enumerate(texts), lanes=3, steps=8))
    assert len(got) == len(texts)
    for i, words in enumerate(texts):
        assert got[i] == pytest.approx(plain_score(net, words), abs=1e-3)


def test_training_lowers_the_loss():
    rng = np.random.default_rng(2)
    texts = [np.tile(rng.integers(0, 12, 3), 40) for _ in range(60)]
    net = rnn.Net(16, 3, 4)
    before = sum(v for _, v in rnn.score(net, enumerate(texts), 8, 16))
    for _ in range(3):
        rnn.train(net, iter(texts), 8, 16, 0.02)
    assert sum(v for _, v in rnn.score(net, enumerate(texts), 8, 16)) > 0.7 * before


@pytest.mark.parametrize("hot", [lm.HOT, 600])
def test_counts_and_base_are_exact(spark, hot):
    docs = spark.read.parquet(SF_DIR + "/documents.parquet")
    docs = docs.select("doc_id", ((F.crc32(F.col("doc_id").cast("string")) % 7) == 2).alias("held_out"), "text")
    rows = {r["doc_id"]: r for r in lm.score_texts(docs, docs.where("not held_out"), ["doc_id", "held_out"], hot=hot).collect()}
    texts = {r["doc_id"]: tokens(r["text"]) for r in docs.collect()}
    counts = Counter(w for k, t in texts.items() if zlib.crc32(str(k).encode()) % 7 != 2 for w in t)
    total = sum(counts.values())
    for k, t in texts.items():
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in t)
        assert (rows[k]["n_tokens"], rows[k]["n_known"], rows[k]["train_tokens"]) == (len(t), sum(counts[w] > 0 for w in t), total)
        assert rows[k]["base_score"] == pytest.approx(base, rel=1e-9)


def test_other_words_get_a_proper_share(spark, frame):
    """The shares of all words after one history add up to one."""
    docs = frame(["a b c d e f g", "a a b b c h i j", "k l m n o p"])
    counts = lm.token_counts(docs)
    v = lm.vocabulary(counts, words=4, hot=6)
    inside = {r["h"]: r["c"] for r in counts.collect()}
    hot, c, number = v.find(np.array(list(inside), dtype=np.int64).view(np.uint64))
    others = [n for n, w in zip(inside.values(), number, strict=True) if w == v.words]
    unseen = 10 ** v.among_others(0)
    assert sum(10 ** v.among_others(n) for n in others) + unseen == pytest.approx(1)


def test_held_out_texts_are_better_than_the_base(spark):
    out = QUERIES["op4_lm_scoring"](spark, SF_DIR.replace("0.001", "0.01"))
    score, base = out.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert base < score < 0


def test_odd_texts(spark, hostile, nothing):
    rows = lm.score_texts(hostile, hostile, ["doc_id", "kept"]).collect()
    assert len(rows) == hostile.count() and all(r["score"] < 0 and r["kept"] == "b" for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4, 5)} == {1}
    untrained = lm.score_texts(hostile, nothing, ["doc_id"]).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in untrained} == {(0, 0)}
    assert lm.score_texts(nothing, hostile, ["doc_id"]).count() == 0
    assert shared(spark, 1).value == 1


def test_rare_tokens_of_a_slice_at_once():
    rng = np.random.default_rng(5)
    for n in (0, 1, 40):
        h, hot = rng.integers(0, 1 << 64, 9, dtype=np.uint64)[rng.integers(0, 9, n)], rng.random(n) < 0.4
        bounds = np.concatenate([[0], np.sort(rng.integers(0, n + 1, 5)), [n]])
        odd, times, cuts = lm.rare_tokens(h, hot, bounds)
        for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            expected = np.unique(h[a:b][~hot[a:b]].view(np.int64), return_counts=True)
            assert (odd[cuts[r] : cuts[r + 1]].tolist(), times[cuts[r] : cuts[r + 1]].tolist()) == tuple(e.tolist() for e in expected)


def test_lanes_last_give_the_states_of_lanes_first():
    net = rnn.Net(5, 3, 4, 1)
    rng = np.random.default_rng(2)
    inputs, fresh, h = rng.integers(0, 14, (6, 3)), rng.random((6, 3)) < 0.2, rng.standard_normal((3, 5)).astype(np.float32)
    states, last, _ = net.forward(inputs, fresh, h)
    for lane in range(3):
        alone = net.forward(inputs[:, [lane]], fresh[:, [lane]], h[[lane]])
        assert np.allclose(states[:, lane], alone[0][:, 0], atol=1e-6) and np.allclose(last[lane], alone[1][0], atol=1e-6)
