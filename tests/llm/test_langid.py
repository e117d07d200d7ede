from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from conftest import SF_DIR
from llm_fixtures import _importable, hostile, nothing  # noqa: F401
from pyspark.sql import functions as F

from tallywind.llm import langid
from tallywind.llm import text as X
from tallywind.llm.queries import QUERIES


def plain_code_length(training: list[bytes], text: bytes) -> float:
    """Prediction by partial matching, method C, a byte at a time."""
    follow = defaultdict(Counter)
    pad = bytes(langid.ORDER)
    for t in training:
        t = pad + t
        for i in range(langid.ORDER, len(t)):
            for k in range(langid.ORDER + 1):
                follow[(k, t[i - k : i])][t[i]] += 1
    bits, t = 0.0, pad + text
    for i in range(langid.ORDER, len(t)):
        for k in range(langid.ORDER, -1, -1):
            seen = follow.get((k, t[i - k : i]))
            if seen is None:
                continue
            total, distinct = sum(seen.values()), len(seen)
            if t[i] in seen:
                bits -= math.log2(seen[t[i]] / (total + distinct))
                break
            bits -= math.log2(distinct / (total + distinct))
        else:
            bits += 8
    return bits


def slice_of(texts):
    return next(X.slices(pa.array(texts)))


def test_code_lengths_are_those_of_a_plain_coder():
    training = ["the rain in spain", "a plain Train", "ÉTÉ été the"]
    codes = langid.contexts(slice_of(training))
    values, n = np.unique(codes, return_counts=True)
    model = langid.Model(["x"], [langid.Tree.grow(values, n.astype(float))])
    texts = ["the train", "rain!", "", "zebra été", "a" * 50]
    piece = slice_of(texts)
    bits = langid.Coder(model).bits(langid.contexts(piece), piece.offsets)[:, 0]
    fold = lambda t: langid.fold(np.frombuffer(t.encode(), dtype=np.uint8)).tobytes()
    want = [plain_code_length([fold(t) for t in training], fold(t)) for t in texts]
    assert np.allclose(bits, want)


def test_remembered_code_lengths_do_not_change(monkeypatch):
    """A table with few slots, where codes push each other out, gives what a large one gives."""
    texts = [f"alpha {i} beta gamma delta {i * 7919}xyz" + chr(97 + i % 26) * 3 for i in range(300)]
    piece = slice_of(texts)
    values, n = np.unique(langid.contexts(piece), return_counts=True)
    model = langid.Model(["x"], [langid.Tree.grow(values[::2], n[::2].astype(float))])
    want = langid.Coder(model).bits(langid.contexts(piece), piece.offsets)
    monkeypatch.setattr(langid, "CACHE_SLOTS", 64)
    small = langid.Coder(model)
    for _ in range(3):
        assert np.allclose(small.bits(langid.contexts(piece), piece.offsets), want)


def test_held_out_accuracy(spark):
    out = QUERIES["op1_language_id"](spark, SF_DIR.replace("0.001", "0.01"))
    docs = spark.read.parquet(SF_DIR.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "lang")
    right = out.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    assert out.count() == 1000 and out.where("score < 0 or score > 1").count() == 0


def test_odd_texts(spark, hostile, nothing):
    model = langid.fit(hostile)
    assert model.languages == ["en", "xx", "zh"]
    rows = langid.identify(hostile, model).collect()
    assert len(rows) == hostile.count()
    by_text = {r["text"]: r for r in rows}
    for t in (None, "", " \n\t \x0b", "123 !!"):
        assert by_text[t]["lang_pred"] == langid.UNKNOWN and by_text[t]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert langid.identify(nothing, model).count() == 0
    blank = langid.fit(nothing)
    assert {r["lang_pred"] for r in langid.identify(hostile, blank).collect()} == {langid.UNKNOWN}


def test_workers_keep_no_coder_for_later_stages(spark, hostile):
    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(langid._coders)], pa.int64())], names=["n"])

    langid.identify(hostile, langid.fit(hostile)).count()
    langid.identify(hostile, langid.fit(hostile)).select("lang_pred").collect()
    later = spark.range(64).repartition(8).mapInArrow(held, "n long").collect()
    assert later and all(r["n"] == 0 for r in later)
