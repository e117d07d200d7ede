from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from llm_fixtures import _importable, hostile, nothing  # noqa: F401
from pyspark.sql import functions as F

from tallywind.llm import bpe, packing
from tallywind.llm import text as X
from tallywind.llm.queries import QUERIES, vocabulary


@pytest.fixture(scope="module")
def coder():
    return bpe.encoder(vocabulary())


def test_ids_are_the_library_s(coder, monkeypatch):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "a", "bc", "Z", "é", "ß", "1", "23", "!", "#", "'t", "ve", "一", "٣", " ", "<|endoftext|>", "　", "😀", "͸"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    want = [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for slots in (bpe.SLOTS, 64):
        monkeypatch.setattr(bpe, "SLOTS", slots)
        fresh = bpe.Encoder(vocabulary())
        got = [ids.tolist() for piece in X.slices(pa.array(texts), 2000) for ids in fresh.encode(piece)]
        assert got == want


def check_pieces(rows, texts, coder, capacity=2048):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(n for _, n in spans) <= capacity
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], {})[r["piece"]] = r
    for doc, text in texts.items():
        ids = np.array([*coder.tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        mine = [pieces[doc][k] for k in range(len(pieces[doc]))]
        assert sum(p["length"] for p in mine) == len(ids) and all(p["length"] == capacity for p in mine[1:])
        for p in mine:
            assert zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"]
    return len(by_sequence)


def test_every_document_comes_back(spark, coder):
    rows = QUERIES["op2_best_fit_packing"](spark, SF_DIR).collect()
    docs = spark.read.parquet(SF_DIR + "/documents.parquet")
    used = check_pieces(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, coder)
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert used <= least + 1


def test_small_blocks_pack_well(spark):
    rng = random.Random(5)
    lengths = [min(64, max(1, int(rng.expovariate(1 / 20)))) for _ in range(1500)]
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length int")
    rows = packing.pack(items, capacity=64, block=200).collect()
    assert sorted(r["item"] for r in rows) == list(range(len(lengths)))
    spans = {}
    for r in rows:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], lengths[r["item"]]))
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:], strict=False)) and sum(n for _, n in s) <= 64
    assert len(spans) <= 1.02 * -(-sum(lengths) // 64)


def test_crossover_keeps_every_item_once():
    rng = random.Random(1)
    lengths = [rng.randint(1, 50) for _ in range(200)]
    population = packing.first_population(lengths, 64, rng)
    child = packing.crossover(population[0], population[1], lengths, 64, rng)
    assert sorted(i for content in child for i in content) == list(range(200))
    assert all(sum(lengths[i] for i in content) <= 64 for content in child)
    again = packing._unpacked(packing._packed(child, 200))
    assert sorted(map(sorted, again)) == sorted(map(sorted, child))


def test_odd_texts(hostile, nothing, coder):
    rows = packing.pack_texts(hostile.where("doc_id is not null and doc_id > 2").drop("lang"), vocabulary()).collect()
    texts = {r["doc_id"]: r["text"] for r in hostile.where("doc_id > 2").collect()}
    check_pieces(rows, texts, coder)
    assert {r["length"] for r in rows if r["doc_id"] in (3, 4)} == {1}
    everything = packing.pack_texts(hostile, vocabulary())
    assert everything.where("piece = 0").count() == hostile.count()
    assert everything.where(F.col("doc_id").isNull() & (F.col("piece") == 0)).count() == 2
    assert packing.pack_texts(nothing, vocabulary()).count() == 0
