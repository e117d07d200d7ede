from __future__ import annotations

import pytest
from conftest import SF_DIR
from llm_fixtures import _importable, hostile, nothing  # noqa: F401
from pyspark.sql import functions as F
from test_ngram_join import brute
from test_packing import check_pieces

import corpus_pipeline as P
from tallywind.llm import bpe
from tallywind.llm.queries import QUERIES, vocabulary
from tallywind.storage import store

FOLDER = SF_DIR


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage made of its predecessor's documents, as written."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for _, stage in P.STAGES:
        made = store(stage(spark, docs, FOLDER)).df
        out.append((docs, made))
        docs = made
    return out


def test_all_but_the_last_keep_the_columns(stages):
    for docs, made in stages[:-1]:
        assert made.columns == ["doc_id", "text", "lang", "source", "n_chars"] and made.dtypes == docs.dtypes


def test_documents_in_a_language_stay(stages):
    docs, made = stages[0]
    assert made.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()


def test_one_of_each_group_stays(stages):
    docs, made = stages[1]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    groups = brute(texts)
    assert {r["doc_id"] for r in made.collect()} == {group for _, group in groups.values()}


def test_items_go_and_others_stay(spark, stages):
    docs, made = stages[2]
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet").select(F.col("text").alias("item"))
    held = docs.join(bench, F.contains("text", F.col("item"))).select("doc_id").distinct()
    gone = docs.join(made, "doc_id", "left_anti").select("doc_id")
    assert held.exceptAll(gone).count() == 0 and gone.count() <= held.count() + 1


def test_secrets_are_marked(stages):
    docs, made = stages[3]
    assert made.count() == docs.count()
    joined = made.join(docs.select("doc_id", F.col("text").alias("before")), "doc_id")
    had = F.col("before").rlike("[0-9a-f]{16}")
    assert joined.where(had & (~F.contains("text", F.lit("[secret]")) | F.col("text").rlike("[0-9a-f]{16}"))).count() == 0
    assert joined.where((F.col("text") != F.col("before")) & ~F.contains("text", F.lit("[secret]"))).count() == 0
    assert made.where("n_chars <> length(text)").count() == 0


def test_everything_is_packed(stages):
    docs, made = stages[4]
    check_pieces(made.collect(), {r["doc_id"]: r["text"] for r in docs.collect()}, bpe.encoder(vocabulary()))


def test_query_runs_all_stages(spark, stages):
    rows = QUERIES["pipeline"](spark, FOLDER)
    assert rows.select("doc_id", "piece", "ids_crc32").exceptAll(stages[4][1].select("doc_id", "piece", "ids_crc32")).count() == 0
    assert rows.count() == stages[4][1].count()


def test_odd_documents(spark, hostile, nothing):
    columns = ["doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"), "score", "kept", "length", "row"]
    for docs in (hostile.select(*columns), nothing.select(*columns)):
        for name, stage in P.STAGES:
            made = store(stage(spark, docs, FOLDER)).df
            if name == "ngram_jaccard_join":
                texts = [r["text"] for r in made.collect()]
                assert len(texts) == len(set(texts))
            if name != P.STAGES[-1][0]:
                assert made.columns == docs.columns
            docs = made
