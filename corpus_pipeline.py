"""A corpus from raw documents to packed sequences: five stages, each over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir); ``docs`` has the columns of ``documents`` and so has what a stage gives, but for
the last one. Between stages the documents are written to the shared folder and read again.

- Documents in no language go: no letter, or none of the languages learned from the labelled documents makes the text
  shorter. A missing language is filled in.
- Of near copies the one with the least id stays; of rows alike in id and text one.
- Documents that hold a benchmark item go.
- Secrets in texts are put in for a mark; no document goes.
- Texts become token pieces in sequences.

Null texts are in no language and go with the first stage; null ids are kept as they are; an empty table stays empty.
Other columns of ``docs`` are passed on but for names that begin with an underscore.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywind.llm import decontam, langid, ngram_join, packing, secrets
from tallywind.llm.queries import vocabulary
from tallywind.llm.registry import importable, table
from tallywind.storage import shared_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    found = langid.identify(docs, langid.fit(docs)).where(~langid.rejected(F.col("lang_pred"), F.col("bits_per_byte")))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    # Ids may be missing or repeat: a document is known by its id and text, one without an id comes last.
    keyed = docs.withColumn("_key", F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("x")))
    groups = ngram_join.similarity_groups(keyed, "_key")
    stays = groups.where(F.col("_key") == F.col("component_id")).select("_key")
    return keyed.join(stays, "_key", "left_semi").dropDuplicates(["_key"]).select(docs.columns)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return decontam.without_items(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def secret_marks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.scan(docs, secrets.discovery_levels(docs))
    text = secrets.redacted(F.col("text"), F.col("secret_spans"))
    changed = F.size("secret_spans") > 0
    return found.withColumns({"text": text, "n_chars": F.when(changed, F.length(text)).otherwise(F.col("n_chars"))}).select(docs.columns)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return packing.pack_texts(docs.select("doc_id", "text"), vocabulary())


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark_items),
    ("secret_scans", secret_marks),
    ("best_fit_packing", best_fit),
]

#: Models, components and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: one row per token piece."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
