from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tallywind.llm.registry import importable

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        # Names that operators give their own columns.
        T.StructField("score", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("length", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("row", T.StringType()),
    ]
)
WORDS = "the of and river stone light walks under seven green clouds while old birds sing softly near water gate".split()
PROSE = " ".join(WORDS * 6)
ROWS = [
    (1, PROSE, "en"),
    (1, PROSE, "en"),
    (2, PROSE, None),
    (None, PROSE + " and more", "en"),
    (None, None, None),
    (3, None, "en"),
    (4, "", "en"),
    (5, " \n\t \x0b", None),
    (6, "123 !!", "xx"),
    (7, "one", "xx"),
    (8, "中文 अर Été \U0001f600", "zh"),
    (9, "long " + "word%d " * 3 + "x" * 200_000, "en"),
    (10, " ".join(f"w{i % 977}" for i in range(60_000)), "en"),
    (11, "null\x00byte mark <|endoftext|> it's", "en"),
]


@pytest.fixture(scope="session", autouse=True)
def _importable(spark):
    importable(spark)


@pytest.fixture(scope="session")
def hostile(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing names."""
    return spark.createDataFrame([(*r, "a", "b", "c", None, "e", None) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def frame(spark):
    def make(texts, first=0):
        return spark.createDataFrame([(i, t) for i, t in enumerate(texts, first)], "doc_id long, text string").repartition(3)

    return make
