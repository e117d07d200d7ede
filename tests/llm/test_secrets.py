from __future__ import annotations

import base64
import hashlib
import random
import re

import duckdb
import pandas as pd
from conftest import SF_DIR
from llm_fixtures import _importable, frame, hostile, nothing  # noqa: F401
from pyspark.sql import functions as F

from tallywind.llm import secrets as S
from tallywind.llm.queries import SECRETS_SQL

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_spans(t):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out)


def written(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)


def crafted(seed=4, n=400):
    rng = random.Random(seed)
    parts = ["token", "Secret", "API_KEY", "apikey", "password", "=", " = ", ": ", ":", '"', "'", " ", "\n", "AKIA", "ABCDEFGHIJKL0123", "AKIAAKIA", "abcdef0123456789", "deadbeef",
             "hunter2-long.value", "😀", "é", "", "", "", "x", "secret: token: abcdefghijklmn", "ſecret", "$1", "\\"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_base_spans_are_those_of_python_s_patterns(frame):
    texts = crafted()
    rows = {r["doc_id"]: r for r in S.scan(frame(texts), {}).collect()}
    for i, t in enumerate(texts):
        want = plain_spans(t)
        assert rows[i]["spans"] == written(want)
        assert rows[i]["base_sha256"] == hashlib.sha256(written(want).encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in S.KINDS[:3]] == [sum(s[2] == k for s in want) for k in S.KINDS[:3]]


def test_a_long_text_of_many_matches(frame):
    texts = ["é token=" + " token=".join(f"{i:014x}-value AKIAABCDEFGH{i:08d}" for i in range(6000)), "x" * 2_000_000, "deadbeef01234567"]
    rows = {r["doc_id"]: r for r in S.scan(frame(texts), {}).collect()}
    assert [rows[i]["spans"] for i in range(3)] == [written(plain_spans(t)) for t in texts]


def test_the_battery_adds_random_tokens_and_leaves_words(spark, frame):
    rng = random.Random(6)
    keys = [base64.b64encode(rng.randbytes(36)).decode() for _ in range(40)]
    slugs = ["the-best-offers-of-the-year-2024", "conference2019proceedings", "aaaaaaaaaaaaaaaaaaaa1111111111", "version-1-0-release-candidate", "internationalization18characters"]
    texts = [f"some words {k} and more" for k in keys] + [f"see {rng.choice(slugs)} here" for _ in range(400)]
    docs = frame(texts)
    levels = S.discovery_levels(docs)
    rows = {r["doc_id"]: r["spans"] for r in S.scan(docs, levels).collect()}
    found = sum("random:11:" in rows[i] for i in range(40))
    assert found >= 36
    assert not [i for i in range(40, 440) if "random" in rows[i]]


def test_sql_says_the_same(frame):
    rng = random.Random(8)
    texts = crafted(7, 200) + [f"some words {base64.b64encode(rng.randbytes(36)).decode()} and more" for _ in range(20)] + ["see best-offers-of-the-year-2024"] * 100
    docs = frame(texts)
    rows = S.scan(docs, S.discovery_levels(docs)).drop("text", "secret_spans").collect()
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    db = duckdb.connect()
    db.register("documents", documents)
    want = sorted(db.execute(f"select doc_id, n_assign, n_access, n_hex, base_sha256, spans from ({SECRETS_SQL})").fetchall())
    assert sorted(tuple(r) for r in rows) == want
    assert any("random" in r["spans"] for r in rows)


def test_native_plan(spark):
    docs = spark.read.parquet(SF_DIR + "/documents.parquet")
    text = S.scan(docs, {5: 30})._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "ArrowEval", "MapIn") if w in text]


def test_redaction(spark):
    df = spark.sql("select 'a secret b c' as t, array(named_struct('start', 2, 'end', 8), named_struct('start', 4, 'end', 10)) as s")
    assert df.select(S.redacted(F.col("t"), F.col("s"))).first()[0] == "a [secret] c"


def test_odd_texts(hostile, nothing):
    rows = S.scan(hostile, S.discovery_levels(hostile)).collect()
    assert len(rows) == hostile.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r["base_sha256"] == empty and r["spans"] == "" for r in rows if r["doc_id"] in (3, 4))
    assert S.discovery_levels(nothing) == {} and S.scan(nothing, {}).count() == 0
