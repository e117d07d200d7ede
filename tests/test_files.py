"""Text files by place, rejects, one ordered output file; exact medians and heavy keys without a full group in a task."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.operators import aggregates, clean, joins
from tallywind.sources import text

SCHEMA = T.StructType([T.StructField("instance_id", T.LongType()), T.StructField("v", T.StringType())])


@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 0])
def test_rows_are_numbered_as_they_stand(spark, tmp_path, broadcast_bytes):
    rng = random.Random(2)
    ids, whole = [], []
    for name in ("b.txt", "a.txt", "c.txt"):
        rows = [(rng.randint(0, 500), f"{name}{i}") for i in range(3000)]
        (tmp_path / name).write_text("instance_id v\n" + "".join(f"{i} {v}\n" for i, v in rows))
        ids.append((name, rows))
    for _, rows in sorted(ids):
        whole += rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")  # several blocks a file
    try:
        numbered = text.read_log_in_order(spark, str(tmp_path), SCHEMA, broadcast_bytes=broadcast_bytes)
        got = [(r["instance_id"], r["v"]) for r in numbered.orderBy("row_number").collect()]
        assert got == whole
        first = {}
        for i, v in whole:
            first.setdefault(i, v)
        kept = clean.dedupe_by(numbered, ["instance_id"], ["row_number"]).collect()
        assert {r["instance_id"]: r["v"] for r in kept} == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rejects_do_not_end_the_job(spark, tmp_path):
    lines = [f"{i} v{i}" for i in range(100)]
    lines[10], lines[20], lines[30] = "x v10", "20", "30 a b"
    (tmp_path / "log.txt").write_text("instance_id v\n" + "\n".join(lines) + "\n")
    good, rejects = text.read_log_checked(spark, str(tmp_path / "log.txt"), SCHEMA, most_rejected=0.05)
    assert sorted(r[0] for r in good.collect()) == [i for i in range(100) if i not in (10, 20, 30)]
    assert sorted((r["line"], r["reason"]) for r in rejects.collect()) == [("20", "1 fields, not 2"), ("30 a b", "3 fields, not 2"), ("x v10", "instance_id is x")]
    assert all(r["file"].endswith("log.txt") for r in rejects.collect())
    with pytest.raises(text.TooManyRejects, match="3 of 100"):
        text.read_log_checked(spark, str(tmp_path / "log.txt"), SCHEMA, most_rejected=0.02)


def test_one_file_as_pandas_writes_it(spark, tmp_path):
    rng = random.Random(4)
    scores = [rng.random() * 10 ** -rng.randint(0, 7) for _ in range(400)] + [0.0, 1.0, 1e-4, 2.5e-5, 1e-10, 0.001]
    rows = list(enumerate(scores))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "instance_id long, predicted_score double").repartition(6)
    path = tmp_path / "scores.txt"
    text.write_scores_file(df, str(path))
    pd.DataFrame(sorted(rows), columns=["instance_id", "predicted_score"]).to_csv(tmp_path / "pandas.txt", sep=" ", index=False)
    assert path.read_bytes() == (tmp_path / "pandas.txt").read_bytes()
    assert not (tmp_path / "scores.txt._parts").exists()
    with pytest.raises(Exception, match="exists"):
        text.write_scores_file(df, str(path))


@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 0])
def test_median_by_selection(spark, broadcast_bytes):
    rng = random.Random(6)
    rows = [("all", rng.gauss(0, 5)) for _ in range(1999)] + [("even", float(v)) for v in (4, 1, 3, 2)] + [("same", 2.5)] * 7 + [("none", None), (None, 1.0), ("one", -1.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {r["k"]: r["v_median"] for r in aggregates.group_median(df, "k", "v", broadcast_bytes=broadcast_bytes).collect()}
    want = {r["k"]: r["m"] for r in df.where("k is not null").groupBy("k").agg(F.median("v").alias("m")).where("m is not null").collect()}
    assert got == want
    table = {r["k"]: tuple(r)[1:] for r in aggregates.group_mean_median_std(df, "k", "v").collect()}
    assert table["none"] == (None, None, None) and table["even"][:2] == (2.5, 2.5) and table["one"] == (-1.0, -1.0, None)
    plan = aggregates.group_median(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "median" not in plan.replace("v_median", "") and "percentile" not in plan


def test_every_heavy_key_is_named(spark):
    """3,000 equally hot keys beside a tail of single ones, on many partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        df = spark.range(36_000).select(F.when(F.col("id") < 30_000, F.col("id") % 3000).otherwise(F.col("id")).alias("k"))
        assert joins.heavy_keys(df, ["k"]).rows == 3000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_left_join_deals_out_a_heavy_key(spark):
    rows = [(i, 1 if i % 2 else (None if i % 10 == 0 else i % 50), i % 3) for i in range(4000)]
    df = spark.createDataFrame(rows, "instance_id int, k int, l int")
    table = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (999, "e")], "k int, name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.left_join(df, table, ["k"])
        assert joined.columns == ["k", "instance_id", "l", "name"]
        assert sorted(map(str, joined.collect())) == sorted(map(str, df.join(table, "k", "left").collect()))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 0.5 * sum(sizes)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
