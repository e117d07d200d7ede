"""Rows that are passed over many times lie in even parts of bounded size; rounds that every fit has are one fit."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallywind import storage
from tallywind.operators import boosting, models
from tallywind.plans import ensembles

FEATURES = ["a", "b"]
PARAMS = models.GBTParams(trees=6, depth=2, learning_rate=0.3)


@pytest.fixture(scope="module")
def parts(spark):
    log = spark.range(400).select(
        F.col("id").cast("int").alias("instance_id"), (F.col("id") % 7).cast("int").alias("a"), (F.col("id") % 11 / 11).alias("b"),
        ((F.col("id") * 37 % 101 < 20) | (F.col("id") % 7 > 4)).cast("int").alias("is_trade"), (F.col("id") % 4).cast("int").alias("day"),
    )
    data = storage.store(log).df
    return data.where("day < 3"), data.where("day = 3")


def sizes(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]


def test_uneven_files_are_dealt_evenly(spark):
    uneven = spark.range(45_000).union(spark.range(300)).union(spark.range(50)).coalesce(3)
    stored = storage.store(uneven)
    even = sizes(storage.dealt(stored, 100))
    assert sum(even) == 45_350 and len(even) == 3 and max(even) < 1.1 * min(even)
    wide = sizes(storage.dealt(stored, 1 << 17))
    assert sum(wide) == 45_350 and max(wide) * (1 << 17) < 1.2 * storage.PART_BYTES
    assert storage.dealt(small := storage.store(spark.range(9)), 1 << 30) is small.df


def test_jobs_side_by_side_share_the_cores(spark):
    stored = storage.store(spark.range(200_000))
    stored.rows  # noqa: B018
    parts = lambda _: storage.dealt(stored, 100).rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    alone = parts(0)
    assert alone == min(2 * cores, 10) and storage.side_by_side(parts, range(4)) == [min(10, -(-2 * cores // 4))] * 4
    assert storage.side_by_side(lambda _: storage.side_by_side(parts, range(2)), range(4)) == [[min(10, -(-2 * cores // 8))] * 2] * 4
    # The bytes of a part are bounded all the same, and later jobs have all cores again.
    wide = storage.side_by_side(lambda _: storage.dealt(stored, 1 << 13).count(), range(2))
    assert wide == [200_000] * 2 and storage.side_by_side(lambda _: storage.dealt(stored, 1 << 13).rdd.getNumPartitions(), range(8)) == [13] * 8
    assert parts(0) == alone


def test_the_regression_on_leaves_reads_bounded_parts(parts, monkeypatch):
    monkeypatch.setattr(storage, "SMALL_ROWS", 0)
    monkeypatch.setattr(storage, "PART_BYTES", 1 << 13)
    seen, fit = [], ensembles.LogisticRegression.fit
    monkeypatch.setattr(ensembles.LogisticRegression, "fit", lambda self, df: seen.extend(sizes(df)) or fit(self, df))
    train, valid = parts
    scored = ensembles.leaf_lr_scores(train, valid, FEATURES, PARAMS, max_iter=5)
    assert scored.count() == valid.count() and sum(seen) == train.count()
    assert max(seen) * models.row_width(PARAMS.trees + len(FEATURES)) < 2 * (1 << 13)


def test_first_rounds_are_one_fit(parts, monkeypatch):
    train, valid = parts
    rows, held = (models.training_rows(df, FEATURES) for df in parts)
    one_by_one = boosting.boost(rows, held, PARAMS, 6)
    grown, real = [], boosting.RandomForestRegressor
    monkeypatch.setattr(boosting, "RandomForestRegressor", lambda **kw: grown.append(kw["seed"]) or real(**kw))
    _, best, losses = models.fit_gbt_early_stop(train, valid, FEATURES, params=PARAMS)
    assert grown == [] and losses == pytest.approx(one_by_one.losses, abs=1e-9) and best == one_by_one.best
    # Five rounds at least with a patience of four, in one fit; the others follow one by one.
    _, best, losses = models.fit_gbt_early_stop(train, valid, FEATURES, params=PARAMS, patience=4, most=8)
    assert len(grown) <= 8 - 5 and losses[:6] == pytest.approx(one_by_one.losses[: len(losses)], abs=1e-9)
    # Sampled rows are drawn by their numbers, one tree at a time, as before.
    models.fit_gbt_early_stop(train, valid, FEATURES, params=models.GBTParams(trees=2, depth=2, subsample=0.8))
    assert grown[-2:] == [2018, 2019]
