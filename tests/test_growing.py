"""Trees grown on blocks of binned rows: those of Spark ML, the same in one task and on many, without jobs for each level."""

from __future__ import annotations

import random
import threading
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywind.operators import boosting, growing, models, trees
from tallywind.plans import cross_features, ensembles
from tallywind.schema import DayPlan
from tallywind.storage import store

FEATURES = ["a", "b", "c", "same"]
PARAMS = models.GBTParams(trees=9, depth=4, learning_rate=0.3)
SAMPLED = replace(PARAMS, subsample=0.7, colsample=0.6)


@pytest.fixture(scope="module")
def parts(spark):
    rng = random.Random(11)
    rows = []
    for i in range(1500):
        a, b = rng.randint(0, 4), rng.random() if i % 9 else None
        p = 0.8 if a in (0, 2, 4) else 0.3 * (b or 1.0)
        rows.append((i, a if i % 31 else None, b, rng.choice([0.0, 0.0, -1.5, 2.0]), int(rng.random() < p) if i % 40 else None, 1 + i % 6))
    data = store(spark.createDataFrame(rows, "instance_id int, a int, b double, c double, is_trade int, day int").withColumn("same", F.lit(3)).repartition(3)).df
    return data.where("day < 6"), data.where("day = 6")


def scores(scorer, df):
    return [r[0] for r in models.predict_proba(scorer, df).orderBy("instance_id").select("predicted_score").collect()]


def jobs(spark, fn):
    """How many jobs ``fn`` starts in this thread."""
    group = f"counted-{threading.get_ident()}-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        fn()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("categories", [None, {"a": 5}])
def test_trees_are_those_of_spark_ml(parts, categories):
    train, valid = parts
    ours, theirs = (fit(train, FEATURES, params=PARAMS, categories=categories) for fit in (models.fit_blocks, models.fit_gbt))
    assert scores(ours, valid) == pytest.approx(scores(theirs, valid), abs=1e-9)
    assert ours.model.getNumTrees == 9 and ours.model.numFeatures == 4
    assert ours.model.featureImportances.toArray() == pytest.approx(theirs.model.featureImportances.toArray(), abs=1e-6)


def test_leaf_size_and_gain_are_kept(parts):
    train, valid = parts
    strict = replace(PARAMS, min_leaf=60, min_gain=0.002, bins=8)
    assert scores(models.fit_blocks(train, FEATURES, params=strict), valid) == pytest.approx(scores(models.fit_gbt(train, FEATURES, params=strict), valid), abs=1e-9)


@pytest.mark.parametrize("params", [PARAMS, SAMPLED])
def test_one_task_and_many_grow_the_same(parts, params, monkeypatch):
    train, valid = parts
    one = growing.grow_ensemble(train, valid, FEATURES, params, 9, "is_trade", {"a": 5})
    monkeypatch.setattr(growing, "LOCAL_BYTES", 0)
    monkeypatch.setattr(growing, "CUT", 4)
    monkeypatch.setattr(growing, "_in_one_task", lambda *_: pytest.fail("one task"))
    many = growing.grow_ensemble(train, valid, FEATURES, params, 9, "is_trade", {"a": 5})
    assert len(one.grown.trees) == len(many.grown.trees) == 9
    for ours, theirs in zip(one.grown.trees, many.grown.trees, strict=True):
        assert (ours.feature == theirs.feature).all() and (ours.left == theirs.left).all() and (ours.turns == theirs.turns).all()
        assert ours.value == pytest.approx(theirs.value, abs=1e-12)
    assert one.grown.losses == pytest.approx(many.grown.losses, abs=1e-12)
    assert [one.grown.accuracy(n) for n in (1, 9)] == [many.grown.accuracy(n) for n in (1, 9)]


def test_losses_and_accuracy_are_those_of_the_model(parts):
    train, valid = parts
    grown = growing.grow_ensemble(train, valid, FEATURES, SAMPLED, 5, "is_trade")
    scored = models.predict(models.Scorer(grown.model(train.sparkSession, 4), tuple(FEATURES)), valid.where("is_trade is not null"))
    assert grown.grown.accuracy(4) == pytest.approx(scored.agg(F.avg((F.col("prediction") == F.col("is_trade")).cast("double"))).first()[0])


def test_jobs_do_not_grow_with_the_trees(spark, parts):
    few, many = (jobs(spark, lambda n=n: models.fit_blocks(parts[0], FEATURES, params=replace(PARAMS, trees=n))) for n in (2, 12))
    assert few == many


def test_bases_of_the_stack_grow_on_blocks(spark, parts, monkeypatch):
    monkeypatch.setattr(models, "gbt", lambda *_, **__: pytest.fail("a job for every level"))
    train, valid = parts
    bases = {n: ensembles.default_bases(replace(PARAMS, trees=3))[n] for n in ("shallow", "deep")}
    _, blended = models.blend(train.where("is_trade is not null"), valid, bases, FEATURES, k=2)
    assert blended.select("shallow", "deep").na.drop().count() == valid.count()


def test_the_grid_grows_on_blocks(parts, monkeypatch):
    monkeypatch.setattr(models, "gbt", lambda *_, **__: pytest.fail("a job for every level"))
    best, means = models.grid_by_trees(parts[0], FEATURES, (2, 5), PARAMS, k=3)
    assert [n for n, _ in means] == [2, 5] and best.model.getNumTrees == max(means, key=lambda m: (m[1], -m[0]))[0]


def test_rounds_after_the_first_grow_on_blocks(parts, monkeypatch):
    monkeypatch.setattr(boosting, "RandomForestRegressor", lambda **_: pytest.fail("one by one"))
    monkeypatch.setattr(models, "gbt", lambda *_, **__: pytest.fail("a job for every level"))
    train, valid = parts
    slow = replace(SAMPLED, learning_rate=0.05)
    _, best, losses = models.fit_gbt_early_stop(train, valid, FEATURES, params=slow, patience=4, most=60, refit_on=train)
    assert len(losses) > 6 and (len(losses) == best + 4 or len(losses) == 60) and losses[best - 1] == min(losses)


def test_cross_features_are_worked_out_once(spark, parts, monkeypatch):
    train, valid = parts
    features = train.unionByName(valid).unionByName(train.limit(30).withColumns({"is_trade": F.lit(None).cast("int"), "instance_id": F.col("instance_id") + 5000}))
    written = []
    monkeypatch.setattr(cross_features, "store", lambda df: written.append(df) or store(df))
    plan = DayPlan(first=1, train=(4, 5), valid=6, test=7)
    ids = features.where("is_trade is null").select("instance_id")
    scored = cross_features.score_cross_features(features, ids, plan, replace(SAMPLED, trees=3), patience=2)
    assert written == [features] and scored.count() == ids.count()


def test_no_rows_are_an_error(parts):
    train, valid = parts
    with pytest.raises(ValueError, match="no labelled row"):
        models.fit_blocks(train.where("is_trade is null"), FEATURES, params=PARAMS)
    with pytest.raises(Exception, match="no row to measure"):
        growing.grow_ensemble(train, valid.where("false"), FEATURES, PARAMS, 9, "is_trade", patience=2)


def test_columns_by_name():
    assert [trees.columns_of(c, 22) for c in ("all", "auto", 1.0, "sqrt", "onethird", "log2", 0.7, 3, 99)] == [None, None, None, 5, 8, 5, 16, 3, None]
    with pytest.raises(ValueError):
        trees.columns_of(1.5, 22)


@pytest.mark.parametrize("bins", [4, 32])
def test_counts_are_exact(bins):
    rng = np.random.default_rng(1)
    n, f = 9000, 5
    x = rng.integers(0, bins, (f, n)).astype(np.uint8)
    chunk = trees.Chunk(x, rng.integers(0, 2, n).astype(float), rng.random(n) < 0.2, np.arange(n), rng.normal(size=n) * 50)
    chunk.begin(1, trees.Settings(3, 0.1, 0.8, None, 1, 0.0, 7))
    chunk.node = rng.integers(0, 4, n)
    got = chunk.counts(np.array([1, -1, 0, 2]), 3, bins)
    whole = np.rint(chunk.target * trees.SCALE)
    for slot, node in ((1, 0), (0, 2), (2, 3)):
        at = np.intersect1d(chunk.drawn, np.flatnonzero(chunk.node == node))
        for j in range(f):
            assert (got[0, slot, j] == np.bincount(x[j][at], minlength=bins)).all()
            assert got[1, slot, j].tolist() == [whole[at][x[j][at] == b].sum() for b in range(bins)]
