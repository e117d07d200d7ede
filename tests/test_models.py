"""Models on data with a planted signal."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tallywind.operators import encode, evaluate, models
from tallywind.plans import baseline, cross_features, ensembles, point_in_time
from tallywind.sources.standin import PLAN, raw_log
from tallywind.storage import store

FEATURES = ["a", "b", "noise"]
SMALL = models.GBTParams(trees=6, depth=2)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        a, b = rng.randint(0, 9), rng.random()
        p = 0.85 if a >= 5 else 0.1
        rows.append((i, a, b if i % 50 else None, rng.random(), int(rng.random() < p), 18 + i % 7))
    return store(spark.createDataFrame(rows, "instance_id int, a int, b double, noise double, is_trade int, day int")).df


@pytest.fixture(scope="module")
def parts(data):
    return data.filter("day < 24"), data.filter("day = 24")


def constant_loss(df):
    rate = df.agg(F.avg("is_trade")).first()[0]
    return -(rate * math.log(rate) + (1 - rate) * math.log(1 - rate))


def loss(df):
    return evaluate.log_loss(df).first()[0]


FITS = {
    "gbt": lambda train: models.fit_gbt(train, FEATURES, params=SMALL),
    "lr": lambda train: models.fit_lr(train, FEATURES),
}


@pytest.mark.parametrize("name", list(FITS))
def test_models_beat_the_constant_rate(parts, name):
    train, valid = parts
    scored = models.predict_proba(FITS[name](train), valid)
    assert scored.count() == valid.count()
    assert scored.filter("predicted_score < 0 or predicted_score > 1 or predicted_score is null").count() == 0
    assert loss(scored) < constant_loss(valid)
    assert evaluate.roc_auc(scored).first()[0] > 0.7


def test_same_seed_same_scores(parts):
    train, valid = parts
    once, again = (models.predict_proba(models.fit_gbt(train, FEATURES, params=SMALL), valid).collect() for _ in range(2))
    assert sorted(once) == sorted(again)


def test_early_stop_takes_the_best_tree_count(parts):
    train, valid = parts
    scorer, best, losses = models.fit_gbt_early_stop(train, valid, FEATURES, params=models.GBTParams(trees=12, depth=4), refit_on=train.unionByName(valid))
    assert len(losses) == 12 and losses[best - 1] == min(losses)
    assert scorer.model.getNumTrees == best


def test_importance_and_selection(parts):
    train, valid = parts
    scorer = models.fit_gbt(train, FEATURES, params=SMALL)
    table = models.feature_importance(scorer, train).collect()
    assert table[0]["n"] == "a" and sum(r["s"] for r in table) == pytest.approx(1)
    sliced, kept = encode.select_by_importance(scorer.vectors(valid), scorer.model, FEATURES)
    assert kept == ["a"] and len(sliced.first()["selected"]) == 1


def test_accuracy_of_hard_classes(parts):
    train, valid = parts
    assert evaluate.accuracy(models.predict(models.fit_gbt(train, FEATURES, params=SMALL), valid)).first()[0] > 0.7


def test_factorization_machine(parts):
    train, valid = parts
    scored = ensembles.fm_scores(train.na.fill(0), valid.na.fill(0), FEATURES, max_iter=30)
    assert scored.count() == valid.count()
    assert scored.filter("predicted_score between 0 and 1").count() == valid.count()


@pytest.mark.parametrize("with_raw", [True, False])
def test_leaves_with_regression(parts, with_raw):
    train, valid = parts
    scored = ensembles.leaf_lr_scores(train, valid, FEATURES, SMALL, with_raw=with_raw, max_iter=20)
    assert scored.count() == valid.count() and loss(scored) < constant_loss(valid)


def test_stacking_scores_every_row(parts):
    train, valid = parts
    bases = {n: ensembles.default_bases(SMALL)[n] for n in ("shallow", "linear")}
    oof, blended = models.blend(train, valid, bases, FEATURES, k=3)
    assert oof.count() == train.count() and oof.select("instance_id").distinct().count() == train.count()
    assert blended.select("shallow", "linear").na.drop().count() == valid.count()
    scored = ensembles.stacked_scores(train, valid, FEATURES, bases, k=3)
    assert scored.count() == valid.count() and loss(scored) < constant_loss(valid)


def test_grid_search_reports_every_setting(parts):
    train, valid = parts
    best, settings = models.grid_search(train, FEATURES, {"maxIter": [1, 5], "maxDepth": [1, 3]}, estimator=models.gbt(SMALL), k=2)
    assert len(settings) == 4 and all(0 <= metric <= 1 for _, metric in settings)
    assert models.predict(best, valid).count() == valid.count()


def test_standardize(data):
    scaled = encode.standardize(data, ["a"]).agg(F.avg("a").alias("m"), F.stddev_pop("a").alias("s")).first()
    assert scaled["m"] == pytest.approx(0, abs=1e-9) and scaled["s"] == pytest.approx(1)
    flat = encode.standardize(data.withColumn("a", F.lit(3)), ["a"])
    assert {r[0] for r in flat.select("a").distinct().collect()} == {0.0}


def test_plans_score_every_row(spark):
    raw = raw_log(spark, "/root/testdata/sf0.001")
    small = models.GBTParams(trees=2, depth=2)
    features = store(baseline.baseline_features(raw)).df
    assert baseline.score_baseline(features, PLAN, online=False, params=small).count() == features.filter(F.col("day") == PLAN.valid).count()
    table = store(point_in_time.point_in_time_features(raw, PLAN)).df
    _, valid, test = point_in_time.score_point_in_time(table, PLAN, small, patience=2)
    assert valid.count() == table.filter(F.col("day") == PLAN.valid).count()
    assert test.count() == table.filter(F.col("day") == PLAN.test).count()
    crossed = store(cross_features.cross_features(raw, PLAN)).df
    ids = raw.filter("is_trade is null").select("instance_id").distinct()
    scores = cross_features.score_cross_features(crossed, ids, PLAN, small, patience=2)
    assert scores.count() == ids.count() and scores.filter("predicted_score is null").count() == 0
