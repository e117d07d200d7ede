"""Categories, boosting that goes on, stratified folds and the grid read from prefixes."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tallywind.operators import boosting, encode, models, splits
from tallywind.storage import store

FEATURES = ["a", "b"]
PARAMS = models.GBTParams(trees=7, depth=3, learning_rate=0.3)


@pytest.fixture(scope="module")
def parts(spark):
    rng = random.Random(3)
    rows = []
    for i in range(500):
        a, b = rng.randint(0, 4), rng.random()
        rows.append((i, a, b, int(rng.random() < (0.9 if a in (0, 2, 4) else 0.1)), 1 + i % 6))
    data = store(spark.createDataFrame(rows, "instance_id int, a int, b double, is_trade int, day int")).df
    return data.where("day < 6"), data.where("day = 6")


def scores(scorer, df):
    return [r[0] for r in models.predict_proba(scorer, df).orderBy("instance_id").select("predicted_score").collect()]


def test_a_set_of_codes_is_one_split(parts):
    train, _ = parts
    exact = train.withColumn("is_trade", F.col("a").isin(0, 2, 4).cast("int"))
    one = models.GBTParams(trees=1, depth=1)
    by_set = models.predict(models.fit_gbt(exact, ["a"], params=one, categories={"a": 5}), exact)
    assert by_set.where("prediction <> is_trade").count() == 0
    by_size = models.predict(models.fit_gbt(exact, ["a"], params=one), exact)
    assert by_size.where("prediction <> is_trade").count() > 0


def test_unknown_codes_and_nulls_take_the_last_code(spark):
    df = spark.createDataFrame([(None,), (0,), (2,), (7,), (-1,)], "a int")
    assert [list(r[0]) for r in models.vectorize(df, ["a"], categories={"a": 3}).select("features").collect()] == [[2], [0], [2], [2], [2]]
    assert models.vectorize(df, ["a"], categories={"a": 3}).schema["features"].metadata["ml_attr"]["attrs"]["nominal"][0]["num_vals"] == 3


def test_codes_fitted_on_the_training_rows(spark):
    train = spark.createDataFrame([(i, i % 3, i) for i in range(90)], "instance_id int, few int, many int")
    (coded,), sizes = encode.nominal(train, [spark.createDataFrame([(1, 2, 5), (2, 9, 5), (3, None, 5)], "instance_id int, few int, many int")], ["few", "many"])
    assert sizes == {"few_cat": 4}
    assert {r["instance_id"]: r["few_cat"] for r in coded.collect()} == {1: 2, 2: 3, 3: 3}


def test_target_statistic_uses_earlier_days_only(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["x", "y", None]), rng.randint(1, 5), rng.choice([0, 1, None])) for i in range(200)]
    df = spark.createDataFrame(rows, "instance_id int, c string, day int, is_trade int")
    for options in ({}, {"broadcast_bytes": 0}):
        got = {r["instance_id"]: r["c_rate"] for r in encode.target_statistic(df, ["c"], weight=4.0, **options).collect()}
        for i, c, day, _ in rows:
            known = [y for _, v, d, y in rows if d < day and y is not None]
            mean = sum(known) / len(known) if known else 0.0
            own = [y for _, v, d, y in rows if d < day and y is not None and v == c and c is not None]
            assert got[i] == pytest.approx((sum(own) + 4 * mean) / (len(own) + 4))


def test_one_by_one_gives_what_the_classifier_gives(parts):
    train, valid = parts
    rows, held = (models.training_rows(df, FEATURES) for df in parts)
    grown = boosting.boost(rows, held, PARAMS, 7)
    ours = models.Scorer(grown.model(train), tuple(FEATURES))
    assert scores(ours, valid) == pytest.approx(scores(models.fit_gbt(train, FEATURES, params=PARAMS), valid), abs=1e-9)
    p, y = scores(ours, valid), [r[0] for r in valid.orderBy("instance_id").select("is_trade").collect()]
    assert grown.losses[-1] == pytest.approx(-sum(math.log(q if t else 1 - q) for q, t in zip(p, y)) / len(y))


def test_two_parts_equal_one(parts, monkeypatch):
    train, valid = parts
    rows, held = (models.training_rows(df, FEATURES) for df in parts)
    sampled = models.GBTParams(depth=3, subsample=0.7, colsample=0.5)
    whole = boosting.boost(rows, held, sampled, 9)
    monkeypatch.setattr(boosting, "BLOCK", 4)
    rest = boosting.boost(rows, held, sampled, 9, start=boosting.boost(rows, held, sampled, 5))
    assert rest.losses == pytest.approx(whole.losses, abs=1e-12)
    ours, theirs = (scores(models.Scorer(b.model(train), tuple(FEATURES)), train) for b in (rest, whole))
    assert ours == pytest.approx(theirs, abs=1e-9)


def test_patience(parts):
    assert boosting.stopped_at([3, 2, 1, 1, 1], 2) == 5 and boosting.stopped_at([3, 2, 1, 1], 2) is None
    assert boosting.stopped_at([1, 2, 0, 3, 4], 2) == 5
    train, valid = parts
    hasty = models.GBTParams(depth=4, learning_rate=1.0)
    scorer, best, losses = models.fit_gbt_early_stop(train, valid, FEATURES, params=hasty, patience=3, most=60)
    assert len(losses) == best + 3 and losses[best - 1] == min(losses) and scorer.model.getNumTrees == best
    again = models.fit_gbt_early_stop(train, valid, FEATURES, params=hasty, patience=3, most=60, refit_on=train)
    assert scores(again[0], valid) == pytest.approx(scores(scorer, valid), abs=1e-9)


def test_stratified_folds(spark):
    rows = [(i, None if i % 17 == 0 else int(i % 3 == 0)) for i in range(203)]
    folds = splits.stratified_fold(spark.createDataFrame(rows, "instance_id int, is_trade int").repartition(5)).collect()
    assert len(folds) == 203
    for label in (None, 0, 1):
        n = [sum(1 for r in folds if r["is_trade"] == label and r["fold"] == f) for f in range(5)]
        assert max(n) - min(n) <= 1


def test_grid_from_prefixes(parts):
    train, _ = parts
    best, means = models.grid_by_trees(train, FEATURES, (1, 4, 6), PARAMS, k=3)
    folded = store(splits.stratified_fold(train, 3, fold="f")).df
    for n, mean in means:
        right = []
        for f in range(3):
            scorer = models.fit_gbt(folded.where(f"f <> {f}"), FEATURES, params=models.GBTParams(trees=n, depth=3, learning_rate=0.3))
            right.append(models.predict(scorer, folded.where(f"f = {f}")).agg(F.avg((F.col("prediction") == F.col("is_trade")).cast("double"))).first()[0])
        assert mean == pytest.approx(sum(right) / 3, abs=0.02)
    assert best.model.getNumTrees == max(means, key=lambda m: (m[1], -m[0]))[0]


def test_first_rounds_are_one_fit_with_samples_too(parts, monkeypatch):
    train, valid = parts
    given = []
    monkeypatch.setattr(models, "boost", lambda *a: given.append(a[-1]) or boosting.boost(*a))
    sampled = models.GBTParams(depth=3, subsample=0.9, colsample=0.8)
    _, best, losses = models.fit_gbt_early_stop(train, valid, FEATURES, params=sampled, patience=6, most=7)
    assert len(given[0].trees) == 7 and len(losses) == 7 and losses[best - 1] == min(losses)
    assert given[0].losses == pytest.approx(losses)


def test_rounds_ahead_are_in_the_first_fit(parts, monkeypatch):
    train, valid = parts
    rows, held = (models.training_rows(df, FEATURES) for df in parts)
    slow = models.GBTParams(depth=4, learning_rate=0.6)
    one_by_one = boosting.boost(rows, held, slow, 40, patience=8)
    assert one_by_one.best > 1  # else it ends with the rounds that every fit has
    given = []
    monkeypatch.setattr(models, "boost", lambda *a: given.append(a[-1]) or boosting.boost(*a))
    _, best, losses = models.fit_gbt_early_stop(train, valid, FEATURES, params=slow, patience=8, most=40)
    assert len(given[0].trees) == 11 and best == one_by_one.best and losses == pytest.approx(one_by_one.losses, abs=1e-9)


def test_trees_that_end_it_read_no_rows(parts, monkeypatch):
    rows, held = (models.training_rows(df, FEATURES) for df in parts)
    grown = boosting.boost(rows, held, PARAMS, 4)
    ended = boosting.Boosted(grown.trees, grown.weights, (0.1, 0.2, 0.3, 0.4))
    monkeypatch.setattr(boosting, "store", lambda df: pytest.fail("margins were written"))
    assert boosting.boost(rows, held, PARAMS, 9, patience=2, start=ended).losses == (0.1, 0.2, 0.3)
    assert len(boosting.boost(rows, held, PARAMS, 4, start=grown).trees) == 4
