"""Splits, scaling, evaluation and models. Fitted models have no SQL; what must hold for them has."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallywind.operators import encode, evaluate, models, splits
from tallywind.operators.aggregates import mean_of
from tallywind.operators.history import daily_history_rate
from tallywind.operators.joins import attach
from tallywind.plans import baseline, cross_features, ensembles, point_in_time
from tallywind.schema import BASELINE_FEATURES
from tallywind.sources.standin import PLAN, raw_log
from tallywind.storage import store
from tallywind.suite.registry import case, log_case, on_log

V, T = PLAN.valid, PLAN.test
#: Rounds without a better validation loss after which boosting ends.
PATIENCE = 50


@log_case("split_by_day", on_log(f"select instance_id, case when day = {V} then 'valid' else 'train' end as part from log where day <= {V}"))
def _(log):
    train, valid = splits.split_by_day(log, V)
    return train.select("instance_id", F.lit("train").alias("part")).unionByName(valid.select("instance_id", F.lit("valid").alias("part")))


_LABEL_DAYS = ", ".join(str(d) for d in PLAN.label_days)


@log_case(
    "multi_day_training_set",
    on_log(
        f"""select instance_id, case when day = {V} then 'valid' when day = {T} then 'test' else 'train' end as part, coalesce(n, 0) as count_item_id_before_3_day
        from log left join c using (item_id, day) where day in ({_LABEL_DAYS})""",
        """c as (select a.item_id, a.day, count(b.is_trade) as n from (select distinct item_id, day from log) a
          join log b on b.item_id = a.item_id and b.day < a.day and b.day >= a.day - 3 group by 1, 2)""",
    ),
)
def _(log):
    table = daily_history_rate(log, "item_id", label_days=PLAN.label_days)
    features = attach(log, table, ["item_id", "day"], weight="_n")
    parts = splits.multi_day_training_set(features, PLAN)
    tagged = [df.select("instance_id", F.lit(name).alias("part"), "count_item_id_before_3_day") for name, df in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@log_case("kfold", on_log("select instance_id, cast(ntile(5) over (order by instance_id) - 1 as int) as fold from log"))
def _(log):
    return splits.kfold(log.select("instance_id"))


@log_case(
    "stratified_fold",
    on_log("select instance_id, cast((row_number() over (partition by is_trade order by instance_id) - 1) % 5 as int) as fold from log where is_trade is not null"),
)
def _(log):
    return splits.stratified_fold(log.filter(F.col("is_trade").isNotNull()).select("instance_id", "is_trade")).select("instance_id", "fold")


@log_case("hash_fold", on_log("select instance_id, cast(('0x' || substr(md5(cast(instance_id as varchar)), 1, 8))::bigint % 5 as int) as fold from log"))
def _(log):
    return splits.hash_fold(log).select("instance_id", "fold")


_SCALED = ["item_price_level", "item_sales_level", "user_age_level", "shop_score_service", "hour"]


def _z(c: str, source: str) -> str:
    return f"({c} - (select avg({c}) from {source})) / (select stddev_pop({c}) from {source})"


_TRAIN = f"train as (select * from log where day < {V})"


@log_case("standardize", on_log("select instance_id, " + ", ".join(f"round({_z(c, 'train')}, 6) as {c}" for c in _SCALED) + " from log", _TRAIN))
def _(log):
    return encode.standardize(log, _SCALED, fit_on=log.filter(F.col("day") < V)).select("instance_id", *_SCALED)


@log_case(
    "standardize_refit",
    on_log("select instance_id, " + ", ".join(f"round({_z(c, 'valid')}, 6) as {c}" for c in _SCALED) + " from valid", f"valid as (select * from log where day = {V})"),
)
def _(log):
    return encode.standardize(log.filter(F.col("day") == V), _SCALED).select("instance_id", *_SCALED)


# Two standardised columns have their components along the diagonals, the one of the correlation's sign first.
_PAIR = ["shop_score_service", "shop_score_delivery"]
_A, _B = (_z(c, "train") for c in _PAIR)


@log_case(
    "pca",
    on_log(
        f"""select instance_id, round(case when r >= 0 then abs(a + b) else abs(a - b) end / sqrt(2e0), 6) as pca_0,
        round(case when r >= 0 then abs(a - b) else abs(a + b) end / sqrt(2e0), 6) as pca_1
        from (select instance_id, {_A} as a, {_B} as b, (select corr({_PAIR[0]}, {_PAIR[1]}) from train) as r from log)""",
        _TRAIN,
    ),
)
def _(log):
    train = log.filter(F.col("day") < V)
    scaled = encode.standardize(log, _PAIR, fit_on=train)
    values = vector_to_array("pca")
    projected = encode.pca(scaled, _PAIR, 2, fit_on=encode.standardize(train, _PAIR))
    return projected.select("instance_id", F.abs(values[0]).alias("pca_0"), F.abs(values[1]).alias("pca_1"))  # signs are arbitrary


@log_case(
    "target_statistic",
    on_log(
        """select instance_id, round((coalesce(y, 0) + 10 * coalesce(m, 0)) / (coalesce(k, 0) + 10), 6) as user_id_rate from log
        left join (select a.user_id, a.day, count(b.is_trade) as k, sum(b.is_trade) as y from (select distinct user_id, day from log) a
          join log b on b.user_id = a.user_id and b.day < a.day group by 1, 2) using (user_id, day)
        left join (select a.day, avg(b.is_trade) as m from (select distinct day from log) a join log b on b.day < a.day group by 1) using (day)"""
    ),
)
def _(log):
    return encode.target_statistic(store(log).df, ["user_id"]).select("instance_id", "user_id_rate")


# A score that needs no model: the smoothed conversion rate of the item over the three days before.
_SCORED = [
    """history as (select a.item_id, a.day, count(b.is_trade) as n, coalesce(sum(b.is_trade), 0) as y from (select distinct item_id, day from log) a
      left join log b on b.item_id = a.item_id and b.day < a.day and b.day >= a.day - 3 group by 1, 2)""",
    """scored as (select instance_id, day, is_trade, round((y::double + 1e0) / (n::double + 5e0), 6) as predicted_score,
      case when (y::double + 1e0) / (n::double + 5e0) > 201e-3 then 1 else 0 end as prediction from log join history using (item_id, day) where is_trade is not null)""",
]


def smoothed_scores(log):
    table = daily_history_rate(log, "item_id", days=(3,))
    rows = attach(log.filter(F.col("is_trade").isNotNull()), table, ["item_id", "day"], weight="_n")
    n = F.col("count_item_id_before_3_day")
    p = (F.round(F.col("mean_item_id_before_3_day") * n) + 1.0) / (n + 5.0)
    return rows.select("instance_id", "day", "is_trade", F.round(p, 6).alias("predicted_score"), (p > 0.201).cast("int").alias("prediction"))


_LOSS = "-avg(is_trade * ln(predicted_score) + (1 - is_trade) * ln(1e0 - predicted_score))"


@log_case("log_loss", on_log(f"select round({_LOSS}, 6) as log_loss from scored", *_SCORED))
def _(log):
    return evaluate.log_loss(smoothed_scores(log))


@log_case("log_loss_unclipped", on_log(f"select round({_LOSS}, 6) as log_loss from scored", *_SCORED))
def _(log):
    return evaluate.log_loss(smoothed_scores(log), eps=None)


@log_case("daily_log_loss", on_log(f"select day, round({_LOSS}, 6) as log_loss, count(*) as rows from scored group by 1", *_SCORED))
def _(log):
    return evaluate.daily_log_loss(smoothed_scores(log))


@log_case("mean_daily_log_loss", on_log(f"select round(avg(l), 6) as mean_log_loss from (select day, {_LOSS} as l from scored group by 1)", *_SCORED))
def _(log):
    return mean_of(evaluate.daily_log_loss(smoothed_scores(log)), "log_loss")


@log_case(
    "roc_auc",
    on_log(
        """select round(sum(pos * (below + 5e-1 * neg)) / (sum(pos)::double * sum(neg)::double), 6) as auc from (
        select *, coalesce(sum(neg) over (order by predicted_score rows between unbounded preceding and 1 preceding), 0) as below from (
        select predicted_score, sum(is_trade) as pos, sum(1 - is_trade) as neg from scored group by 1))""",
        *_SCORED,
    ),
)
def _(log):
    return evaluate.roc_auc(smoothed_scores(log))


@log_case("accuracy", on_log("select round(avg(case when is_trade = prediction then 1e0 else 0e0 end), 6) as accuracy from scored", *_SCORED))
def _(log):
    return evaluate.accuracy(smoothed_scores(log))


def _parts(spark, sf):
    """Training and validation rows with the baseline features."""
    features = store(baseline.baseline_features(raw_log(spark, sf))).df
    labelled = features.filter(F.col("is_trade").isNotNull())
    return splits.split_by_day(labelled, V)


_fitted: dict[tuple[str, str], models.Scorer] = {}


def _boosted(spark, sf, train) -> models.Scorer:
    """The baseline model, which several queries look at; fitted once in a session."""
    key = spark.sparkContext.applicationId, sf
    if key not in _fitted:
        _fitted[key] = models.fit_gbt(train, BASELINE_FEATURES, params=baseline.PARAMS)
    return _fitted[key]


@case("fit_gbt")
def _(spark, sf):
    train, valid = _parts(spark, sf)
    return models.predict_proba(_boosted(spark, sf, train), valid).select("instance_id", "predicted_score")


@case("fit_gbt_early_stop")
def _(spark, sf):
    train, valid = _parts(spark, sf)
    scorer, best, losses = models.fit_gbt_early_stop(train, valid, BASELINE_FEATURES, params=baseline.PARAMS, refit_on=train.unionByName(valid), patience=PATIENCE)
    scored = models.predict_proba(scorer, valid).select("instance_id", "predicted_score")
    return scored.withColumns({"trees": F.lit(best), "best_loss": F.lit(min(losses))})


@case("fit_lr")
def _(spark, sf):
    train, valid = _parts(spark, sf)
    return models.predict_proba(models.fit_lr(train, BASELINE_FEATURES), valid).select("instance_id", "predicted_score")


@case("fit_fm")
def _(spark, sf):
    train, valid = _parts(spark, sf)
    return ensembles.fm_scores(train, valid).select("instance_id", "predicted_score")


@case("leaf_lr")
def _(spark, sf):
    train, valid = _parts(spark, sf)
    return ensembles.leaf_lr_scores(train, valid).select("instance_id", "predicted_score")


@case("select_by_importance")
def _(spark, sf):
    train, valid = _parts(spark, sf)
    scorer = _boosted(spark, sf, train)
    sliced, kept = encode.select_by_importance(scorer.vectors(valid), scorer.model, BASELINE_FEATURES)
    values = vector_to_array("selected")
    return sliced.select("instance_id", *[values[i].alias(c) for i, c in enumerate(kept)])


@case("pca_scores")
def _(spark, sf):
    train, valid = _parts(spark, sf)
    return ensembles.pca_scores(train, valid, refit=True).select("instance_id", "predicted_score")


# One tree that is deep enough for the values of its only feature scores every value by its rows' mean label m:
# 1 / (1 + exp(-2 (2 m - 1))).
ONE_TREE = models.GBTParams(trees=1, depth=5)
_BY_GENDER = f"""g as (select user_gender_id, 1 / (1 + exp(-2 * avg(2e0 * is_trade - 1))) as p from log where day < {V} group by 1)"""


@case("predict", on_log(f"select instance_id, cast(p > 5e-1 as int) as prediction from log join g using (user_gender_id) where day = {V}", _BY_GENDER))
def _(spark, sf):
    train, valid = _parts(spark, sf)
    return models.predict(models.fit_gbt(train, ["user_gender_id"], params=ONE_TREE), valid).select("instance_id", "prediction")


@case("predict_proba", on_log("select instance_id, round(p, 6) as predicted_score from log join g using (user_gender_id)", _BY_GENDER))
def _(spark, sf):
    features = store(baseline.baseline_features(raw_log(spark, sf))).df
    train, _ = splits.split_by_day(features.filter(F.col("is_trade").isNotNull()), V)
    return models.predict_proba(models.fit_gbt(train, ["user_gender_id"], params=ONE_TREE), features).select("instance_id", "predicted_score")


# The leaves of a tree are numbered from left to right, so the leaf of a value of its only feature is its rank. Every row falls into
# exactly one leaf of each tree of the plan's ensemble over all features.
@case("leaf_encode", on_log(f"""select instance_id, cast(r as int) as leaf, {ensembles.LEAF_PARAMS.trees}e0 as leaves_hit from log
    join (select user_gender_id, dense_rank() over (order by user_gender_id) - 1 as r
    from (select distinct user_gender_id from log where day < {V})) using (user_gender_id) where day = {V}"""))
def _(spark, sf):
    train, valid = _parts(spark, sf)
    one = models.fit_gbt(train, ["user_gender_id"], params=ONE_TREE, leafCol="leaf")
    vectors = [models.vectorize(df, ["user_gender_id"]) for df in (train, valid)]
    encoded = encode.leaf_encode(one.model, vectors, vectors[1], "one").drop("features")
    all_trees = models.fit_gbt(train, BASELINE_FEATURES, params=ensembles.LEAF_PARAMS, leafCol="leaf")
    vectors = [models.vectorize(df, BASELINE_FEATURES) for df in (train, encoded)]
    encoded = encode.leaf_encode(all_trees.model, vectors, vectors[1])
    hit = F.aggregate(vector_to_array("leaves"), F.lit(0.0), lambda a, b: a + b)
    return encoded.select("instance_id", (F.array_position(vector_to_array("one"), F.lit(1.0)) - 1).cast("int").alias("leaf"), hit.alias("leaves_hit"))


# A single split by a set of codes tells these rows apart, which a split by size cannot.
@case("fit_gbt_categories", on_log(f"""select instance_id, cast(item_id % 5 in (0, 2, 4) as int) as prediction,
    round(1 / (1 + exp(case when item_id % 5 in (0, 2, 4) then -2e0 else 2e0 end)), 6) as predicted_score from log where day = {V}"""))
def _(spark, sf):
    train, valid = (df.withColumns({"code": F.col("item_id") % 5, "is_trade": (F.col("item_id") % 5).isin(0, 2, 4).cast("int")}) for df in _parts(spark, sf))
    scorer = models.fit_gbt(train, ["code"], params=models.GBTParams(trees=1, depth=1), categories={"code": 5})
    classes = models.predict(scorer, models.predict_proba(scorer, valid))
    return classes.select("instance_id", "prediction", "predicted_score")


# All gain is the only informative column's.
@case("feature_importance_exact", "select * from (values ('user_gender_id', 1e0), ('is_constant', 0e0)) as t(n, s)")
def _(spark, sf):
    train, _ = _parts(spark, sf)
    rows = train.withColumn("is_constant", F.lit(7))
    return models.feature_importance(models.fit_gbt(rows, ["user_gender_id", "is_constant"], params=ONE_TREE), rows)


@case("feature_importance")
def _(spark, sf):
    train, _ = _parts(spark, sf)
    return models.feature_importance(_boosted(spark, sf, train), train)


@case("stack")
def _(spark, sf):
    train, valid = _parts(spark, sf)
    return ensembles.stacked_scores(train, valid).select("instance_id", "predicted_score")


# A training row's score comes from the rows of its gender in the other folds, a test row's is the mean over the folds.
_FOLDS = f"""f as (select *, ('0x' || substr(md5(cast(instance_id as varchar)), 1, 8))::bigint % 5 as fold from log where day <= {V}),
r as (select g.user_gender_id, k.fold, 1 / (1 + exp(-2 * avg(2e0 * f.is_trade - 1))) as p from (select distinct user_gender_id from f where day < {V}) g
  cross join (select unnest(range(0, 5)) as fold) k join f on f.user_gender_id = g.user_gender_id and f.fold <> k.fold and f.day < {V} group by 1, 2)"""


@case("blend", on_log(f"""select instance_id, round(p, 6) as predicted_score from f join r using (user_gender_id, fold) where day < {V}
    union all select instance_id, round(m, 6) from f join (select user_gender_id, avg(p) as m from r group by 1) using (user_gender_id) where day = {V}""", _FOLDS))
def _(spark, sf):
    train, valid = _parts(spark, sf)
    bases = {"trees": lambda rows, names: models.fit_gbt(rows, names, params=ONE_TREE)}
    oof, blended = models.blend(train, valid, bases, ["user_gender_id"])
    score = F.col("trees").alias("predicted_score")
    return oof.select("instance_id", score).unionByName(blended.select("instance_id", score))


@case("grid_search")
def _(spark, sf):
    train, valid = _parts(spark, sf)
    best, means = models.grid_by_trees(train, BASELINE_FEATURES)
    scored = models.predict(best, valid).select("instance_id", "prediction")
    return scored.withColumn("best_accuracy", F.lit(max(mean for _, mean in means)))


@case("score_baseline")
def _(spark, sf):
    features = store(baseline.baseline_features(raw_log(spark, sf))).df
    return baseline.score_baseline(features, PLAN, online=True, categories=["user_gender_id"]).select("instance_id", "predicted_score")


@case("rolling_day_scores")
def _(spark, sf):
    features = store(baseline.baseline_features(raw_log(spark, sf))).df
    return evaluate.daily_log_loss(baseline.rolling_day_scores(features, PLAN))


@case("score_point_in_time")
def _(spark, sf):
    features = store(point_in_time.point_in_time_features(raw_log(spark, sf), PLAN)).df
    _, _, test = point_in_time.score_point_in_time(features, PLAN)
    return test.select("instance_id", "predicted_score")


@case("score_cross_features")
def _(spark, sf):
    raw = raw_log(spark, sf)
    features = cross_features.cross_features(raw, PLAN)
    ids = raw.filter(F.col("is_trade").isNull()).select("instance_id").distinct()
    return cross_features.score_cross_features(features, ids, PLAN).select("instance_id", "predicted_score")
