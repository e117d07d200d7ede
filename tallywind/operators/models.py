"""Classifiers on Spark ML: boosted trees, logistic regression, factorization machine, stacking, grid search."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    FMClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywind.operators.boosting import Boosted, boost
from tallywind.operators.growing import Ensemble, cell, grow_ensemble
from tallywind.operators.splits import hash_fold, stratified_fold
from tallywind.storage import dealt, side_by_side, store

LABEL = "is_trade"

#: The share of the patience that is fitted ahead with the rounds that every fit has.
AHEAD = 4


@dataclass(frozen=True)
class GBTParams:
    """Settings of the boosted trees, under their usual names."""

    trees: int = 80
    depth: int = 5
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample: float | str = "all"
    min_leaf: int = 1
    min_gain: float = 0.0
    bins: int = 32
    seed: int = 2018


@dataclass(frozen=True)
class Scorer:
    """A fitted model, the columns it reads, and how many codes each of those has that are categories."""

    model: Model
    features: tuple[str, ...]
    categories: Mapping[str, int] = field(default_factory=dict)

    def vectors(self, df: DataFrame) -> DataFrame:
        return vectorize(df, self.features, categories=self.categories)


def vectorize(df: DataFrame, features: Sequence[str], out: str = "features", categories: Mapping[str, int] | None = None) -> DataFrame:
    """Feature vector with nulls taken as the sentinel -1, since trees do not route missing values.

    ``categories`` names columns of codes 0..n-1 with their n: trees split those by sets of codes and not by size. A null, or
    a code from n on, takes the last code.
    """
    categories = categories or {}
    known = {f"_f_{i}": f"{cell(c, categories.get(c, 0))} as _f_{i}" for i, c in enumerate(features)}
    wide = df.selectExpr("*", *known.values())
    for i, c in enumerate(features):
        if c in categories:
            wide = wide.withMetadata(f"_f_{i}", {"ml_attr": {"type": "nominal", "name": c, "num_vals": categories[c]}})
    return VectorAssembler(inputCols=list(known), outputCol=out, handleInvalid="keep").transform(wide).drop(*known)


def row_width(values: int) -> int:
    """Bytes of a row with so many values while a model is fitted: a value of a sparse vector takes 12."""
    return 200 + 12 * values


def training_rows(df: DataFrame, features: Sequence[str], label: str = LABEL, categories: Mapping[str, int] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Vector and label of the labelled rows, and columns to ``keep``, written once: fitting passes over them many times, in even parts."""
    rows = vectorize(df.filter(F.col(label).isNotNull()), features, categories=categories)
    return dealt(store(rows.select("features", F.col(label).cast("double"), *keep)), row_width(len(features)))


def with_room(params: GBTParams, categories: Mapping[str, int] | None) -> GBTParams:
    """Settings whose bins hold the codes of every category."""
    return replace(params, bins=max([params.bins, *(categories or {}).values()]))


def gbt(params: GBTParams, label: str = LABEL, **extra) -> GBTClassifier:
    return GBTClassifier(
        labelCol=label,
        maxIter=params.trees,
        maxDepth=params.depth,
        stepSize=params.learning_rate,
        subsamplingRate=params.subsample,
        featureSubsetStrategy=str(params.colsample),
        minInstancesPerNode=params.min_leaf,
        minInfoGain=params.min_gain,
        maxBins=params.bins,
        seed=params.seed,
        **extra,
    )


def _fit(estimator: Estimator, train: DataFrame, features: Sequence[str], label: str = LABEL, categories: Mapping[str, int] | None = None) -> Scorer:
    return Scorer(estimator.fit(training_rows(train, features, label, categories)), tuple(features), categories or {})


def fit_gbt(
    train: DataFrame, features: Sequence[str], label: str = LABEL, params: GBTParams = GBTParams(), categories: Mapping[str, int] | None = None, **extra
) -> Scorer:
    """Boosted trees with log-loss, probability output; ``categories`` as in ``vectorize``."""
    return _fit(gbt(with_room(params, categories), label, **extra), train, features, label, categories)


def fit_blocks(
    train: DataFrame, features: Sequence[str], label: str = LABEL, params: GBTParams = GBTParams(), categories: Mapping[str, int] | None = None
) -> Scorer:
    """The model of ``fit_gbt``, its trees grown on blocks of binned rows (``growing``), for fits of many trees. Samples are drawn otherwise than Spark ML draws them."""
    ensemble = grow_ensemble(train, None, features, with_room(params, categories), params.trees, label, categories)
    return Scorer(ensemble.model(train.sparkSession, label=label), tuple(features), categories or {})


def fit_gbt_early_stop(
    train: DataFrame,
    valid: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    params: GBTParams = GBTParams(),
    refit_on: DataFrame | None = None,
    patience: int | None = None,
    most: int = 20_000,
    categories: Mapping[str, int] | None = None,
    start: Boosted = Boosted(),
) -> tuple[Scorer, int, list[float]]:
    """Fit, keep the number of trees with the least validation loss, and refit with that number.

    With ``patience`` trees are added, up to ``most``, until the best number is followed by that many that are no better;
    else there are ``params.trees``. Trees are grown on blocks of binned rows, rows and columns drawn as a refit draws them; going on from
    ``start``, or without patience from samples of rows or columns, they are fitted one by one on stored margins. No tree is fitted again. With ``refit_on`` (all labelled
    rows) the model is fitted anew on those rows; else it is made of the first trees. Returns the model, the tree count and the validation loss after each tree.
    """
    params = with_room(params, categories)
    rounds = params.trees if patience is None else most
    sampled = params.subsample < 1 or params.colsample != "all"
    rows = held = None
    if start.trees or (sampled and patience is None):
        rows, held = (training_rows(df, features, label, categories) for df in (train, valid))
    else:
        # No fit ends before patience + 1 rounds. Trees that end it leave no rows to be read.
        least = rounds if patience is None else min(patience + 1 + patience // AHEAD, rounds)
        whole = _boosted(grow_ensemble(train, valid, features, params, rounds, label, categories, patience, least), train, label)
        start = replace(whole.first(least), whole=whole)
    grown = boost(rows, held, params, rounds, label, patience, start)
    if refit_on is not None:
        final = fit_blocks(refit_on, features, label, replace(params, trees=grown.best), categories)
    else:
        final = Scorer(grown.first(grown.best).model(train), tuple(features), categories or {})
    return final, grown.best, list(grown.losses)


def _boosted(ensemble: Ensemble, df: DataFrame, label: str) -> Boosted:
    """The trees as models of their own, with their losses; ``df`` lends its session."""
    model = ensemble.model(df.sparkSession, label=label)
    return Boosted(tuple(model.trees), tuple(model.treeWeights), tuple(ensemble.grown.losses))


def fit_lr(train: DataFrame, features: Sequence[str], label: str = LABEL, max_iter: int = 100, reg: float = 0.0) -> Scorer:
    return _fit(LogisticRegression(labelCol=label, maxIter=max_iter, regParam=reg), train, features, label)


def fit_fm(
    train: DataFrame, features: Sequence[str], label: str = LABEL, factors: int = 4, max_iter: int = 50, step: float = 0.05, seed: int = 2018
) -> Scorer:
    """Factorization machine. Columns should be standardised first: raw ids saturate the score."""
    machine = FMClassifier(labelCol=label, factorSize=factors, maxIter=max_iter, stepSize=step, seed=seed)
    return _fit(machine, train, features, label)


def predict_proba(scorer: Scorer, df: DataFrame, name: str = "predicted_score") -> DataFrame:
    """Add the probability of a conversion."""
    scored = scorer.model.transform(scorer.vectors(df))
    return scored.withColumn(name, vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def predict(scorer: Scorer, df: DataFrame, name: str = "prediction") -> DataFrame:
    """Add the hard class."""
    scored = scorer.model.transform(scorer.vectors(df))
    classes = scored.withColumn("_class", F.col("prediction").cast("int")).drop(
        "features", "rawPrediction", "probability", "prediction"
    )
    return classes.withColumnRenamed("_class", name)


def feature_importance(scorer: Scorer, df: DataFrame) -> DataFrame:
    """Table (n, s) of feature names and scores, highest first. ``df`` only lends its session."""
    scores = dict(enumerate(scorer.model.featureImportances.toArray()))  # ends with the last feature that is used
    rows = [(n, float(scores.get(i, 0.0))) for i, n in enumerate(scorer.features)]
    return df.sparkSession.createDataFrame(rows, "n string, s double").orderBy(F.desc("s"), "n")


Fit = Callable[[DataFrame, Sequence[str]], Scorer]


def stack(
    train: DataFrame,
    test: DataFrame,
    bases: dict[str, Fit],
    features: Sequence[str],
    label: str = LABEL,
    k: int = 5,
    id_col: str = "instance_id",
    fold: str | None = None,
    second: Estimator | None = None,
) -> DataFrame:
    """Two-level stacking: scores of ``test`` from a forest on the out-of-fold scores of the base models.

    A base model's score of a training row comes from the fold model that has not seen it; a test row's
    score is the mean over the fold models.
    """
    oof, blended = blend(train, test, bases, features, label, k, id_col, fold)
    level = list(bases)
    final = second or RandomForestClassifier(labelCol=label, numTrees=100, seed=2018)
    scorer = _fit(final, oof.select(*level, label), level, label)
    return predict_proba(scorer, blended)


def blend(
    train: DataFrame,
    test: DataFrame,
    bases: dict[str, Fit],
    features: Sequence[str],
    label: str = LABEL,
    k: int = 5,
    id_col: str = "instance_id",
    fold: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold scores of ``train`` and mean fold-model scores of ``test``, one column per base model."""
    folded = train if fold else hash_fold(train, k, id_col, "_fold")
    fold = fold or "_fold"
    folded = store(folded).df
    held_out = []
    tests = test
    fold_scores: dict[str, list[str]] = {name: [] for name in bases}
    # The fits do not depend on each other: they run side by side.
    fits = [(i, name) for i in range(k) for name in bases]
    fitted = dict(zip(fits, side_by_side(lambda f: bases[f[1]](folded.filter(F.col(fold) != f[0]), features), fits), strict=True))
    for i in range(k):
        part = folded.filter(F.col(fold) == i)
        for name in bases:
            scorer = fitted[i, name]
            part = predict_proba(scorer, part, name)
            tests = predict_proba(scorer, tests, f"_{name}_{i}")
            fold_scores[name].append(f"_{name}_{i}")
        held_out.append(part)
    oof = held_out[0]
    for part in held_out[1:]:
        oof = oof.unionByName(part)
    means = {name: sum((F.col(c) for c in cols[1:]), F.col(cols[0])) / F.lit(float(k)) for name, cols in fold_scores.items()}
    blended = tests.withColumns(means).drop(*[c for cols in fold_scores.values() for c in cols])
    return oof.drop("_fold"), blended


def grid_search(
    train: DataFrame,
    features: Sequence[str],
    grid: dict[str, Sequence],
    estimator: Estimator | None = None,
    label: str = LABEL,
    k: int = 5,
    evaluator: Evaluator | None = None,
    seed: int = 2018,
    parallelism: int = 2,
) -> tuple[Scorer, list[tuple[dict, float]]]:
    """Cross-validated search over a parameter grid: the best model and the mean metric of every setting."""
    model = estimator or gbt(GBTParams(), label)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(model.getParam(name), list(values))
    evaluator = evaluator or MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    search = CrossValidator(
        estimator=model,
        estimatorParamMaps=builder.build(),
        evaluator=evaluator,
        numFolds=k,
        seed=seed,
        parallelism=parallelism,
    )
    fitted: CrossValidatorModel = search.fit(training_rows(train, features, label))
    settings = [{p.name: v for p, v in m.items()} for m in fitted.getEstimatorParamMaps()]
    return Scorer(fitted.bestModel, tuple(features)), list(zip(settings, fitted.avgMetrics, strict=True))


def grid_by_trees(
    train: DataFrame,
    features: Sequence[str],
    counts: Sequence[int] = (100, 300, 500),
    params: GBTParams = GBTParams(depth=3),
    label: str = LABEL,
    k: int = 5,
    id_col: str = "instance_id",
    categories: Mapping[str, int] | None = None,
) -> tuple[Scorer, list[tuple[int, float]]]:
    """Search over numbers of trees with stratified folds: the model of the best number on all rows, and (number, mean accuracy).

    Trees of one seed are the same whatever their number, so each fold is fitted once, with the largest number, and the
    smaller ones are read from its first trees. The least of equally accurate numbers is best.
    """
    params = with_room(params, categories)
    folded = store(stratified_fold(train.filter(F.col(label).isNotNull()), k, label, id_col, "_fold")).df
    counts = sorted(counts)

    def grown(fold: int | None) -> Ensemble:
        held = None if fold is None else folded.filter(F.col("_fold") == fold)
        rows = folded if fold is None else folded.filter(F.col("_fold") != fold)
        return grow_ensemble(rows, held, features, params, counts[-1], label, categories)

    # The model of all rows is grown beside the folds, with the largest number too.
    whole, *measured = side_by_side(grown, [None, *range(k)])
    hits = {n: [hit for m in measured if (hit := m.grown.accuracy(n)) is not None] for n in counts}
    means = [(n, sum(h) / len(h)) for n, h in hits.items() if h]
    best = max(means, key=lambda m: (m[1], -m[0]))[0]
    return Scorer(whole.model(train.sparkSession, best, label), tuple(features), categories or {}), means
