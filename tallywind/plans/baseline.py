"""Baseline scorer: log columns, the hour, and how often the user searched that day and hour."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tallywind.functions.time import check_day_number, with_clock
from tallywind.operators.clean import dedupe_rows, split_labelled
from tallywind.operators.encode import nominal
from tallywind.operators.history import same_period_count
from tallywind.operators.models import GBTParams, Scorer, fit_gbt, predict_proba
from tallywind.operators.splits import split_by_day
from tallywind.schema import BASELINE_FEATURES, DayPlan
from tallywind.storage import store

PARAMS = GBTParams(trees=80, depth=7)


def baseline_features(raw: DataFrame, tz: str = "UTC", day_number: str = "month") -> DataFrame:
    """The distinct rows with their clock and search counts. They are written once, as counting and joining both read them."""
    log = store(with_clock(dedupe_rows(raw), tz=tz, day_number=day_number)).df
    check_day_number(log, tz=tz, day_number=day_number)
    return same_period_count(log)


def score_baseline(
    features: DataFrame,
    plan: DayPlan = DayPlan(),
    online: bool = False,
    fit: Callable[..., Scorer] | None = None,
    params: GBTParams = PARAMS,
    categories: Sequence[str] = (),
) -> DataFrame:
    """Scores of the validation day, or of the unlabelled rows when ``online``.

    Trees split ``categories`` by sets of values, coded on the training rows.
    """
    train, rest = split_labelled(features)
    if not online:
        train, rest = split_by_day(train, plan.valid)
    if categories:
        (coded, rest), sizes = nominal(train, [train, rest], categories)
        names = [f"{c}_cat" if f"{c}_cat" in sizes else c for c in BASELINE_FEATURES]
        scored = predict_proba(fit_gbt(coded, names, params=params, categories=sizes), rest)
        return scored.drop(*sizes)
    scorer = fit(train, BASELINE_FEATURES) if fit else fit_gbt(train, BASELINE_FEATURES, params=params)
    return predict_proba(scorer, rest)


def rolling_day_scores(
    features: DataFrame, plan: DayPlan = DayPlan(), params: GBTParams = GBTParams(trees=122, depth=6)
) -> DataFrame:
    """Scores of every labelled day from a model of the days before the validation day.

    Days in training are scored too; only the validation day is a fair test.
    """
    labelled, _ = split_labelled(features)
    train, _ = split_by_day(labelled, plan.valid)
    return predict_proba(fit_gbt(train, BASELINE_FEATURES, params=params), labelled)
