"""Point-in-time scorer: every feature of a row describes days before the row's own day."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywind.functions.lists import category_match_flags, list_number, predicted_category
from tallywind.functions.time import check_day_number, hour_after, hour_before, with_clock
from tallywind.operators.clean import dedupe_by
from tallywind.operators.encode import label_codes, to_category
from tallywind.operators.history import (
    HOUR_COUNTS,
    RATE_KEYS,
    daily_history_rate,
    daily_hour_std,
    daily_key_hour_count,
    daily_user_lifetime,
)
from tallywind.operators.joins import attach_all
from tallywind.operators.models import GBTParams, Scorer, fit_gbt, fit_gbt_early_stop, predict_proba
from tallywind.operators.splits import multi_day_training_set
from tallywind.schema import CATEGORY_COLUMNS, DayPlan
from tallywind.storage import store

RAW_LISTS = ["item_category_list", "item_property_list", "predict_category_property"]
HELPERS = ["hour_before", "hour_after", "day", "context_timestamp", "context_id", "instance_id", "is_trade"]


def list_features(df: DataFrame, strict: bool = True) -> DataFrame:
    """Category and property pieces, predicted categories, and where they agree. Drops the raw lists.

    A list too short for its pieces is an error, or -1 when not ``strict``.
    """

    def piece(col: str, i: int):
        if strict:
            return list_number(col, i)
        return F.coalesce(F.get(F.split(F.col(col), ";"), F.lit(i)).try_cast("bigint"), F.lit(-1))

    pieces = {f"item_category_list_{i + 1}": piece("item_category_list", i) for i in range(2)}
    pieces |= {f"item_property_list_{i}": piece("item_property_list", i) for i in range(3)}
    pieces |= {f"predict_category_{i}": predicted_category("predict_category_property", i, strict=strict) for i in range(3)}
    wide = df.withColumns(pieces)
    flags = category_match_flags(
        ["item_category_list_1", "item_category_list_2"], [f"predict_category_{i}" for i in range(3)]
    )
    return wide.withColumns(flags).drop(*RAW_LISTS)


def point_in_time_features(
    raw: DataFrame,
    plan: DayPlan = DayPlan(),
    lists: bool = True,
    tz: str = "UTC",
    days: Sequence[int] = (1, 2, 3),
    day_number: str = "month",
    **join_options,
) -> DataFrame:
    """The feature table of all label days of ``plan``, from one pass over the log per history table.

    Each history table is small next to the log (one row per key and label day) and is written once, which
    gives the size its join is chosen by. Logs that span months take ``day_number="index"``, with ``plan`` and all days
    counted from 1970-01-01.
    """
    log = with_clock(dedupe_by(raw, ["instance_id"], ["context_timestamp", "context_id"]), tz=tz, day_number=day_number)
    log = store(log).df
    check_day_number(log, tz=tz, day_number=day_number)
    label_days = plan.label_days

    tables: list[tuple[DataFrame, list[str]]] = []
    for key in RATE_KEYS:
        tables.append((daily_history_rate(log, key, days, label_days=label_days), [key, "day"]))
    for name, key in HOUR_COUNTS.items():
        tables.append((daily_key_hour_count(log, key, name, days, label_days=label_days), [key, "hour", "day"]))
    tables.append((daily_user_lifetime(log, label_days), ["user_id", "day"]))
    tables.append((daily_hour_std(log, label_days, days), ["hour", "day"]))

    out = log.filter(F.col("day").isin(list(label_days))).withColumns(
        {"hour_before": hour_before("hour"), "hour_after": hour_after("hour")}
    )
    out = list_features(out) if lists else out.drop(*RAW_LISTS)
    out = attach_all(out, tables, weight="_n", **join_options)
    return out.na.fill(0, [c for c in out.columns if c != "is_trade"])


def score_point_in_time(
    features: DataFrame,
    plan: DayPlan = DayPlan(),
    params: GBTParams = GBTParams(trees=100, depth=2),
    categories: Sequence[str] = CATEGORY_COLUMNS,
    patience: int | None = 50,
) -> tuple[Scorer, DataFrame, DataFrame]:
    """Early-stopped trees on the stacked label days, refitted with the validation day, scoring the test day.

    Returns the model, the scores of the validation day (from the model that has not seen it) and of the
    test day. Category codes are fitted on the training rows and applied to all.
    """
    used = [c for c in categories if c in features.columns]
    codes = label_codes(multi_day_training_set(features, plan)["train"], used)
    coded = multi_day_training_set(store(to_category(codes, features)).df, plan)
    names = [f"{c}_cat" if c in used else c for c in features.columns if c not in HELPERS]
    fair, best, _ = fit_gbt_early_stop(coded["train"], coded["valid"], names, params=params, patience=patience)
    final = fit_gbt(coded["train"].unionByName(coded["valid"]), names, params=replace(params, trees=best))
    return final, predict_proba(fair, coded["valid"]), predict_proba(final, coded["test"])
