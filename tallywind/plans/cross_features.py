"""Cross-count scorer: label codes, bins, earlier-day counts and pair counts over labelled and unlabelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywind.functions import bins
from tallywind.functions.lists import list_item, list_length
from tallywind.functions.time import check_day_number, hour_bucket, with_clock
from tallywind.operators.clean import dedupe_by, drop_sentinel_rows, scale_column, sentinel_to_zero, split_labelled
from tallywind.operators.cross import (
    ITEM_CROSSES,
    SHOP_ITEM_CROSSES,
    USER_CROSSES,
    USER_ITEM_CROSSES,
    USER_SHOP_CROSSES,
    cross_counts,
)
from tallywind.operators.encode import label_encode
from tallywind.operators.history import before_counts
from tallywind.operators.joins import restore_rows
from tallywind.operators.models import GBTParams, fit_gbt_early_stop, predict_proba
from tallywind.schema import NON_FEATURES, DayPlan
from tallywind.storage import store

# List pieces that are label-encoded, and ids replaced by their code.
PIECES = {"item_category_list": range(1, 3), "item_property_list": range(10), "predict_category_property": range(5)}
ENCODED_IDS = ["item_id", "item_brand_id", "item_city_id", "user_id", "shop_id"]
LENGTHS = {
    "len_item_category": "item_category_list",
    "len_item_property": "item_property_list",
    "len_predict_category_property": "predict_category_property",
}
SCORE_BINS = {
    "shop_score_delivery": bins.DELIVERY,
    "shop_score_service": bins.SERVICE,
    "shop_score_description": bins.DESCRIPTION,
}
LEVEL_PAIRS = {
    "sale_price": ("item_sales_level", "item_price_level"),
    "sale_collect": ("item_sales_level", "item_collected_level"),
    "price_collect": ("item_price_level", "item_collected_level"),
    "gender_age": ("user_gender_id", "user_age_level"),
    "gender_occ": ("user_gender_id", "user_occupation_id"),
    "gender_star": ("user_gender_id", "user_star_level"),
}
# Crosses that share their columns share one table of combinations.
BLOCKS = [
    [*ITEM_CROSSES, *SHOP_ITEM_CROSSES],
    USER_CROSSES,
    [x for x in (*USER_ITEM_CROSSES, *USER_SHOP_CROSSES) if x.anchor == "user_id"],
    [x for x in (*USER_ITEM_CROSSES, *USER_SHOP_CROSSES) if x.anchor != "user_id"],
]


def base_columns(df: DataFrame, flag_sets: dict = bins.FLAG_SETS, tz: str = "UTC", day_number: str = "month") -> DataFrame:
    """List lengths and pieces, membership flags, day and hour."""
    columns = {name: list_length(col) for name, col in LENGTHS.items()}
    columns |= {f"{col}{i}": list_item(col, i) for col, positions in PIECES.items() for i in positions}
    columns |= {name: bins.membership_flag(bins.FLAG_COLUMNS[name], values) for name, values in flag_sets.items()}
    columns["shop_score_delivery0"] = bins.range_flag("shop_score_delivery", 0.96, 0.98)
    clocked = with_clock(df, tz=tz, day_number=day_number).withColumns(columns)
    return clocked.withColumn("hour_map", hour_bucket("hour"))


def shop_levels(df: DataFrame) -> DataFrame:
    """Scale the shop scores, drop rows without them, and flag shops in the top level of every measure."""
    out = df
    for col in SCORE_BINS:
        out = drop_sentinel_rows(scale_column(out, col, 5.0), col, -5.0)
    out = drop_sentinel_rows(out, "shop_review_positive_rate", -1.0)
    measured = {**SCORE_BINS, "shop_review_positive_rate": bins.REVIEW}
    out = out.withColumns({f"_{c}": bins.bin_level2(bins.bin_uniform(c, b), b) for c, b in measured.items()})
    return out.withColumn("normal_shop", bins.all_equal_flag({f"_{c}": 3 for c in measured})).drop(*[f"_{c}" for c in measured])


def cross_features(raw: DataFrame, plan: DayPlan = DayPlan(), encode: bool = True, tz: str = "UTC", day_number: str = "month", **join_options) -> DataFrame:
    """The full feature table over labelled and unlabelled rows."""
    out = base_columns(dedupe_by(raw, ["instance_id"], ["context_timestamp", "context_id"]), tz=tz, day_number=day_number)
    check_day_number(raw, tz=tz, day_number=day_number)
    if encode:
        # Codes cover all rows, before rows without shop scores are dropped.
        out = store(out).df
        out = label_encode(out, [f"{c}{i}" for c, positions in PIECES.items() for i in positions] + ENCODED_IDS, "", **join_options)
    out = store(shop_levels(out)).df
    out = before_counts(out, plan.first, **join_options)
    out = sentinel_to_zero(out)
    out = out.withColumns({name: bins.concat_cross(a, b) for name, (a, b) in LEVEL_PAIRS.items()})
    return cross_counts(store(out).df, *BLOCKS, **join_options)


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NON_FEATURES]


def score_cross_features(
    features: DataFrame,
    all_ids: DataFrame,
    plan: DayPlan = DayPlan(),
    params: GBTParams = GBTParams(trees=200, depth=5, learning_rate=0.05, subsample=0.9, colsample=0.8),
    patience: int | None = 200,
) -> DataFrame:
    """Scores for every id of ``all_ids``; ids dropped on the way get 0."""
    names = feature_columns(features)
    # Written once: both fits and the scores read them.
    labelled, unlabelled = split_labelled(store(features).df)
    train = labelled.filter((F.col("day") >= plan.first) & (F.col("day") < plan.valid))
    valid = labelled.filter(F.col("day") == plan.valid)
    scorer, _, _ = fit_gbt_early_stop(train, valid, names, params=params, refit_on=labelled, patience=patience)
    scores = predict_proba(scorer, unlabelled).select("instance_id", "predicted_score")
    return restore_rows(all_ids, scores)
