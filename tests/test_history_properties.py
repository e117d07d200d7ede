"""History never looks at the label day or later, and its two forms agree."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tallywind.operators import history
from tallywind.plans.point_in_time import point_in_time_features
from tallywind.sources.standin import PLAN, clean_log, raw_log
from tallywind.storage import store

L = PLAN.valid


@pytest.fixture(scope="module")
def log(spark):
    return store(clean_log(spark, SF_DIR)).df


def disturbed(df, day="day"):
    """Labels, shop columns and hours of the label day and later changed, and rows doubled."""
    later = df.filter(F.col(day) >= L)
    changed = later.withColumns({"is_trade": F.lit(1), "shop_score_service": F.lit(0.5), "context_timestamp": F.col("context_timestamp") + 1})
    return df.filter(F.col(day) < L).unionByName(changed).unionByName(changed)


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


FORMS = {
    "rate": lambda df: history.history_rate(df, "item_id", L),
    "hour_std": lambda df: history.history_hour_std(df, L),
    "key_hour": lambda df: history.history_key_hour_count(df, "shop_id", "shop_query_day_hour", L),
    "lifetime": lambda df: history.history_user_lifetime(df, L),
    "daily_rate": lambda df: history.daily_history_rate(df, "item_id", label_days=[L]).drop("_n"),
    "daily_std": lambda df: history.daily_hour_std(df, [L]),
    "daily_key_hour": lambda df: history.daily_key_hour_count(df, "shop_id", "n", label_days=[L]).drop("_n"),
    "daily_lifetime": lambda df: history.daily_user_lifetime(df, [L]).drop("_n"),
}


@pytest.mark.parametrize("form", list(FORMS))
def test_rows_of_the_label_day_do_not_change_its_features(log, form):
    assert rows(FORMS[form](log)) == rows(FORMS[form](disturbed(log)))


@pytest.mark.parametrize("key", history.RATE_KEYS)
def test_one_day_form_equals_all_days_form(log, key):
    one = history.history_rate(log, key, L)
    present = log.filter(F.col("day") == L).select(key).distinct()
    literal = present.join(one, key, "left").na.fill(0)
    daily = history.daily_history_rate(log, key, label_days=[L]).drop("_n", "day")
    assert rows(literal) == rows(daily)


def test_lifetime_forms_agree(log):
    present = log.filter(F.col("day") == L).select("user_id").distinct()
    literal = present.join(history.history_user_lifetime(log, L), "user_id", "left").na.fill(-1)
    assert rows(literal) == rows(history.daily_user_lifetime(log, [L]).drop("_n", "day"))


def test_feature_table_keeps_every_label_day_row_once(spark, log):
    features = point_in_time_features(raw_log(spark, SF_DIR), PLAN)
    wanted = {r[0] for r in log.filter(F.col("day").isin(list(PLAN.label_days))).select("instance_id").collect()}
    got = [r[0] for r in features.select("instance_id").collect()]
    assert len(got) == len(wanted) and set(got) == wanted
    split = point_in_time_features(raw_log(spark, SF_DIR), PLAN, broadcast_bytes=0, hot_keys=2)
    assert rows(split) == rows(features)


def test_without_list_features(spark):
    features = point_in_time_features(raw_log(spark, SF_DIR), PLAN, lists=False)
    assert not [c for c in features.columns if "list" in c or c.startswith("predict_")]
