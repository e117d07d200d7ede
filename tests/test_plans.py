"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tallywind.operators import clean, history
from tallywind.operators.aggregates import group_size
from tallywind.sources.standin import PLAN, clean_log, raw_log
from tallywind.storage import store
from tallywind.suite import QUERIES


@pytest.fixture(scope="module")
def log(spark):
    return store(clean_log(spark, SF_DIR)).df


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["dedupe_rows", "same_period_count", "daily_history_rate", "item_cross", "bin_level2", "predicted_category", "roc_auc"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert word not in text


def test_history_reads_only_its_columns_and_days(log):
    text = plan(history.daily_history_rate(log, "item_id", label_days=[PLAN.valid]))
    assert "ReadSchema: struct<item_id:bigint,is_trade:int,day:int>" in text
    assert "LessThanOrEqual(day,29)" in text and "GreaterThanOrEqual(day,26)" in text
    assert text.count("Exchange") == 2  # one by (key, day), one of the daily rows by key


def test_one_day_history_has_one_shuffle(log):
    text = plan(history.history_rate(log, "item_id", PLAN.valid))
    assert text.count("Exchange") == 1 and "partial_avg" in text


def test_grouped_counts_merge_before_the_shuffle(log):
    text = plan(group_size(log, ["user_id", "day"], "n"))
    assert "partial_count" in text and text.count("Exchange") == 1


def test_first_row_per_key_is_limited_before_the_shuffle(spark):
    text = plan(clean.dedupe_by(raw_log(spark, SF_DIR), ["instance_id"], ["context_timestamp"]))
    assert text.count("WindowGroupLimit") == 2


def test_row_functions_do_not_shuffle(log):
    text = plan(clean.replace_sentinel(clean.sentinel_to_zero(log)).withColumn("h", F.col("hour") + 1))
    assert "Exchange" not in text
