"""Every registered query with SQL gives what DuckDB gives, at the smallest scale."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

import __spark_entry__ as registered
from check import compare


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_same_as_sql(spark, checker, name):
    rows, difference = compare(registered.queries()[name], spark, SF_DIR, checker, registered.oracle_sql()[name])
    assert difference is None
    assert rows > 0


def test_entry_is_the_whole_label_days_table(spark):
    frame = registered.entry(spark)
    assert {"mean_item_id_before_3_day", "alive/alive_cov", "shop_score_service_hour_std_3"} <= set(frame.columns)
    assert frame.count() > 0
