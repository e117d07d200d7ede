"""States kept day by day equal one build over the log."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallywind.operators import day_state, history
from tallywind.storage import store


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([None, 1, 2, 3, 4]), rng.randint(1, 6), rng.choice([0, 1, None]), rng.gauss(1000, 1), 10**9 + rng.randint(0, 9999), rng.randint(0, 3)) for i in range(600)]
    return store(spark.createDataFrame(rows, "instance_id int, item_id int, day int, is_trade int, score double, ts long, hour int")).df


def rows(df):
    return sorted([tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()], key=str)


MEASURES = ["is_trade", "score", "ts"]


def write(log, folder, days):
    day_state.write_days(log, folder, ["item_id"], MEASURES, days, centre={"score": 1000.0, "ts": 1e9})


def read(spark, folder, first=1, behind=7):
    return day_state.read_days(spark, folder, ["item_id"], first, behind)


def test_steps_equal_one_build(spark, log, tmp_path):
    once, steps = str(tmp_path / "once"), str(tmp_path / "steps")
    write(log, once, [1, 2, 3, 4, 5])
    for d in (1, 2, 3, 4, 5):
        write(log, steps, [d])
    assert rows(read(spark, steps)) == rows(read(spark, once))
    write(log, steps, [3])  # again
    assert rows(read(spark, steps)) == rows(read(spark, once))


def test_a_late_day_replaces_its_own(spark, log, tmp_path):
    folder = str(tmp_path / "late")
    write(log.where("day <> 2 or instance_id % 2 = 0"), folder, [1, 2, 3])
    write(log, folder, [2])
    whole = str(tmp_path / "whole")
    write(log, whole, [1, 2, 3])
    assert rows(read(spark, folder)) == rows(read(spark, whole))
    write(log.where("day <> 2"), folder, [2])  # its rows were taken back
    assert rows(read(spark, folder)) == rows(read(spark, whole).where("day <> 2"))


def test_features_out_of_states(spark, log, tmp_path):
    folder = str(tmp_path / "features")
    write(log, folder, [1, 2, 3, 4, 5])
    states = read(spark, folder, 2, 5)
    assert rows(day_state.history_rate_of(states, "item_id", 5)) == rows(history.history_rate(log, "item_id", 5))
    std = day_state.history_std_of(states, "item_id", ["score"], 5)
    want = history.history_hour_std(log, 5, cols=["score"], hour="item_id").where("item_id is not null")
    assert rows(std) == rows(want.withColumnsRenamed({f"score_hour_std_{d}": f"score_item_id_std_{d}" for d in (1, 2, 3)}))
    spans = log.where("day < 5 and item_id is not null").groupBy("item_id").agg(F.min("ts").alias("day_begin"), F.max("ts").alias("day_end"))
    assert rows(day_state.spans_of(read(spark, folder, 1, 5), "item_id", "ts", 5)) == rows(spans)


def test_only_the_days_asked_for_are_read(spark, log, tmp_path):
    folder = str(tmp_path / "pruned")
    write(log, folder, [1, 2, 3, 4, 5])
    files = day_state.history_rate_of(read(spark, folder, 2, 5), "item_id", 5)
    assert "PartitionFilters: [isnotnull(day" in files._jdf.queryExecution().executedPlan().toString()
    read_from = {r[0].split("day=")[1][0] for r in read(spark, folder, 2, 5).select(F.input_file_name()).distinct().collect()}
    assert read_from == {"2", "3", "4"}
    # A new day reads that day of the log.
    day_state.write_days(log, str(tmp_path / "one"), ["item_id"], MEASURES, [5])
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "one")).select("day").distinct().collect()] == [5]
