"""The shuffle route of every size-dependent operator gives what the small route gives."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywind.operators import cross, encode
from tallywind.operators.joins import attach, attach_all
from tallywind.operators.ordering import row_index, running_total
from tallywind.operators.splits import hash_fold, kfold
from tallywind.storage import store

random.seed(7)


@pytest.fixture(scope="module")
def log(spark):
    """A third of the rows share one user, some keys are null."""
    rows = []
    for i in range(1500):
        user = 1 if i % 3 == 0 else random.randint(2, 60)
        item = random.choice([None, *range(1, 40)])
        rows.append((i, None if i % 97 == 0 else user, item, random.randint(0, 3), None if i % 89 == 0 else random.randint(0, 5)))
    return spark.createDataFrame(rows, "instance_id bigint, user_id bigint, item_id bigint, level int, grade int").cache()


def as_set(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("weight", [None, "_n"])
@pytest.mark.parametrize("hot_keys", [1, 5, 1000])
def test_split_join_equals_broadcast_join(log, weight, hot_keys):
    table = log.filter("user_id is not null").groupBy("user_id").agg(F.count("*").alias("_n"), F.max("grade").alias("best"))
    table = table if weight else table.drop("_n")
    small = attach(log, table, ["user_id"], weight=weight)
    large = attach(log, table, ["user_id"], weight=weight, broadcast_bytes=0, hot_keys=hot_keys)
    assert as_set(small) == as_set(large)
    assert large.count() == log.count()


def test_split_join_matches_null_keys_when_asked(log):
    table = log.groupBy("user_id", "item_id").agg(F.count("*").alias("pairs"))
    joined = attach(log, table, ["user_id", "item_id"], null_safe=True, broadcast_bytes=0, hot_keys=3)
    assert joined.filter("pairs is null").count() == 0
    assert as_set(joined) == as_set(attach(log, table, ["user_id", "item_id"], null_safe=True))


def test_unknown_keys_stay_null(log):
    table = log.filter("user_id = 1").groupBy("user_id").agg(F.count("*").alias("n"))
    for limit in (0, 1 << 20):
        assert attach(log, table, ["user_id"], broadcast_bytes=limit).filter("n is not null and user_id <> 1").count() == 0


def test_lookups_share_one_broadcast_budget(log):
    users = log.filter("user_id is not null").groupBy("user_id").agg(F.count("*").alias("u"))
    items = log.filter("item_id is not null").groupBy("item_id").agg(F.count("*").alias("i"))
    both = attach_all(log, [(users, ["user_id"]), (items, ["item_id"])], broadcast_bytes=60 * 16)
    assert as_set(both) == as_set(attach_all(log, [(users, ["user_id"]), (items, ["item_id"])]))


def test_split_join_spreads_a_hot_key(log):
    """With the hot user taken out, no shuffle partition holds a third of the rows."""
    table = log.filter("user_id is not null").groupBy("user_id").agg(F.count("*").alias("_n"), F.max("grade").alias("best"))
    joined = attach(log, table, ["user_id"], weight="_n", broadcast_bytes=0, hot_keys=4)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.45 * sum(sizes) or len(sizes) == 1


BLOCK = [
    cross.Cross("user_id", ("item_id", "level"), "user"),
    cross.Cross("level", ("item_id", "grade"), "level"),
    cross.Cross("grade", ("item_id",), "grade", pair_key="level"),
]


def brute_force(pdf: pd.DataFrame) -> pd.DataFrame:
    out = pdf.copy()
    for x in BLOCK:
        total = pdf.groupby(x.anchor)["instance_id"].transform("count")
        for c in x.cols:
            pair = pdf.groupby([c, x.key])["instance_id"].transform("count")
            out[f"{c}_{x.prefix}_cnt"] = pair
            out[f"{c}_{x.prefix}_prob"] = pair / total
    return out


@pytest.mark.parametrize("group_limit", [1_000_000, 400, 40, 1])
@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 0])
def test_cross_counts_by_every_route(log, group_limit, broadcast_bytes):
    if broadcast_bytes == 0 and group_limit == 400:
        pytest.skip("covered by the others")
    got = cross.cross_counts(log, BLOCK, group_limit=group_limit, broadcast_bytes=broadcast_bytes, hot_keys=2).toPandas()
    want = brute_force(log.toPandas())
    got, want = (f.sort_values("instance_id").reset_index(drop=True) for f in (got, want))
    assert len(got) == len(want)
    for c in cross.feature_names(BLOCK):
        pd.testing.assert_series_equal(got[c].astype(float), want[c].astype(float), check_names=False)


@pytest.mark.parametrize("group_limit", [1_000_000, 40])
def test_counts_on_rows_equal_counts_of_combinations(log, group_limit):
    """Null ids are not counted, null anchors and partners have no counts, whichever way is taken."""
    log = log.withColumn("instance_id", F.when(F.col("instance_id") % 11 != 0, F.col("instance_id")))
    block = [cross.Cross("user_id", ("item_id", "level", "grade"), "user")]
    rows = cross.cross_counts(log, block, group_limit=group_limit, broadcast_bytes=0)
    assert as_set(rows) == as_set(cross.cross_counts(log, block, row_anchors=()))


def test_user_crosses_stand_on_one_exchange(log):
    block = [cross.Cross("user_id", ("item_id", "level"), "user"), cross.Cross("user_id", ("grade",), "other")]
    plan = cross.cross_counts(store(log).df, block)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 1 and plan.count("Exchange") == 1
    assert "<=>" not in plan and "Join" not in plan


def test_text_columns_can_be_crossed(log):
    text = log.withColumn("level", F.concat(F.lit("l"), F.col("level").cast("string")))
    got = cross.cross_counts(text, BLOCK).agg(F.sum("item_id_level_cnt")).first()[0]
    assert got == cross.cross_counts(log, BLOCK).agg(F.sum("item_id_level_cnt")).first()[0]


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_running_total(log, ranges):
    got = running_total(log.fillna(0), ["instance_id"], "grade", "before", ranges).toPandas().sort_values("instance_id")
    want = log.toPandas().fillna(0).sort_values("instance_id")["grade"].cumsum().shift(1, fill_value=0)
    assert got["before"].tolist() == want.astype(int).tolist()


def test_row_index_is_gapless(log):
    got = row_index(log, ["instance_id"], ranges=5).select("instance_id", "index").collect()
    assert all(r["instance_id"] == r["index"] for r in got)


@pytest.mark.parametrize("n,k", [(10, 5), (13, 5), (3, 5), (1500, 7)])
def test_kfold_sizes(spark, n, k):
    folds = kfold(spark.range(n).withColumnRenamed("id", "instance_id"), k).toPandas().sort_values("instance_id")["fold"].tolist()
    sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
    assert folds == [i for i, size in enumerate(sizes) for _ in range(size)]


def test_hash_fold_covers_all_folds(log):
    assert {r["fold"] for r in hash_fold(log, 5).select("fold").distinct().collect()} == set(range(5))


@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 0])
def test_label_codes_follow_numeric_order(spark, broadcast_bytes):
    df = spark.createDataFrame([(i, v, str(v)) for i, v in enumerate([10, 2, 1, 2, 10, 1])], "instance_id int, n bigint, t string")
    got = encode.label_encode(df, ["n", "t"], broadcast_bytes=broadcast_bytes).orderBy("instance_id").collect()
    assert [r["n_code"] for r in got] == [2, 1, 0, 1, 2, 0]
    assert [r["t_code"] for r in got] == [1, 2, 0, 2, 1, 0]  # "1" < "10" < "2"


def test_unseen_categories_share_one_code(spark):
    train = spark.createDataFrame([(1,), (5,)], "v bigint")
    df = spark.createDataFrame([(1,), (5,), (7,), (9,)], "v bigint")
    codes = encode.label_codes(train, ["v"])
    assert [r["v_cat"] for r in encode.to_category(codes, df).orderBy("v").collect()] == [0, 1, 2, 2]


def test_stored_table_knows_its_rows(log):
    assert store(log).rows == 1500
