"""Hand-made frames for the cases that are easy to get wrong."""

from __future__ import annotations

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywind.functions import bins, lists, time
from tallywind.operators import aggregates, clean, evaluate, history, joins
from tallywind.schema import LOG_SCHEMA
from tallywind.sources import text
from tallywind.storage import store


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_dedupe_by_keeps_the_first_of_conflicting_rows(spark):
    df = spark.createDataFrame([(1, 20, "late"), (1, 10, "early"), (2, 5, "only")], "id int, ts int, v string")
    assert sorted(values(clean.dedupe_by(df, ["id"], ["ts"]), "id", "v")) == [(1, "early"), (2, "only")]


def test_dedupe_rows_keeps_null_rows_once(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int")
    assert clean.dedupe_rows(df).count() == 2


@pytest.mark.parametrize("name", list(bins.FLAG_SETS))
def test_flags_in_force_are_a_subset_of_the_intended_ones(name):
    assert set(bins.FLAG_SETS[name]) <= set(bins.INTENDED_FLAG_SETS[name])


def bin_by_hand(x, b):
    for i in range(1, b.count):
        if b.start + b.step * (i - 1) <= x <= b.start + b.step * i:
            return i + 1
    return 1 if x == b.sentinel else None


@pytest.mark.parametrize("b", [bins.DELIVERY, bins.REVIEW, bins.SERVICE, bins.DESCRIPTION])
def test_bins_match_a_scan_of_the_edges(spark, b):
    xs = [b.start + b.step * i for i in range(b.count + 2)] + [round(b.start + b.step * i, 3) for i in range(b.count + 2)]
    xs += [x + e for x in xs for e in (-1e-12, 1e-12, b.step / 3)] + [b.sentinel, -1.0, 0.0, 99.0, b.start - 1e-9]
    xs += [0.9 * 5 + i * 0.005 for i in range(100)]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = values(df.select("x", bins.bin_uniform("x", b).alias("code")), "x", "code")
    assert [(x, code) for x, code in got if code != bin_by_hand(x, b)] == []


def test_level2_sends_unbinned_values_to_three(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (4,), (5,), (7,), (8,)], "c int")
    got = [r[0] for r in df.select(bins.bin_level2("c", bins.DELIVERY)).collect()]
    assert got == [3, 3, 1, 1, 2, 2, 3]


def test_lists_shorter_than_the_index(spark):
    df = spark.createDataFrame([("a;b",), ("-1",), ("7:1,2;8:3",)], "v string")
    assert [r[0] for r in df.select(lists.list_item("v", 1)).collect()] == ["b", "", "8:3"]
    assert [r[0] for r in df.select(lists.list_length("v")).collect()] == [2, 1, 2]
    numeric = df.filter("v <> 'a;b'")
    assert values(numeric.select(*[lists.predicted_category("v", i).alias(f"c{i}") for i in range(3)]), "c0", "c1", "c2") == [(-1, -1, -1), (7, 8, -1)]
    with pytest.raises(PySparkException):
        df.filter("v = '-1'").select(lists.list_number("v", 1)).collect()


def test_clock_in_another_zone_than_the_session(spark):
    df = spark.createDataFrame([(1537228800,)], "context_timestamp bigint")  # 2018-09-18 00:00 UTC
    row = df.select(
        time.epoch_to_datetime("context_timestamp", "Asia/Shanghai").alias("t"),
        time.day_of_month("context_timestamp", "America/New_York").alias("d"),
        time.hour_of_day("context_timestamp", "America/New_York").alias("h"),
    ).first()
    assert tuple(row) == ("2018-09-18 08:00:00", 17, 20)


def test_hours_wrap(spark):
    df = spark.createDataFrame([(0,), (23,)], "hour int")
    assert values(df.select(time.hour_before("hour").alias("b"), time.hour_after("hour").alias("a")), "b", "a") == [(23, 1), (22, 0)]


LOG = "instance_id int, user_id int, item_id int, shop_id int, day int, hour int, context_timestamp bigint, is_trade int"


def make_log(spark, rows):
    return spark.createDataFrame(rows, LOG)


def test_rate_of_keys_seen_only_early_or_unlabelled(spark):
    log = make_log(
        spark,
        [
            (1, 1, 1, 1, 21, 0, 0, 1),  # day L-3 only
            (2, 1, 2, 1, 23, 0, 0, None),  # only null labels
            (3, 1, 3, 1, 23, 0, 0, 1),
            (4, 1, 3, 1, 22, 0, 0, 0),
        ],
    )
    got = {r["item_id"]: r for r in history.history_rate(log, "item_id", 24).collect()}
    assert got[1]["mean_item_id_before_1_day"] == 0 and got[1]["count_item_id_before_1_day"] == 0
    assert got[1]["mean_item_id_before_3_day"] == 1 and got[1]["count_item_id_before_3_day"] == 1
    assert got[2]["mean_item_id_before_3_day"] == 0 and got[2]["count_item_id_before_3_day"] == 0
    assert got[3]["mean_item_id_before_1_day"] == 1 and got[3]["mean_item_id_before_2_day"] == 0.5


def test_other_day_spans(spark):
    log = make_log(spark, [(i, 1, 1, 1, d, 0, 0, 1) for i, d in enumerate(range(10, 24))])
    row = history.history_rate(log, "item_id", 24, days=(7, 2)).first()
    assert row["count_item_id_before_7_day"] == 7 and row["count_item_id_before_2_day"] == 2


def test_counts_are_null_on_the_first_day_and_zero_for_new_keys(spark):
    log = make_log(spark, [(1, 1, 1, 1, 18, 0, 0, 0), (2, 1, 2, 1, 19, 0, 0, 0), (3, 2, 1, 1, 20, 0, 0, 0)])
    got = {r["instance_id"]: r for r in history.before_counts(log, 18).collect()}
    assert got[1]["user_cnt1"] is None and got[1]["user_cntx"] is None
    assert got[2]["user_cnt1"] == 1 and got[2]["item_cnt1"] == 0 and got[2]["item_cntx"] == 0
    assert got[3]["item_cnt1"] == 0 and got[3]["item_cntx"] == 1 and got[3]["shop_cntx"] == 2


def test_null_keys_are_not_counted(spark):
    log = make_log(spark, [(1, None, 1, 1, 18, 0, 0, 0), (2, None, 1, 1, 19, 0, 0, 0)])
    got = {r["instance_id"]: r for r in history.before_counts(log, 18).collect()}
    assert got[2]["user_cnt1"] is None and got[2]["item_cnt1"] == 1
    assert values(history.same_period_count(log), "user_query_day") == [(None,), (None,)]


def test_lifetime_edges(spark):
    log = make_log(
        spark,
        [
            (1, 1, 1, 1, 20, 0, 100, 1),  # converts on the first event only: zero span to conversion
            (2, 1, 1, 1, 21, 0, 400, 0),
            (3, 2, 1, 1, 20, 0, 100, 0),  # one event
            (4, 3, 1, 1, 20, 0, 100, 0),
            (5, 3, 1, 1, 22, 0, 300, 1),
            (6, 9, 1, 1, 24, 0, 900, 0),  # first seen on the label day
        ],
    )
    got = {r["user_id"]: r for r in history.history_user_lifetime(log, 24).collect()}
    assert math.isinf(got[1]["alive/alive_cov"]) and got[1]["alive_cov"] == 0 and got[1]["alive"] == 300
    assert got[2]["alive/alive_cov"] == -1 and got[2]["alive"] == 0
    assert got[3]["alive/alive_cov"] == 1 and got[3]["s_alive"] == 24 - 100
    assert 9 not in got
    daily = {r["user_id"]: r for r in history.daily_user_lifetime(log, [24]).collect()}
    assert daily[9]["alive"] == -1 and daily[9]["alive/s_alive"] == -1


def test_lifetime_in_seconds(spark):
    log = make_log(spark, [(1, 1, 1, 1, 20, 0, 100, 0), (2, 1, 1, 1, 21, 0, 400, 0)])
    row = history.history_user_lifetime(log, 24, label_epoch=1000).first()
    assert row["s_alive"] == 900 and row["alive/s_alive"] == pytest.approx(300 / 900)


def test_std_of_one_row_is_null(spark):
    log = spark.createDataFrame([(23, 5, 1.0), (23, 6, 1.0), (23, 6, 3.0)], "day int, hour int, s double")
    got = {r["hour"]: r["s_hour_std_1"] for r in history.history_hour_std(log, 24, days=(1,), cols=["s"]).collect()}
    assert got[5] is None and got[6] == pytest.approx(math.sqrt(2))
    assert aggregates.group_std(log.filter("hour = 5"), "hour", "s").first()["s_std"] is None


def test_city_keyed_brand_count(spark):
    assert history.HOUR_COUNTS["item_brand_id_day"] == "item_city_id"


def test_loss_of_certain_scores_and_ties_in_auc(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.5), (0, 0.5)], "is_trade int, predicted_score double")
    loss = evaluate.log_loss(df).first()[0]
    assert loss == pytest.approx((-2 * math.log(1 - 1e-15) - 2 * math.log(0.5)) / 4)
    wrong = spark.createDataFrame([(0, 1.0)], "is_trade int, predicted_score double")
    assert evaluate.log_loss(wrong).first()[0] == pytest.approx(-math.log(1e-15), rel=1e-2)
    assert evaluate.roc_auc(df).first()[0] == pytest.approx((1 + 1 + 1 + 0.5) / 4)
    assert evaluate.roc_auc(wrong).first()[0] is None


def test_unclipped_loss_keeps_the_worst_rows(spark):
    def loss(*rows):
        return evaluate.log_loss(spark.createDataFrame(list(rows), "is_trade int, predicted_score double"), eps=None).first()[0]

    assert loss((1, 0.0), (0, 0.5)) == math.inf and loss((0, 1.0), (0, 0.5)) == math.inf
    assert loss((1, 1.0), (0, 0.0), (1, 0.5)) == pytest.approx(-math.log(0.5) / 3)
    assert loss((None, 0.3), (None, None), (1, 0.5)) == pytest.approx(-math.log(0.5))
    for eps in (None, 1e-15):
        missing = spark.createDataFrame([(1, None), (0, 0.5)], "is_trade int, predicted_score double")
        with pytest.raises(Exception, match="predicted_score is null"):
            evaluate.log_loss(missing, eps=eps).first()


def test_days_grow_over_a_month_end(spark):
    at = {31 + i: 1706659200 + 86400 * i for i in range(3)}  # 31 January and the two days after
    rows = [(i, 7, i, 3, t) for i, t in enumerate([at[31] - 30 * 86400, at[31], at[32], at[33]])]
    df = spark.createDataFrame(rows, "instance_id int, user_id int, item_id int, shop_id int, context_timestamp long")
    with pytest.raises(ValueError, match="more than one month"):
        time.check_day_number(df)
    time.check_day_number(df, day_number="index")
    log = time.with_clock(df, day_number="index")
    first = log.agg(F.min("day")).first()[0]
    counts = history.before_counts(log, first).orderBy("context_timestamp").collect()
    assert [r["user_cntx"] for r in counts] == [None, 1, 2, 3]
    assert [r["user_cnt1"] for r in counts] == [None, 0, 1, 1]


def test_predicted_category_may_be_lenient(spark):
    df = spark.createDataFrame([("5:1;x:2",), ("-1",), (None,)], "p string")
    assert [r[0] for r in df.select(lists.predicted_category("p", 1, strict=False)).collect()] == [-1, -1, -1]
    with pytest.raises(Exception, match="CAST"):
        df.select(lists.predicted_category("p", 1)).collect()


def test_long_text_keys_count_by_their_length(spark):
    keys = spark.range(3000).selectExpr("concat(repeat('k', 1000), id) as k", "id as v")
    assert store(keys).bytes > 3000 * 1000


def test_concat_cross_collides_and_rejects_negative_seconds(spark):
    df = spark.createDataFrame([(1, 12), (11, 2), (1, -1)], "a int, b int")
    assert [r[0] for r in df.select(bins.concat_cross("a", "b")).collect()] == [112, 112, None]


def test_fill_null_from_column_and_value(spark):
    df = spark.createDataFrame([(None, 7), (3, None)], "a int, b int")
    assert values(clean.fill_null(df, F.col("b"), ["a"]), "a") == [(7,), (3,)]
    assert values(clean.fill_null(df, 0), "a", "b") == [(0, 7), (3, 0)]


def test_null_is_not_the_sentinel(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (2.0,)], "a double")
    assert clean.drop_sentinel_rows(df, "a", -1.0).count() == 2


def test_lookup_and_restore(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "instance_id int, k int")
    table = spark.createDataFrame([(5, 9)], "k int, n bigint")
    assert sorted(values(joins.lookup_or_default(df, table, ["k"]), "instance_id", "n")) == [(1, 9), (2, 0), (3, 0)]
    scores = spark.createDataFrame([(1, 0.5)], "instance_id int, predicted_score double")
    assert sorted(values(joins.restore_rows(df, scores), "instance_id", "predicted_score")) == [(1, 0.5), (2, 0.0), (3, 0.0)]


def test_text_round_trip_with_ragged_spaces(spark, tmp_path):
    row = [1, 2, "79;1", "3;4", 5, 6, 7, 8, 9, 10, 11, 0, 1001, 2003, 3004, 12, 13, 4001, "79:1;-1", 14, 3, 0.5, 5000, 0.9, 0.91, 0.92, 1]
    names = LOG_SCHEMA.names
    body = [" ".join(names), "   ".join(map(str, row)), "  " + "\t".join(map(str, row)) + "  "]
    (tmp_path / "log.txt").write_text("\n".join(body) + "\n")
    assert [list(r) for r in text.read_log_ws(spark, str(tmp_path / "log.txt")).collect()] == [row, row]
    (tmp_path / "plain.txt").write_text("\n".join([" ".join(names), " ".join(map(str, row))]) + "\n")
    assert [list(r) for r in text.read_log(spark, str(tmp_path / "plain.txt")).collect()] == [row]
    unlabelled = LOG_SCHEMA.__class__(LOG_SCHEMA.fields[:-1])
    (tmp_path / "test.txt").write_text("\n".join([" ".join(names[:-1]), " ".join(map(str, row[:-1]))]) + "\n")
    both = clean.union_rows(text.read_log(spark, str(tmp_path / "plain.txt")), text.read_log(spark, str(tmp_path / "test.txt"), unlabelled))
    assert sorted(values(both, "is_trade"), key=repr) == [(1,), (None,)]


def test_written_scores_have_a_header(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.25, "x")], "instance_id int, predicted_score double, other string").coalesce(1)
    text.write_scores(df, str(tmp_path / "scores"))
    lines = [p.read_text() for p in (tmp_path / "scores").glob("part-*")]
    assert lines == ["instance_id predicted_score\n1 0.25\n"]
