"""Joins, aggregates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywind.functions import bins, lists, time
from tallywind.functions.bins import DELIVERY, DESCRIPTION, REVIEW, SERVICE
from tallywind.operators import aggregates as agg
from tallywind.operators import encode, joins
from tallywind.operators.clean import drop_sentinel_rows
from tallywind.schema import SHOP_MEASURES
from tallywind.sources.standin import PLAN
from tallywind.suite.registry import log_case, on_log

V, T = PLAN.valid, PLAN.test


@log_case("left_join", on_log("select instance_id, n from log left join (select item_id, count(*) as n from log where day < 29 group by 1) using (item_id)"))
def _(log):
    table = agg.group_size(log.filter(F.col("day") < V), "item_id", "n")
    return joins.left_join(log, table, ["item_id"]).select("instance_id", "n")


@log_case(
    "left_join_two_keys",
    on_log("select instance_id, n from log left join (select shop_id, hour, count(*) as n from log where day < 29 group by 1, 2) using (shop_id, hour)"),
)
def _(log):
    table = agg.group_size(log.filter(F.col("day") < V), ["shop_id", "hour"], "n")
    return joins.attach(log, table, ["shop_id", "hour"]).select("instance_id", "n")


@log_case(
    "outer_join_fill",
    on_log(
        """select item_id, coalesce(a.n, 0) as n1, coalesce(b.n, 0) as n2, coalesce(c.n, 0) as n3
        from (select item_id, count(*) as n from log where day = 28 group by 1) a
        full join (select item_id, count(*) as n from log where day in (27, 28) group by 1) b using (item_id)
        full join (select item_id, count(*) as n from log where day in (26, 27, 28) group by 1) c using (item_id)"""
    ),
)
def _(log):
    windows = [agg.group_size(log.filter((F.col("day") >= V - d) & (F.col("day") < V)), "item_id", f"n{d}") for d in (1, 2, 3)]
    return joins.outer_join_fill(windows, ["item_id"])


@log_case(
    "lookup_or_default",
    on_log("select instance_id, coalesce(n, 0) as n from log left join (select user_id, count(*) as n from log where day = 28 group by 1) using (user_id)"),
)
def _(log):
    table = agg.group_size(log.filter(F.col("day") == V - 1), "user_id", "n")
    return joins.lookup_or_default(log, table, ["user_id"]).select("instance_id", "n")


@log_case(
    "join_by_id",
    on_log("select instance_id, x from log left join (select instance_id, hour + 1 as x from log where day > 1) using (instance_id)"),
)
def _(log):
    rows = log.filter(F.col("day") > 1).select("instance_id", (F.col("hour") + 1).alias("x"))
    return joins.join_by_id(log.select("instance_id"), rows)


@log_case(
    "restore_rows",
    on_log("select instance_id, case when shop_score_service <> -1 then round(shop_score_service / 2, 6) else 0 end as predicted_score from log where day = 30"),
)
def _(log):
    test = log.filter(F.col("day") == T)
    scores = drop_sentinel_rows(test, "shop_score_service", -1.0).select("instance_id", (F.col("shop_score_service") / 2).alias("predicted_score"))
    return joins.restore_rows(test, scores)


@log_case("group_size", on_log("select user_id, day, hour, count(*) as n from log group by 1, 2, 3"))
def _(log):
    return agg.group_size(log, ["user_id", "day", "hour"], "n")


@log_case("group_count", on_log("select item_brand_id, count(is_trade) as n from log group by 1"))
def _(log):
    return agg.group_count(log, "item_brand_id", "is_trade", "n")


@log_case("group_mean_count", on_log("select shop_id, round(avg(is_trade), 6) as mean, count(is_trade) as count from log group by 1"))
def _(log):
    return agg.group_mean_count(log, "shop_id")


@log_case("group_min_max", on_log("select user_id, min(context_timestamp) as day_begin, max(context_timestamp) as day_end from log group by 1"))
def _(log):
    return agg.group_min_max(log, "user_id", "context_timestamp")


@log_case("group_max_where", on_log("select user_id, max(context_timestamp) as day_end_cov from log where is_trade = 1 group by 1"))
def _(log):
    return agg.group_max_where(log, F.col("is_trade") == 1, "user_id", "context_timestamp")


@log_case("group_std", on_log("select hour, " + ", ".join(f"round(stddev_samp({c}), 6) as {c}_std" for c in SHOP_MEASURES) + " from log group by 1"))
def _(log):
    return agg.group_std(log, "hour", *SHOP_MEASURES)


@log_case(
    "group_mean_median_std",
    on_log(
        """select day, hour, round(avg(item_pv_level), 6) as item_pv_level_mean, cast(median(item_pv_level) as double) as item_pv_level_median,
        round(stddev_samp(item_pv_level), 6) as item_pv_level_std from log group by 1, 2"""
    ),
)
def _(log):
    return agg.group_mean_median_std(log, ["day", "hour"], "item_pv_level")


@log_case("scalar_agg", on_log("select cast(day - (select min(day) from log where is_trade is not null) as int) as days_in, count(*) as n from log group by 1"))
def _(log):
    first = agg.scalar_agg(log.filter(F.col("is_trade").isNotNull()), F.min("day"))
    return log.groupBy((F.col("day") - first).alias("days_in")).agg(F.count(F.lit(1)).alias("n"))


@log_case("distinct_values", on_log("select distinct day from log"))
def _(log):
    return agg.distinct_values(log, "day")


@log_case("value_counts", on_log("select item_sales_level, count(*) as count from log group by 1"))
def _(log):
    return agg.value_counts(log, "item_sales_level")


@log_case("mean_of", on_log("select round(avg(r), 6) as mean_r from (select day, avg(is_trade) as r from log where is_trade is not null group by 1)"))
def _(log):
    daily = log.filter(F.col("is_trade").isNotNull()).groupBy("day").agg(F.avg("is_trade").alias("r"))
    return agg.mean_of(daily, "r")


@log_case(
    "epoch_to_datetime",
    on_log(
        """select instance_id, strftime(to_timestamp(context_timestamp) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as utc,
        strftime(to_timestamp(context_timestamp) at time zone 'UTC' + interval 8 hour, '%Y-%m-%d %H:%M:%S') as shanghai from log"""
    ),
)
def _(log):
    return log.select(
        "instance_id",
        time.epoch_to_datetime("context_timestamp").alias("utc"),
        time.epoch_to_datetime("context_timestamp", "Asia/Shanghai").alias("shanghai"),
    )


@log_case(
    "day_of_month_hour_of_day",
    on_log(
        """select instance_id, cast((context_timestamp + 28800) // 86400 - 19722 as int) as day, cast((context_timestamp + 28800) % 86400 // 3600 as int) as hour,
        cast((context_timestamp + 28800) // 86400 as int) as day_index from log"""
    ),
)
def _(log):
    tz = "Asia/Shanghai"
    return log.select(
        "instance_id",
        time.day_of_month("context_timestamp", tz).alias("day"),
        time.hour_of_day("context_timestamp", tz).alias("hour"),
        time.day_index("context_timestamp", tz).alias("day_index"),
    )


@log_case(
    "hour_before_hour_after",
    on_log("select instance_id, case when hour = 0 then 23 else hour - 1 end as hour_before, case when hour = 23 then 0 else hour + 1 end as hour_after from log"),
)
def _(log):
    return log.select("instance_id", time.hour_before("hour").alias("hour_before"), time.hour_after("hour").alias("hour_after"))


@log_case("hour_bucket", on_log("select instance_id, case when hour < 7 then 3 when hour <= 12 then 1 when hour <= 20 then 2 else 3 end as hour_map from log"))
def _(log):
    return log.select("instance_id", time.hour_bucket("hour").alias("hour_map"))


@log_case(
    "list_length",
    on_log(
        """select instance_id, cast(len(string_split(item_category_list, ';')) as int) as c, cast(len(string_split(item_property_list, ';')) as int) as p,
        cast(len(string_split(predict_category_property, ';')) as int) as q from log"""
    ),
)
def _(log):
    cols = {"c": "item_category_list", "p": "item_property_list", "q": "predict_category_property"}
    return log.select("instance_id", *[lists.list_length(v).alias(k) for k, v in cols.items()])


@log_case(
    "list_item",
    on_log(
        "select instance_id, cast(split_part(item_category_list, ';', 1) as bigint) as first_category, "
        + ", ".join(f"split_part(item_property_list, ';', {i + 1}) as p{i}" for i in range(10))
        + " from log"
    ),
)
def _(log):
    pieces = [lists.list_item("item_property_list", i).alias(f"p{i}") for i in range(10)]
    return log.select("instance_id", lists.list_number("item_category_list", 0).alias("first_category"), *pieces)


_PREDICTED = ", ".join(
    f"coalesce(try_cast(split_part(split_part(predict_category_property, ';', {i + 1}), ':', 1) as bigint), -1) as predict_category_{i}" for i in range(3)
)


@log_case("predicted_category", on_log(f"select instance_id, {_PREDICTED} from log"))
def _(log):
    return log.select("instance_id", *[lists.predicted_category("predict_category_property", i).alias(f"predict_category_{i}") for i in range(3)])


_PARTS = f"parts as (select instance_id, cast(split_part(item_category_list, ';', 1) as bigint) as item_category_list_1, cast(split_part(item_category_list, ';', 2) as bigint) as item_category_list_2, {_PREDICTED} from log)"


@log_case(
    "category_match_flags",
    on_log(
        "select instance_id, "
        + ", ".join(
            f"case when item_category_list_{c} = predict_category_{p} then 1 else 0 end as item_category_list_{c}_predict_category_{p}" for c in (1, 2) for p in range(3)
        )
        + " from parts",
        _PARTS,
    ),
)
def _(log):
    parts = log.withColumns(
        {f"item_category_list_{i + 1}": lists.list_number("item_category_list", i) for i in range(2)}
        | {f"predict_category_{i}": lists.predicted_category("predict_category_property", i) for i in range(3)}
    )
    flags = lists.category_match_flags(["item_category_list_1", "item_category_list_2"], [f"predict_category_{i}" for i in range(3)])
    return parts.select("instance_id", *[c.alias(n) for n, c in flags.items()])


_BINNED = {"deliver": ("shop_score_delivery", DELIVERY, 5), "service": ("shop_score_service", SERVICE, 5), "de": ("shop_score_description", DESCRIPTION, 5), "review": ("shop_review_positive_rate", REVIEW, 1)}


def _bin_sql(col: str, b, factor: int) -> str:
    """The bin by lookup: the smallest i whose closed interval holds the value."""
    x = f"({col} * {factor}::double)"
    lo = f"{b.start!r}::double + {b.step!r}::double * (i - 1)"
    hi = f"{b.start!r}::double + {b.step!r}::double * i"
    return f"(select cast(min(i) + 1 as int) from range(1, {b.count}) r(i) where {x} >= {lo} and {x} <= {hi})"


_KNOWN = "from log where shop_score_delivery <> -1 and shop_score_service <> -1 and shop_score_description <> -1 and shop_review_positive_rate <> -1"


def _known(log):
    out = log
    for c in ("shop_score_delivery", "shop_score_service", "shop_score_description", "shop_review_positive_rate"):
        out = drop_sentinel_rows(out, c, -1.0)
    return out.withColumns({c: F.col(c) * 5.0 for c, _, f in _BINNED.values() if f == 5})


_BINS_SQL = ", ".join(f"{_bin_sql(c, b, f)} as {n}_bin" for n, (c, b, f) in _BINNED.items())


@log_case("bin_uniform", on_log(f"select instance_id, {_BINS_SQL} {_KNOWN}"))
def _(log):
    return _known(log).select("instance_id", *[bins.bin_uniform(c, b).alias(f"{n}_bin") for n, (c, b, _) in _BINNED.items()])


_LEVELS_SQL = ", ".join(
    f"case when {n}_bin between {b.low[0]} and {b.low[1]} then 1 when {n}_bin between {b.middle[0]} and {b.middle[1]} then 2 else 3 end as {n}_map" for n, (_, b, _) in _BINNED.items()
)


@log_case(
    "bin_level2",
    on_log(
        "select *, case when deliver_map = 3 and service_map = 3 and de_map = 3 and review_map = 3 then 1 else 0 end as normal_shop from levels",
        f"binned as (select instance_id, {_BINS_SQL} {_KNOWN})",
        f"levels as (select instance_id, {_LEVELS_SQL} from binned)",
    ),
)
def _(log):
    levels = _known(log).select("instance_id", *[bins.bin_level2(bins.bin_uniform(c, b), b).alias(f"{n}_map") for n, (c, b, _) in _BINNED.items()])
    return levels.withColumn("normal_shop", bins.all_equal_flag({f"{n}_map": 3 for n in _BINNED}))


@log_case(
    "safe_ratio",
    on_log("select instance_id, round(case when item_collected_level <> 0 then item_price_level::double / item_collected_level end, 6) as ratio from log"),
)
def _(log):
    return log.select("instance_id", bins.safe_ratio("item_price_level", "item_collected_level").alias("ratio"))


_CODED = ["item_id", "item_brand_id", "item_city_id", "user_id", "shop_id", "item_property_list"]


@log_case("label_encode", on_log("select instance_id, " + ", ".join(f"dense_rank() over (order by {c}) - 1 as {c}_code" for c in _CODED) + " from log"))
def _(log):
    return encode.label_encode(log, _CODED).select("instance_id", *[f"{c}_code" for c in _CODED])


@log_case(
    "to_category",
    on_log(
        """select instance_id, coalesce(i.code, (select count(*) from i)) as item_id_cat, coalesce(u.code, (select count(*) from u)) as user_id_cat
        from log left join i using (item_id) left join u using (user_id)""",
        "i as (select item_id, dense_rank() over (order by item_id) - 1 as code from (select distinct item_id from log where day < 29))",
        "u as (select user_id, dense_rank() over (order by user_id) - 1 as code from (select distinct user_id from log where day < 29))",
    ),
)
def _(log):
    codes = encode.label_codes(log.filter(F.col("day") < V), ["item_id", "user_id"])
    return encode.to_category(codes, log).select("instance_id", "item_id_cat", "user_id_cat")


@log_case(
    "log_loss_terms",
    on_log(
        "select instance_id, round(case when is_trade = 1 then ln(p) else ln(1e0 - p) end, 6) as term from s",
        "s as (select instance_id, is_trade, 5e-2 + 1e-2 * item_price_level::double + 3e-2 * user_gender_id::double + 1e-1 as p from log where is_trade is not null)",
    ),
)
def _(log):
    p = F.lit(0.05) + F.lit(0.01) * F.col("item_price_level") + F.lit(0.03) * F.col("user_gender_id") + F.lit(0.1)
    scored = log.filter(F.col("is_trade").isNotNull()).withColumn("p", p)
    return scored.select("instance_id", bins.log_loss_terms("is_trade", "p").alias("term"))
