"""Reading and writing, projection, filters, nulls, deduplication, unions, order."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from tallywind.functions import bins
from tallywind.operators import clean, encode
from tallywind.schema import BASELINE_FEATURES, LOG_SCHEMA, SENTINEL_REPLACEMENTS, USER_LEVELS
from tallywind.sources.standin import PLAN, clean_log, raw_log
from tallywind.sources.text import read_log, read_log_checked, read_log_in_order, read_log_ws, write_scores, write_scores_file
from tallywind.storage import shared_dir
from tallywind.suite.registry import case, log_case, on_log

L, V, T = PLAN.train[-1], PLAN.valid, PLAN.test


def _fresh(spark) -> str:
    return f"{shared_dir(spark)}/text-{uuid.uuid4().hex}"


@case("read_log", on_log("select * from raw"))
def _(spark, sf):
    path = _fresh(spark)
    raw_log(spark, sf).write.csv(path, sep=" ", header=True)
    return read_log(spark, path)


# The file is laid out by id, copies together, so the number of a row is its rank.
@case("read_log_in_order", on_log("select *, row_number() over (order by instance_id) - 1 as row_number from raw"))
def _(spark, sf):
    path = _fresh(spark)
    raw_log(spark, sf).repartitionByRange(5, "instance_id").sortWithinPartitions("instance_id").write.csv(path, sep=" ", header=True)
    return read_log_in_order(spark, path)


# The first row of every user in the file.
@case("dedupe_by_file_order", on_log("select * from raw qualify row_number() over (partition by user_id order by instance_id desc) = 1"))
def _(spark, sf):
    path = _fresh(spark)
    order = F.desc("instance_id")
    raw_log(spark, sf).repartitionByRange(5, order).sortWithinPartitions(order).write.csv(path, sep=" ", header=True)
    return clean.dedupe_by(read_log_in_order(spark, path), ["user_id"], ["row_number"]).drop("row_number")


# Every fifth line is broken: a field too many, or a word for the item's id.
@case("read_log_checked", on_log("""select instance_id, item_id, null as reason from raw where instance_id % 10 not in (3, 8)
    union all select instance_id, null, case when instance_id % 10 = 3 then 'item_id is none' else '28 fields, not 27' end from raw where instance_id % 10 in (3, 8)"""))
def _(spark, sf):
    path = _fresh(spark)
    names = LOG_SCHEMA.names
    spoilt = F.when(F.col("instance_id") % 10 == 3, "none").otherwise(F.col("item_id").cast("string"))
    fields = [spoilt if c == "item_id" else F.col(c).cast("string") for c in names]
    line = F.concat_ws(" ", *[F.coalesce(f, F.lit("")) for f in fields])
    lines = raw_log(spark, sf).select(F.when(F.col("instance_id") % 10 == 8, F.concat(line, F.lit(" 1"))).otherwise(line).alias("value"))
    lines.write.text(f"{path}/lines")
    # A header in every file, as the reader expects.
    with_header = spark.read.text(f"{path}/lines", wholetext=True).select(F.concat(F.lit(" ".join(names) + "\n"), F.rtrim("value")).alias("value"))
    with_header.write.text(f"{path}/log")
    good, rejects = read_log_checked(spark, f"{path}/log", most_rejected=0.5)
    named = rejects.select(F.split_part("line", F.lit(" "), F.lit(1)).cast("long").alias("instance_id"), F.lit(None).cast("long").alias("item_id"), "reason")
    return good.select("instance_id", "item_id", F.lit(None).cast("string").alias("reason")).unionByName(named)


@case("read_log_ws", on_log("select * from raw"))
def _(spark, sf):
    path = _fresh(spark)
    names = LOG_SCHEMA.names
    header = F.lit("  ".join(names))
    line = F.concat_ws("  ", *[F.col(c).cast("string") for c in names])
    rows = raw_log(spark, sf).select(line.alias("value"))
    rows.unionByName(spark.range(1).select(header.alias("value"))).write.text(path)
    return read_log_ws(spark, path)


SCORE = "round(1e0 / (2e0 + item_price_level + user_age_level % 10), 6)"


@case("write_scores", on_log(f"select instance_id, {SCORE} as predicted_score from log where day = {T}"))
def _(spark, sf):
    log = clean_log(spark, sf).filter(F.col("day") == T)
    level = F.lit(2.0) + F.col("item_price_level") + F.col("user_age_level") % 10
    scored = log.withColumn("predicted_score", F.round(F.lit(1.0) / level, 6))
    path = _fresh(spark)
    write_scores(scored, path)
    return spark.read.csv(path, sep=" ", header=True, schema="instance_id bigint, predicted_score double")


@case("write_scores_file", on_log(f"select row_number() over (order by instance_id) - 1 as row_number, instance_id, {SCORE} as predicted_score from log where day = {T}"))
def _(spark, sf):
    log = clean_log(spark, sf).filter(F.col("day") == T)
    level = F.lit(2.0) + F.col("item_price_level") + F.col("user_age_level") % 10
    path = _fresh(spark)
    write_scores_file(log.withColumn("predicted_score", F.round(F.lit(1.0) / level, 6)), path)
    schema = T_.StructType([T_.StructField("instance_id", T_.LongType()), T_.StructField("predicted_score", T_.DoubleType())])
    return read_log_in_order(spark, path, schema)


_PLAIN = [c for c in BASELINE_FEATURES if c not in ("user_query_day", "user_query_day_hour")]


@log_case("select_features", on_log(f"select {', '.join(_PLAIN)}, is_trade from log"))
def _(log):
    return clean.select_features(log, _PLAIN, "is_trade")


@log_case("drop_columns", on_log("select * exclude (item_category_list, item_property_list, predict_category_property, is_trade) from log"))
def _(log):
    return clean.drop_columns(log, ["item_category_list", "item_property_list", "predict_category_property", "is_trade"])


@log_case("filter_day", on_log(f"select * from log where day >= {PLAN.first} and day < {V}"))
def _(log):
    return clean.filter_day(log, lo=PLAN.first, hi=V - 1)


_REPLACED = ", ".join(f"cast(case when {c} = {a} then {b} else {c} end as int) as {c}" for c, (a, b) in SENTINEL_REPLACEMENTS.items())


@log_case("replace_sentinel", on_log(f"select * replace ({_REPLACED}) from log"))
def _(log):
    return clean.replace_sentinel(log)


_ZEROED = ", ".join(f"cast(case when {c} = -1 then 0 else {c} end as int) as {c}" for c in USER_LEVELS)


@log_case("sentinel_to_zero", on_log(f"select * replace ({_ZEROED}) from log"))
def _(log):
    return clean.sentinel_to_zero(log)


@log_case("drop_sentinel_rows", on_log("select * from log where shop_score_delivery * 5 <> -5 and shop_review_positive_rate <> -1"))
def _(log):
    scaled = clean.drop_sentinel_rows(log.withColumn("s", F.col("shop_score_delivery") * 5), "s", -5.0).drop("s")
    return clean.drop_sentinel_rows(scaled, "shop_review_positive_rate", -1.0)


@log_case(
    "fill_null",
    on_log("select instance_id, coalesce(is_trade, -1) as is_trade, coalesce(is_trade, user_gender_id) as filled from log"),
)
def _(log):
    filled = clean.fill_null(log.select("instance_id", "is_trade", "user_gender_id", F.col("is_trade").alias("filled")), F.col("user_gender_id"), ["filled"])
    return clean.fill_null(filled, -1, ["is_trade"]).drop("user_gender_id")


@log_case("split_labelled", on_log("select instance_id, case when is_trade is null then 0 else 1 end as labelled from log"))
def _(log):
    known, unknown = clean.split_labelled(log)
    return known.select("instance_id", F.lit(1).alias("labelled")).unionByName(unknown.select("instance_id", F.lit(0).alias("labelled")))


@log_case(
    "membership_flag",
    on_log(
        """select instance_id, case when user_gender_id = -1 then 1 else 2 end as gender0,
        case when user_age_level = 1007 then 1 else 2 end as age0, 2 as occupation0, 2 as star0,
        case when context_page_id = 4007 then 1 else 2 end as context_page0 from log"""
    ),
)
def _(log):
    flags = {n: bins.membership_flag(bins.FLAG_COLUMNS[n], v) for n, v in bins.FLAG_SETS.items()}
    return log.select("instance_id", *[c.alias(n) for n, c in flags.items()])


@log_case(
    "membership_flag_intended",
    on_log(
        """select instance_id, if(user_gender_id in (-1), 1, 2) as gender0,
        if(user_age_level in (1004, 1005, 1006, 1007), 1, 2) as age0,
        if(user_occupation_id in (-1, 2003), 1, 2) as occupation0, if(user_star_level in (-1, 3000, 3001), 1, 2) as star0,
        if(context_page_id in (4001, 4002, 4003, 4004, 4007), 1, 2) as context_page0 from log"""
    ),
)
def _(log):
    flags = {n: bins.membership_flag(bins.FLAG_COLUMNS[n], v) for n, v in bins.INTENDED_FLAG_SETS.items()}
    return log.select("instance_id", *[c.alias(n) for n, c in flags.items()])


@log_case(
    "range_flag",
    on_log("select instance_id, case when shop_score_delivery >= 96e-2 and shop_score_delivery <= 98e-2 then 0 else 1 end as shop_score_delivery0 from log"),
)
def _(log):
    return log.select("instance_id", bins.range_flag("shop_score_delivery", 0.96, 0.98).alias("shop_score_delivery0"))


@log_case(
    "all_equal_flag",
    on_log("select instance_id, case when item_collected_level = 3 and user_gender_id = 1 then 1 else 0 end as flag from log"),
)
def _(log):
    return log.select("instance_id", bins.all_equal_flag({"item_collected_level": 3, "user_gender_id": 1}).alias("flag"))


@log_case(
    "scale_column",
    on_log(
        """select instance_id, round(shop_score_delivery * 5, 6) as shop_score_delivery, round(shop_score_service * 5, 6) as shop_score_service,
        round(shop_score_description * 5, 6) as shop_score_description from log"""
    ),
)
def _(log):
    out = log
    for c in ("shop_score_delivery", "shop_score_service", "shop_score_description"):
        out = clean.scale_column(out, c, 5.0)
    return out.select("instance_id", "shop_score_delivery", "shop_score_service", "shop_score_description")


@log_case("cast_columns", on_log("select instance_id, cast(item_sales_level as varchar) as item_sales_level, cast(item_price_level as varchar) as item_price_level from log"))
def _(log):
    return clean.cast_columns(log, ["item_sales_level", "item_price_level"], "string").select("instance_id", "item_sales_level", "item_price_level")


@log_case("rename_columns", on_log("select item_id, avg(is_trade) as mean_item_id_before_1_day, count(is_trade) as count_item_id_before_1_day from log group by 1".replace("avg(is_trade)", "round(avg(is_trade), 6)")))
def _(log):
    stats = log.groupBy("item_id").agg(F.avg("is_trade").alias("mean"), F.count("is_trade").alias("count"))
    return clean.rename_columns(stats, "_item_id_before_1_day", keep=["item_id"])


@log_case("align_columns", on_log("select instance_id, item_id, user_id, shop_id, day from log"))
def _(log):
    like = log.select("instance_id", "item_id", "user_id", "shop_id", "day")
    return clean.align_columns(log.select("day", "shop_id", "user_id", "item_id", "instance_id"), like)


@case("dedupe_rows", on_log("select distinct * from raw"))
def _(spark, sf):
    return clean.dedupe_rows(raw_log(spark, sf))


@case(
    "dedupe_by",
    on_log("select user_id, item_id, instance_id, context_timestamp, is_trade from (select *, row_number() over (partition by user_id, item_id order by context_timestamp, instance_id) as r from raw) where r = 1"),
)
def _(spark, sf):
    first = clean.dedupe_by(raw_log(spark, sf), ["user_id", "item_id"], ["context_timestamp", "instance_id"])
    return first.select("user_id", "item_id", "instance_id", "context_timestamp", "is_trade")


@log_case("union_missing_columns", on_log(f"select instance_id, day, is_trade from log where day < {T} union all select instance_id, day, null from log where day = {T}"))
def _(log):
    seen = log.filter(F.col("day") < T).select("instance_id", "day", "is_trade")
    return clean.union_rows(seen, log.filter(F.col("day") == T).select("instance_id", "day"))


@log_case("sort_desc", on_log("select shop_id, count(*) as n from log group by 1 order by n desc"))
def _(log):
    return clean.sort_desc(log.groupBy("shop_id").agg(F.count(F.lit(1)).alias("n")), "n")


@log_case(
    "hstack",
    on_log("select instance_id, cast(item_price_level as double) as a, cast(user_age_level as double) as b, shop_score_service as c from log"),
)
def _(log):
    left = encode.assemble(log, ["item_price_level", "user_age_level"], "left_block")
    both = encode.assemble(left, ["left_block", "shop_score_service"], "block")
    v = vector_to_array("block")
    return both.select("instance_id", v[0].alias("a"), v[1].alias("b"), v[2].alias("c"))
