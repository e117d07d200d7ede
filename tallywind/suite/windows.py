"""History features and cross counts."""

from __future__ import annotations

import uuid

from tallywind.functions.bins import concat_cross
from tallywind.operators import cross, day_state, history
from tallywind.operators.clean import sentinel_to_zero
from tallywind.operators.joins import attach
from tallywind.plans import baseline, cross_features, point_in_time
from tallywind.schema import BASELINE_FEATURES, SHOP_MEASURES, USER_LEVELS
from tallywind.sources.standin import PLAN, raw_log
from tallywind.storage import shared_dir, store
from tallywind.suite.registry import case, log_case, on_log

L = PLAN.valid
DAYS = history.DAYS
LABEL_DAYS = ", ".join(str(d) for d in PLAN.label_days)


def _rate_sql(key: str, where: str, day: str) -> str:
    cols = ", ".join(
        f"round(coalesce(avg(is_trade) filter (day >= {day} - {d}), 0), 6) as mean_{key}_before_{d}_day, count(is_trade) filter (day >= {day} - {d}) as count_{key}_before_{d}_day"
        for d in DAYS
    )
    return f"select {key}, {cols} from log where {where} group by 1"


for _key in history.RATE_KEYS:

    def _one_day(log, key=_key):
        return history.history_rate(log, key, L)

    log_case(f"history_rate_{_key}", on_log(_rate_sql(_key, f"day >= {L} - 3 and day < {L}", str(L))))(_one_day)


def _states(log, key: str, measures: list[str]):
    """States written day by day, the middle day twice, and read back for the label day."""
    log, folder = store(log).df, f"{shared_dir(log.sparkSession)}/states-{uuid.uuid4().hex}"
    for days in ([L - 3], [L - 2], [L - 1], [L - 2]):
        day_state.write_days(log, folder, [key], measures, days)
    return day_state.read_days(log.sparkSession, folder, [key], L - 3, L)


@log_case("history_rate_by_day", on_log(_rate_sql("item_id", f"day >= {L} - 3 and day < {L}", str(L))))
def _(log):
    return day_state.history_rate_of(_states(log, "item_id", ["is_trade"]), "item_id", L)


def _daily_rate_cte(key: str) -> tuple[str, str]:
    """Every (key, day) of the log against the key's rows of the three days before, by join."""
    cols = ", ".join(
        f"round(coalesce(avg(b.is_trade) filter (b.day >= a.day - {d}), 0), 6) as mean_{key}_before_{d}_day, "
        f"count(b.is_trade) filter (b.day >= a.day - {d}) as count_{key}_before_{d}_day"
        for d in DAYS
    )
    name = f"rate_{key}"
    return name, (
        f"{name} as (select a.{key}, a.day, {cols} from (select distinct {key}, day from log) a "
        f"left join log b on b.{key} = a.{key} and b.day < a.day and b.day >= a.day - 3 group by 1, 2)"
    )


@log_case("daily_history_rate", on_log("select * from rate_item_id", _daily_rate_cte("item_id")[1]))
def _(log):
    return history.daily_history_rate(log, "item_id").drop("_n")


def _before_sql(kind: str, condition: str) -> tuple[str, list[str]]:
    ctes = [
        f"{n} as (select a.{n}_id, a.day, coalesce(sum(b.n), 0)::bigint as c from (select distinct {n}_id, day from log) a "
        f"left join (select {n}_id, day, count(*) as n from log group by 1, 2) b on b.{n}_id = a.{n}_id and {condition} group by 1, 2)"
        for n in ("user", "item", "shop")
    ]
    cols = ", ".join(f"case when l.day > {PLAN.first} then {n}.c end as {n}_{kind}" for n in ("user", "item", "shop"))
    joins = " ".join(f"join {n} on {n}.{n}_id = l.{n}_id and {n}.day = l.day" for n in ("user", "item", "shop"))
    return f"select l.instance_id, {cols} from log l {joins}", ctes


_PREVIOUS, _PREVIOUS_CTES = _before_sql("cnt1", "b.day = a.day - 1")
_EARLIER, _EARLIER_CTES = _before_sql("cntx", "b.day < a.day")


@log_case("previous_day_count", on_log(_PREVIOUS, *_PREVIOUS_CTES))
def _(log):
    return history.before_counts(log, PLAN.first, ["cnt1"]).select("instance_id", "user_cnt1", "item_cnt1", "shop_cnt1")


@log_case("cumulative_before_count", on_log(_EARLIER, *_EARLIER_CTES))
def _(log):
    return history.before_counts(log, PLAN.first, ["cntx"]).select("instance_id", "user_cntx", "item_cntx", "shop_cntx")


def _std_sql(day: str, prefix: str = "") -> str:
    return ", ".join(f"round(stddev_samp({prefix}{c}) filter ({prefix}day >= {day} - {i}), 6) as {c}_hour_std_{i}" for i in DAYS for c in SHOP_MEASURES)


@log_case("history_hour_std", on_log(f"select hour, {_std_sql(str(L))} from log where day >= {L} - 3 and day < {L} group by 1"))
def _(log):
    return history.history_hour_std(log, L)


@log_case("history_hour_std_by_day", on_log(f"select hour, {_std_sql(str(L))} from log where day >= {L} - 3 and day < {L} group by 1"))
def _(log):
    return day_state.history_std_of(_states(log, "hour", list(SHOP_MEASURES)), "hour", SHOP_MEASURES, L)


_DAILY_STD = (
    f"hour_std as (select b.hour, a.day, {_std_sql('a.day', 'b.')} from (select unnest([{LABEL_DAYS}]) as day) a "
    "join log b on b.day < a.day and b.day >= a.day - 3 group by 1, 2)"
)


@log_case("daily_hour_std", on_log("select hour, cast(day as int) as day, * exclude (hour, day) from hour_std", _DAILY_STD))
def _(log):
    return history.daily_hour_std(log, PLAN.label_days)


def _hour_count_sql(name: str, key: str) -> str:
    cols = ", ".join(f"nullif(count(*) filter (day >= {L} - {i}), 0) as {name}_{i}" for i in DAYS)
    return f"select {key}, hour, {cols} from log where day >= {L} - 3 and day < {L} group by 1, 2"


for _name, _key in history.HOUR_COUNTS.items():

    def _one_day_hours(log, name=_name, key=_key):
        return history.history_key_hour_count(log, key, name, L)

    log_case(f"history_key_hour_count_{_name}", on_log(_hour_count_sql(_name, _key)))(_one_day_hours)


def _hour_count_cte(name: str, key: str) -> str:
    cols = ", ".join(f"nullif(count(b.day) filter (b.day >= a.day - {i}), 0) as {name}_{i}" for i in DAYS)
    return (
        f"{name} as (select a.{key}, a.hour, a.day, {cols} from (select distinct {key}, hour, day from log) a "
        f"left join log b on b.{key} = a.{key} and b.hour = a.hour and b.day < a.day and b.day >= a.day - 3 group by 1, 2, 3)"
    )


@log_case("daily_key_hour_count", on_log("select * from shop_query_day_hour", _hour_count_cte("shop_query_day_hour", "shop_id")))
def _(log):
    return history.daily_key_hour_count(log, "shop_id", "shop_query_day_hour").drop("_n")


def _float_ratio(a: str, b: str) -> str:
    return f"case when {b} <> 0 then ({a})::double / {b} when {a} > 0 then 'inf'::double when {a} < 0 then '-inf'::double end"


def _life_sql(keys: str, today: str, source: str) -> str:
    return f"""select {keys}, coalesce(e - b, -1) as alive, coalesce({today} - b, -1) as "s_alive",
        round(coalesce({_float_ratio('(e - b)', f'({today} - b)')}, -1) + 0e0, 6) as "alive/s_alive", coalesce(coalesce(cv, e) - b, -1) as alive_cov,
        round(coalesce({_float_ratio('(e - b)', '(coalesce(cv, e) - b)')}, -1) + 0e0, 6) as "alive/alive_cov" from {source}"""


_SPANS = "select {keys}, min(context_timestamp) as b, max(context_timestamp) as e, max(context_timestamp) filter (is_trade = 1) as cv from log where day < {day} group by 1"


@log_case("history_user_lifetime", on_log(_life_sql("user_id", f"{L}::bigint", "u"), f"u as ({_SPANS.format(keys='user_id', day=L)})"))
def _(log):
    return history.history_user_lifetime(log, L)


@log_case("history_user_lifetime_seconds", on_log(_life_sql("user_id", "1706486400::bigint", "u"), f"u as ({_SPANS.format(keys='user_id', day=L)})"))
def _(log):
    return history.history_user_lifetime(log, L, label_epoch=1706486400)


_DAILY_LIFE = [
    """spans as (select a.user_id, a.day, min(l.context_timestamp) as b, max(l.context_timestamp) as e, max(l.context_timestamp) filter (l.is_trade = 1) as cv
      from (select distinct user_id, day from log) a left join log l on l.user_id = a.user_id and l.day < a.day group by 1, 2)""",
    f"life as ({_life_sql('user_id, day', 'day::bigint', 'spans')})",
]


@log_case("daily_user_lifetime", on_log("select * from life", *_DAILY_LIFE))
def _(log):
    return history.daily_user_lifetime(log).drop("_n")


_PERIOD = "count(*) over (partition by user_id, day) as user_query_day, count(*) over (partition by user_id, day, hour) as user_query_day_hour"


@log_case("same_period_count", on_log(f"select instance_id, {_PERIOD} from log"))
def _(log):
    return history.same_period_count(log).select("instance_id", "user_query_day", "user_query_day_hour")


@case("baseline_features", on_log(f"select instance_id, day, is_trade, {', '.join(BASELINE_FEATURES)} from (select *, {_PERIOD} from log)"))
def _(spark, sf):
    return baseline.baseline_features(raw_log(spark, sf)).select("instance_id", "day", "is_trade", *BASELINE_FEATURES)


def _point_in_time_sql() -> str:
    pieces = ["cast(split_part(item_category_list, ';', 1) as bigint) as item_category_list_1", "cast(split_part(item_category_list, ';', 2) as bigint) as item_category_list_2"]
    pieces += [f"cast(split_part(item_property_list, ';', {i + 1}) as bigint) as item_property_list_{i}" for i in range(3)]
    pieces += [f"coalesce(try_cast(split_part(split_part(predict_category_property, ';', {i + 1}), ':', 1) as bigint), -1) as predict_category_{i}" for i in range(3)]
    flags = [f"cast(item_category_list_{c} = predict_category_{p} as int) as item_category_list_{c}_predict_category_{p}" for c in (1, 2) for p in range(3)]
    ctes = [
        f"""rows_ as (select * exclude (item_category_list, item_property_list, predict_category_property), {', '.join(pieces)},
          (hour + 23) % 24 as hour_before, (hour + 1) % 24 as hour_after from log where day in ({LABEL_DAYS}))"""
    ]
    ctes += [_daily_rate_cte(k)[1] for k in history.RATE_KEYS]
    ctes += [_hour_count_cte(n, k) for n, k in history.HOUR_COUNTS.items()]
    ctes += [*_DAILY_LIFE, _DAILY_STD]
    filled = [f"coalesce({c}, 0) as {c}" for n in history.HOUR_COUNTS for c in (f"{n}_{i}" for i in DAYS)]
    filled += [f"coalesce({c}_hour_std_{i}, 0) as {c}_hour_std_{i}" for i in DAYS for c in SHOP_MEASURES]
    rates = [f"{m}_{k}_before_{d}_day" for k in history.RATE_KEYS for d in DAYS for m in ("mean", "count")]
    joins = " ".join(f"left join rate_{k} using ({k}, day)" for k in history.RATE_KEYS)
    joins += " " + " ".join(f"left join {n} using ({k}, hour, day)" for n, k in history.HOUR_COUNTS.items())
    joins += " left join life using (user_id, day) left join hour_std using (hour, day)"
    base = ["rows_.* exclude (item_id, shop_id, user_id, item_brand_id, item_city_id, item_pv_level, item_sales_level, hour, day)"]
    base += ["item_id", "shop_id", "user_id", "item_brand_id", "item_city_id", "item_pv_level", "item_sales_level", "hour", "rows_.day"]
    life = [f'"{c}"' for c in history.LIFETIME]
    return on_log(f"select {', '.join([*base, *flags, *rates, *life, *filled])} from rows_ {joins}", *ctes)


@case("point_in_time_features", _point_in_time_sql())
def _(spark, sf):
    return point_in_time.point_in_time_features(raw_log(spark, sf), PLAN)


def _cross_sql(crosses, source: str = "log") -> str:
    cols = []
    for x in crosses:
        for c in x.cols:
            pair = f"count(*) over (partition by {c}, {x.key})"
            cols.append(f"{pair} as {c}_{x.prefix}_cnt")
            cols.append(f"round({pair}::double / count(*) over (partition by {x.anchor}), 6) as {c}_{x.prefix}_prob")
    return f"select instance_id, {', '.join(cols)} from {source}"


_ZERO = "zeroed as (select * replace (" + ", ".join(f"case when {c} = -1 then 0 else {c} end as {c}" for c in USER_LEVELS) + ") from log)"


@log_case("pair_count_ratio", on_log(_cross_sql([cross.Cross("user_id", ("item_brand_id",), "user")])))
def _(log):
    out = cross.pair_count_ratio(log, ["item_brand_id"], "user_id", "user")
    return out.select("instance_id", "item_brand_id_user_cnt", "item_brand_id_user_prob")


_CROSSES = {
    "item_cross": cross.ITEM_CROSSES,
    "user_cross": cross.USER_CROSSES,
    "user_item_cross": cross.USER_ITEM_CROSSES,
    "user_shop_cross": cross.USER_SHOP_CROSSES,
    "shop_item_cross": cross.SHOP_ITEM_CROSSES,
}
for _name, _crosses in _CROSSES.items():

    def _block(log, crosses=_crosses):
        return cross.cross_counts(sentinel_to_zero(log), crosses).select("instance_id", *cross.feature_names(crosses))

    log_case(_name, on_log(_cross_sql(_crosses, "zeroed"), _ZERO))(_block)


_LEVEL_PAIRS_SQL = ", ".join(f"cast(cast({a} as varchar) || cast({b} as varchar) as bigint) as {n}" for n, (a, b) in cross_features.LEVEL_PAIRS.items())


@log_case("concat_cross", on_log(f"select instance_id, {_LEVEL_PAIRS_SQL} from zeroed", _ZERO))
def _(log):
    return sentinel_to_zero(log).select("instance_id", *[concat_cross(a, b).alias(n) for n, (a, b) in cross_features.LEVEL_PAIRS.items()])


def _cross_features_sql() -> str:
    """The whole feature table: codes over all rows, counts over the rows that have shop scores."""
    from tallywind.suite.groups import _BINNED, _BINS_SQL, _LEVELS_SQL

    pieces = ", ".join(f"split_part({col}, ';', {i + 1}) as {col}{i}" for col, pos in cross_features.PIECES.items() for i in pos)
    coded = [f"{col}{i}" for col, pos in cross_features.PIECES.items() for i in pos] + cross_features.ENCODED_IDS
    codes = ", ".join(f"dense_rank() over (order by {c}) - 1 as {c}" for c in coded)
    lengths = ", ".join(f"cast(len(string_split({c}, ';')) as int) as {n}" for n, c in cross_features.LENGTHS.items())
    flags = """case when user_gender_id = -1 then 1 else 2 end as gender0, case when user_age_level = 1007 then 1 else 2 end as age0, 2 as occupation0, 2 as star0,
      case when context_page_id = 4007 then 1 else 2 end as context_page0, case when shop_score_delivery between 96e-2 and 98e-2 then 0 else 1 end as shop_score_delivery0,
      case when hour between 7 and 12 then 1 when hour between 13 and 20 then 2 else 3 end as hour_map"""
    known = "shop_score_delivery <> -1 and shop_score_service <> -1 and shop_score_description <> -1 and shop_review_positive_rate <> -1"
    normal = " and ".join(f"{n}_map = 3" for n in _BINNED)
    counts = [
        f"{n}_{kind} as (select a.{n}_id, a.day, coalesce(sum(b.n), 0)::bigint as c from (select distinct {n}_id, day from kept) a "
        f"left join (select {n}_id, day, count(*) as n from kept group by 1, 2) b on b.{n}_id = a.{n}_id and {cond} group by 1, 2)"
        for n in ("user", "item", "shop")
        for kind, cond in (("cnt1", "b.day = a.day - 1"), ("cntx", "b.day < a.day"))
    ]
    crosses = [x for xs in _CROSSES.values() for x in xs]
    cross_sql = _cross_sql(crosses, "zeroed")
    joins = " ".join(f"left join {n}_{k} on {n}_{k}.{n}_id = z.{n}_id and {n}_{k}.day = z.day" for n in ("user", "item", "shop") for k in ("cnt1", "cntx"))
    before = ", ".join(f"case when z.day > {PLAN.first} then {n}_{k}.c end as {n}_{k}" for n in ("user", "item", "shop") for k in ("cnt1", "cntx"))
    scaled = ", ".join(f"round({c} * 5, 6) as {c}" for c in cross_features.SCORE_BINS)
    zeroed = ", ".join(f"cast(case when {c} = -1 then 0 else {c} end as int) as {c}" for c in USER_LEVELS)
    return on_log(
        f"select z.* replace ({scaled}), {_LEVEL_PAIRS_SQL}, {before}, x.* exclude (instance_id) from zeroed z {joins} join x on x.instance_id = z.instance_id",
        f"pieces as (select *, {pieces}, {lengths}, {flags} from log)",
        f"codes as (select * exclude ({', '.join(coded)}), {codes} from pieces)",
        f"binned as (select instance_id, {_BINS_SQL} from log where {known})",
        f"levels as (select instance_id, {_LEVELS_SQL} from binned)",
        f"kept as (select codes.*, case when {normal} then 1 else 0 end as normal_shop from codes join levels using (instance_id))",
        f"zeroed as (select * replace ({zeroed}) from kept)",
        *counts,
        f"x as ({cross_sql})",
    )


@case("cross_features", _cross_features_sql())
def _(spark, sf):
    return cross_features.cross_features(raw_log(spark, sf), PLAN)


@log_case("attach_history", on_log("select instance_id, day, item_id, rate_item_id.* exclude (item_id, day) from log join rate_item_id using (item_id, day)", _daily_rate_cte("item_id")[1]))
def _(log):
    table = history.daily_history_rate(log, "item_id")
    out = attach(log.select("instance_id", "day", "item_id"), table, ["item_id", "day"], weight="_n", broadcast_bytes=0)
    return out


