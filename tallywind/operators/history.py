"""Point-in-time history: what was known about a key before the day being scored.

Two forms of each feature. With ``label_day`` the table holds the features for that one day. Without,
it holds them for every day a key occurs on, from one pass: the log is first reduced to one row per
key and day, and only those rows (at most one per day and key) meet a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywind.functions.bins import float_ratio
from tallywind.operators.aggregates import grouped
from tallywind.operators.joins import attach, attach_all
from tallywind.schema import SHOP_MEASURES
from tallywind.storage import store

DAYS = (1, 2, 3)
RATE_KEYS = ("shop_id", "item_id", "hour", "item_pv_level", "item_sales_level")

# Key of each per-hour count and the name it goes by. The second is counted per city
# although named after the brand.
HOUR_COUNTS = {
    "shop_query_day_hour": "shop_id",
    "item_brand_id_day": "item_city_id",
    "item_brand_id_hour": "item_brand_id",
    "item_pv_level_hour": "item_pv_level",
}


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _before(keys: Sequence[str], day: str, d: int | None = None):
    """Days ``[today - d, today)`` of the same key, or all earlier days."""
    start = Window.unboundedPreceding if d is None else -d
    return Window.partitionBy(*keys).orderBy(day).rangeBetween(start, -1)


def _window(df: DataFrame, day: str, label_day: int, days: Sequence[int]) -> DataFrame:
    return df.filter((F.col(day) >= label_day - max(days)) & (F.col(day) < label_day))


def _reach(df: DataFrame, day: str, label_days: Sequence[int] | None, days: Sequence[int] | None = None) -> DataFrame:
    """Only the days the features of ``label_days`` look at, so that other days are never read."""
    if label_days is None:
        return df
    df = df.filter(F.col(day) <= max(label_days))
    return df if days is None else df.filter(F.col(day) >= min(label_days) - max(days))


def _on_days(table: DataFrame, day: str, label_days: Sequence[int] | None) -> DataFrame:
    return table if label_days is None else table.filter(F.col(day).isin(list(label_days)))


def history_rate(
    df: DataFrame, key: str, label_day: int, days: Sequence[int] = DAYS, day: str = "day", label: str = "is_trade"
) -> DataFrame:
    """Conversion rate and labelled rows per key over ``[label_day - d, label_day)`` for each d.

    Keys seen in the widest window only have 0 for the narrower ones.
    """
    aggs = []
    for d in days:
        inside = F.when(F.col(day) >= label_day - d, F.col(label))
        aggs.append(F.coalesce(F.avg(inside), F.lit(0.0)).alias(f"mean_{key}_before_{d}_day"))
        aggs.append(F.count(inside).alias(f"count_{key}_before_{d}_day"))
    return grouped(_window(df, day, label_day, days), key, *aggs)


def daily_history_rate(
    df: DataFrame,
    key: str,
    days: Sequence[int] = DAYS,
    day: str = "day",
    label: str = "is_trade",
    label_days: Sequence[int] | None = None,
) -> DataFrame:
    """``history_rate`` for every day at once: one row per (key, day), with the day's row count ``_n``."""
    daily = grouped(
        _reach(df, day, label_days, days),
        [key, day],
        F.count(F.lit(1)).alias("_n"),
        F.sum(label).alias("_y"),
        F.count(label).alias("_c"),
    )
    out: list[Column] = []
    for d in days:
        w = _before([key], day, d)
        labelled = F.coalesce(F.sum("_c").over(w), F.lit(0))
        mean = F.try_divide(F.sum("_y").over(w).cast("double"), labelled.cast("double"))
        out.append(F.coalesce(mean, F.lit(0.0)).alias(f"mean_{key}_before_{d}_day"))
        out.append(labelled.alias(f"count_{key}_before_{d}_day"))
    return _on_days(daily.select(key, day, "_n", *out), day, label_days)


def daily_before_counts(
    df: DataFrame,
    key: str,
    first_day: int,
    name: str,
    day: str = "day",
    id_col: str = "instance_id",
) -> DataFrame:
    """Rows of the same key on the previous day (``<name>_cnt1``) and on all earlier days (``<name>_cntx``).

    Null on the first day of the log, 0 where the key is new.
    """
    daily = grouped(df, [key, day], F.count(id_col).alias("_n"))
    known = F.col(day) > first_day

    def earlier(w) -> Column:
        return F.when(known, F.coalesce(F.sum("_n").over(w), F.lit(0)))

    return daily.select(
        key,
        day,
        "_n",
        earlier(_before([key], day, 1)).alias(f"{name}_cnt1"),
        earlier(_before([key], day)).alias(f"{name}_cntx"),
    )


def before_counts(df: DataFrame, first_day: int, kinds: Sequence[str] = ("cnt1", "cntx"), day: str = "day", **join_options) -> DataFrame:
    """Previous-day and cumulative counts of the row's user, item and shop.

    The keys and days are written once for the three tables, so that ``df`` itself is worked out twice and not four times.
    """
    lookups = []
    keys = store(df.select("instance_id", "user_id", "item_id", "shop_id", day)).df
    for name in ("user", "item", "shop"):
        key = f"{name}_id"
        table = daily_before_counts(keys, key, first_day, name, day)
        lookups.append((table.select(key, day, "_n", *[f"{name}_{kind}" for kind in kinds]), [key, day]))
    return attach_all(df, lookups, weight="_n", **join_options)


def history_hour_std(
    df: DataFrame,
    label_day: int,
    days: Sequence[int] = DAYS,
    cols: Sequence[str] = SHOP_MEASURES,
    day: str = "day",
    hour: str = "hour",
) -> DataFrame:
    """Per hour, standard deviation of the shop columns over ``[label_day - i, label_day)``; at most 24 rows."""
    aggs = [
        F.stddev_samp(F.when(F.col(day) >= label_day - i, F.col(c))).alias(f"{c}_hour_std_{i}")
        for i in days
        for c in cols
    ]
    return grouped(_window(df, day, label_day, days), hour, *aggs)


def daily_hour_std(
    df: DataFrame,
    label_days: Sequence[int],
    days: Sequence[int] = DAYS,
    cols: Sequence[str] = SHOP_MEASURES,
    day: str = "day",
    hour: str = "hour",
) -> DataFrame:
    """``history_hour_std`` for several label days: at most 24 rows per label day.

    Each row is counted for every label day it precedes, and merged map-side into the day-hour groups.
    """
    span = max(days)
    candidates = F.array(*[F.lit(d) for d in label_days])
    serves = F.explode(F.filter(candidates, lambda x: (x > F.col(day)) & (x <= F.col(day) + span)))
    fanned = _reach(df, day, label_days, days).select(hour, F.col(day).alias("_day"), *cols, serves.alias(day))
    aggs = [
        F.stddev_samp(F.when(F.col("_day") >= F.col(day) - i, F.col(c))).alias(f"{c}_hour_std_{i}")
        for i in days
        for c in cols
    ]
    return grouped(fanned, [hour, day], *aggs)


def history_key_hour_count(
    df: DataFrame,
    key: str,
    name: str,
    label_day: int,
    days: Sequence[int] = DAYS,
    day: str = "day",
    hour: str = "hour",
) -> DataFrame:
    """Rows per (key, hour) over ``[label_day - i, label_day)``; null where there are none."""
    aggs = []
    for i in days:
        n = F.count(F.when(F.col(day) >= label_day - i, F.lit(1)))
        aggs.append(F.when(n > 0, n).alias(f"{name}_{i}"))
    return grouped(_window(df, day, label_day, days), [key, hour], *aggs)


def daily_key_hour_count(
    df: DataFrame,
    key: str,
    name: str,
    days: Sequence[int] = DAYS,
    day: str = "day",
    hour: str = "hour",
    label_days: Sequence[int] | None = None,
) -> DataFrame:
    """``history_key_hour_count`` for every day at once."""
    daily = grouped(_reach(df, day, label_days, days), [key, hour, day], F.count(F.lit(1)).alias("_n"))
    counts = [F.sum("_n").over(_before([key, hour], day, i)).alias(f"{name}_{i}") for i in days]
    return _on_days(daily.select(key, hour, day, "_n", *counts), day, label_days)


def _lifetime(first: Column, last: Column, converted: Column, today: Column) -> list[Column]:
    """Lifetime features of a user, -1 where unknown."""
    alive = last - first
    since = today - first
    alive_cov = F.coalesce(converted, last) - first
    raw = {
        "alive": alive,
        "s_alive": since,
        "alive/s_alive": float_ratio(alive, since),
        "alive_cov": alive_cov,
        "alive/alive_cov": float_ratio(alive, alive_cov),
    }
    return [F.coalesce(c, F.lit(-1)).alias(name) for name, c in raw.items()]


LIFETIME = ["alive", "s_alive", "alive/s_alive", "alive_cov", "alive/alive_cov"]


def history_user_lifetime(
    df: DataFrame,
    label_day: int,
    label_epoch: int | None = None,
    user: str = "user_id",
    day: str = "day",
    ts: str = "context_timestamp",
    label: str = "is_trade",
) -> DataFrame:
    """Per user seen before ``label_day``: active span, span to the last conversion, and their ratios.

    ``s_alive`` subtracts an epoch from the day number unless ``label_epoch`` gives the label day's start
    in seconds. A positive span over a zero span is infinite.
    """
    spans = grouped(
        df.filter(F.col(day) < label_day),
        user,
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
        F.max(F.when(F.col(label) == 1, F.col(ts))).alias("_conv"),
    )
    today = F.lit(label_day if label_epoch is None else label_epoch).cast("bigint")
    return spans.select(user, *_lifetime(F.col("_first"), F.col("_last"), F.col("_conv"), today))


def daily_user_lifetime(
    df: DataFrame,
    label_days: Sequence[int] | None = None,
    user: str = "user_id",
    day: str = "day",
    ts: str = "context_timestamp",
    label: str = "is_trade",
) -> DataFrame:
    """``history_user_lifetime`` for every day a user occurs on; -1 where there is no earlier day."""
    daily = grouped(
        _reach(df, day, label_days),
        [user, day],
        F.count(F.lit(1)).alias("_n"),
        F.min(ts).alias("_b"),
        F.max(ts).alias("_e"),
        F.max(F.when(F.col(label) == 1, F.col(ts))).alias("_v"),
    )
    w = _before([user], day)
    seen = daily.select(
        user,
        day,
        "_n",
        F.min("_b").over(w).alias("_first"),
        F.max("_e").over(w).alias("_last"),
        F.max("_v").over(w).alias("_conv"),
    )
    today = F.col(day).cast("bigint")
    features = _lifetime(F.col("_first"), F.col("_last"), F.col("_conv"), today)
    return _on_days(seen.select(user, day, "_n", *features), day, label_days)


def same_period_count(df: DataFrame, user: str = "user_id", day: str = "day", hour: str = "hour") -> DataFrame:
    """Rows of the same user on the same day, and in the same hour of that day, later rows included.

    The log is reduced to user-day-hours; the daily total is a window over at most 24 of those.
    """
    hourly = grouped(df, [user, day, hour], F.count(F.lit(1)).alias("user_query_day_hour"))
    total = F.sum("user_query_day_hour").over(Window.partitionBy(user, day)).alias("user_query_day")
    table = hourly.select(user, day, hour, total, "user_query_day_hour", F.col("user_query_day_hour").alias("_n"))
    return attach(df, table, [user, day, hour], weight="_n")
