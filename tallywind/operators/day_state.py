"""History kept up day by day: mergeable states per key and day, one folder partition a day.

A day's state has, per key, the row count and for every measure its count, sum, sum of squares, least and greatest value. States of
days add up, so any window of days is merged from them without the log. A new day reads that day's rows only; a late day
replaces its own partition and no other; writing a day again changes nothing. What a label day looks at is a range of
partitions, the only ones its scan opens.

Sums and squares are those of the distance from a ``centre`` given per measure, so that large values of small spread, like times,
keep their digits; a mean is that distance's. All days of a folder take the same centres.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywind.operators.history import DAYS


def _parts(c: str, centre: float) -> dict[str, Column]:
    away = F.col(c).cast("double") - F.lit(float(centre))
    return {f"{c}__n": F.count(c), f"{c}__s": F.sum(away), f"{c}__q": F.sum(away * away), f"{c}__lo": F.min(c), f"{c}__hi": F.max(c)}


def write_days(
    log: DataFrame, folder: str, keys: Sequence[str], measures: Sequence[str], days: Sequence[int], day: str = "day", centre: Mapping[str, float] | None = None
) -> None:
    """Write the states of ``days``, each in place of what its partition held; other partitions stay untouched.

    A day without rows gets an empty state (a null key), so that a day whose rows were taken back is not left as it was.
    Rows with a null key belong to no group.
    """
    rows = log.where(F.col(day).isin(list(days)))
    aggs = {"rows__n": F.count(F.lit(1))}
    for c in measures:
        aggs |= _parts(c, (centre or {}).get(c, 0.0))
    state = rows.groupBy(*keys, day).agg(*[a.alias(name) for name, a in aggs.items()])
    empty = log.sparkSession.createDataFrame([(d,) for d in days], f"`{day}` int")
    both = state.unionByName(empty.withColumn(day, F.col(day).cast(log.schema[day].dataType)), allowMissingColumns=True)
    both.repartition(day, *keys).write.option("partitionOverwriteMode", "dynamic").partitionBy(day).mode("overwrite").parquet(folder)


def read_days(spark: SparkSession, folder: str, keys: Sequence[str], first: int, behind: int, day: str = "day") -> DataFrame:
    """The states of the days ``[first, behind)``; partitions of other days are not read."""
    states = spark.read.parquet(folder).where((F.col(day) >= first) & (F.col(day) < behind))
    for k in keys:
        states = states.where(F.col(k).isNotNull())
    return states


def _inside(day: str, label_day: int, d: int, c: str) -> Column:
    return F.when(F.col(day) >= label_day - d, F.col(c))


def history_rate_of(states: DataFrame, key: str, label_day: int, days: Sequence[int] = DAYS, day: str = "day", label: str = "is_trade") -> DataFrame:
    """``history.history_rate`` out of the states of the days before the label day."""
    aggs = []
    for d in days:
        n, s = (F.sum(_inside(day, label_day, d, f"{label}__{part}")) for part in ("n", "s"))
        aggs.append(F.coalesce(F.try_divide(s, n.cast("double")), F.lit(0.0)).alias(f"mean_{key}_before_{d}_day"))
        aggs.append(F.coalesce(n, F.lit(0)).alias(f"count_{key}_before_{d}_day"))
    return states.where((F.col(day) >= label_day - max(days)) & (F.col(day) < label_day)).groupBy(key).agg(*aggs)


def history_std_of(states: DataFrame, key: str, cols: Sequence[str], label_day: int, days: Sequence[int] = DAYS, day: str = "day") -> DataFrame:
    """``history.history_hour_std`` out of states kept by ``key``; null for fewer than two values."""
    aggs = []
    for d in days:
        for c in cols:
            n, s, q = (F.sum(_inside(day, label_day, d, f"{c}__{part}")).cast("double") for part in ("n", "s", "q"))
            spread = F.greatest(q - s * s / n, F.lit(0.0))
            aggs.append(F.when(n > 1, F.sqrt(spread / (n - 1))).alias(f"{c}_{key}_std_{d}"))
    return states.where((F.col(day) >= label_day - max(days)) & (F.col(day) < label_day)).groupBy(key).agg(*aggs)


def spans_of(states: DataFrame, key: str, ts: str, label_day: int, day: str = "day") -> DataFrame:
    """First and last ``ts`` per key on all days before the label day."""
    return states.where(F.col(day) < label_day).groupBy(key).agg(F.min(f"{ts}__lo").alias("day_begin"), F.max(f"{ts}__hi").alias("day_end"))


def history_count_of(states: DataFrame, keys: Sequence[str], name: str, label_day: int, days: Sequence[int] = DAYS, day: str = "day") -> DataFrame:
    """Rows per key over ``[label_day - d, label_day)`` as ``<name>_<d>``."""
    aggs = [F.coalesce(F.sum(_inside(day, label_day, d, "rows__n")), F.lit(0)).alias(f"{name}_{d}") for d in days]
    return states.where((F.col(day) >= label_day - max(days)) & (F.col(day) < label_day)).groupBy(*keys).agg(*aggs)
