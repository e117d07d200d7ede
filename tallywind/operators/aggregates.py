"""Grouped and whole-table aggregates. Null keys form no group, as no row can be joined back to them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywind.operators.joins import attach
from tallywind.operators.ordering import running_total
from tallywind.storage import store

Keys = str | Sequence[str]


def grouped(df: DataFrame, keys: Keys, *aggs: Column, value: str | None = None) -> DataFrame:
    """``groupBy(keys).agg(aggs)`` over rows whose keys are all known; by ``value`` too if one is named."""
    names = [keys] if isinstance(keys, str) else list(keys)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in names])
    return df.filter(known).groupBy(*names, *([value] if value else [])).agg(*aggs)


def group_size(df: DataFrame, keys: Keys, name: str) -> DataFrame:
    return grouped(df, keys, F.count(F.lit(1)).alias(name))


def group_count(df: DataFrame, keys: Keys, col: str, name: str) -> DataFrame:
    return grouped(df, keys, F.count(col).alias(name))


def group_mean_count(df: DataFrame, key: Keys, label: str = "is_trade") -> DataFrame:
    """Conversion rate and number of labelled rows."""
    return grouped(df, key, F.avg(label).alias("mean"), F.count(label).alias("count"))


def group_min_max(df: DataFrame, key: Keys, ts: str) -> DataFrame:
    return grouped(df, key, F.min(ts).alias("day_begin"), F.max(ts).alias("day_end"))


def group_max_where(df: DataFrame, pred: Column, key: Keys, ts: str, name: str = "day_end_cov") -> DataFrame:
    """Largest ``ts`` among the rows that satisfy ``pred``; keys without such a row are left out."""
    return grouped(df.filter(pred), key, F.max(ts).alias(name))


def group_std(df: DataFrame, key: Keys, *cols: str) -> DataFrame:
    """Sample standard deviation; null for a group of one."""
    return grouped(df, key, *[F.stddev_samp(c).alias(f"{c}_std") for c in cols])


def group_mean_median_std(df: DataFrame, keys: Keys, col: str) -> DataFrame:
    """Mean, exact median and sample deviation; the median by distributed selection."""
    names = [keys] if isinstance(keys, str) else list(keys)
    rest = store(grouped(df, names, F.avg(col).alias(f"{col}_mean"), F.stddev_samp(col).alias(f"{col}_std")))
    out = attach(rest.df, group_median(df, names, col), names, spread_by=names)
    return out.select(*names, f"{col}_mean", f"{col}_median", f"{col}_std")


def group_median(df: DataFrame, keys: Keys, col: str, **join_options) -> DataFrame:
    """(keys, ``<col>_median``): the exact median, by selection in a distributed order.

    Rows shrink to one per (keys, value) with its count before they are shuffled. Those are range-partitioned, so a group's
    values lie in as many tasks as they need, and running counts over the ranges tell which value stands in the middle. No
    task holds a group. Nulls do not count; a group without a value has no row.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    counts = grouped(df.where(F.col(col).isNotNull()), names, F.count(F.lit(1)).alias("_n"), value=col)
    placed = store(running_total(counts, [*names, col], "_n", "_before")).df
    whole = placed.groupBy(*names).agg(F.min("_before").alias("_start"), F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
    at = attach(placed, whole, names, weight="_values", spread_by=[col], **join_options)
    first, behind = F.col("_before") - F.col("_start"), F.col("_before") - F.col("_start") + F.col("_n")
    low, high = F.floor((F.col("_rows") - 1) / 2), F.floor(F.col("_rows") / 2)
    holds = lambda place: F.max(F.when((first <= place) & (place < behind), F.col(col).cast("double")))
    middle = at.where((first <= high) & (low < behind)).groupBy(*names).agg(holds(low).alias("_low"), holds(high).alias("_high"))
    return middle.select(*names, ((F.col("_low") + F.col("_high")) / 2).alias(f"{col}_median"))


def scalar_agg(df: DataFrame, agg: Column):
    """A single aggregate value on the driver."""
    return df.agg(agg).first()[0]


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of every value, most frequent first."""
    return grouped(df, col, F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), col)


def mean_of(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.avg(col).alias(f"mean_{col}"))
