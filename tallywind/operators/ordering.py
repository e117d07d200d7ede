"""Global running totals without a global window.

Rows are range-partitioned by the order columns and written once; totals then run inside each range, and
each range adds the sum of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywind.storage import store


def running_total(df: DataFrame, order: Sequence[str], value, name: str, ranges: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows that come strictly before this one in ``order``.

    ``order`` must identify a row. Only one row per range is collected into a single window.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid_out = (
        df.withColumn("_value", value if not isinstance(value, str) else F.col(value))
        .repartitionByRange(ranges, *order)
        .withColumn("_range", F.spark_partition_id())
    )
    stored = store(laid_out).df
    sums = stored.groupBy("_range").agg(F.sum("_value").alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select(F.col("_range").alias("_r"), F.coalesce(before, F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, so the broadcast side has at most ``ranges`` rows.
    return (
        stored.join(F.broadcast(offsets), F.col("_range") == F.col("_r"))
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .drop("_value", "_range", "_r", "_offset")
    )


def row_index(df: DataFrame, order: Sequence[str], name: str = "index", ranges: int | None = None) -> DataFrame:
    """Add a gapless 0-based position in ``order``, which must identify a row."""
    return running_total(df, order, F.lit(1), name, ranges)
