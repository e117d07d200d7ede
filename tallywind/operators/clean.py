"""Projection, filters, sentinel and null handling, row deduplication and row unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywind.schema import SENTINEL_REPLACEMENTS, USER_LEVELS


def select_features(df: DataFrame, cols: Sequence[str], target: str | None = None) -> DataFrame:
    return df.select(*cols, *([target] if target else []))


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def filter_day(df: DataFrame, day: str = "day", lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Rows with ``lo <= day <= hi``; an open end is left out."""
    if lo is not None:
        df = df.filter(F.col(day) >= lo)
    return df if hi is None else df.filter(F.col(day) <= hi)


def replace_sentinel(df: DataFrame, mapping: Mapping[str, tuple] = SENTINEL_REPLACEMENTS) -> DataFrame:
    """Replace one value per column by another."""
    return df.withColumns({c: F.when(F.col(c) == a, b).otherwise(F.col(c)) for c, (a, b) in mapping.items()})


def sentinel_to_zero(df: DataFrame, cols: Sequence[str] = USER_LEVELS) -> DataFrame:
    return replace_sentinel(df, {c: (-1, 0) for c in cols})


def drop_sentinel_rows(df: DataFrame, col: str, sentinel) -> DataFrame:
    """Rows whose ``col`` is known. A null is not the sentinel and stays."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(sentinel)))


def fill_null(df: DataFrame, value, cols: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls with a number, or with another column given as a ``Column``."""
    if isinstance(value, Column):
        return df.withColumns({c: F.coalesce(F.col(c), value) for c in cols or df.columns})
    return df.na.fill(value, list(cols) if cols else None)


def split_labelled(df: DataFrame, label: str = "is_trade") -> tuple[DataFrame, DataFrame]:
    """Rows with a label, rows without."""
    return df.filter(F.col(label).isNotNull()), df.filter(F.col(label).isNull())


def scale_column(df: DataFrame, col: str, factor: float) -> DataFrame:
    return df.withColumn(col, F.col(col) * factor)


def cast_columns(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(kind) for c in cols})


def rename_columns(df: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Add ``suffix`` to every column but ``keep``."""
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in keep})


def align_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*like.columns)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop fully identical rows; copies are merged before the shuffle."""
    return df.dropDuplicates()


def dedupe_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in ``order``. Spark keeps one row per key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def union_rows(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; a column one of them lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def sort_desc(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(F.desc(col))
