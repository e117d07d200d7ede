"""Hold-outs by day, stacked label days and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywind.operators.ordering import row_index
from tallywind.schema import DayPlan


def split_by_day(df: DataFrame, valid: int = 24, day: str = "day") -> tuple[DataFrame, DataFrame]:
    """Rows before the validation day, rows on it."""
    return df.filter(F.col(day) < valid), df.filter(F.col(day) == valid)


def multi_day_training_set(features: DataFrame, plan: DayPlan, day: str = "day") -> dict[str, DataFrame]:
    """Cut an all-days feature table into training, validation and test rows."""
    return {
        "train": features.filter(F.col(day).isin(list(plan.train))),
        "valid": features.filter(F.col(day) == plan.valid),
        "test": features.filter(F.col(day) == plan.test),
    }


def kfold(df: DataFrame, k: int = 5, id_col: str = "instance_id", fold: str = "fold") -> DataFrame:
    """Contiguous folds in id order, the first ``rows % k`` of them one row longer."""
    indexed = row_index(df, [id_col], "_index")
    n = indexed.count()  # counts what row_index has written, not df anew
    size, longer = divmod(n, k)
    edge = longer * (size + 1)
    head = F.floor(F.col("_index") / F.lit(size + 1))
    tail = F.lit(longer) + F.floor((F.col("_index") - edge) / F.lit(max(size, 1)))
    return indexed.withColumn(fold, F.when(F.col("_index") < edge, head).otherwise(tail).cast("int")).drop("_index")


def hash_fold(df: DataFrame, k: int = 5, id_col: str = "instance_id", fold: str = "fold") -> DataFrame:
    """Folds by hash of the id: no sort and no shuffle. The hash is the first 32 bits of the id's md5."""
    digits = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(fold, (digits % k).cast("int"))


def stratified_fold(df: DataFrame, k: int = 5, label: str = "is_trade", id_col: str = "instance_id", fold: str = "fold") -> DataFrame:
    """Folds with the same share of every label, to one row: the rank by id within the label, dealt round.

    Ranks are distributed positions (``row_index``) less the label's first; ids must not repeat within a label. A null label is a
    label of its own.
    """
    indexed = row_index(df, [label, id_col], "_index")
    # A row per label.
    first = indexed.groupBy(label).agg(F.min("_index").alias("_first")).withColumnRenamed(label, "_label")
    placed = indexed.join(F.broadcast(first), F.col(label).eqNullSafe(F.col("_label")))
    return placed.withColumn(fold, ((F.col("_index") - F.col("_first")) % k).cast("int")).drop("_index", "_first", "_label")
