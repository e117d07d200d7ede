"""Registered queries: each pairs a Spark function with the SQL another engine must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.sources.standin import LOG_SQL, clean_log

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def on_log(select: str, *ctes: str) -> str:
    """SQL over the stand-in log (``raw`` with duplicates, ``log`` without)."""
    return "with " + ",\n".join([LOG_SQL.strip(), *[c.strip() for c in ctes]]) + "\n" + select.strip()


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that the order of a sum does not show."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 6) + F.lit(0.0) for c in doubles}) if doubles else df


def case(name: str, sql: str | None = None):
    """Register a function of (spark, folder)."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def log_case(name: str, sql: str | None = None):
    """Register a function of the cleaned stand-in log."""

    def register(fn: Callable[[DataFrame], DataFrame]):
        case(name, sql)(lambda spark, sf_dir: fn(clean_log(spark, sf_dir)))
        return fn

    return register
