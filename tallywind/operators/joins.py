"""Joins of small-per-key tables back onto the log.

``attach`` is the join that meets the whole log. It looks at the exact size of the table: up to a byte
limit the table is broadcast, beyond it the log is shuffled by key with the heavy keys taken out, so that no task receives
more than its share however skewed the keys are. A key is heavy if it has more than ``1 / (SHARE * partitions)`` of
the rows: every such key is known by an exact count, and by that bound there are at most ``SHARE * partitions`` of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.storage import Stored, store, store_all

BROADCAST_BYTES = 64 * 1024 * 1024
SHARE = 4
SPREAD = 1 << 20


def attach(
    df: DataFrame,
    table: DataFrame | Stored,
    keys: Sequence[str],
    weight: str | None = None,
    null_safe: bool = False,
    spread_by: Sequence[str] = ("instance_id",),
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int | None = None,
) -> DataFrame:
    """Left join of ``table`` (one row per key) onto ``df``.

    ``weight`` names a column of ``table`` holding how many rows of ``df`` carry the key; it is used to
    find the hot keys and is not returned. Null keys match nothing unless ``null_safe``.
    """
    options = {"null_safe": null_safe, "spread_by": spread_by, "broadcast_bytes": broadcast_bytes, "hot_keys": hot_keys}
    return attach_all(df, [(table, keys)], weight, **options)


def attach_all(
    df: DataFrame,
    lookups: Sequence[tuple[DataFrame | Stored, Sequence[str]]],
    weight: str | None = None,
    null_safe: bool = False,
    spread_by: Sequence[str] = ("instance_id",),
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int | None = None,
) -> DataFrame:
    """``attach`` for several tables: those small enough are joined in one pass over ``df``.

    ``broadcast_bytes`` bounds the broadcast tables together, smallest first.
    """
    stored = store_all(*[table for table, _ in lookups])
    small, large, room = [], [], broadcast_bytes
    for table, keys in sorted(zip(stored, (keys for _, keys in lookups), strict=True), key=lambda lookup: lookup[0].bytes):
        room -= table.bytes
        (small if room >= 0 else large).append((table, list(keys)))

    out, added = df, []
    for i, (table, keys) in enumerate(small):
        values = _values(table, keys, weight)
        side = _keyed(table.df.select(*keys, *values), keys, f"_k{i}")
        out = out.join(F.broadcast(side), _condition(keys, null_safe, f"_k{i}"), "left")
        added += values
    if small:
        out = out.select(*df.columns, *added)
    for table, keys in large:
        values = _values(table, keys, weight)
        frequency = weight if weight in table.df.columns else None
        out = _attach_split(out, table.df, keys, values, frequency, null_safe, spread_by, hot_keys)
    return out


def _values(table: Stored, keys: Sequence[str], weight: str | None) -> list[str]:
    return [c for c in table.df.columns if c not in keys and c != weight]


def _attach_split(df, table, keys, values, weight, null_safe, spread_by, hot_keys) -> DataFrame:
    """Shuffle join with the heavy keys answered from a broadcast instead.

    The broadcast is bounded by ``SHARE`` times the shuffle partitions, or by ``hot_keys`` rows, the most frequent, if given. Rows with a hot (or null) key get a bucket from
    their own id rather than from the key, which spreads them evenly; all others meet the table.
    """
    packed = table.select(*keys, F.struct(*values).alias("_cold"))
    if weight is not None:
        counted = table.select(*keys, *values, F.col(weight).alias("_count"))
        hot = _heaviest(counted, hot_keys).drop("_count")
    else:
        frequent = _heaviest(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_count")), hot_keys)
        hot = _match(frequent.select(*keys), _keyed(table, keys), keys, null_safe, how="inner")
    hot = hot.select(*keys, F.struct(*values).alias("_hot"))

    marked = _match(df, F.broadcast(_keyed(hot, keys)), keys, null_safe).select(*df.columns, "_hot")
    own = [c for c in spread_by if c in df.columns] or df.columns
    off = F.col("_hot").isNotNull()
    if not null_safe:
        off = reduce(lambda a, k: a | F.col(k).isNull(), keys, off)
    bucket = F.when(off, SPREAD + F.pmod(F.xxhash64(*own), F.lit(SPREAD))).otherwise(
        F.pmod(F.xxhash64(*keys), F.lit(SPREAD))
    )
    left = marked.withColumn("_bucket", bucket)
    right = packed.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(SPREAD)))
    right = _keyed(right, [*keys, "_bucket"])
    condition = _condition(keys, null_safe) & (F.col("_bucket") == F.col("_k__bucket"))
    joined = left.join(right, condition, "left")
    picked = [F.coalesce(F.col("_hot")[v], F.col("_cold")[v]).alias(v) for v in values]
    return joined.select(*df.columns, *picked)


def _keyed(table: DataFrame, keys: Sequence[str], prefix: str = "_k") -> DataFrame:
    return table.withColumnsRenamed({k: f"{prefix}_{k}" for k in keys})


def _condition(keys: Sequence[str], null_safe: bool, prefix: str = "_k") -> Column:
    pairs = [(F.col(k), F.col(f"{prefix}_{k}")) for k in keys]
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _match(left, keyed_right, keys, null_safe, how="left") -> DataFrame:
    return left.join(keyed_right, _condition(keys, null_safe), how)


def _heaviest(counted: DataFrame, most: int | None = None) -> DataFrame:
    """The keys (with their ``_count`` of rows) above the bound of a heavy key, or the ``most`` most frequent of all."""
    if most is not None:
        return counted.orderBy(F.desc("_count"), *[c for c in counted.columns if c != "_count"][:1]).limit(most)
    partitions = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counted.agg(F.sum("_count")).first()[0] or 0
    return counted.where(F.col("_count") * (SHARE * partitions) > total)


def heavy_keys(df: DataFrame, keys: Sequence[str]) -> Stored:
    """(keys, ``_count``, ``_parts``) of every key that has more than its share of the rows of ``df``; ``_parts`` shares cover it."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counted = store(df.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("_count"))).df
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counted.agg(F.sum("_count")).first()[0] or 1
    return store(_heaviest(counted).withColumn("_parts", F.ceil(F.col("_count") * (SHARE * partitions) / total).cast("int")))


def left_join(df: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left equi-join on one or more keys; a null key finds nothing. ``table`` may have any number of rows per key.

    Rows of heavy keys are dealt over as many parts as the key has shares, and the table's rows of that key are given to
    each part; all parts of all keys are at most twice the bound on heavy keys. Rows with a null key are dealt out by themselves.
    """
    on = list(on)
    hot = heavy_keys(df, on)
    if not hot.rows and not any(df.schema[k].nullable for k in on):
        return df.join(table, on, "left")
    parts = F.broadcast(hot.df.select(*on, F.col("_parts").alias("_of")))
    own = F.xxhash64(*[c for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)])
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    dealt = df.join(parts, on, "left").withColumn("_part", F.when(null, F.pmod(own, F.lit(SPREAD))).otherwise(F.pmod(own, F.coalesce("_of", F.lit(1)))).cast("int")).drop("_of")
    given = table.join(parts, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_of", F.lit(1)) - 1))).drop("_of")
    return dealt.join(given, [*on, "_part"], "left").drop("_part")


def outer_join_fill(tables: Sequence[DataFrame], on: Sequence[str], fill=0) -> DataFrame:
    """Full outer join of several per-key tables, missing values filled."""
    joined = reduce(lambda a, b: a.join(b, list(on), "full"), tables)
    return joined.na.fill(fill, [c for c in joined.columns if c not in on])


def lookup_or_default(df: DataFrame, table: DataFrame | Stored, keys: Sequence[str], default=0, **options) -> DataFrame:
    """Look up every value of ``table`` by key, ``default`` where the key is unknown."""
    columns = (table.df if isinstance(table, Stored) else table).columns
    values = [c for c in columns if c not in keys and c != options.get("weight")]
    return attach(df, table, keys, **options).na.fill(default, values)


def join_by_id(df: DataFrame, features: DataFrame, id_col: str = "instance_id") -> DataFrame:
    """Left join of per-row columns by row id; rows without an entry stay null."""
    return df.join(features, id_col, "left")


def restore_rows(ids: DataFrame, scores: DataFrame, id_col: str = "instance_id", fill=0) -> DataFrame:
    """Scores for the full id list: rows dropped on the way come back with ``fill``."""
    joined = ids.select(id_col).join(scores, id_col, "left")
    return joined.na.fill(fill, [c for c in scores.columns if c != id_col])
