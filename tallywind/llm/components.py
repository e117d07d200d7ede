"""Connected components of a link table, and small fixed-size filters over keys."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywind.storage import store


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) for every node of ``links``: comp is the least node reachable.

    Labels move along links and then jump to their label's label, so rounds grow with the logarithm of the longest
    path. Every round is written to the shared folder; nothing but one count per round reaches the driver. Links are
    joined by sort-merge joins, whose heavy keys (hubs) the adaptive planner splits. Null ends are ignored.
    """
    both = links.select(F.col(a).alias("from"), F.col(b).alias("to")).where("from is not null and to is not null and from <> to")
    both = store(both.union(both.select(F.col("to").alias("from"), F.col("from").alias("to"))).distinct()).df
    labels = store(both.groupBy(F.col("from").alias("node")).agg(F.least(F.first("from"), F.min("to")).alias("comp"))).df
    while True:
        told = both.join(labels, both["from"] == labels["node"]).select(F.col("to").alias("node"), "comp")
        heard = told.union(labels).groupBy("node").agg(F.min("comp").alias("near"))
        near = store(heard).df
        roots = labels.select(F.col("node").alias("root"), F.col("comp").alias("far"))
        jumped = near.join(roots, near["near"] == roots["root"], "left").select("node", F.least("near", "far").alias("comp"))
        fresh = store(jumped).df
        before = labels.withColumnRenamed("comp", "old")
        changed = fresh.join(before, "node").where("comp <> old").count()
        labels = fresh
        if not changed:
            return labels


#: 2**25 bits: 4 MB whatever the number of keys. A full filter lets everything pass and loses nothing.
FILTER_BITS = 25


def key_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit per hash slot, set for the slots of all keys. At most 2**bits / 64 rows reach the driver."""
    slot = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    words = keys.select((F.shiftright(slot, 6)).alias("word"), F.expr("shiftleft(1L, cast(%s & 63 as int))" % key).alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each 64-bit key may be among the filter's keys."""
    keys = keys.view(np.uint64)
    slot = keys & np.uint64(len(table) * 64 - 1)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def shared(spark: SparkSession, value):
    """A broadcast of a value whose size has a stated bound."""
    return spark.sparkContext.broadcast(value)
