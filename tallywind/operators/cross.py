"""Pair counts of two columns and their share of one column's count.

The log is reduced once to its distinct combinations of the columns involved, with their number. All
counts are derived from that table, and one join per block brings them back to the log.

Combinations with an id of users are as many as rows. Their counts are taken on the rows themselves, by windows that all
stand on one exchange by user; users with very many rows are aggregated and joined instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.operators.aggregates import grouped
from tallywind.operators.joins import BROADCAST_BYTES, attach, attach_all
from tallywind.schema import ITEM_LEVELS, SHOP_LEVELS
from tallywind.storage import Stored, side_by_side, store

GROUP_LIMIT = 1_000_000
#: Bytes that the sorts of the windows of one task may hold together, and those that the rows of one key may.
TASK_BYTES = 256 * 1024 * 1024
KEY_BYTES = 4 * TASK_BYTES
#: Anchors whose pairs are counted on the rows of the log.
ROW_ANCHORS = ("user_id",)


@dataclass(frozen=True)
class Cross:
    """Count ``(col, pair_key)`` for each col, over the count of ``anchor``. ``pair_key`` is ``anchor`` unless set."""

    anchor: str
    cols: tuple[str, ...]
    prefix: str
    pair_key: str | None = None

    @property
    def key(self) -> str:
        return self.pair_key or self.anchor


_ITEM = ("item_id", *ITEM_LEVELS)

# The crosses, by block. The price block counts pairs per city and divides by the price count.
ITEM_CROSSES = [
    Cross("item_id", tuple(ITEM_LEVELS), "item"),
    Cross("item_brand_id", tuple(ITEM_LEVELS[1:]), "brand"),
    Cross("item_city_id", tuple(ITEM_LEVELS[2:]), "city"),
    Cross("item_price_level", tuple(ITEM_LEVELS[3:]), "price", pair_key="item_city_id"),
    Cross("item_sales_level", tuple(ITEM_LEVELS[4:]), "salse"),
    Cross("item_collected_level", tuple(ITEM_LEVELS[5:]), "coll"),
]
USER_CROSSES = [
    Cross("user_id", ("user_gender_id", "user_age_level", "user_occupation_id", "user_star_level"), "user"),
    Cross("user_gender_id", ("user_age_level", "user_occupation_id", "user_star_level"), "user_gender"),
    Cross("user_age_level", ("user_occupation_id", "user_star_level"), "user_age"),
    Cross("user_occupation_id", ("user_star_level",), "user_occ"),
]
_USER_ANCHORS = {
    "user_id": "user",
    "user_gender_id": "user_gender",
    "user_age_level": "user_age",
    "user_occupation_id": "user_occ",
}
USER_ITEM_CROSSES = [Cross(a, _ITEM, p) for a, p in _USER_ANCHORS.items()]
USER_SHOP_CROSSES = [Cross(a, tuple(SHOP_LEVELS), p) for a, p in _USER_ANCHORS.items()]
SHOP_ITEM_CROSSES = [Cross("shop_id", _ITEM, "shop"), Cross("shop_review_num_level", _ITEM, "shop_rev")]


def feature_names(crosses: Sequence[Cross]) -> list[str]:
    return [f"{c}_{x.prefix}_{kind}" for x in crosses for c in x.cols for kind in ("cnt", "prob")]


def cross_counts(
    df: DataFrame,
    *blocks: Sequence[Cross],
    id_col: str = "instance_id",
    group_limit: int = GROUP_LIMIT,
    row_anchors: Sequence[str] = ROW_ANCHORS,
    **join_options,
) -> DataFrame:
    """Add ``<col>_<prefix>_cnt`` and ``<col>_<prefix>_prob`` for every pair of every block.

    The crosses of one block share a table of combinations; group those that share their columns. Crosses anchored in
    ``row_anchors`` are counted on the rows of ``df``, which is read more than once and should be a stored table.
    """
    on_rows = [x for block in blocks for x in block if x.anchor in row_anchors and x.key == x.anchor]
    rest = [kept for block in blocks if (kept := [x for x in block if x not in on_rows])]
    if on_rows:
        df = _count_on_rows(df, on_rows, id_col, group_limit, join_options)

    def lookup(block: Sequence[Cross]):
        return _cross_table(df, block, id_col, group_limit, join_options)

    return attach_all(df, side_by_side(lookup, rest), weight="_n", null_safe=True, **join_options) if rest else df


def _count_on_rows(df, crosses: Sequence[Cross], id_col: str, group_limit: int, join_options) -> DataFrame:
    """The features of crosses whose pairs share their anchor, one exchange of the rows for each anchor."""
    rows = df.withColumn("_n", F.col(id_col).isNotNull().cast("bigint"))
    counted = rows
    for key, partners in _partners(crosses).items():
        counted = _count_within(counted, rows, key, partners, group_limit, {"spread_by": [id_col], **join_options})
    return counted.selectExpr(*[f"`{c}`" for c in df.columns], *_features(crosses))


def _partners(crosses: Sequence[Cross]) -> dict[str, list[str | None]]:
    """What is counted with each key: None for the key alone, and its partners."""
    sets: dict[str, list[str | None]] = {}
    for x in crosses:
        sets.setdefault(x.anchor, []).append(None)
        sets.setdefault(x.key, []).extend(x.cols)
    return {key: list(dict.fromkeys(partners)) for key, partners in sets.items()}


def _features(crosses: Sequence[Cross]) -> list[str]:
    features = []
    for x in crosses:
        for c in x.cols:
            pairs, total = _total(x.key, c), _total(x.anchor, None)
            features.append(f"`{pairs}` as `{c}_{x.prefix}_cnt`")
            features.append(f"try_divide(double(`{pairs}`), double(`{total}`)) as `{c}_{x.prefix}_prob`")
    return features


def _cross_table(df, crosses, id_col, group_limit, join_options) -> tuple[DataFrame | Stored, list[str]]:
    """The features of every combination of a block's columns, and those columns."""
    cols = list(dict.fromkeys(c for x in crosses for c in (x.anchor, x.key, *x.cols)))
    combos = store(df.groupBy(*cols).agg(F.count(id_col).alias("_n")))
    sets = _partners(crosses)
    if combos.rows <= group_limit:
        counted = _count_together(combos.df, cols, sets, join_options)
    else:
        counted = combos.df
        for key, partners in sets.items():
            counted = _count_within(counted, combos.df, key, partners, group_limit, join_options)
    table = Stored(counted.selectExpr(*[f"`{c}`" for c in cols], "_n", *_features(crosses)), (combos.rows, combos.text_bytes))
    # One row per stored combination, so the size is known; it is written only if it cannot be broadcast.
    return (table if table.bytes <= join_options.get("broadcast_bytes", BROADCAST_BYTES) else table.df), cols


def _total(key: str, partner: str | None) -> str:
    return f"_{key}__{partner or ''}"


def _count_together(combos: DataFrame, cols: Sequence[str], sets: dict[str, list[str | None]], join_options) -> DataFrame:
    """All counts at once: the combinations laid out per (key, partner), counted, looked up, and put back side by side.

    Counting merges map-side, and so does putting back, since the entries of a combination stay in its task
    as long as the counts can be broadcast.
    """
    pairs = [(key, partner) for key, partners in sets.items() for partner in partners]
    kinds = {combos.schema[c].dataType for pair in pairs for c in pair if c}
    kind = "bigint" if all(isinstance(k, T.IntegralType) for k in kinds) else "string"
    entries = []
    for i, (key, partner) in enumerate(pairs):
        known = " and ".join(f"`{c}` is not null" for c in (key, partner) if c)
        second = f"cast(`{partner}` as {kind})" if partner else f"cast(null as {kind})"
        entries.append(f"named_struct('_s', {i}, '_a', cast(`{key}` as {kind}), '_b', {second}, '_known', {known})")
    laid_out = combos.selectExpr(*[f"`{c}`" for c in cols], "_n", f"inline(array({', '.join(entries)}))")
    counts = laid_out.filter("_known").groupBy("_s", "_a", "_b").agg(F.sum("_n").alias("_c"), F.count(F.lit(1)).alias("_w"))
    options = {**join_options, "spread_by": [*cols, "_s"]}
    counted = attach(laid_out, counts, ["_s", "_a", "_b"], weight="_w", null_safe=True, **options)
    picked = [F.expr(f"max(case when _s = {i} and _known then _c end) as `{_total(*pair)}`") for i, pair in enumerate(pairs)]
    return counted.groupBy(*cols, "_n").agg(*picked)


def _count_within(df, counted: DataFrame, key: str, partners, group_limit: int, join_options) -> DataFrame:
    """Row counts per ``key`` and per (``key``, partner): sums of ``_n`` over ``counted``, given to the rows of ``df``.

    Keys with a bounded number of rows in ``counted`` are counted by windows after one shuffle by key, into as many parts
    as keep the sorts of a task within ``TASK_BYTES``. The few larger keys, of over ``group_limit`` rows or ``KEY_BYTES``, are
    aggregated and joined instead. A null key has no counts and is not shuffled.
    """
    row_bytes = _sorted_bytes(df, partners)
    group_limit = min(group_limit, max(1, KEY_BYTES // row_bytes))
    sizes = store(counted.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_m"))).df
    parts = math.ceil((sizes.agg(F.sum("_m")).first()[0] or 0) * row_bytes / TASK_BYTES)
    large = store(sizes.filter(F.col("_m") > group_limit).select(F.col(key).alias("_large")))
    unknown = df.filter(F.col(key).isNull()).withColumns(
        {_total(key, partner): F.lit(None).cast("bigint") for partner in partners}
    )
    known = df.filter(F.col(key).isNotNull())
    if large.rows == 0:
        return _by_window(known, key, partners, parts).unionByName(unknown)
    is_large = F.col(key) == F.col("_large")
    small_part = _by_window(known.join(F.broadcast(large.df), is_large, "left_anti"), key, partners, parts)
    large_part = known.join(F.broadcast(large.df), is_large, "left_semi")
    source = counted.join(F.broadcast(large.df), is_large, "left_semi")
    options = {"spread_by": [c for c in counted.columns if c != "_n"], **join_options}
    for partner in partners:
        keys = [key] if partner is None else [key, partner]
        counts = grouped(source, keys, F.sum("_n").alias(_total(key, partner)), F.count(F.lit(1)).alias("_w"))
        large_part = attach(large_part, counts, keys, weight="_w", **options)
    return small_part.unionByName(large_part).unionByName(unknown)


def _sorted_bytes(df: DataFrame, partners) -> int:
    """Bytes a row takes in the sorts of its windows: each partner has a sort of its own, of rows that also have the sums so far."""
    fields = len(df.columns) + len(partners)
    texts = sum(isinstance(f.dataType, T.StringType) for f in df.schema.fields)
    return len(partners) * (16 + 8 * fields + 48 * texts)


def _by_window(df: DataFrame, key: str, partners, parts: int = 0) -> DataFrame:
    """Sums over (key, partner), all served by one exchange on ``key``; a null key or partner has no count.

    An exchange into the session's partitions may be merged to one for each core, so a larger table names its own number.
    """
    columns = {}
    for partner in partners:
        keys = [key] if partner is None else [key, partner]
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        columns[_total(key, partner)] = F.when(known, F.sum("_n").over(Window.partitionBy(*keys)))
    dealt = df.repartition(parts, key) if parts > df.sparkSession.sparkContext.defaultParallelism else df.repartition(key)
    return dealt.withColumns(columns)


def pair_count_ratio(df: DataFrame, cols: Sequence[str], anchor: str, prefix: str, pair_key: str | None = None, **options) -> DataFrame:
    """One anchor's pair counts and ratios."""
    return cross_counts(df, [Cross(anchor, tuple(cols), prefix, pair_key)], **options)
