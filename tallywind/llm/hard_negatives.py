"""Hard negatives by inner product, found through STR-packed R-trees.

Rows are cut into tiles by sort-tile-recursive packing over the coordinates with the largest spread: cut points of the
first coordinate give slabs, cut points of the second within each slab give tiles. Every tile is packed the same way into
an R-tree of minimum bounding boxes inside the task that holds it. For an anchor a, a box [lo, hi] bounds every inner
product inside it coordinate by coordinate:

    sum of min(a_j lo_j, a_j hi_j)  <=  a . x  <=  sum of max(a_j lo_j, a_j hi_j),

all of them integers, hence exact. A best-first queue opens boxes by their upper bound and leaves out those outside the
anchor's score windows or strictly below its kth score so far.

Two searches run one after the other: the positives (same label, any score) and, in the window that each positive's score
sets, the negatives (another label). A search goes over the tiles in waves, each several times as many tiles as all before
it: the kth scores of one wave are the bounds of the next, for whole tiles first (anchors are not sent to a tile that
cannot help) and for boxes inside them. A tile gives at most k rows per anchor and window, so what is merged grows with
the number of waves and not with that of tiles. In a task the tile comes first and anchors stream past it, so memory is
bounded by a tile.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part; a component whose
product with ``SCALE`` reaches 2**24 raises an error; vectors of different lengths are compared as if the shorter went on with
zeros; equal scores go by the smaller id, null ids last; a row without an id is no anchor; repeated rows are rows of
their own (each is the other's candidate) and each is an anchor; a negative positive score leaves an empty window; an empty
table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.llm import text as X
from tallywind.llm import vectors as V
from tallywind.llm.components import shared
from tallywind.storage import store

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: Share of the positive's score, in percent, that a negative reaches at least; at most it is the whole.
LEAST_PERCENT = 80
#: Rows of a tile, which is what a task holds at once. Small inputs have up to ``TILES`` tiles of ``LEAST_ROWS``.
MOST_ROWS = 1 << 17
LEAST_ROWS = 1 << 11
TILES = 64
#: Rows of a leaf, and boxes of an inner node.
LEAF = 64
FAN = 16
#: A wave has this many times the tiles of all waves before it.
WAVE = 7
#: Boxes that anchors are routed by: 2 MB at 64 dimensions. More tiles share boxes.
ROUTES = 4096
#: Beyond every score; and the rank of rows without an id.
_FAR = 1 << 62
_LAST = (1 << 63) - 1


def str_order(q: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Rows in sort-tile-recursive order: consecutive ``leaf`` rows make a leaf."""
    spread = np.argsort(-q.astype(np.float64).var(axis=0), kind="stable") if len(q) else np.zeros(0, dtype=np.int64)

    def cut(rows: np.ndarray, level: int) -> list[np.ndarray]:
        pages = -(-len(rows) // leaf)
        if pages <= 1 or level == len(spread):
            return [rows]
        left = max(1, min(len(spread) - level, int(np.log2(pages))))
        slabs = int(np.ceil(pages ** (1 / left)))
        size = -(-pages // slabs) * leaf
        rows = rows[np.argsort(q[rows, spread[level]], kind="stable")]
        return [part for at in range(0, len(rows), size) for part in cut(rows[at : at + size], level + 1)]

    return np.concatenate(cut(np.arange(len(q)), 0)) if len(q) else np.zeros(0, dtype=np.int64)


def interval(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the inner product of ``a`` with anything in each box, coordinate by coordinate."""
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    return lo @ plus + hi @ minus, hi @ plus + lo @ minus


class RTree:
    """A packed tree over the rows of a tile. Level 0 are the leaves; a node's children are ``FAN`` in a row."""

    def __init__(self, row: np.ndarray, rank: np.ndarray, label: np.ndarray, q: np.ndarray, leaf: int = LEAF):
        order = str_order(q, leaf)
        self.leaf = leaf
        self.row, self.rank, self.label, self.q = row[order], rank[order], label[order], q[order]
        self.levels = [self._boxes(self.q, self.q, leaf)]
        while len(self.levels[-1][0]) > 1:
            self.levels.append(self._boxes(*self.levels[-1], FAN))

    @staticmethod
    def _boxes(lo: np.ndarray, hi: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
        starts = np.arange(0, len(lo), fan)
        return np.minimum.reduceat(lo, starts, axis=0), np.maximum.reduceat(hi, starts, axis=0)

    def search(self, own: int, a: np.ndarray, label: int, same: bool, low: np.ndarray, high: np.ndarray, floor: np.ndarray, most: int):
        """Per window [low, high] the best ``most`` rows of score ``floor`` or more, as (score, rank, row), best first.

        Labels are the anchor's (``same``) or any other; the anchor's own row is never among them.
        """
        best: list[list[tuple[int, int, int]]] = [[] for _ in low]
        least = np.maximum(low, floor)
        queue: list[tuple[float, int, int]] = []

        def offer(level: int, nodes: np.ndarray) -> None:
            lo, hi = self.levels[level]
            lower, upper = interval(a, lo[nodes], hi[nodes])
            open_ = ((upper[:, None] >= least) & (lower[:, None] <= high)).any(axis=1)
            for node, top in zip(nodes[open_].tolist(), upper[open_].tolist(), strict=True):
                heapq.heappush(queue, (-top, level, node))

        offer(len(self.levels) - 1, np.arange(len(self.levels[-1][0])))
        while queue and -queue[0][0] >= least.min():
            leaves = []
            while queue and len(leaves) < FAN and -queue[0][0] >= least.min():
                _, level, node = heapq.heappop(queue)
                if level:
                    offer(level - 1, np.arange(node * FAN, min((node + 1) * FAN, len(self.levels[level - 1][0]))))
                else:
                    leaves.append(node)
            if not leaves:
                continue
            at = (np.array(leaves)[:, None] * self.leaf + np.arange(self.leaf)).ravel()
            at = at[at < len(self.row)]
            at = at[((self.label[at] == label) == same) & (self.row[at] != own)]
            scores = self.q[at] @ a
            for w in range(len(low)):
                fits = np.flatnonzero((scores >= least[w]) & (scores <= high[w]))
                if not len(fits):
                    continue
                if len(fits) > most:
                    kth = np.partition(scores[fits], len(fits) - most)[len(fits) - most]
                    fits = fits[scores[fits] >= kth]
                    if len(fits) > most:
                        fits = fits[np.lexsort((self.row[at[fits]], self.rank[at[fits]], -scores[fits]))[:most]]
                found = zip(scores[fits].astype(np.int64).tolist(), self.rank[at[fits]].tolist(), self.row[at[fits]].tolist(), strict=True)
                best[w] = sorted(best[w] + list(found), key=lambda f: (-f[0], f[1], f[2]))[:most]
                if len(best[w]) == most:
                    least[w] = max(least[w], best[w][-1][0])
        return best


def _cuts(parts: int) -> list[float]:
    return [i / parts for i in range(1, parts)]


def _place(c: Column, cuts: Column) -> Column:
    """How many of the cut points lie below a value."""
    return F.size(F.filter(cuts, lambda v: v < c))


def tiled(rows: DataFrame, n: int, width: int, most_rows: int = MOST_ROWS, least_rows: int = LEAST_ROWS) -> tuple[DataFrame, int]:
    """The rows with a ``tile`` number, and how many tiles there are.

    Cut points are approximate quantiles of an integer coordinate plus a hash of the row in [0, 1), so that equal
    values, however many, are spread over tiles too.
    """
    tiles = max(-(-n // most_rows), min(TILES, -(-n // least_rows)))
    if tiles <= 1 or not width:
        return rows.withColumn("tile", F.lit(0)), 1
    slabs = int(np.ceil(np.sqrt(tiles)))
    per_slab = -(-tiles // slabs)
    component = lambda j: F.get("q", F.lit(j)).cast("double")
    spread = rows.agg(*[F.var_pop(component(j)).alias(f"v{j}") for j in range(width)]).first()
    wide = sorted(range(width), key=lambda j: -(spread[j] or 0.0))
    salt = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / float(1 << 20)
    keyed = rows.withColumns({"_x": component(wide[0]) + salt, "_y": component(wide[min(1, width - 1)]) + salt})
    # The cut points of the slabs are one row, those of the tiles a row per slab: the square root of the number of tiles.
    x_cuts = keyed.agg(F.percentile_approx("_x", _cuts(slabs))).first()[0]
    slabbed = keyed.withColumn("_slab", _place(F.col("_x"), F.array(*[F.lit(float(v)) for v in x_cuts])))
    if per_slab == 1:
        return slabbed.withColumn("tile", F.col("_slab")).drop("_x", "_y", "_slab"), slabs
    y_cuts = store(slabbed.groupBy("_slab").agg(F.percentile_approx("_y", _cuts(per_slab)).alias("_cuts"))).df
    placed = slabbed.join(F.broadcast(y_cuts), "_slab").withColumn("tile", F.col("_slab") * per_slab + _place(F.col("_y"), F.col("_cuts")))
    return placed.drop("_x", "_y", "_slab", "_cuts"), slabs * per_slab


def _routes(rows: DataFrame, tiles: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(numbers, lo, hi, tiles per box) of the boxes that anchors are routed by; at most ``ROUTES`` rows reach the driver."""
    per_box = -(-tiles // ROUTES)

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            box, q = batch.column(0).to_numpy() // per_box, V.matrix_of(batch.column(1))
            order = np.argsort(box, kind="stable")
            known, starts = np.unique(box[order], return_index=True)
            lo, hi = np.minimum.reduceat(q[order], starts, axis=0), np.maximum.reduceat(q[order], starts, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(known, pa.int32()), V.lists(lo, pa.int32()), V.lists(hi, pa.int32())], names=["box", "lo", "hi"])

    each = rows.select("tile", "q").mapInArrow(boxes, "box int, lo array<int>, hi array<int>")
    each = each.select("box", F.posexplode(F.arrays_zip("lo", "hi")).alias("i", "b"))
    merged = each.groupBy("box", "i").agg(F.min("b.lo").alias("lo"), F.max("b.hi").alias("hi"))
    found = merged.groupBy("box").agg(F.sort_array(F.collect_list(F.struct("i", "lo", "hi"))).alias("b")).orderBy("box").collect()
    lo, hi = (np.array([[b[end] for b in r["b"]] for r in found]) for end in ("lo", "hi"))
    return np.array([r["box"] for r in found], dtype=np.int64), lo, hi, per_box


def _runs(values: np.ndarray) -> Iterator[slice]:
    """Maximal stretches of equal values."""
    edges = np.flatnonzero(values[1:] != values[:-1]) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(values)], strict=True):
        yield slice(a, b)


class Search:
    """Searches of anchors (row, label, q and their windows low, high, floor) over tiled rows, wave by wave."""

    def __init__(self, rows: DataFrame, tiles: int, exact: type):
        self.rows, self.tiles, self.exact = rows, tiles, exact
        number, lo, hi, per_box = _routes(rows, tiles)
        self.routes = shared(rows.sparkSession, (number, lo.astype(exact), hi.astype(exact), per_box))

    def best(self, anchors: DataFrame, same: bool, most: int) -> DataFrame:
        """(row, w, score, rank, found) of the best ``most`` rows of every window of every anchor."""
        anchors = store(anchors.withColumn("floor", F.transform("low", lambda _: F.lit(-_FAR)))).df
        state, kept, first, size = anchors, None, 0, 1
        while first < self.tiles:
            found = self._wave(state, first, min(first + size, self.tiles), same, most)
            kept = store(_best(found if kept is None else found.union(kept), most)).df
            first, size = first + size, (first + size) * WAVE
            if first < self.tiles:
                kth = kept.groupBy("row", "w").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") == most)
                kth = kth.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("kth"))
                floors = F.transform("low", lambda _, w: F.coalesce(F.try_element_at("kth", w), F.lit(-_FAR)))
                state = store(anchors.drop("floor").join(kth, "row", "left").withColumn("floor", floors).drop("kth")).df
        return kept

    def _wave(self, anchors: DataFrame, first: int, behind: int, same: bool, most: int) -> DataFrame:
        routes, exact = self.routes, self.exact

        def route(batch: pa.RecordBatch) -> Iterator[dict]:
            number, lo, hi, per_box = routes.value
            mine = (number + 1) * per_box > first
            mine &= number * per_box < behind
            number, lo, hi = number[mine], lo[mine], hi[mine]
            windows = [V.rows_of(batch.column(c)) for c in ("low", "high", "floor")]
            q = V.matrix_of(batch.column("q")).astype(exact)
            at, tile = [], []
            for i in range(batch.num_rows):
                lower, upper = interval(q[i], lo, hi)
                low, high, floor = (w[i] for w in windows)
                open_ = ((upper[:, None] >= np.maximum(low, floor)) & (lower[:, None] <= high)).any(axis=1)
                for box in number[open_].tolist():
                    tiles = range(max(first, box * per_box), min(behind, (box + 1) * per_box))
                    at += [i] * len(tiles)
                    tile += tiles
            sent = batch.take(pa.array(at, pa.int64()))
            yield {c: sent.column(c) for c in batch.schema.names} | {"tile": np.array(tile, dtype=np.int32)}

        width = T.StructType([*anchors.schema.fields, T.StructField("tile", T.IntegerType())])
        sent = X.map_batches(anchors, route, width).withColumn("rank", F.lit(None).cast("long"))
        members = self.rows.where(F.col("tile").between(first, behind - 1))
        nothing = F.lit(None).cast("array<long>")
        columns = ["tile", "anchor", "row", "rank", "label", "q", "low", "high", "floor"]
        members = members.withColumns({"low": nothing, "high": nothing, "floor": nothing, "anchor": F.lit(0)}).select(columns)
        both = members.union(sent.withColumn("anchor", F.lit(1)).select(columns)).repartition("tile").sortWithinPartitions("tile", "anchor")

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts, tree, now = [], None, None
            for batch in batches:
                if not batch.num_rows:
                    continue
                tile, anchor = (batch.column(c).to_numpy() for c in ("tile", "anchor"))
                for run in _runs(tile.astype(np.int64) * 2 + anchor):
                    piece = batch.slice(run.start, run.stop - run.start)
                    if tile[run.start] != now:
                        parts, tree, now = [], None, tile[run.start]
                    row, label, q = piece.column("row").to_numpy(), piece.column("label").to_numpy(), V.matrix_of(piece.column("q"))
                    if not anchor[run.start]:
                        parts.append((row, piece.column("rank").to_numpy(), label, q.astype(exact)))
                        continue
                    if tree is None:
                        if not parts:
                            continue
                        tree, parts = RTree(*[np.concatenate(p) for p in zip(*parts, strict=True)]), []
                    yield _found(tree, row, label, q.astype(exact), piece, same, most)

        return both.mapInArrow(search, "row long, w int, score long, rank long, found long")


def _found(tree: RTree, row: np.ndarray, label: np.ndarray, q: np.ndarray, piece: pa.RecordBatch, same: bool, most: int) -> pa.RecordBatch:
    """What some anchors find in one tile."""
    low, high, floor = (V.rows_of(piece.column(c)) for c in ("low", "high", "floor"))
    out = []
    for i in range(len(row)):
        for w, found in enumerate(tree.search(row[i], q[i], label[i], same, low[i], high[i], floor[i], most), 1):
            out += [(row[i], w, *f) for f in found]
    columns = np.array(out, dtype=np.int64).reshape(-1, 5).T
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True)], names=["row", "w", "score", "rank", "found"])


def _best(found: DataFrame, most: int) -> DataFrame:
    """The best rows per anchor and window; there are ``most`` per tile of a wave at most, and as many from before."""
    order = Window.partitionBy("row", "w").orderBy(F.desc("score"), "rank", "found")
    return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).drop("r")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    most_rows: int = MOST_ROWS,
    least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among the rows."""
    taken = vectors.where(F.col(label).isNotNull() & V.finite(F.col(vector)))
    taken = taken.select(
        F.coalesce(F.col(vec_id).cast("long"), F.lit(_LAST)).alias("rank"),
        F.col(label).cast("long").alias("label"),
        V.scaled(F.col(vector), scale).alias("q"),
        (F.col(vec_id).isNotNull() & F.coalesce(is_anchor, F.lit(False))).alias("anchor"),
    )
    taken = store(taken.withColumn("row", F.monotonically_increasing_id())).df
    largest = F.aggregate("q", F.lit(0), lambda most, x: F.greatest(most, F.abs(x)))
    n, width, top = taken.agg(F.count("*"), F.max(F.size("q")), F.max(largest)).first()
    width, top = width or 0, top or 0
    padded = taken.withColumn("q", F.concat("q", F.array_repeat(F.lit(0), F.lit(width) - F.size("q"))))
    rows, tiles = tiled(padded, n, width, most_rows, least_rows)
    rows = store(rows).df
    if not width:
        rows = rows.withColumn("q", F.array(F.lit(0)))
    # Doubles hold the sums exactly below 2**53.
    finder = Search(rows.drop("anchor"), tiles, np.float64 if width * top * top < 1 << 53 else np.int64)

    whole = {"low": F.array(F.lit(-_FAR)), "high": F.array(F.lit(_FAR))}
    anchors = store(rows.where("anchor").select("row", "rank", "label", "q")).df
    liked = finder.best(anchors.drop("rank").withColumns(whole), True, positives)
    liked = store(liked.select("row", F.col("rank").alias("positive"), F.col("score").alias("positive_score"), F.col("found").alias("positive_row"))).df

    # One window per different positive score; none for negative ones, whose window is empty.
    scores = liked.where("positive_score >= 0").groupBy("row").agg(F.array_sort(F.collect_set("positive_score")).alias("high"))
    low = F.transform("high", lambda s: F.floor((s * least_percent + 99) / 100))
    windowed = anchors.drop("rank").join(scores, "row").withColumn("low", low)
    disliked = finder.best(windowed.select("row", "label", "q", "low", "high"), False, negatives)
    ranked = disliked.withColumn("r", F.row_number().over(Window.partitionBy("row", "w").orderBy(F.desc("score"), "rank", "found")))
    pairs = liked.join(scores, "row").withColumn("w", F.array_position("high", F.col("positive_score")).cast("int")).drop("high")
    out = pairs.join(ranked, ["row", "w"]).join(anchors.select("row", F.col("rank").alias("anchor_id")), "row")
    named = lambda c: F.nullif(F.col(c), F.lit(_LAST))
    return out.select(
        "anchor_id",
        named("positive").alias("positive_id"),
        F.col("r").alias("rank"),
        named("rank").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
