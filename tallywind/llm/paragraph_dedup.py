"""Repeated paragraphs and passages across documents.

Paragraphs are lines of ``MIN_WORDS`` words or more. Their 5-word shingles are reduced to MinHash values, whose bands
are tuned for a recall at the similarity sought; colliding paragraphs are verified by exact Jaccard on whole shingle
sets and clustered by connected components.

A passage set inside other lines is no paragraph of its own. So texts are also cut by content: of every ``REACH``
consecutive windows of ``PASSAGE`` words the one with the least hash is a unit (winnowing), which makes sure that texts
sharing ``PASSAGE + REACH - 1`` words in a row share a unit whatever stands around. Equal units are one class.

One paragraph or unit of each cluster stays, the first by document id and place; the others are to be removed. Only
clusters that span two documents or more are reported, then with every occurrence in every document. Overlapping units of
a document are reported as one span if all of them stay or all are later copies. A later copy that overlaps a unit that
stays is reported without the words of that unit, so the words of a unit that stays are never in a removed passage.

Defined results: null, empty and short texts give no rows; repeats within one document only do not count; a null id comes last;
equal texts in two rows are two documents; empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.llm import ngram_join as J
from tallywind.llm import text as X
from tallywind.llm.components import components, key_filter, may_hold, shared
from tallywind.operators.joins import attach
from tallywind.storage import store

MIN_WORDS = 25
SHINGLE = 5
PERCENT = 75
RECALL = 0.99
PASSAGE = 24
REACH = 25
HASHES = 128


def tuned_bands(similarity: float, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, hence the fewest chance collisions, that reach ``recall``."""
    for rows in range(12, 0, -1):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))
        # A third of the hashes: chance collisions are rare long before the last row.
        if bands * rows <= hashes // 2:
            return bands, rows
    return hashes, 1


class FlatSets:
    """Sets end to end, each sorted."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray):
        self.flat, self.bounds = flat, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def __getitem__(self, i: int) -> np.ndarray:
        return self.flat[self.bounds[i] : self.bounds[i + 1]]

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)


def paragraph_sets(piece: X.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, FlatSets]:
    """(row, first word, words, shingle sets) of the paragraphs of a slice."""
    found = X.words(piece)
    hashes = X.span_hashes(piece.data, found, fold=True)
    spans = X.lines(piece)
    first, last = np.searchsorted(found.start, spans.start), np.searchsorted(found.start, spans.end)
    keep = last - first >= MIN_WORDS
    first, last, row = first[keep], last[keep], spans.row[keep]
    windows, _, _ = X.windows(hashes, np.array([0, len(hashes)]), SHINGLE, whole_if_shorter=False)
    counts = last - first - SHINGLE + 1
    line = np.repeat(np.arange(len(first)), counts)
    at = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(len(line)) if len(first) else np.zeros(0, dtype=np.int64)
    h = windows[at]
    order = np.lexsort((h, line))
    h, line = h[order], line[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    sets = FlatSets(h[new], np.searchsorted(line[new], np.arange(len(first) + 1)))
    return row, first - found.bounds[row], last - first, sets


def _nodes(sets: FlatSets) -> np.ndarray:
    return J.identities(sets.flat, sets.bounds)


def _bands(sets: FlatSets, bands: int, rows: int) -> list[np.ndarray]:
    """The band keys of every set: least values under multiplications of the (well mixed) shingle hashes."""
    if not len(sets):
        return []
    factors = X.mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64)).reshape(-1, 2) | np.uint64(1)
    least = np.stack([np.minimum.reduceat((sets.flat ^ a) * b, sets.bounds[:-1]) for a, b in factors], axis=1)
    keys = np.zeros((len(sets), bands), dtype=np.uint64)
    for r in range(rows):
        keys = keys * np.uint64(0xC2B2AE3D27D4EB4F) + least[:, r::rows]
    return list(X.mix(keys + np.arange(bands, dtype=np.uint64)))


def paragraphs(rows: DataFrame, bands: int, per_band: int) -> DataFrame:
    """(row, doc, start, words, node, n, bands) of all paragraphs of (row, doc, text)."""
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("doc", rows.schema["doc"].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("words", T.LongType()),
            T.StructField("node", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in X.slices(batch.column("text")):
            row, start, words, sets = paragraph_sets(piece)
            of = pa.array(row + piece.first)
            yield {
                "row": batch.column("row").take(of),
                "doc": batch.column("doc").take(of),
                "start": start,
                "words": words,
                "node": _nodes(sets),
                "n": sets.sizes,
                "bands": X.list_array(_bands(sets, bands, per_band), pa.int64()),
            }

    return X.map_batches(rows, cut, schema)


def _shared_entries(items: DataFrame, key: str, of: str) -> DataFrame:
    """The rows of ``items`` whose ``key`` is met with two values of ``of`` or more."""
    held = items.groupBy(key).agg(F.min(of).alias("lo"), F.max(of).alias("hi")).where("lo <> hi").select(key)
    held = store(held).df
    bits = shared(items.sparkSession, key_filter(held, key, 27))
    at = items.columns.index(key)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(may_hold(bits.value, batch.column(at).to_numpy(zero_copy_only=False))))

    return items.mapInArrow(likely, items.schema).join(held, key, "left_semi")


#: Words of 64 bits that mark which shingles of a paragraph others have too.
MARKS = 8


def _shared_shingles(nodes: DataFrame, texts: DataFrame, rows_of) -> DataFrame:
    """(node, shared, marks): how many shingles of each paragraph any other of ``nodes`` has too, and one bit for each by its hash.

    Both bound every overlap. Copies that differ from a common source by as much as keeps them from linking with it have too
    many of their own; lines of one template share too few of the same.
    """
    return marked(J.whole_rows(store(nodes).df, texts, "text", rows_of))


def marked(rows: DataFrame) -> DataFrame:
    """What ``_shared_shingles`` tells of (node, row)."""
    each = store(rows.select("node", F.explode("row").alias("h"))).df
    held = each.groupBy("h").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("h")
    bit = F.expr("shiftleft(1L, cast(h & 63 as int))")
    marks = [F.bit_or(F.when(F.expr(f"shiftrightunsigned(h, 6) & {MARKS - 1} = {i}"), bit).otherwise(0)) for i in range(MARKS)]
    found = each.join(held, "h", "left_semi").groupBy("node").agg(F.count("*").alias("shared"), *[m.alias(f"mark{i}") for i, m in enumerate(marks)])
    return found.withColumn("marked", sum(F.bit_count(f"mark{i}") for i in range(MARKS)))


def _most_shared(a: str = "x", b: str = "") -> Column:
    """The most shingles that two paragraphs can share: the bits both have, and for each bit that stands for several shingles of
    both, the others behind it."""
    both = sum(F.bit_count(F.col(f"{a}mark{i}").bitwiseAND(F.col(f"{b}mark{i}"))) for i in range(MARKS))
    return both + F.least(F.col(f"{a}shared") - F.col(f"{a}marked"), F.col(f"{b}shared") - F.col(f"{b}marked"))


def near_paragraphs(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(row, doc, start, words, cluster) of the paragraphs in clusters over two rows or more."""
    bands, per_band = tuned_bands(percent / 100)
    made = store(paragraphs(rows, bands, per_band)).df
    entries = made.select("node", "n", F.explode("bands").alias("s"))
    entries = _shared_entries(entries, "s", "node").distinct().withColumn("pos", F.lit(0).cast("long"))
    entries = store(entries).df
    texts = rows.select("text")

    def rows_of(piece: X.Slice) -> tuple[np.ndarray, FlatSets]:
        sets = paragraph_sets(piece)[3]
        return _nodes(sets), sets

    def remaining(labelled: DataFrame, percent: int) -> DataFrame:
        mixed = J.mixed_columns(labelled)
        open_ = mixed.select("node").distinct()
        mixed = store(mixed.join(_shared_shingles(open_, texts, rows_of), "node")).df
        met = J.cross_pairs(mixed, J.reachable(percent, F.col("xn"), F.col("n"), _most_shared()))
        return met.select(F.least("xnode", "node").alias("a"), F.greatest("xnode", "node").alias("b")).distinct()

    labels = J.components_by_pivots(entries, percent, lambda pairs: J.exact_links(pairs, texts, "text", rows_of, percent), remaining)
    named = made.select("row", "doc", "start", "words", "node").join(labels, "node", "left")
    named = named.select("row", "doc", "start", "words", F.coalesce("comp", "node").alias("cluster"))
    spread = named.groupBy("cluster").agg(F.min("row").alias("lo"), F.max("row").alias("hi")).where("lo <> hi").select("cluster")
    return named.join(spread, "cluster")


def winnowed(piece: X.Slice, passage: int = PASSAGE, reach: int = REACH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, hash) of the windows chosen in every text: of each ``reach`` in a row the least, the last of equals."""
    found = X.words(piece)
    hashes = X.span_hashes(piece.data, found, fold=True)
    h, first, bounds = X.windows(hashes, found.bounds, passage, whole_if_shorter=False)
    row = np.repeat(np.arange(piece.rows), np.diff(bounds))
    if not len(h):
        return row, first, h
    counts = np.diff(bounds)
    chosen = np.zeros(len(h), dtype=bool)
    # The least of every full stretch, by doubling; texts with fewer windows give their least one.
    least = np.arange(len(h))
    width = 1
    while width < reach:
        step = min(width, reach - width)
        other = np.minimum(np.arange(len(h)) + step, len(h) - 1)
        a, b = least, least[other]
        least = np.where(h[b] <= h[a], b, a)
        width += step
    inside = np.arange(len(h)) + reach <= bounds[row + 1]
    chosen[least[inside]] = True
    for r in np.flatnonzero((counts > 0) & (counts < reach)):
        part = h[bounds[r] : bounds[r + 1]]
        chosen[bounds[r + 1] - 1 - int(np.argmin(part[::-1]))] = True
    at = np.flatnonzero(chosen)
    return row[at], first[at] - found.bounds[row[at]], h[at]


def _places_of_each(row: np.ndarray, start: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(row, all places, hash) of each hash in each text: a text that says one thing over and over gives one entry."""
    order = np.lexsort((start, h, row))
    row, start, h = row[order], start[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(new)
    places = pa.ListArray.from_arrays(pa.array(np.append(heads, len(h)), pa.int32()), pa.array(start, pa.int64()))
    return row[heads], places, h[heads]


def repeated_passages(rows: DataFrame) -> DataFrame:
    """(row, doc, start, words, cluster, removed): merged spans of the units that two rows or more hold."""
    schema = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("doc", rows.schema["doc"].dataType), T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("h", T.LongType())]
    )

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in X.slices(batch.column("text")):
            row, starts, h = _places_of_each(*winnowed(piece))
            of = pa.array(row + piece.first)
            yield {"row": batch.column("row").take(of), "doc": batch.column("doc").take(of), "starts": starts, "h": h.view(np.int64)}

    units = store(X.map_batches(rows, cut, schema)).df
    met = store(_shared_entries(units, "h", "row")).df
    first = met.withColumn("start", F.col("starts")[0]).groupBy("h").agg(F.min(_rank("doc", "row", "start")).alias("first"), F.count("*").alias("_n"))
    # One passage may be in a third of all texts: its rows are dealt out.
    known = attach(met, first, ["h"], weight="_n", spread_by=("row", "h"), broadcast_bytes=0)
    known = known.select("row", "doc", "h", "first", F.explode("starts").alias("start"))
    known = known.withColumn("later", (_rank("doc", "row", "start") != F.col("first")).cast("int"))
    inside = Window.partitionBy("row").orderBy("start")  # the units of one text
    stays = F.col("later") == 0
    before = F.max(F.when(stays, F.col("start") + PASSAGE)).over(inside.rangeBetween(-PASSAGE, -1))
    behind = F.min(F.when(stays, F.col("start"))).over(inside.rangeBetween(1, PASSAGE))
    known = known.withColumn("before", before).withColumn("behind", behind)
    known = known.withColumn("from", F.when(stays, F.col("start")).otherwise(F.greatest("start", "before")))
    known = known.withColumn("to", F.when(stays, F.col("start") + PASSAGE).otherwise(F.least(F.col("start") + PASSAGE, "behind"))).where("from < to")
    inside = Window.partitionBy("row").orderBy("from")
    reached = F.max("to").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    opens = (F.col("from") > reached) | (F.col("later") != F.lag("later").over(inside))
    spans = known.withColumn("opens", F.coalesce(opens, F.lit(True)).cast("int"))
    spans = spans.withColumn("span", F.sum("opens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return spans.groupBy("row", "span").agg(
        F.first("doc").alias("doc"),
        F.min("from").alias("start"),
        (F.max("to") - F.min("from")).alias("words"),
        F.min("h").alias("cluster"),
        (F.max("later") > 0).alias("removed"),
    )


def _rank(doc: str, row: str, start: str):
    return F.struct(F.col(doc).isNull().alias("none"), F.col(doc).alias("doc"), F.col(row).alias("row"), F.col(start).alias("start"))


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per repeated span: doc_id, kind (paragraph, passage), start_word, n_words, cluster_id, removed."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    lines = store(near_paragraphs(rows)).df
    kept = lines.groupBy("cluster").agg(F.min(_rank("doc", "row", "start")).alias("first"))
    lines = lines.join(kept, "cluster").withColumn("removed", _rank("doc", "row", "start") != F.col("first"))
    out = [("paragraph", lines), ("passage", repeated_passages(rows))]
    parts = [
        df.select(
            F.col("doc").alias(doc_id),
            F.lit(kind).alias("kind"),
            F.col("start").alias("start_word"),
            F.col("words").alias("n_words"),
            F.col("cluster").alias("cluster_id"),
            "removed",
        )
        for kind, df in out
    ]
    return parts[0].unionByName(parts[1])
