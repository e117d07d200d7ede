"""Similarity self-join of texts on word n-grams, as a sparse product of documents by n-grams.

A text is the set of its distinct n-word shingles (A-Z lowered). Two texts link when 100 * intersection reaches
``percent`` * union. The join never multiplies whole columns:

1. Texts of equal sets form one class, a row of the matrix.
2. Columns are put in one global order, rare before frequent. A row that links with anything shares one of its first
   ``size - ceil(percent * size / 100) + 1`` columns with it, so only those entries are indexed; columns held by one
   class go at once.
3. Each column's rows meet the column's pivot, the row that most others meet. Pairs whose sizes, or whose places in the
   two rows, bound the overlap below what a link needs are discarded. The overlap of the others is accumulated over
   blocks of columns of their whole rows, and a pair is given up as soon as its count and what is left of either row
   fall below the bound that their sizes set. Links merge components.
4. Within a column only pairs in different components are left. They are taken between the rows outside the column's
   largest component and all others, so a group of near copies costs its stragglers times its size, and go the same
   way. That loses no link.

Shingles and classes are 64-bit hashes; among N classes N**2 / 2**65 accidental merges are to be expected.

Defined results: a null, empty or all-white text has the empty set and links with nothing; fewer words than n give
one shingle; repeated rows fall in one class; a null id is carried and never names a component that has another id;
empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.llm import text as X
from tallywind.llm.components import components, key_filter, may_hold, shared
from tallywind.llm.suffix_dedup import TALLY, passes, repeated, tallied
from tallywind.storage import store

SIZE = 5
PERCENT = 75
#: Columns whose frequency is known to the order: 3 MB. Any order gives the same links; this one keeps columns short.
FREQUENT = 1 << 18
PIVOT_TURNS = 2
_CHUNK = 1 << 21


def identities(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every set, given end to end; 0 for the empty set."""
    sizes = np.diff(bounds)
    salt = sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    each = X.mix(flat * np.uint64(0x9E3779B97F4A7C15) + np.repeat(salt, sizes))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(each, dtype=np.uint64)])
    out = X.mix((total[bounds[1:]] - total[bounds[:-1]]) ^ salt).view(np.int64)
    return np.where(sizes > 0, out, 0)


def identities_of(sets: list[np.ndarray]) -> np.ndarray:
    if not sets:
        return np.zeros(0, dtype=np.int64)
    return identities(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))


def met_again(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The values that ``held`` has twice or more, sorted, and how often. ``held`` is emptied and sorted in place, as chunks are large."""
    flat = np.concatenate(held)
    held.clear()
    flat.sort()
    same = np.zeros(len(flat) + 1, dtype=np.int8)
    same[1:-1] = flat[1:] == flat[:-1]
    edge = np.diff(same)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return flat[first], last - first + 1


def frequent_columns(docs: DataFrame, text: str, size: int = SIZE, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and in how many texts they were counted.

    Each task counts chunks of about two million entries and reports what occurs twice or more in one. A passage that
    is rare in every chunk but common in the whole is met twice in some chunk or other and so becomes known too.
    """
    schema = T.StructType([T.StructField("s", T.LongType()), T.StructField("n", T.LongType())])
    target = pa.schema([("s", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            s, times = met_again(held)
            return pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(times)], schema=target)

        for batch in batches:
            for piece in X.slices(batch.column(0)):
                for found in X.shingle_sets(piece, size):
                    held.append(found)
                    n += len(found)
                    if n >= _CHUNK:
                        yield flush()
                        held, n = [], 0
        if held:
            yield flush()

    counted = docs.select(text).mapInArrow(count, schema).groupBy("s").agg(F.sum("n").alias("n"))
    table = counted.orderBy(F.desc("n"), "s").limit(most).toArrow()
    s = table.column("s").to_numpy().view(np.uint64)
    order = np.argsort(s)
    return s[order], table.column("n").to_numpy()[order]


def prefixes(docs: DataFrame, doc_id: str, text: str, size: int, percent: int, most: int = FREQUENT) -> DataFrame:
    """Per text: id, set size, class, the indexed part of its row in column order, and its sketch."""
    spark = docs.sparkSession
    frequent = shared(spark, frequent_columns(docs, text, size, most))
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("n", T.LongType()), T.StructField("node", T.LongType()), T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())])

    def index(batch: pa.RecordBatch) -> Iterator[dict]:
        known, times = frequent.value
        for piece in X.slices(batch.column(1)):
            sets = X.shingle_sets(piece, size)
            kept = []
            for found in sets:
                take = len(found) - -(-percent * len(found) // 100) + 1 if len(found) else 0
                if len(known) and len(found):
                    place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                    weight = np.where(known[place] == found, times[place], 0)
                    found = found[np.argsort(weight, kind="stable")]
                kept.append(found[:take])
            yield {
                "id": batch.column(0).slice(piece.first, piece.rows),
                "n": np.array([len(s) for s in sets], dtype=np.int64),
                "node": identities_of(sets),
                "prefix": X.list_array(kept, pa.int64()),
                "sketch": pa.array([sketch(found) for found in sets], pa.binary()),
            }

    return X.map_batches(docs.select(doc_id, text), index, schema)


def shared_columns(rows: DataFrame) -> DataFrame:
    """(s, node, n, pos) of the columns that two classes or more hold among their indexed entries.

    Tasks first tally the columns as sorted hashes of four bytes; a filter of fixed size keeps those met twice. What it lets
    pass beyond them is sorted out when the entries meet by column.
    """
    indexed = rows.where("n > 0").select("node", "n", "prefix")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, owner, n = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(2)
            held.append(lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            owner.append(np.repeat(batch.column(0).to_numpy(), np.diff(lists.offsets.to_numpy())))
            n += len(held[-1])
            if n >= _CHUNK // 2:
                yield tallied(np.concatenate(held), np.concatenate(owner))
                held, owner, n = [], [], 0
        if n:
            yield tallied(np.concatenate(held), np.concatenate(owner))

    table = shared(rows.sparkSession, repeated(indexed.mapInArrow(tally, TALLY), 1)[0])
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("n", T.LongType()), T.StructField("pos", T.LongType()), T.StructField("s", T.LongType())])

    def likely(batch: pa.RecordBatch) -> Iterator[dict]:
        lists = batch.column(2)
        s = lists.flatten().to_numpy(zero_copy_only=False)
        lengths = np.diff(lists.offsets.to_numpy())
        at = np.flatnonzero(passes(table.value, s.view(np.uint64)))
        row = np.repeat(np.arange(len(lengths)), lengths)[at]
        start = np.concatenate([[0], np.cumsum(lengths)])
        yield {"node": batch.column(0).take(pa.array(row)), "n": batch.column(1).take(pa.array(row)), "pos": at - start[row], "s": s[at]}

    some = store(X.map_batches(indexed, likely, schema).dropDuplicates(["s", "node"])).df
    held = some.groupBy("s").agg(F.count("*").alias("classes")).where("classes > 1").select("s")
    return some.join(held, "s", "left_semi")


def reachable(percent: int, na: Column, nb: Column, overlap: Column) -> Column:
    """Whether ``overlap`` common shingles are enough for a link."""
    return (100 + percent) * overlap >= percent * (na + nb)


def _possible(percent: int, a: str, b: str) -> Column:
    """Whether rows that first meet in this column can link, by their sizes and by what is left of either."""
    left = 1 + F.least(F.col(f"{a}n") - F.col(f"{a}pos") - 1, F.col(f"{b}n") - F.col(f"{b}pos") - 1)
    return reachable(percent, F.col(f"{a}n"), F.col(f"{b}n"), left)


RowsOf = Callable[[X.Slice], tuple[np.ndarray, list[np.ndarray]]]


def whole_rows(wanted: DataFrame, docs: DataFrame, text: str, rows_of: RowsOf) -> DataFrame:
    """(node, row) for every node of ``wanted``, its whole row made again from the texts."""
    bits = shared(docs.sparkSession, key_filter(wanted, "node"))
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("row", T.ArrayType(T.LongType()))])

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in X.slices(batch.column(0)):
            nodes, sets = rows_of(piece)
            first = np.unique(nodes, return_index=True)[1]
            keep = [i for i in first[may_hold(bits.value, nodes[first])] if len(sets[i])]
            yield {"node": nodes[keep], "row": X.list_array([sets[i] for i in keep], pa.int64())}

    return X.map_batches(docs.select(text), rows, schema).join(wanted, "node", "left_semi").dropDuplicates(["node"])


def exact_links(pairs: DataFrame, docs: DataFrame, text: str, rows_of: RowsOf, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by exact overlap of their whole rows, which ``rows_of`` makes again from the texts."""
    pairs = store(pairs).df
    wanted = store(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()).df

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
            lengths = [np.diff(batch.column(i).offsets.to_numpy()) for i in (2, 3)]
            ends = [np.cumsum(n) for n in lengths]
            hits = [
                overlap_reaches(left[ea - na : ea], right[eb - nb : eb], percent)
                for na, ea, nb, eb in zip(lengths[0], ends[0], lengths[1], ends[1], strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(hits, pa.bool_()))

    # One exchange of the rows by class serves both ends.
    whole = whole_rows(wanted, docs, text, rows_of)
    left = pairs.join(whole.select(F.col("node").alias("a"), F.col("row").alias("ra")), "a")
    both = left.join(whole.select(F.col("node").alias("b"), F.col("row").alias("rb")), "b")
    return both.select("a", "b", "ra", "rb").mapInArrow(linked, "a long, b long")


#: Columns of a row to a bucket of its sketch, at most.
PER_BUCKET = 4


def sketch(row: np.ndarray) -> bytes | None:
    """How many columns of a row each bucket holds, a byte each; as many buckets, a power of two, as keep them small whatever
    the row's length. None if a bucket holds more than a byte can say."""
    buckets = 1 << (-(-max(len(row), 1) // PER_BUCKET) - 1).bit_length()
    counts = np.bincount((row & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return None if counts.max() > 255 else counts.astype(np.uint8).tobytes()


def most_shared(a: np.ndarray, b: np.ndarray) -> int:
    """The most columns that two rows can share by their sketches: the smaller count of every bucket."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if len(b) > len(a):  # buckets are low bits, so those of the longer row fall together
        b = b.reshape(-1, len(a)).sum(axis=0, dtype=np.int64)
    return int(np.minimum(a, b).sum(dtype=np.int64))


def likely_links(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs whose overlap is not bounded below a link by what their rows hold in each bucket of columns.

    Two rows share at most the smaller of their counts in every bucket, so no pair that links is left out; most of the others go
    before a whole row is fetched for them, those of very long rows too, as these have more buckets.
    """
    pairs = store(pairs).df
    bits = shared(pairs.sparkSession, key_filter(store(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()).df, "node"))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(may_hold(bits.value, batch.column(0).to_numpy())))

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            left, right = batch.column(4), batch.column(5)
            hits = [
                x is None or y is None or (100 + percent) * most_shared(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) >= percent * n
                for x, y, n in zip(left.to_pylist(), right.to_pylist(), sizes.tolist(), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(hits, pa.bool_()))

    known = rows.select("node", "n", "sketch").mapInArrow(wanted, "node long, n long, sketch binary").dropDuplicates(["node"])
    sides = [known.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in ("a", "b")]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(possible, "a long, b long")


#: Blocks of columns that overlap is accumulated over.
BLOCKS = 4


def overlap_reaches(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two rows (sorted, as signed or unsigned values) link: their overlap is accumulated over blocks of
    columns, and the pair is given up once the columns left in either row cannot bring it to what their sizes ask."""
    if (100 + percent) * min(len(a), len(b)) < percent * (len(a) + len(b)):
        return False
    a, b = a.view(np.uint64), b.view(np.uint64)
    cuts = [np.uint64((1 << 64) // BLOCKS * i) for i in range(1, BLOCKS)]
    at = np.concatenate([[0], np.searchsorted(a, cuts), [len(a)]])
    bt = np.concatenate([[0], np.searchsorted(b, cuts), [len(b)]])
    met = 0
    for k in range(BLOCKS):
        met += len(np.intersect1d(a[at[k] : at[k + 1]], b[bt[k] : bt[k + 1]], assume_unique=True))
        left = min(len(a) - at[k + 1], len(b) - bt[k + 1])
        if (100 + percent) * (met + left) < percent * (len(a) + len(b)):
            return False
    return True


def text_rows(size: int) -> Callable[[X.Slice], tuple[np.ndarray, list[np.ndarray]]]:
    """The rows of whole texts, with their classes."""

    def rows(piece: X.Slice) -> tuple[np.ndarray, list[np.ndarray]]:
        sets = X.shingle_sets(piece, size)
        return identities_of(sets), sets

    return rows


def with_components(entries: DataFrame, labels: DataFrame) -> DataFrame:
    return entries.join(labels, "node", "left").select("s", "node", "n", "pos", F.coalesce("comp", "node").alias("comp"))


def pivot_pairs(entries: DataFrame, percent: int, turn: int = 0) -> DataFrame:
    """Candidate pairs of every row with the pivot of each of its columns, if that is in another component.

    The pivot is the row that most others meet over all its columns: the middle of a group of near copies. In later
    turns it is the least by a hash of that turn.
    """
    if turn:
        order = F.xxhash64("node", F.lit(turn))
    else:
        sizes = entries.groupBy("s").agg(F.count("*").alias("size"))
        weights = entries.join(sizes, "s").groupBy("node").agg(F.sum("size").alias("weight"))
        entries = store(entries.join(weights, "node")).df
        order = F.struct(-F.col("weight"), F.xxhash64("node"))
    pivots = entries.groupBy("s").agg(F.min_by(F.struct("node", "n", "pos", "comp"), order).alias("p"))
    pivots = pivots.select("s", *[F.col(f"p.{c}").alias(f"p{c}") for c in ("node", "n", "pos", "comp")])
    met = entries.join(pivots, "s").where((F.col("comp") != F.col("pcomp")) & _possible(percent, "", "p"))
    return met.select(F.least("node", "pnode").alias("a"), F.greatest("node", "pnode").alias("b")).distinct()


def mixed_columns(entries: DataFrame) -> DataFrame:
    """The entries of columns with two components or more, with the column's largest component as ``main``."""
    sizes = entries.groupBy("s", "comp").agg(F.count("*").alias("rows"))
    main = sizes.groupBy("s").agg(F.max_by("comp", F.struct("rows", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1")
    return store(entries.join(main.select("s", "main"), "s")).df


def cross_pairs(mixed: DataFrame, possible: Column) -> DataFrame:
    """Rows of two entries (x..., ...) of one column in different components, each pair once per column.

    They are taken between the entries outside the column's largest component and all others.
    """
    few = mixed.where("comp <> main").select("s", *[F.col(c).alias(f"x{c}") for c in mixed.columns if c not in ("s", "main")])
    met = few.join(mixed, "s").where(possible)
    return met.where((F.col("xcomp") != F.col("comp")) & ((F.col("comp") == F.col("main")) | (F.col("xnode") < F.col("node"))))


def _remaining_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of different components, by what is left of either row behind the first column they share."""
    return cross_pairs(mixed_columns(entries), _possible(percent, "x", "")).select(F.least("xnode", "node").alias("a"), F.greatest("xnode", "node").alias("b")).distinct()


def components_by_pivots(
    entries: DataFrame, percent: int, exact: Callable[[DataFrame], DataFrame], remaining: Callable[[DataFrame, int], DataFrame] = _remaining_pairs
) -> DataFrame:
    """(node, comp) of the rows of ``entries`` (s, node, n, pos) that link; ``exact`` keeps the pairs that do.

    ``PIVOT_TURNS`` turns of pivots first, then the pairs still in different components, as ``remaining`` gives them.
    """
    labels = entries.select("node", F.col("node").alias("comp")).limit(0)
    tried = links = None
    for turn in range(PIVOT_TURNS + 1):
        labelled = with_components(entries, labels)
        pairs = pivot_pairs(labelled, percent, turn) if turn < PIVOT_TURNS else remaining(labelled, percent)
        pairs = store(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")).df
        if pairs.isEmpty():
            if turn < PIVOT_TURNS:
                continue
            return labels
        fresh = store(exact(pairs)).df
        tried = pairs if tried is None else tried.union(pairs)
        links = fresh if links is None else links.union(fresh)
        labels = components(links)
    return labels


def linked_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT, frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): id, set size and class of every text; class and component of every class with a link."""
    rows = store(prefixes(docs, doc_id, text, size, percent, frequent)).df
    entries = store(shared_columns(rows)).df
    labels = components_by_pivots(entries, percent, lambda pairs: exact_links(likely_links(pairs, rows, percent), docs, text, text_rows(size), percent))
    return rows.select("id", "n", "node"), labels


def similarity_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """One row per text: doc_id, n_shingles, component_id (least id reachable by links, its own without links)."""
    rows, labels = linked_classes(docs, doc_id, text, size, percent, frequent)
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("least"))
    labelled = store(nodes.join(labels, "node", "left").select("node", "least", F.coalesce("comp", "node").alias("comp"))).df
    lowest = labelled.groupBy("comp").agg(F.min("least").alias("lowest"))
    named = store(labelled.join(lowest, "comp").select(F.col("node").alias("class"), "lowest")).df
    out = rows.join(named, (rows["node"] == named["class"]) & (rows["n"] > 0), "left")
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.coalesce("lowest", "id").alias("component_id"))
