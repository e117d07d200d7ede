"""Removal of every 50-byte string that also starts in an earlier document, by a distributed merge sort of suffixes.

``WIDTH`` consecutive bytes of a text are a window. Not all suffixes are sorted, but sampled ones: of the ``GRAM``-byte strings in a
window the one with the least hash (the first of equals) is the window's anchor. Equal windows have their anchors at the same
place, so what matters is the suffix at an anchor with the bytes before it: the key of an anchor is its next ``WIDTH`` bytes and
then the ``LEFT`` bytes before it, backwards. Two windows that begin j bytes before their anchors are equal just if the keys agree
in the first WIDTH - j bytes and in the first j bytes behind WIDTH.

1. *Whole copies.* A document whose text an earlier one has is removed whole; it takes no part in the rest, where it could
   not change anything.
2. *What can repeat.* Tasks count in how many texts the string at each anchor occurs, as sorted 44-bit hashes per part; parts are
   added up one by one. Strings of two texts or more set a bit in a filter of fixed size (32 MB). An anchor without its bit
   cannot lie in a repeated window. A full filter lets everything pass and loses nothing.
3. *Runs.* Tasks make the keys of the anchors left, sort them, keep equal ones once with the least and the largest document, and
   write them as front-coded runs, cut by range into parts. The places behind every key stay with the run.
4. *Merge.* A part's runs are merged by a loser tree that never compares a known prefix again (``suffix_runs``). Keys in order
   with their common prefixes give the classes of equal windows for every j and so the least document of each.
5. *Answers* go back to the run, one entry per key and not per place, and the run's places become removed spans of documents.

A string that more than a sixteenth of its part's count has (at least ``HEAVY``) could fill a task with different keys of one
anchor. Its windows are sorted one by one instead, as keys without left bytes, where only equal keys have to meet; those are
one entry per run, however many documents hold them. There are at most 16 such strings a part, so their list is bounded.

Defined results: a null text is empty; texts below ``WIDTH`` bytes keep everything; a null id comes behind all others; documents
of one id (repeated rows too) and those without id take nothing from each other; an empty table gives no rows. Memory follows the
longest text, at about 60 bytes for each of its bytes. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.llm import suffix_runs as R
from tallywind.llm import text as X
from tallywind.llm.components import key_filter, may_hold, shared
from tallywind.storage import store

WIDTH = 50
GRAM = 24
LEFT = WIDTH - GRAM
#: Parts that hashes are counted in, by their first bits; each sets 2**16 bits of the filter.
PART_BITS = 12
HEAVY = 4096
#: Anchors counted, and keys sorted, at once in a task.
_COUNTED = 1 << 20
RUN_KEYS = 1 << 18
#: Keys worked on at once in a merge, but for a longer group.
_CHUNK = 1 << 16
#: Strings that a slice of text gives to the sample for cutting parts; the sample's parts, and strings kept of each.
_SAMPLE, _SAMPLES, _SAMPLE_OF_PART = 64, 64, 256
_NONE = (1 << 63) - 1
_PAD = 0xFF  # in no UTF-8 text

_EMPTY = hashlib.sha256().hexdigest()

U64 = np.uint64


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes at every place."""
    forth, back = X._power(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(X._LETTER[data] * forth[: len(data)], out=sums[1:])
    return X.mix((sums[size:] - sums[:-size]) * back[: len(data) - size + 1])


class Anchors:
    """Anchors of the windows of a slice: place, row, hash of the string there, and the first and last window of each."""

    def __init__(self, piece: X.Slice, width: int = WIDTH, gram: int = GRAM):
        data, offsets = piece.data, piece.offsets
        none = np.zeros(0, dtype=np.int64)
        self.at = self.row = self.first = self.last = none
        self.hash = none.astype(U64)
        if len(data) < width:
            return
        h = grams(data, gram)
        # The least of 32 bits of hash, the first of equals, as one number.
        least = (h & U64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=U64)
        reach, span = 1, width - gram + 1
        while reach < span:
            step = min(reach, span - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        # Windows that end in their own row.
        edges = np.zeros(len(least) + 1, dtype=np.int32)
        long = np.flatnonzero(np.diff(offsets) >= width)
        np.add.at(edges, offsets[long], 1)
        np.add.at(edges, offsets[long + 1] - width + 1, -1)
        window = np.flatnonzero(np.cumsum(edges[:-1]))
        if not len(window):
            return
        at = (least[window] & U64(0xFFFFFFFF)).astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        self.at, self.first = at[heads], window[heads]
        self.last = window[np.concatenate([heads[1:], [len(window)]]) - 1]
        self.row = np.searchsorted(offsets, self.at, side="right") - 1
        self.hash = h[self.at]


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Consecutive stretches of an array as a binary column."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


TALLY = "part int, once binary, often binary, counts binary"
_TALLY = pa.schema([("part", pa.int32()), ("once", pa.binary()), ("often", pa.binary()), ("counts", pa.binary())])


def tallied(h: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
    """(part, once, often, counts): 64-bit hashes as 44 bits by part, those of one owner and those of more with their number."""
    order = np.lexsort((owner, h))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h = h[new]
    heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    n = np.diff(np.append(heads, len(h))).astype(np.uint32)
    h = h[heads]
    part = (h >> U64(64 - PART_BITS)).astype(np.int64)
    low = ((h >> U64(32 - PART_BITS)) & U64(0xFFFFFFFF)).astype(np.uint32)
    known = np.unique(part)
    single = n == 1
    bounds = [np.append(np.searchsorted(part[m], known), m.sum()) for m in (single, ~single)]
    columns = [pa.array(known, pa.int32()), _binaries(low[single], bounds[0]), _binaries(low[~single], bounds[1]), _binaries(n[~single], bounds[1])]
    return pa.RecordBatch.from_arrays(columns, schema=_TALLY)


def passes(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the filter of ``repeated`` has a bit for each hash."""
    word, bit = h >> U64(64 - PART_BITS - 16 + 6), (h >> U64(64 - PART_BITS - 16)) & U64(63)
    return (table[word.astype(np.int64)] >> bit) & U64(1) == 1


def occurrences(docs: Firsts) -> DataFrame:
    """``tallied`` hashes of anchors, owned by texts; and, in parts below 0, a sample of the strings themselves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rows, held, first = [], [], 0, 0
        for batch in batches:
            for piece in X.slices(batch.column(2)):
                found = Anchors(piece)
                if len(found.at):
                    chosen = found.at[np.argsort(found.hash)[:_SAMPLE]]
                    sample = piece.data[chosen[:, None] + np.arange(GRAM)]
                    to = -1 - int(found.hash[0] % U64(_SAMPLES))
                    yield pa.RecordBatch.from_arrays([pa.array([to], pa.int32()), *[pa.array([b]) for b in (sample.tobytes(), b"", b"")]], schema=_TALLY)
                hashes.append(found.hash)
                rows.append(found.row + first)
                held, first = held + len(found.at), first + piece.rows
                if held >= _COUNTED:
                    yield tallied(np.concatenate(hashes), np.concatenate(rows))
                    hashes, rows, held = [], [], 0
        if held:
            yield tallied(np.concatenate(hashes), np.concatenate(rows))

    return docs.map(count, TALLY)


def _by(rows: DataFrame, key: str, *then: str) -> DataFrame:
    """Rows of one key in one task, one key after the other."""
    return rows.repartition(key).sortWithinPartitions(key, *then)


def repeated(counted: DataFrame, parts: int, heavy: int = HEAVY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(filter, heavy hashes, splitters): a bit per 28-bit hash of a string in two texts or more; the strings, as 44-bit hashes,
    that are most frequent; and where the order of all strings is cut into ``parts``, by a bounded sample.

    A row per part of at most 8 KB reaches the driver."""

    def settle(once: list[bytes], often: list[bytes], counts: list[bytes]) -> tuple[bytes, bytes]:
        h = np.concatenate([np.frombuffer(b"".join(once), dtype=np.uint32), np.frombuffer(b"".join(often), dtype=np.uint32)])
        n = np.concatenate([np.ones(len(h) - sum(map(len, often)) // 4, dtype=np.int64), np.frombuffer(b"".join(counts), dtype=np.uint32)])
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        times = np.add.reduceat(n, heads)
        h = h[heads]
        bits = np.zeros(1 << 16, dtype=bool)
        bits[h[times >= 2] >> np.uint32(16)] = True
        return np.packbits(bits, bitorder="little").tobytes(), h[times >= max(heavy, times.sum() // 16)].tobytes()

    def thinned(samples: list[bytes]) -> list[bytes]:
        """A fixed number of strings, those of least digest."""
        each = {s[i : i + GRAM] for s in samples for i in range(0, len(s), GRAM)}
        return [b"".join(sorted(each, key=lambda s: hashlib.md5(s).digest())[:_SAMPLE_OF_PART])]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [])

        def out():
            bits, most = settle(*held) if now >= 0 else (thinned(held[0])[0], b"")
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([bits]), pa.array([most])], names=["part", "bits", "heavy"])

        for batch in batches:
            for part, *bodies in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if part != now and held[0]:
                    yield out()
                    held = ([], [], [])
                now = part
                if now < 0 and len(held[0]) >= _SAMPLES:
                    held = (thinned(held[0]), [], [])
                for one, body in zip(held, bodies, strict=True):
                    one.append(body)
        if held[0]:
            yield out()

    table = np.zeros(1 << (PART_BITS + 16 - 6), dtype=U64)
    per = len(table) >> PART_BITS
    most, sample = [np.zeros(0, dtype=U64)], []
    for r in _by(counted, "part").mapInArrow(add, "part int, bits binary, heavy binary").toArrow().to_pylist():
        if r["part"] < 0:
            sample += [r["bits"][i : i + GRAM] for i in range(0, len(r["bits"]), GRAM)]
            continue
        table[r["part"] * per : (r["part"] + 1) * per] = np.frombuffer(r["bits"], dtype=U64)
        most.append((U64(r["part"]) << U64(32)) | np.frombuffer(r["heavy"], dtype=np.uint32).astype(U64))
    strings = np.array(sorted(sample), dtype=f"S{GRAM}")
    cuts = np.unique(strings[(np.arange(1, parts) * len(strings)) // parts]) if len(strings) else strings
    return table, np.sort(np.concatenate(most)), cuts


class Keys:
    """Keys of a run with the places behind them: row of the run, place in the text, and least and largest j."""

    def __init__(self, left: int):
        self.left = left
        self.held: list[tuple[np.ndarray, ...]] = []

    def add(self, piece: X.Slice, at: np.ndarray, row: np.ndarray, low: np.ndarray, high: np.ndarray, first: int) -> int:
        """Keys hold what the anchor's own windows hold; equal windows have one anchor, so no other byte is ever asked for."""
        behind = np.arange(WIDTH)
        right = np.where(behind < WIDTH - low[:, None], piece.data[np.minimum(at[:, None] + behind, len(piece.data) - 1)], _PAD)
        before = np.arange(1, self.left + 1)
        left = np.where(before <= high[:, None], piece.data[np.maximum(at[:, None] - before, 0)], _PAD)
        keys = np.concatenate([right, left], axis=1).astype(np.uint8)
        self.held.append((keys, row + first, at - piece.offsets[row], low, high))
        return len(at)

    def bodies(self, order: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        """(part, front-coded keys with the least and largest document of each, places of each) of the run."""
        if not self.held:
            return
        keys, row, at, low, high = (np.concatenate(p) for p in zip(*self.held, strict=True))
        if not len(keys):
            return
        by, new = R.sort_keys(keys)
        heads = np.append(np.flatnonzero(new), len(by))
        distinct = keys[by[heads[:-1]]]
        row, at, low, high = row[by], at[by], low[by], high[by]
        doc = order[row]
        least, most = np.minimum.reduceat(doc, heads[:-1]), np.maximum.reduceat(doc, heads[:-1])
        starts = np.ascontiguousarray(distinct[:, :GRAM]).view(f"S{GRAM}").ravel()
        bounds = np.concatenate([[0], np.searchsorted(starts, cuts), [len(distinct)]])
        for part, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if a < b:
                known, rest = R.front_coded(distinct[a:b])
                of = slice(heads[a], heads[b])
                places = np.diff(heads[a : b + 1]).astype(np.uint32), row[of].astype(np.uint32), at[of].astype(np.uint32), low[of].astype(np.uint8), high[of].astype(np.uint8)
                yield part, R.packed(known, rest, least[a:b], most[a:b] - least[a:b]), R.packed(*places)


#: Kinds of rows: documents of a run, places of a part's keys, front-coded keys, answers to them.
DOCS, PLACES, RUN, ANSWERS = range(4)
_ROWS = "run long, kind int, part int, body binary"
_NAMES = ["run", "kind", "part", "body"]


def runs(docs: Firsts, known, run_keys: int = RUN_KEYS) -> DataFrame:
    """The sorted runs of (id, key, text). Parts 0, 1, ... hold keys of anchors, parts -2, -3, ... single windows."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, heavy, cuts = known.value
        number = TaskContext.get().partitionId() << 32

        def out():
            ids, hashes = (np.concatenate(c) for c in zip(*rows, strict=True))
            found = [(DOCS, -1, R.packed(ids, hashes))]
            for keys, place in ((anchors, lambda p: p), (windows, lambda p: -2 - p)):
                for part, run, places in keys.bodies(ids, cuts):
                    found += [(RUN, place(part), run), (PLACES, place(part), places)]
            if len(found) > 1:
                for kind, part, body in found:
                    yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([body])], names=_NAMES)

        rows, anchors, windows, held, first = [], Keys(LEFT), Keys(0), 0, 0
        for batch in batches:
            for piece in X.slices(batch.column(2)):
                of = slice(piece.first, piece.first + piece.rows)
                rows.append(tuple(batch.column(i).to_numpy()[of] for i in (0, 1)))
                found = Anchors(piece)
                may = passes(table, found.hash)
                short = found.hash >> U64(32 - PART_BITS)
                often = may & np.isin(short, heavy) if len(heavy) else np.zeros(len(may), dtype=bool)
                one = np.flatnonzero(may & ~often)
                at, row = found.at[one], found.row[one]
                held += anchors.add(piece, at, row, at - found.last[one], at - found.first[one], first)
                many = np.flatnonzero(often)
                counts = found.last[many] - found.first[many] + 1
                at = np.repeat(found.first[many], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                none = np.zeros(len(at), dtype=np.int64)
                held += windows.add(piece, at, np.repeat(found.row[many], counts), none, none, first)
                first += piece.rows
                if held >= run_keys:
                    yield from out()
                    rows, anchors, windows, held, first, number = [], Keys(LEFT), Keys(0), 0, 0, number + 1
        if held:
            yield from out()

    return docs.map(make, _ROWS)


def _classes(before: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return np.unique(before * 256 + byte, return_inverse=True)[1]


def least_documents(known: np.ndarray, keys: np.ndarray, doc: np.ndarray, left: int, group: int) -> np.ndarray:
    """For distinct sorted keys (common prefixes, bytes, least document) the least document that has the window beginning j
    bytes before the anchor, one column per j."""
    n = len(keys)
    out = np.repeat(doc[:, None], left + 1, axis=1)
    starts = np.flatnonzero(known < group)
    sizes = np.diff(np.append(starts, n))
    at = np.flatnonzero(np.repeat(sizes > 1, sizes))
    if not len(at):
        return out
    same, bytes_, doc = known[at], keys[at], doc[at]
    before = np.zeros(len(at), dtype=np.int64)
    for j in range(left + 1):
        if j:
            before = _classes(before, bytes_[:, WIDTH + j - 1])
        ahead = np.cumsum(same < WIDTH - j)
        both = ahead * (int(before.max()) + 1) + before
        order = np.argsort(both, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], np.diff(both[order]) != 0]))
        least = np.minimum.reduceat(doc[order], heads)
        out[at[order], j] = np.repeat(least, np.diff(np.append(heads, len(order))))
    return out


class Merge:
    """The merge of one part: what its runs have to be told."""

    def __init__(self, part: int, bodies: dict[int, bytes]):
        self.left, self.group = (LEFT, GRAM) if part >= 0 else (0, WIDTH)
        self.width = WIDTH + self.left
        self.names = list(bodies)
        opened = [R.unpacked(bodies[r], "u1", "u1", "i8", "i8") for r in self.names]
        self.runs = [(known, rest.tobytes()) for known, rest, _, _ in opened]
        self.least = [o[2] for o in opened]
        self.most = [o[2] + o[3] for o in opened]
        self.told: list[list[np.ndarray]] = []

    def answers(self) -> Iterator[tuple[int, bytes]]:
        """(run, packed (place of the key, first j, last j, least document)) where that document is before a place's own."""
        held: list[tuple[int, int, int, bytes]] = []
        for entry in R.merged(self.runs, self.width):
            if len(held) >= _CHUNK and entry[0] < self.group:
                self._settle(held)
                held = []
            held.append(entry)
        if held:
            self._settle(held)
        if not self.told:
            return
        run, *found = (np.concatenate(c) for c in zip(*self.told, strict=True))
        order = np.argsort(run, kind="stable")
        run = run[order]
        for r in np.unique(run):
            a, b = np.searchsorted(run, [r, r + 1])
            place, first, last, doc = (c[order[a:b]] for c in found)
            yield self.names[r], R.packed(place.astype(np.uint32), first.astype(np.uint8), last.astype(np.uint8), doc)

    def _settle(self, held: list[tuple[int, int, int, bytes]]) -> None:
        known, run, place, keys = zip(*held, strict=True)
        known, run, place = (np.array(c, dtype=np.int64) for c in (known, run, place))
        known[0] = 0
        bounds = np.concatenate([[0], np.cumsum([len(c) for c in self.least])])
        of = bounds[run] + place
        least, most = np.concatenate(self.least)[of], np.concatenate(self.most)[of]
        heads = np.flatnonzero(known < self.width)
        distinct = np.frombuffer(b"".join([keys[i] for i in heads.tolist()]), dtype=np.uint8).reshape(len(heads), self.width)
        docs = least_documents(known[heads], distinct, np.minimum.reduceat(least, heads), self.left, self.group)
        # Stretches of j with one answer, for the keys that a later document of some run has.
        key = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(held))))
        later = np.flatnonzero(docs.min(axis=1)[key] < most)
        mine = docs[key[later]]
        turn = np.ones(mine.shape, dtype=bool)
        turn[:, 1:] = mine[:, 1:] != mine[:, :-1]
        entry, first = np.nonzero(turn)
        last = np.append(first[1:], 0) - 1
        last = np.where(last < 0, self.left, last)
        doc = mine[entry, first]
        told = doc < most[later[entry]]
        entry, first, last, doc = entry[told], first[told], last[told], doc[told]
        self.told.append([run[later[entry]], place[later[entry]], first, last, doc])


def merge_parts(made: DataFrame) -> DataFrame:
    """The answers to all runs, part by part, and the runs' documents and places as they are.

    Keys are shuffled to their parts and never written; what has to come back together is.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bodies = None, {}

        def out():
            for run, body in Merge(now, bodies).answers():
                yield pa.RecordBatch.from_arrays([pa.array([run]), pa.array([ANSWERS], pa.int32()), pa.array([now], pa.int32()), pa.array([body])], names=_NAMES)

        for batch in batches:
            keys = batch.column("kind").to_numpy() == RUN
            yield batch.filter(pa.array(~keys))
            mine = batch.filter(pa.array(keys))
            for run, part, body in zip(*[mine.column(c).to_pylist() for c in ("run", "part", "body")], strict=True):
                if part != now:
                    if bodies:
                        yield from out()
                    now, bodies = part, {}
                bodies[run] = body
        if bodies:
            yield from out()

    to = F.when(F.col("kind") == RUN, F.col("part").cast("long")).otherwise(F.xxhash64("run", "part"))
    return _by(made.withColumn("to", to), "to", "part", "run").select(*_NAMES).mapInArrow(merge, _ROWS)


def spans_of(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of documents, those that meet or touch as one: (document, start, end) in order."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    # Documents far apart on one line, so that a running maximum does not carry over.
    step = int(end.max()) + 1
    reach = np.maximum.accumulate(doc * step + end)
    opens = np.concatenate([[True], (doc * step + start)[1:] > reach[:-1]])
    heads = np.flatnonzero(opens)
    return doc[heads], start[heads], np.maximum.reduceat(end, heads)


def told_spans(places: bytes, answers: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the bytes that the answers to a part remove from the run's documents."""
    sizes, row, at, low, high = R.unpacked(places, "u4", "u4", "u4", "u1", "u1")
    key, first, last, doc = R.unpacked(answers, "u4", "u1", "u1", "i8")
    behind = np.cumsum(sizes, dtype=np.int64)
    counts = sizes[key].astype(np.int64)
    entry = np.repeat(np.arange(len(key)), counts)
    of = np.arange(len(entry)) - np.repeat(np.cumsum(counts) - counts, counts) + (behind - sizes)[key[entry]]
    near, far = np.maximum(low[of], first[entry]).astype(np.int64), np.minimum(high[of], last[entry]).astype(np.int64)
    take = (near <= far) & (ids[row[of]] > doc[entry])
    of, near, far = of[take], near[take], far[take]
    at = at[of].astype(np.int64)
    return spans_of(row[of].astype(np.int64), at - far, at - near + WIDTH)


def removed_spans(told: DataFrame) -> DataFrame:
    """(id, key, starts, ends) of the documents from which anything is removed."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("id", "key")] + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("starts", "ends")])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = ids = hashes = places = None
        found: list[tuple[np.ndarray, ...]] = []

        def out():
            row, start, end = spans_of(*[np.concatenate(c) for c in zip(*found, strict=True)])
            known, heads = np.unique(row, return_index=True)
            bounds = pa.array(np.append(heads, len(row)), pa.int32())
            columns = [pa.array(ids[known]), pa.array(hashes[known]), *[pa.ListArray.from_arrays(bounds, pa.array(c)) for c in (start, end)]]
            return pa.RecordBatch.from_arrays(columns, names=["id", "key", "starts", "ends"])

        for batch in batches:
            for run, kind, body in zip(*[batch.column(c).to_pylist() for c in ("run", "kind", "body")], strict=True):
                if run != now:
                    if found:
                        yield out()
                    now, found = run, []
                if kind == DOCS:
                    ids, hashes = R.unpacked(body, "i8", "i8")
                elif kind == PLACES:
                    places = body
                else:
                    found.append(told_spans(places, body, ids))
        if found:
            yield out()

    return _by(told.withColumn("behind", F.col("kind") != DOCS), "run", "behind", "part", "kind").select(*_NAMES).mapInArrow(apply, schema)


def kept_bytes(data: bytes, starts, ends) -> tuple[int, str]:
    """(bytes removed, SHA-256 of those left)."""
    left, at, removed = hashlib.sha256(), 0, 0
    for a, b in zip(starts, ends, strict=True):
        left.update(data[at:a])
        at, removed = b, removed + b - a
    left.update(data[at:])
    return removed, left.hexdigest()


@dataclass
class Firsts:
    """Documents (id, key, text, sure) less those that are not ``sure`` and whose key is in the filter.

    Whoever reads the texts applies the filter, so that no task has two Python workers.
    """

    rows: DataFrame
    copies: Broadcast

    def map(self, make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        bits = self.copies

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def first(batch: pa.RecordBatch) -> pa.RecordBatch:
                keep = batch.column(3).to_numpy(zero_copy_only=False) | ~may_hold(bits.value, batch.column(1).to_numpy())
                return batch if keep.all() else batch.filter(pa.array(keep))

            return make(first(batch) for batch in batches if batch.num_rows)

        return self.rows.mapInArrow(run, schema)


def without_copies(rows: DataFrame) -> tuple[Firsts, DataFrame]:
    """(The documents but for those whose whole text an earlier document has; those, by order and hash.)

    Copies are known by SHA-256, so the search for them moves digests and no text. A filter of fixed size tells in which
    documents to look; what it takes for a copy and is none comes back by a join, which alone moves text.
    """
    each = rows.select("id", "key", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    first = each.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("sha", "first")
    copies = store(each.join(first, "sha").where("id > first").select("id", "key").distinct()).df
    bits = shared(rows.sparkSession, key_filter(copies, "key"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(may_hold(bits.value, batch.column(1).to_numpy())))

    texts = rows.select("id", "key", "text")
    back = store(texts.mapInArrow(take, texts.schema).join(copies, ["id", "key"], "left_anti")).df
    return Firsts(texts.withColumn("sure", F.lit(False)).union(back.withColumn("sure", F.lit(True))), bits), copies


def repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run_keys: int = RUN_KEYS, heavy: int = HEAVY, parts: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents by order, hash of the text, text and id as given; the removed byte spans (starts, ends) by order and hash of those
    without an earlier whole copy; the others by order and hash)."""
    spark = docs.sparkSession
    key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NONE)).alias("id"), key.alias("key"), F.col(text).alias("text"), F.col(doc_id).alias("own"))
    firsts, copies = without_copies(rows)
    known = shared(spark, repeated(occurrences(firsts), parts or int(spark.conf.get("spark.sql.shuffle.partitions")), heavy))
    spans = store(removed_spans(merge_parts(runs(firsts, known, run_keys))).dropDuplicates(["id", "key"])).df
    return rows, spans, copies


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, spans, copies = repeats(docs, doc_id, text, **options)
    bits = shared(docs.sparkSession, key_filter(spans, "key"))
    kind = T.StructType([f for f in rows.schema if f.name != "text"] + [T.StructField("body", T.BinaryType()), T.StructField("n_bytes", T.LongType()), T.StructField("sha", T.StringType())])

    def settle(batch: pa.RecordBatch) -> Iterator[dict]:
        """Texts that lose nothing are done here; the others go on compressed."""
        open_ = may_hold(bits.value, batch.column("key").to_numpy()).tolist()
        raw = [(t or "").encode() for t in batch.column("text").to_pylist()]
        yield {c: batch.column(c) for c in ("id", "key", "own")} | {
            "body": pa.array([R.packed(np.frombuffer(b, dtype=np.uint8)) if o else None for b, o in zip(raw, open_, strict=True)], pa.binary()),
            "n_bytes": np.array([len(b) for b in raw], dtype=np.int64),
            "sha": pa.array([hashlib.sha256(b).hexdigest() for b in raw], pa.string()),
        }

    whole = copies.withColumn("whole", F.lit(True))
    joined = X.map_batches(rows, settle, kind).join(spans, ["id", "key"], "left").join(whole, ["id", "key"], "left")
    out = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType)] + [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType())])

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        done = []
        for body, sha, starts, ends, whole, n in zip(*[batch.column(c).to_pylist() for c in ("body", "sha", "starts", "ends", "whole", "n_bytes")], strict=True):
            if whole and n >= WIDTH:
                done.append((n, 1, _EMPTY))
            elif starts and not whole:
                removed, sha = kept_bytes(R.unpacked(body, "u1")[0].tobytes(), starts, ends)
                done.append((removed, len(starts), sha))
            else:
                done.append((0, 0, sha))
        removed, spans_, sha = zip(*done, strict=True)
        yield {
            doc_id: batch.column("own"),
            "n_bytes": batch.column("n_bytes"),
            "n_removed": np.array(removed, dtype=np.int64),
            "n_spans": np.array(spans_, dtype=np.int64),
            "kept_sha256": pa.array(sha, pa.string()),
        }

    return X.map_batches(joined.select("own", "body", "sha", "starts", "ends", "whole", "n_bytes"), cut, out)
