"""Benchmark decontamination by templates.

Words lose punctuation and case. Numbers, units behind numbers, and names (capitalised words inside a sentence) become
typed placeholders whose values are kept as slots; what is left is a template. Windows of ``WINDOW`` template words
are hashed and joined between texts and benchmark items, so a question with other numbers and names still meets. A
match counts if the slots agree: each value of the item must stand for one value of the text wherever the windows met.

Windows are made in four ways, which meet only their own kind. ``EACH`` has a placeholder for every name, number and unit.
``RUNS`` has one placeholder for a run of names or of numbers, number words among them, whose slot value is the whole
run, so "Alice" meets "Mary Ann Lee" and "12" meets "twenty five". Names are known by their capitals, which a copy in
capitals or small letters does not have: ``NUMBERS`` is ``RUNS`` with names left as words, ``WORDS`` has no placeholders.
Case is folded for all letters.

A text holds an item if in one of the ways at least half of the item's windows, or ``RUN`` of them, are met and at least
half of the item's slot values are consistent; the first such way gives the counts. Windows with fewer than three plain
words (in ``WORDS``: words that are no numbers) say too little and are not used.

The windows of the benchmark reach the texts' side as a filter of fixed size; matches are then joined by hash.

Defined results: null and empty texts hold nothing; items shorter than a window are not sought; items that say the same
count as one, named by the least item id; equal texts give one row per row; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.llm import text as X
from tallywind.llm.components import key_filter, may_hold, shared
from tallywind.storage import store

WINDOW = 8
PLAIN_WORDS = 3
SHARE_PERCENT = 50
RUN = 24

# Words read as units when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers mg g kg lb lbs oz gram grams "
    "kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons cup cups second seconds minute minutes "
    "hour hours day days week weeks month months year years dollar dollars cent cents euro euros percent degree degrees watt watts volt volts mph kmh"
).split()

# Words read as numbers in runs, with "twentyone" to "ninetynine" as hyphens are dropped.
ONES = "one two three four five six seven eight nine".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
TEENS = "zero ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen hundred thousand million billion trillion dozen".split()
NUMBER_WORDS = ONES + TENS + TEENS + [t + o for t in TENS for o in ONES]

PLAIN, NUMBER, UNIT, NAME = range(4)
EACH, RUNS, NUMBERS, WORDS = range(4)

_CORE = X.table_of(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_DIGIT = X.table_of(b"0123456789")
_STOP = X.table_of(b".!?:")
# All letters with case lie below this code point.
_CASED = 0x1E944
_CAPITAL = np.array([chr(c).isupper() or chr(c).istitle() for c in range(_CASED)])
_SMALL = np.array([chr(c).islower() for c in range(_CASED)])


def _word_hashes(known: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(known).encode(), dtype=np.uint8)
    ends = np.cumsum([len(u) for u in known])
    spans = X.Spans(np.concatenate([[0], ends[:-1]]), ends, np.array([0, len(known)]))
    return np.sort(X.span_hashes(data, spans, fold=True))


def letters(data: np.ndarray) -> np.ndarray:
    """The code point that starts at each byte; 0 at bytes inside a letter, and for all points without case beyond the last with it."""
    point = np.where(data < 128, data, 0).astype(np.int64)
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        byte = [data[np.minimum(lead + i, len(data) - 1)].astype(np.int64) for i in range(4)]
        rest = [b & 0x3F for b in byte]
        two, three = (byte[0] & 0x1F) << 6 | rest[1], (byte[0] & 0x0F) << 12 | rest[1] << 6 | rest[2]
        four = (byte[0] & 0x07) << 18 | rest[1] << 12 | rest[2] << 6 | rest[3]
        found = np.where(byte[0] < 0xE0, two, np.where(byte[0] < 0xF0, three, four))
        point[lead] = np.where(found < _CASED, found, 0)
    return point


def folded(piece: X.Slice) -> X.Slice:
    """The slice with the case of all letters folded: the same words in the same order, maybe of other lengths."""
    if not len(piece.data) or piece.data.max() < 128:
        return piece
    rows = []
    for r in range(piece.rows):
        raw = piece.data[piece.offsets[r] : piece.offsets[r + 1]].tobytes()
        rows.append(raw if raw.isascii() else raw.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape"))
    return X.Slice(piece.first, np.frombuffer(b"".join(rows), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in rows])]))


class Templates:
    """Template words of a slice: their hashes, kinds, slot values and bounds per row."""

    def __init__(self, piece: X.Slice):
        data = piece.data
        found = X.words(piece)
        plain = folded(piece)
        same = X.words(plain)
        kept = np.concatenate([[0], np.cumsum(_CORE[plain.data])])
        core = X.Spans(kept[same.start], kept[same.end], same.bounds)
        value = X.span_hashes(plain.data[_CORE[plain.data]], core, fold=True)
        has = lambda table: _counts(table[data], found) > 0
        spoken = core.end > core.start
        number = has(_DIGIT)
        point = letters(data)
        first = _CAPITAL[point[found.start]]
        starts = np.zeros(len(found.start), dtype=bool)
        starts[found.bounds[:-1][found.counts > 0]] = True
        joined = np.zeros(len(found.start), dtype=bool)  # nothing but a space stands before the word
        if len(found.start):
            starts[1:] |= _STOP[data[found.end - 1]][:-1]
            broken = np.concatenate([[0], np.cumsum(data == 10)])
            starts[1:] |= broken[found.start[1:]] > broken[found.end[:-1]]
            joined[1:] = _CORE[data[found.end - 1]][:-1] & _CORE[data[found.start]][1:]
            joined[found.bounds[:-1][found.counts > 0]] = False
        name = first & ~starts & (_counts(_SMALL[point], found) > 0) & ~number
        self.value = value[spoken]
        self.joined = joined[spoken]
        self.bounds = np.concatenate([[0], np.cumsum(spoken)])[found.bounds]
        self.number, self.name = number[spoken], name[spoken]

    def _kinds(self, number: np.ndarray, name: np.ndarray) -> np.ndarray:
        kind = np.where(number, NUMBER, np.where(name, NAME, PLAIN))
        after_number = np.zeros(len(kind), dtype=bool)
        after_number[1:] = kind[:-1] == NUMBER
        after_number[self.bounds[:-1][np.diff(self.bounds) > 0]] = False
        kind[after_number & (kind != NUMBER) & np.isin(self.value, _UNIT_HASHES)] = UNIT
        return kind

    def way(self, way: int) -> Template:
        """The template words in one of the ways."""
        nothing = np.zeros(len(self.value), dtype=bool)
        if way == WORDS:
            return Template(np.full(len(self.value), PLAIN), self.value, self.bounds, way, ~self.number)
        if way == EACH:
            kind = self._kinds(self.number, self.name)
            return Template(kind, self.value, self.bounds, way, kind == PLAIN)
        number = self.number | np.isin(self.value, _NUMBER_HASHES)
        kind = self._kinds(number, self.name & ~number if way == RUNS else nothing)
        goes_on = np.zeros(len(kind), dtype=bool)
        goes_on[1:] = (kind[1:] == kind[:-1]) & ((kind[1:] == NUMBER) | (kind[1:] == NAME)) & self.joined[1:]
        heads = np.flatnonzero(~goes_on)
        lengths = np.diff(np.append(heads, len(kind)))
        within = (np.arange(len(kind)) - np.repeat(heads, lengths)).astype(np.uint64)
        placed = X.mix(self.value + within * np.uint64(0x9FB21C651E98DF25))
        whole = X.mix(np.add.reduceat(placed, heads)) if len(heads) else placed
        return Template(kind[heads], whole, np.searchsorted(heads, self.bounds), way, kind[heads] == PLAIN)


class Template:
    """Template words in one of the ways."""

    def __init__(self, kind: np.ndarray, value: np.ndarray, bounds: np.ndarray, way: int, plain: np.ndarray):
        self.kind, self.value, self.bounds, self.way, self.plain = kind, value, bounds, way, plain
        self.hash = np.where(kind == PLAIN, value, X.mix(kind.astype(np.uint64)))

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first word, row) of the windows with enough plain words."""
        h, first, bounds = X.windows(self.hash, self.bounds, WINDOW, whole_if_shorter=False)
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        plain = np.concatenate([[0], np.cumsum(self.plain)])
        enough = plain[first + WINDOW] - plain[first] >= PLAIN_WORDS
        return X.mix(h[enough] + np.uint64(self.way)), first[enough], row[enough]

    def slots(self, first: int) -> list[dict]:
        """The slots of one window: kind and value."""
        at = np.flatnonzero(self.kind[first : first + WINDOW] != PLAIN) + first
        return [{"kind": int(self.kind[i]), "value": int(self.value[i].view(np.int64))} for i in at]


def _counts(member: np.ndarray, spans: X.Spans) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(member)])
    return total[spans.end] - total[spans.start]


_UNIT_HASHES = _word_hashes(UNITS)
_NUMBER_HASHES = _word_hashes(NUMBER_WORDS)

_SLOTS = T.ArrayType(T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("value", T.LongType())]))
_ARROW_SLOTS = pa.list_(pa.struct([("kind", pa.int32()), ("value", pa.int64())]))


def template_windows(df: DataFrame, key: str, text: str, only: np.ndarray | None = None, ways: tuple[int, ...] = (EACH,)) -> DataFrame:
    """(key, way, pos, h, slots, windows, same): the windows of every text in ``ways``, or those that ``only`` may hold.

    ``pos`` counts template words of the way. ``same`` is a hash of the whole text's words, slots filled.
    """
    bits = shared(df.sparkSession, only) if only is not None else None
    fields = [("way", T.IntegerType()), ("pos", T.LongType()), ("h", T.LongType()), ("slots", _SLOTS), ("windows", T.LongType()), ("same", T.LongType())]
    schema = T.StructType([T.StructField("key", df.schema[key].dataType)] + [T.StructField(n, t) for n, t in fields])

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in X.slices(batch.column(1)):
            templates = Templates(piece)
            for way in ways:
                made = templates.way(way)
                h, first, row = made.windows()
                total = np.bincount(row, minlength=piece.rows)
                keep = np.flatnonzero(may_hold(bits.value, h)) if bits is not None else np.arange(len(h))
                if not len(keep):
                    continue
                same = np.zeros(piece.rows, dtype=np.int64)
                for r in np.unique(row[keep]) if bits is None else ():
                    words = templates.value[templates.bounds[r] : templates.bounds[r + 1]]
                    same[r] = X.windows(words, np.array([0, len(words)]), len(words), whole_if_shorter=True)[0].view(np.int64)[0]
                yield {
                    "key": batch.column(0).take(pa.array(row[keep] + piece.first)),
                    "way": np.full(len(keep), way, dtype=np.int32),
                    "pos": first[keep] - made.bounds[row[keep]],
                    "h": h[keep].view(np.int64),
                    "slots": pa.array([made.slots(i) for i in first[keep]] if way != WORDS else [[]] * len(keep), _ARROW_SLOTS),
                    "windows": total[row[keep]],
                    "same": same[row[keep]],
                }

    return X.map_batches(df.select(key, text), cut, schema)


def held_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per text and item it holds: doc_id, item_id, windows_met, windows_of_item, slots, slots_consistent, slots_changed."""
    ways = (EACH, RUNS, NUMBERS, WORDS)
    sought = store(template_windows(items, item_id, item_text, ways=ways)).df
    named = sought.groupBy("same").agg(F.min("key").alias("item"))
    sought = sought.join(named, "same").where(F.col("key").eqNullSafe(F.col("item")))
    sought = store(sought.select("h", "item", "way", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"), F.col("windows").alias("of_item")).dropDuplicates(["h", "item", "item_pos"])).df
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    rows = rows.withColumn("key", F.struct("row", "doc"))
    found = template_windows(rows, "key", "text", key_filter(sought, "h", 27), ways)
    met = store(found.select("key", "pos", "h", "slots").join(sought, "h")).df
    by = ["key", "item", "way"]
    counted = met.select(*by, "item_pos", "of_item").distinct().groupBy(*by).agg(F.count("*").alias("met"), F.first("of_item").alias("of_item"))
    pairs = met.select(*by, F.explode(F.arrays_zip("item_slots", "slots")).alias("z"))
    pairs = pairs.select(*by, F.col("z.item_slots").alias("theirs"), F.col("z.slots").alias("ours")).distinct()
    values = pairs.groupBy(*by, "theirs").agg(F.count("*").alias("n"), F.max((F.col("theirs") != F.col("ours")).cast("int")).alias("changed"))
    slots = values.groupBy(*by).agg(
        F.count("*").alias("slots"), F.sum((F.col("n") == 1).cast("long")).alias("consistent"), F.sum(F.col("changed").cast("long")).alias("changed")
    )
    slots = slots.select(F.col("key").alias("k"), F.col("item").alias("i"), F.col("way").alias("w"), "slots", "consistent", "changed")
    joined = counted.join(slots, (F.col("key") == F.col("k")) & (F.col("item") == F.col("i")) & (F.col("way") == F.col("w")), "left")
    enough = (100 * F.col("met") >= SHARE_PERCENT * F.col("of_item")) | (F.col("met") >= RUN)
    agreed = F.col("slots").isNull() | (2 * F.col("consistent") >= F.col("slots"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    best = F.struct("way", "met", "of_item", zero("slots").alias("slots"), zero("consistent").alias("consistent"), zero("changed").alias("changed"))
    best = joined.where(enough & agreed).groupBy("key", "item").agg(F.min(best).alias("best"))
    return best.select(
        F.col("key.doc").alias("doc_id"),
        F.col("item").alias("item_id"),
        F.col("best.met").alias("windows_met"),
        F.col("best.of_item").alias("windows_of_item"),
        F.col("best.slots").alias("slots"),
        F.col("best.consistent").alias("slots_consistent"),
        F.col("best.changed").alias("slots_changed"),
    )


def text_key(text: str) -> Column:
    """A key that equal texts share; a null text has its own."""
    return F.struct(F.xxhash64(text).alias("x"), F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("c"))


def without_items(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item; all texts of equal wording share a verdict."""
    keyed = docs.withColumn("_key", text_key(text))
    held = held_items(keyed, items, "_key", text, item_id, item_text).select(F.col("doc_id").alias("_held")).distinct()
    return keyed.join(held, keyed["_key"] == held["_held"], "left_anti").drop("_key")
