"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Texts become token ids with a closing 0; those longer than a sequence are cut so that all pieces but the first are
full. Full pieces are sequences of their own. The others are dealt by hash into blocks of about ``BLOCK`` pieces, and
every block is packed by ``ISLANDS`` populations that breed apart and pass their elite on to the next island between
epochs. A crossover takes one parent's packing, injects well-filled sequences of the other parent whole, takes out
the sequences that hold pieces injected twice, and puts the displaced pieces back by best fit, longest first.
Sequences that stay poorly filled are taken apart and their pieces of all blocks are packed together in a next round,
kept only if that saves sequences.

A block, its populations and its state are bounded by ``BLOCK`` whatever the input; pieces of any length distribution
are dealt evenly since the hash is of a row number.

Defined results: a null or empty text is the single id 0; equal texts are packed one by one; ids may be null or
repeat; an empty table gives an empty result. Input columns called like an output column are replaced.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.llm import text as X
from tallywind.llm.bpe import encoder
from tallywind.storage import store

CAPACITY = 2048
BLOCK = 2048
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 4
POPULATION = 4
#: A sequence with this share filled is not taken apart again.
WELL_FILLED = 0.98
ROUNDS = 4


class Bins:
    """Sequences under construction: best fit finds the fullest sequence that still takes a length."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.content: list[list[int]] = []
        self.free: list[int] = []
        self._by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._some = 0

    def add(self, content: list[int], free: int) -> None:
        self.content.append(content)
        self.free.append(free)
        self._offer(len(self.content) - 1)

    def _offer(self, at: int) -> None:
        free = self.free[at]
        self._by_free[free].append(at)
        self._some |= 1 << free

    def best_fit(self, item: int, length: int) -> None:
        fitting = self._some >> length
        if not fitting:
            self.add([item], self.capacity - length)
            return
        free = length + (fitting & -fitting).bit_length() - 1
        at = self._by_free[free].pop()
        if not self._by_free[free]:
            self._some &= ~(1 << free)
        self.content[at].append(item)
        self.free[at] = free - length
        self._offer(at)


Packing = list[list[int]]


def fill(packing: Packing, lengths: list[int], order, capacity: int) -> Packing:
    """Best fit of the items of ``order`` behind the sequences of ``packing``."""
    bins = Bins(capacity)
    for content in packing:
        bins.add(list(content), capacity - sum(lengths[i] for i in content))
    for item in order:
        bins.best_fit(item, lengths[item])
    return bins.content


def fitness(packing: Packing, lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then fullness gathered in few of them; greater is better."""
    return -len(packing), sum((sum(lengths[i] for i in content) / capacity) ** 2 for content in packing)


def crossover(a: Packing, b: Packing, lengths: list[int], capacity: int, rng: random.Random) -> Packing:
    """``a`` with some of ``b``'s best-filled sequences injected whole."""
    good = [content for content in b if sum(lengths[i] for i in content) >= WELL_FILLED * capacity]
    taken = rng.sample(good, len(good) // 2) if len(good) > 1 else good
    inside = {i for content in taken for i in content}
    kept, displaced = [], []
    for content in a:
        if inside.isdisjoint(content):
            kept.append(content)
        else:
            displaced += [i for i in content if i not in inside]
    displaced.sort(key=lambda i: (-lengths[i], i))
    return fill(taken + kept, lengths, displaced, capacity)


def mutate(packing: Packing, lengths: list[int], capacity: int, rng: random.Random) -> Packing:
    """The worst-filled sequences and a few others are taken apart and put back by best fit."""
    order = sorted(range(len(packing)), key=lambda k: sum(lengths[i] for i in packing[k]))
    apart = set(order[: max(2, len(order) // 20)]) | set(rng.sample(order, min(len(order), 3)))
    freed = sorted((i for k in apart for i in packing[k]), key=lambda i: (-lengths[i], i))
    return fill([c for k, c in enumerate(packing) if k not in apart], lengths, freed, capacity)


def first_population(lengths: list[int], capacity: int, rng: random.Random) -> list[Packing]:
    """Best fit by decreasing length, and of orders disturbed at random."""
    items = range(len(lengths))
    out = [fill([], lengths, sorted(items, key=lambda i: (-lengths[i], i)), capacity)]
    while len(out) < POPULATION:
        out.append(fill([], lengths, sorted(items, key=lambda i: (-lengths[i] * rng.uniform(0.8, 1.25), i)), capacity))
    return out


def evolve(population: list[Packing], lengths: list[int], capacity: int, rng: random.Random) -> list[Packing]:
    """Some generations; the worst packing makes room for each child. Ends early at the least possible number."""
    least = -(-sum(lengths) // capacity)
    population = sorted(population, key=lambda p: fitness(p, lengths, capacity), reverse=True)
    for _ in range(GENERATIONS):
        if len(population[0]) <= least:
            break
        a, b = population[0], rng.choice(population[1:])
        for x, y in ((a, b), (b, a)):
            child = mutate(crossover(x, y, lengths, capacity, rng), lengths, capacity, rng)
            population = sorted([*population[:-1], child], key=lambda p: fitness(p, lengths, capacity), reverse=True)
    return population


def _packed(packing: Packing, n: int) -> list[int]:
    out = [0] * n
    for k, content in enumerate(packing):
        for i in content:
            out[i] = k
    return out


def _unpacked(numbers) -> Packing:
    out: Packing = [[] for _ in range(max(numbers, default=-1) + 1)]
    for i, k in enumerate(numbers):
        out[k].append(i)
    return [content for content in out if content]


STATE = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("island", T.IntegerType()),
        T.StructField("items", T.ArrayType(T.LongType())),
        T.StructField("lengths", T.ArrayType(T.IntegerType())),
        T.StructField("population", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("sequences", T.IntegerType()),
        T.StructField("fullness", T.DoubleType()),
    ]
)


def _state(block: int, island: int, items, lengths: list[int], population: list[Packing], capacity: int) -> pa.Table:
    sequences, fullness = fitness(population[0], lengths, capacity)
    return pa.table(
        {
            "block": pa.array([block], pa.int64()),
            "island": pa.array([island], pa.int32()),
            "items": pa.array([items], pa.list_(pa.int64())),
            "lengths": pa.array([lengths], pa.list_(pa.int32())),
            "population": pa.array([[_packed(p, len(lengths)) for p in population]], pa.list_(pa.list_(pa.int32()))),
            "sequences": pa.array([-sequences], pa.int32()),
            "fullness": pa.array([fullness], pa.float64()),
        }
    )


def _settle(items: DataFrame, capacity: int) -> DataFrame:
    """(block, item, length, bin): the best packing any island found for each block of (block, item, length)."""

    def begin(table: pa.Table) -> pa.Table:
        block, island = table["block"][0].as_py(), table["island"][0].as_py()
        table = table.sort_by("item")
        lengths = table["length"].to_pylist()
        rng = random.Random(f"{block}/{island}/0")
        population = evolve(first_population(lengths, capacity, rng), lengths, capacity, rng)
        return _state(block, island, table["item"].to_pylist(), lengths, population, capacity)

    everywhere = items.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    state = everywhere.groupBy("block", "island").applyInArrow(begin, STATE)
    for epoch in range(1, EPOCHS):
        # Each island's elite moves to the next island of the same block.
        state = store(state).df
        arriving = state.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.slice("population", 1, 1).alias("elite"))

        def breed(batches: Iterator[pa.RecordBatch], epoch=epoch) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    rng = random.Random(f"{row['block']}/{row['island']}/{epoch}")
                    population = [_unpacked(p) for p in row["population"][: POPULATION - 1] + row["elite"]]
                    population = evolve(population, row["lengths"], capacity, rng)
                    yield from _state(row["block"], row["island"], row["items"], row["lengths"], population, capacity).to_batches()

        joined = state.join(arriving, ["block", "island"]).select("block", "island", "items", "lengths", "population", "elite")
        state = joined.mapInArrow(breed, STATE)
    best = F.max_by(F.struct("items", "lengths", F.element_at("population", 1).alias("bins")), F.struct(-F.col("sequences"), "fullness", -F.col("island"))).alias("best")
    chosen = state.groupBy("block").agg(best)
    each = F.explode(F.arrays_zip("best.items", "best.lengths", "best.bins")).alias("z")
    return chosen.select("block", each).select("block", F.col("z.items").alias("item"), F.col("z.lengths").alias("length"), F.col("z.bins").alias("bin"))


def _named(packed: DataFrame, turn: int) -> DataFrame:
    """(item, length, sequence): sequence numbers that no other block or round gives."""
    number = F.lit(turn).cast("long") * F.lit(1 << 58) + F.col("block") * F.lit(1 << 16) + F.col("bin")
    return packed.select("item", "length", number.alias("sequence"))


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """(item, sequence_id, offset) for rows of (item, length): distinct items, 1 <= length <= capacity."""
    items = store(items.select(F.col("item").cast("long"), F.col("length").cast("int"))).df
    full = items.where(F.col("length") == capacity).select("item", "length", (-1 - F.col("item")).alias("sequence"))
    done = [full]
    left = items.where(F.col("length") < capacity)
    for turn in range(ROUNDS):
        n = left.count()
        if not n:
            break
        blocks = -(-n // block)
        dealt = left.withColumn("block", F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(blocks)))
        fresh = store(_named(_settle(dealt, capacity), turn)).df
        filled = fresh.groupBy("sequence").agg(F.sum("length").alias("filled"))
        if turn:
            if filled.count() >= before:
                done.append(previous)
                break
        poor = filled.where(F.col("filled") < WELL_FILLED * capacity).select("sequence")
        if blocks == 1 or turn == ROUNDS - 1:
            done.append(fresh)
            break
        poor = store(poor).df
        before = poor.count()
        done.append(fresh.join(poor, "sequence", "left_anti").select("item", "length", "sequence"))
        previous = store(fresh.join(poor, "sequence").select("item", "length", "sequence")).df
        left = previous.select("item", "length")
    packed = done[0]
    for part in done[1:]:
        packed = packed.unionByName(part)
    # A sequence holds at most ``capacity`` pieces, so its window is small.
    offset = F.sum("length").over(_in_sequence()) - F.col("length")
    return packed.select("item", F.col("sequence").alias("sequence_id"), offset.cast("long").alias("offset"))


def _in_sequence():
    from pyspark.sql import Window

    return Window.partitionBy("sequence").orderBy("item").rowsBetween(Window.unboundedPreceding, 0)


def pieces(docs: DataFrame, vocabulary: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of every text: its other columns with piece, start, length and ids_crc32."""
    extra = [T.StructField("piece", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]]
    kept, schema = X.added(docs.schema, extra)
    kept = [c for c in kept if c != text]
    schema = T.StructType([f for f in schema.fields if f.name != text])

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        coder = encoder(vocabulary)
        row, piece, start, length, crc = [], [], [], [], []
        for part in X.slices(batch.column(text)):
            for r, ids in enumerate(coder.encode(part), part.first):
                ids = np.append(ids, 0).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    row.append(r)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
        rest = batch.select(kept).take(pa.array(row, pa.int64()))
        yield {c: rest.column(c) for c in kept} | {"piece": piece, "start": start, "length": length, "ids_crc32": crc}

    return X.map_batches(docs, cut, schema)


def pack_texts(docs: DataFrame, vocabulary: str, text: str = "text", capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """One row per piece: the columns of ``pieces`` with sequence_id and offset."""
    made = store(pieces(docs, vocabulary, text, capacity).withColumn("_item", F.monotonically_increasing_id())).df
    placed = pack(made.select(F.col("_item").alias("item"), "length"), capacity, block)
    columns = [c for c in made.columns if c not in ("_item", "sequence_id", "offset")]
    return made.select("_item", *columns).join(placed, F.col("_item") == F.col("item")).select(*columns, "sequence_id", "offset")
