"""Scoring by a gated recurrent language model, beside a smoothed unigram base.

Tokens are words with A-Z lowered and one end per text. Counts of all tokens of all training texts give the base and the
vocabulary: the ``classes * width`` most frequent tokens are words of the network, in classes by rank; all others share
one class, inside which they go by their add-one counts over the training texts, so every text has a proper probability.

The network learns from every training text: a start is made on a bounded sample, then each task passes over all its
texts from there by truncated backpropagation, and the results are averaged by tokens. Scoring carries the state through
whole texts.

Counts of the ``HOT`` most frequent tokens (8 MB) go to every task; the rest meet their counts by a join, with its keys
being rare by construction.

Defined results: a null or empty text is one end token; with no training text every count is 0 and the network is as
drawn; a null id counts as an empty one in the hold-out; rows are scored one by one; an empty table gives an empty
result. Input columns called like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.llm import rnn
from tallywind.llm import text as X
from tallywind.llm.components import shared
from tallywind.storage import store

HIDDEN, CLASSES, WIDTH = 16, 16, 32
LANES, STEPS, RATE = 256, 32, 0.01
#: Texts that the start of the network is made on, and passes over them: a bounded sample, whole texts.
START_DOCS, START_PASSES = 512, 2
HOT = 1 << 19
#: The end token's hash; words hash elsewhere with all but certainty.
END = np.uint64(0x9AE16A3B2F90404F)
_CHUNK = 1 << 21


def tokens(piece: X.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a slice, an end behind each text, and bounds per row."""
    found = X.words(piece)
    h = X.span_hashes(piece.data, found, fold=True)
    return np.insert(h, found.bounds[1:], END), found.bounds + np.arange(len(found.bounds))


def token_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(h, c): how often each token occurs in all of ``texts``."""
    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("c", T.LongType())])
    target = pa.schema([("h", pa.int64()), ("c", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], schema=target)

        for batch in batches:
            for piece in X.slices(batch.column(0)):
                held.append(tokens(piece)[0])
                n += len(held[-1])
                if n >= _CHUNK:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    return texts.select(text).mapInArrow(count, schema).groupBy("h").agg(F.sum("c").alias("c"))


class Vocabulary:
    """The hot tokens, sorted by hash, with counts and network numbers; and the totals of the training texts."""

    def __init__(self, h: np.ndarray, c: np.ndarray, total: int, distinct: int, words: int):
        by_count = np.lexsort((h, -c))
        number = np.full(len(h), words, dtype=np.int64)
        number[by_count[:words]] = np.arange(min(words, len(h)))
        order = np.argsort(h)
        self.h, self.c, self.number = h[order], c[order], number[order]
        self.total, self.distinct, self.words = total, distinct, words
        inside = int(c[by_count[:words]].sum())
        self.other_total, self.other_distinct = total - inside, distinct - min(words, len(h))

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hot, count, network number) of tokens; those not hot have count 0 and the number of all other words."""
        if not len(self.h):
            return np.zeros(len(h), dtype=bool), np.zeros(len(h), dtype=np.int64), np.full(len(h), self.words, dtype=np.int64)
        # Each distinct token once and in order, which finds its place in the large table sooner.
        h, where = np.unique(h, return_inverse=True)
        place = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        hot = self.h[place] == h
        return hot[where], np.where(hot, self.c[place], 0)[where], np.where(hot, self.number[place], self.words)[where]

    def base(self, c):
        return np.log10((c + 1) / (self.total + self.distinct + 1))

    def among_others(self, c):
        return np.log10((c + 1) / (self.other_total + self.other_distinct + 1))


def vocabulary(counts: DataFrame, words: int, hot: int = HOT) -> Vocabulary:
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    table = counts.orderBy(F.desc("c"), "h").limit(hot).toArrow()
    return Vocabulary(table.column("h").to_numpy().view(np.uint64), table.column("c").to_numpy(), total, distinct, words)


_VECTOR = T.StructType([T.StructField("tokens", T.LongType()), T.StructField("vector", T.ArrayType(T.FloatType()))])


def _trained(texts: DataFrame, text: str, vocab, start, passes: int) -> DataFrame:
    """(tokens, vector) of a network per task, each trained on the task's texts from ``start``."""
    target = pa.schema([("tokens", pa.int64()), ("vector", pa.list_(pa.float32()))])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = rnn.Net(HIDDEN, CLASSES, WIDTH)
        if start is not None:
            net.load(start.value)

        def numbered() -> Iterator[np.ndarray]:
            for batch in batches:
                for piece in X.slices(batch.column(0)):
                    h, bounds = tokens(piece)
                    yield from np.split(vocab.value.find(h)[2], bounds[1:-1])

        if passes == 1:
            seen = rnn.train(net, numbered(), LANES, STEPS, RATE / 4)
        else:
            sample, seen = list(numbered()), 0
            for _ in range(passes):
                seen += rnn.train(net, iter(sample), LANES // 4, STEPS, RATE)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([net.vector()], pa.list_(pa.float32()))], schema=target)

    return texts.select(text).mapInArrow(fit, _VECTOR)


def fit_network(texts: DataFrame, text: str, vocab) -> np.ndarray:
    """Parameters of the network: a start on a sample, then the token-weighted mean of all tasks' passes."""
    spark = texts.sparkSession
    least = texts.select(F.xxhash64(text).alias("h")).distinct().orderBy("h").limit(START_DOCS)
    sample = texts.select(text, F.xxhash64(text).alias("h")).join(F.broadcast(least), "h").dropDuplicates(["h"]).orderBy("h").select(text)
    first = _trained(sample.coalesce(1), text, vocab, None, START_PASSES).collect()
    if not first:
        return rnn.Net(HIDDEN, CLASSES, WIDTH).vector()
    start = shared(spark, np.array(first[0]["vector"], dtype=np.float32))
    passed = store(_trained(texts, text, vocab, start, 1)).df
    weighted = passed.select("tokens", F.posexplode("vector").alias("i", "v"))
    mean = weighted.groupBy("i").agg((F.sum(F.col("v").cast("double") * F.col("tokens")) / F.sum("tokens")).alias("v"))
    table = mean.toArrow()  # one number per parameter of the network
    if not table.num_rows:
        return start.value
    out = np.zeros(table.num_rows, dtype=np.float32)
    out[table.column("i").to_numpy()] = table.column("v").to_numpy()
    return out


_RARE = T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("times", T.LongType())]))
_ARROW_RARE = pa.list_(pa.struct([("h", pa.int64()), ("times", pa.int64())]))


def rare_tokens(h: np.ndarray, hot: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct tokens of every row that are not hot, how often each occurs in it, and bounds per row."""
    at = np.flatnonzero(~hot)
    row, odd = np.searchsorted(bounds, at, side="right") - 1, h[at].view(np.int64)
    order = np.lexsort((odd, row))
    row, odd = row[order], odd[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(at)), dtype=bool), (row[1:] != row[:-1]) | (odd[1:] != odd[:-1])]))
    times = np.diff(np.append(first, len(at)))
    return odd[first], times, np.searchsorted(row[first], np.arange(len(bounds)))


def _scored(rows: DataFrame, text: str, keys: list[str], vocab, network) -> DataFrame:
    """Per row: its keys, n_tokens, the sums over hot tokens, the network's sum, and its rare tokens."""
    fields = [("n_tokens", T.LongType()), ("known", T.LongType()), ("base", T.DoubleType()), ("net", T.DoubleType()), ("inside", T.DoubleType()), ("rare", _RARE)]
    schema = T.StructType([rows.schema[k] for k in keys] + [T.StructField(n, t) for n, t in fields])
    arrow = pa.schema([pa.field(n, t) for n, t in (("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("net", pa.float64()), ("inside", pa.float64()), ("rare", _ARROW_RARE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.value
        net = rnn.Net(HIDDEN, CLASSES, WIDTH).load(network.value)
        waiting: dict[int, tuple[dict, dict]] = {}

        def fed() -> Iterator[tuple[int, np.ndarray]]:
            number = 0
            for batch in batches:
                for piece in X.slices(batch.column(text)):
                    h, bounds = tokens(piece)
                    hot, c, words = v.find(h)
                    base = X.row_sums(np.where(hot, v.base(c), 0.0), bounds)
                    inside = X.row_sums(np.where(hot & (words == v.words), v.among_others(c), 0.0), bounds)
                    known = X.row_sums(hot.astype(np.int64), bounds)
                    odd, times, cuts = rare_tokens(h, hot, bounds)
                    kept = batch.slice(piece.first, piece.rows).select(keys).to_pylist()
                    for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                        made = {"n_tokens": b - a, "known": known[r], "base": base[r], "inside": inside[r]}
                        made["rare"] = odd[cuts[r] : cuts[r + 1]], times[cuts[r] : cuts[r + 1]]
                        waiting[number] = (kept[r], made)
                        yield number, words[a:b]
                        number += 1

        ready: list[dict] = []

        def flush() -> pa.RecordBatch:
            full = pa.schema(list(key_schema) + list(arrow))
            columns = [pa.array([row[f.name] for row in ready], f.type) for f in full if f.name != "rare"]
            bounds = np.concatenate([[0], np.cumsum([len(row["rare"][0]) for row in ready])]).astype(np.int32)
            pairs = [pa.array(np.concatenate([row["rare"][i] for row in ready])) for i in (0, 1)]
            rare = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(pairs, ["h", "times"]))
            return pa.RecordBatch.from_arrays([*columns, rare.cast(_ARROW_RARE)], schema=full)

        from pyspark.sql.pandas.types import to_arrow_schema

        key_schema = to_arrow_schema(T.StructType([rows_schema[k] for k in keys]))
        for number, logs in rnn.score(net, fed(), LANES, STEPS):
            kept, made = waiting.pop(number)
            ready.append(kept | made | {"net": logs / np.log(10)})
            if len(ready) >= 2000:
                yield flush()
                ready.clear()
        if ready:
            yield flush()

    rows_schema = rows.schema
    return rows.mapInArrow(run, schema)


def score_texts(docs: DataFrame, training: DataFrame, keys: list[str], text: str = "text", hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: ``keys``, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    counts = store(token_counts(training, text)).df
    v = vocabulary(counts, CLASSES * WIDTH, hot)
    vocab = shared(spark, v)
    network = shared(spark, fit_network(training, text, vocab))
    names = {"n_tokens", "n_known", "train_tokens", "base_score", "score"}
    keys = [k for k in keys if k.lower() not in names]
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *keys, text)
    scored = store(_scored(rows, text, ["_row", *keys], vocab, network)).df
    rare = scored.select("_row", F.explode("rare").alias("r")).select("_row", F.col("r.h").alias("h"), F.col("r.times").alias("times"))
    met = rare.join(counts.withColumnRenamed("h", "_h"), F.col("h") == F.col("_h"), "left").select("_row", "times", F.coalesce("c", F.lit(0)).alias("c"))
    log = lambda space: F.sum(F.col("times") * F.log10((F.col("c") + 1) / F.lit(float(space))))
    sums = met.groupBy("_row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more"),
        log(v.total + v.distinct + 1).alias("base_more"),
        log(v.other_total + v.other_distinct + 1).alias("inside_more"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.drop("rare").join(sums.withColumnRenamed("_row", "_of"), F.col("_row") == F.col("_of"), "left").select(
        *keys,
        "n_tokens",
        (F.col("known") + zero("more")).cast("long").alias("n_known"),
        F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("base_more")).alias("base_score"),
        (F.col("net") + F.col("inside") + zero("inside_more")).alias("score"),
    )
