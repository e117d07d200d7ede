"""Language ID by prediction by partial matching over bytes.

For every language a tree of byte contexts up to ``ORDER`` bytes long holds how often each byte followed. A byte
costs -log2 of its share in the longest context seen in training; a byte new to that context first pays the
context's escape (PPM method C: distinct / (total + distinct)) and is looked for in the next shorter one, down to
one of 256 equally likely bytes. A text's code length is the exact sum over all its bytes under frozen counts, and
the language with the shortest code wins.

Case is folded and all but letters is read as a space before coding, so digits and punctuation say nothing.

Defined results: a text that is null, empty or has no letter gives ``und`` with score 0; ties go to the language
that comes first in order; with no labelled row to learn from every text is ``und``. Repeated rows are judged one
by one. Input columns called like an output column are replaced.
"""

from __future__ import annotations

import weakref
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.llm import text as X
from tallywind.llm.components import shared

ORDER = 4
UNKNOWN = "und"
#: Texts of each language that the trees are grown from: a bounded sample, whole texts.
SAMPLE_DOCS = 800
PARTS = 64
CACHE_SLOTS = 1 << 19


def _folding() -> np.ndarray:
    table = np.full(256, 32, dtype=np.uint8)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


_FOLD = _folding()
_ASCII_LETTER = X.table_of(bytes(range(65, 91)) + bytes(range(97, 123)))


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and for the two-byte letters from U+00C0 to U+00DE; other ASCII becomes a space."""
    out = _FOLD[data]
    upper = np.zeros(len(data), dtype=bool)
    upper[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[upper] += 32
    return out


def contexts(piece: X.Slice) -> np.ndarray:
    """For every byte: its ``ORDER`` predecessors and itself in one integer, zeros before the start of a text."""
    data = fold(piece.data).astype(np.int64)
    code = data.copy()
    lengths = np.diff(piece.offsets)
    place = np.arange(len(data)) - np.repeat(piece.offsets[:-1], lengths)
    for back in range(1, ORDER + 1):
        before = np.zeros(len(data), dtype=np.int64)
        before[back:] = data[:-back] if back < len(data) else 0
        before[place < back] = 0
        code |= before << (8 * back)
    return code


def has_letter(piece: X.Slice) -> np.ndarray:
    """Whether each text has a letter of any script."""
    found = X.row_sums(_ASCII_LETTER[piece.data].astype(np.int64), piece.offsets) > 0
    for row in np.flatnonzero(~found & (X.row_sums((piece.data >= 128).astype(np.int64), piece.offsets) > 0)):
        found[row] = any(c.isalpha() for c in piece.text(row))
    return found


@dataclass
class Tree:
    """Frozen counts of one language: per order the contexts with total and distinct followers, and the pairs."""

    contexts: list[np.ndarray] = field(default_factory=list)
    escape: list[np.ndarray] = field(default_factory=list)
    pairs: list[np.ndarray] = field(default_factory=list)
    bits: list[np.ndarray] = field(default_factory=list)

    @staticmethod
    def grow(codes: np.ndarray, counts: np.ndarray) -> Tree:
        """From distinct (context, byte) codes of the longest order and how often each occurred."""
        tree = Tree()
        for order in range(ORDER + 1):
            pairs, where = np.unique(codes & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            seen = np.bincount(where, weights=counts)
            parents, parent = np.unique(pairs >> 8, return_inverse=True)
            total, distinct = np.bincount(parent, weights=seen), np.bincount(parent)
            tree.pairs.append(pairs)
            tree.bits.append(np.log2(total + distinct)[parent] - np.log2(seen))
            tree.contexts.append(parents)
            tree.escape.append(np.log2(total + distinct) - np.log2(distinct))
        return tree

    def code_length(self, codes: np.ndarray) -> np.ndarray:
        """Bits for the last byte of every code."""
        cost = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        for order in range(ORDER, -1, -1):
            pair = codes[open_] & ((1 << 8 * (order + 1)) - 1)
            place, known = _find(self.pairs[order], pair)
            cost[open_[known]] += self.bits[order][place[known]]
            open_, pair = open_[~known], pair[~known]
            place, known = _find(self.contexts[order], pair >> 8)
            cost[open_[known]] += self.escape[order][place[known]]
        cost[open_] += 8.0
        return cost


def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return place, table[place] == values


@dataclass
class Model:
    languages: list[str]
    trees: list[Tree]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Grow one tree per language from about ``sample_docs`` different texts of it (rounded up to full parts), those
    with the least hashes in each of ``PARTS`` parts.

    The sample bounds what reaches the driver; memory follows the number of languages.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h")
    )
    # Drawn from parts of each language, so that a language that most texts have is not ranked in one task.
    rank = F.row_number().over(Window.partitionBy("lang", F.pmod("h", F.lit(PARTS))).orderBy("h"))
    least = rows.select("lang", "h").distinct().withColumn("rank", rank).where(F.col("rank") <= -(-sample_docs // PARTS))
    # About sample_docs rows of 64 bits per language.
    chosen = rows.join(F.broadcast(least.drop("rank")), ["lang", "h"]).dropDuplicates(["lang", "h"])
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("code", T.LongType()), T.StructField("n", T.LongType())])

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        label = np.array(batch.column("lang").to_pylist(), dtype=object)
        for piece in X.slices(batch.column("text")):
            codes = contexts(piece)
            of = np.repeat(label[piece.first : piece.first + piece.rows], np.diff(piece.offsets))
            for name in set(of):
                code, n = np.unique(codes[of == name], return_counts=True)
                yield {"lang": [name] * len(code), "code": code, "n": n}

    table = X.map_batches(chosen.select("lang", "text"), count, schema).groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(table["lang"].unique())
    parts = [table[table["lang"] == name] for name in names]
    return Model(names, [Tree.grow(p["code"].to_numpy(np.int64), p["n"].to_numpy(np.float64)) for p in parts])


class Coder:
    """Code lengths under all trees; the lengths of codes met before are remembered in a table of fixed size."""

    def __init__(self, model: Model):
        self.model = model
        self.keys = np.full(CACHE_SLOTS, -1, dtype=np.int64)
        self.costs = np.zeros((CACHE_SLOTS, len(model.languages)))

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        h = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - CACHE_SLOTS.bit_length() + 1)).astype(np.int64)

    def bits(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every row under every language."""
        slot = self._slot(codes)
        missing = np.flatnonzero(self.keys[slot] != codes)
        fresh, where = np.unique(codes[missing], return_inverse=True)
        table = np.stack([t.code_length(fresh) for t in self.model.trees], axis=1)
        out = np.empty((len(offsets) - 1, len(self.model.languages)))
        for j in range(out.shape[1]):
            each = self.costs[:, j][slot]
            each[missing] = table[where, j]
            out[:, j] = X.row_sums(each, offsets)
        # Written last: a fresh code may take the slot of one read above.
        to = self._slot(fresh)
        self.keys[to], self.costs[to] = fresh, table
        return out


#: Coders end with their models, so that a worker does not keep trees and table while it serves later stages.
_coders: weakref.WeakKeyDictionary[Broadcast, Coder] = weakref.WeakKeyDictionary()


def _coder(model: Broadcast) -> Coder:
    """One coder per broadcast model and Python worker."""
    if model not in _coders:
        _coders[model] = Coder(model.value)
    return _coders[model]


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred, score (posterior under equal priors) and bits_per_byte of the best language."""
    extra = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())]
    kept, schema = X.added(df.schema, extra)
    if not model.languages:
        return df.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits_per_byte"))
    broadcast = shared(df.sparkSession, model)

    def predict(batch: pa.RecordBatch) -> Iterator[dict]:
        coder = _coder(broadcast)
        names = np.array(coder.model.languages, dtype=object)
        best, score, rate = [], [], []
        for piece in X.slices(batch.column(text)):
            bits = coder.bits(contexts(piece), piece.offsets)
            least = bits.argmin(axis=1)
            gap = bits - bits.min(axis=1, keepdims=True)
            known = has_letter(piece)
            best += list(np.where(known, names[least], UNKNOWN))
            score.append(np.where(known, 1.0 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1), 0.0))
            rate.append(np.where(known, bits.min(axis=1) / np.maximum(np.diff(piece.offsets), 1), np.nan))
        rest = {c: batch.column(c) for c in kept}
        bits_per_byte = np.concatenate(rate)
        yield rest | {"lang_pred": best, "score": np.concatenate(score), "bits_per_byte": pa.array(bits_per_byte, mask=np.isnan(bits_per_byte))}

    return X.map_batches(df, predict, schema)


def rejected(lang_pred: Column, bits_per_byte: Column) -> Column:
    """Texts in no language: without a letter, or such that no language's tree makes them shorter than they are."""
    return (lang_pred == UNKNOWN) | (bits_per_byte >= 8.0)
