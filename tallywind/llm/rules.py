"""Quality rules as a short-circuit cascade.

Each rule is a measure over a text and a bound on it. A sample tells what a rule costs per text and what share it
rejects; rules then run in order of rejections per cost, each only on the texts that passed all before. The order
changes how much work is done, never the verdict.

The base measures (words, symbols, repeated lines, repeated word windows) are wanted for every text and are
computed for every text.

Defined results: a null or empty text has no words and fails the base; ties and repeated rows are judged one by
one; an empty table gives an empty result, in the order the rules were written. Input columns called like an output
column are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.llm import text as X

#: Texts that cost and selectivity are estimated on: a bounded sample, whole texts. It decides the order only.
SAMPLE_DOCS = 1000
MIN_WORDS = 50
MAX_REPEAT_SHARE = 50

# The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"

_SYMBOL = X.table_of(SYMBOLS)
_UPPER = X.table_of(bytes(range(65, 91)))
_LETTER = X.table_of(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_DIGIT = X.table_of(b"0123456789")
_CHAR_START = np.array([(b & 0xC0) != 0x80 for b in range(256)])

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(hashes: np.ndarray, bounds: np.ndarray, size: int = 3) -> np.ndarray:
    """Words of each row that lie in a window of ``size`` words found twice or more in the row, the first included."""
    h, first, window_bounds = X.windows(hashes, bounds, size, whole_if_shorter=False)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(window_bounds))
    keyed = X.mix(h ^ (row.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)))
    _, which, n = np.unique(keyed, return_inverse=True, return_counts=True)
    start = first[n[which] > 1]
    cover = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + size, -1)
    return X.row_sums((np.cumsum(cover)[:-1] > 0).astype(np.int64), bounds)


def repeated_lines(piece: X.Slice) -> np.ndarray:
    """Lines of each row that hold a word and equal an earlier line."""
    spans = X.lines(piece)
    inside = np.concatenate([[0], np.cumsum(~X.WHITE[piece.data])])
    used = inside[spans.end] > inside[spans.start]
    row = spans.row[used]
    h = X.span_hashes(piece.data, spans, fold=False)[used]
    keyed = X.mix(h ^ (row.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)))
    first = np.unique(keyed, return_index=True)[1]
    return np.bincount(row, minlength=piece.rows) - np.bincount(row[first], minlength=piece.rows)


def base_measures(piece: X.Slice) -> dict[str, np.ndarray]:
    found = X.words(piece)
    hashes = X.span_hashes(piece.data, found, fold=False)
    chars = _CHAR_START[piece.data] & ~X.WHITE[piece.data]
    return {
        "n_words": found.counts,
        "word_chars": X.row_sums(chars.astype(np.int64), piece.offsets),
        "n_symbols": X.row_sums(_SYMBOL[piece.data].astype(np.int64), piece.offsets),
        "n_dup_lines": repeated_lines(piece),
        "n_repeat_words": repeated_words(hashes, found.bounds),
    }


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_SHARE * n_words)


@dataclass(frozen=True)
class Rule:
    """``measure`` gives one integer pair (part, whole) per text; a text passes if low <= 1000 * part / whole <= high."""

    name: str
    measure: Callable[[X.Slice], tuple[np.ndarray, np.ndarray]]
    low: int = 0
    high: int = 1 << 40

    def passes(self, piece: X.Slice) -> np.ndarray:
        part, whole = self.measure(piece)
        return (1000 * part >= self.low * whole) & (1000 * part <= self.high * whole)


def _share(table: np.ndarray, of: np.ndarray | None = None):
    def measure(piece: X.Slice):
        part = X.row_sums(table[piece.data].astype(np.int64), piece.offsets)
        whole = np.diff(piece.offsets) if of is None else X.row_sums(of[piece.data].astype(np.int64), piece.offsets)
        return part, whole

    return measure


def _word_length(piece: X.Slice):
    chars = _CHAR_START[piece.data] & ~X.WHITE[piece.data]
    return X.row_sums(chars.astype(np.int64), piece.offsets), X.words(piece).counts


def _symbols_per_word(piece: X.Slice):
    return X.row_sums(_SYMBOL[piece.data].astype(np.int64), piece.offsets), X.words(piece).counts


def _duplicate_lines(piece: X.Slice):
    spans = X.lines(piece)
    inside = np.concatenate([[0], np.cumsum(~X.WHITE[piece.data])])
    used = inside[spans.end] > inside[spans.start]
    return repeated_lines(piece), np.bincount(spans.row[used], minlength=piece.rows)


def _distinct_words(piece: X.Slice):
    found = X.words(piece)
    hashes = X.span_hashes(piece.data, found, fold=True)
    sizes = np.array([len(s) for s in X.distinct_sets(hashes, found.bounds)], dtype=np.int64)
    # A long text repeats its common words: the share is taken of at most a thousand words.
    return sizes, np.minimum(found.counts, 1000)


#: Bounds are in thousandths of the measure.
RULES = [
    Rule("symbols_per_word", _symbols_per_word, high=300),
    Rule("letters_of_bytes", _share(_LETTER), low=600),
    Rule("capitals_of_letters", _share(_UPPER, _LETTER), high=400),
    Rule("digits_of_bytes", _share(_DIGIT), high=200),
    Rule("mean_word_length", _word_length, low=2500, high=15000),
    Rule("duplicate_lines", _duplicate_lines, high=500),
    Rule("distinct_words", _distinct_words, low=100),
]


def subset(piece: X.Slice, rows: np.ndarray) -> X.Slice:
    """The given rows of a slice, in order."""
    lengths = np.diff(piece.offsets)
    keep = np.zeros(piece.rows, dtype=bool)
    keep[rows] = True
    return X.Slice(0, piece.data[np.repeat(keep, lengths)], np.concatenate([[0], np.cumsum(lengths[keep])]))


def estimate(sample: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> dict[str, tuple[float, float]]:
    """Per rule: seconds per text and share of texts rejected, each rule run on every text of ``sample``."""
    schema = T.StructType([T.StructField("rule", T.StringType()), T.StructField("seconds", T.DoubleType()), T.StructField("failed", T.LongType()), T.StructField("texts", T.LongType())])

    def measure(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in X.slices(batch.column(0)):
            for rule in rules:
                start = time.process_time()
                failed = int((~rule.passes(piece)).sum())
                yield {"rule": [rule.name], "seconds": [time.process_time() - start], "failed": [failed], "texts": [piece.rows]}

    rows = X.map_batches(sample.select(text), measure, schema).groupBy("rule").agg(F.sum("seconds"), F.sum("failed"), F.sum("texts")).collect()
    return {name: (seconds / texts, failed / texts) for name, seconds, failed, texts in rows}


def cascade_order(estimates: dict[str, tuple[float, float]], rules: Sequence[Rule] = RULES) -> list[Rule]:
    """Most rejections per second first; rules without an estimate come last, ties keep the written order."""

    def gain(rule: Rule) -> float:
        seconds, share = estimates.get(rule.name, (1.0, 0.0))
        return share / max(seconds, 1e-9)

    return sorted(rules, key=gain, reverse=True)


def ordered_rules(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> list[Rule]:
    """The rules in cascade order, estimated on ``sample_docs`` texts chosen by hash."""
    sample = df.select(F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    least = sample.select("h").distinct().orderBy("h").limit(sample_docs)
    return cascade_order(estimate(sample.join(F.broadcast(least), "h").dropDuplicates(["h"]).select("text"), rules), rules)


def judge(df: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """``df`` with the base measures, base_failed, kept, and failed_rule: the first rule in cascade order a text failed."""
    extra = [T.StructField(c, T.LongType()) for c in BASE]
    extra += [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("failed_rule", T.StringType())]
    kept, schema = X.added(df.schema, extra)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        found: dict[str, list] = {f.name: [] for f in extra}
        for piece in X.slices(batch.column(text)):
            base = base_measures(piece)
            failed = base_failed(base["n_words"], base["n_repeat_words"])
            verdict = np.full(piece.rows, None, dtype=object)
            verdict[failed] = "base"
            open_ = np.flatnonzero(~failed)
            for rule in rules:
                if not len(open_):
                    break
                ok = rule.passes(subset(piece, open_))
                verdict[open_[~ok]] = rule.name
                open_ = open_[ok]
            alive = np.zeros(piece.rows, dtype=bool)
            alive[open_] = True
            for name, values in (base | {"base_failed": failed, "kept": alive, "failed_rule": verdict}).items():
                found[name].append(values)
        yield {c: batch.column(c) for c in kept} | {name: np.concatenate(parts) for name, parts in found.items()}

    return X.map_batches(df, run, schema)
