"""Words, shingles and hashes of whole texts, worked out for a slice of a record batch at once.

Everything here runs inside a Spark task on numpy arrays over the UTF-8 bytes of a batch. Slices hold about
``SLICE_BYTES`` of text (one text at least), so memory follows the longest text and not the batch.
A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_BYTES = 1 << 18

# The bytes that separate words.
WHITE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)


def table_of(members: bytes) -> np.ndarray:
    """A truth table over byte values."""
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(members, dtype=np.uint8)] = True
    return table


WHITE = table_of(WHITE_BYTES)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_LETTER = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_LETTER_FOLDED = _LETTER[LOWER]
_powers: list[np.ndarray] = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = 1 << int(n).bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            powers = np.full(size, base, dtype=U64)
            powers[0] = 1
            _powers[i] = np.cumprod(powers, dtype=U64)
    return _powers[0], _powers[1]


@dataclass
class Slice:
    """Some rows of a batch: their bytes end to end and where each row starts."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> str:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes().decode("utf-8", "replace")


@dataclass
class Spans:
    """Byte spans in row order; ``bounds[r]`` is the first span of row ``r``."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def slices(column: pa.Array, limit: int | None = None) -> Iterator[Slice]:
    """Cut a string column into slices of about ``limit`` bytes, whole rows each."""
    limit = limit or SLICE_BYTES
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, n)
        yield Slice(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def runs(member: np.ndarray, offsets: np.ndarray) -> Spans:
    """Maximal runs of true values, cut at row starts."""
    n = len(member)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Spans(none, none, np.zeros(len(offsets), dtype=np.int64))
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = member[:-1]
    start = np.flatnonzero(member & (~before | edge[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = member[1:]
    end = np.flatnonzero(member & (~after | edge[1:])) + 1
    return Spans(start, end, np.searchsorted(start, offsets))


def words(piece: Slice) -> Spans:
    """Runs of bytes that are not white space."""
    return runs(~WHITE[piece.data], piece.offsets)


def lines(piece: Slice) -> Spans:
    """The parts between newlines, empty ones included; an empty text has one empty line."""
    breaks = np.flatnonzero(piece.data == 10)
    offsets = piece.offsets
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    end = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    per_row = np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1
    return Spans(start, end, np.concatenate([[0], np.cumsum(per_row)]))


def span_hashes(data: np.ndarray, spans: Spans, fold: bool) -> np.ndarray:
    """A 64-bit hash of the bytes of every span, A-Z read as a-z if ``fold``."""
    n = len(data)
    forth, back = _power(n + 1)
    sums = np.empty(n + 1, dtype=U64)
    sums[0] = 0
    np.cumsum((_LETTER_FOLDED if fold else _LETTER)[data] * forth[:n], out=sums[1:])
    h = (sums[spans.end] - sums[spans.start]) * back[spans.start]
    return mix(h + (spans.end - spans.start).astype(U64) * U64(0xA0761D6478BD642F))


def windows(hashes: np.ndarray, bounds: np.ndarray, size: int, whole_if_shorter: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` items: (window hash, first item, bounds per row).

    A row with fewer items, but at least one, gives its whole sequence as one window if ``whole_if_shorter``.
    """
    counts = np.diff(bounds)
    per_row = np.maximum(counts - size + 1, 0)
    short = (counts > 0) & (counts < size) & whole_if_shorter
    out_bounds = np.concatenate([[0], np.cumsum(per_row + short)])
    row = np.repeat(np.arange(len(counts)), per_row + short)
    first = bounds[row] + np.arange(len(row)) - out_bounds[row]
    length = np.minimum(counts[row], size)
    h = np.zeros(len(row), dtype=U64)
    for j in range(size):
        inside = length > j
        if inside.all():
            h = h * U64(0xC2B2AE3D27D4EB4F) + hashes[first + j]
        elif inside.any():
            h[inside] = h[inside] * U64(0xC2B2AE3D27D4EB4F) + hashes[first[inside] + j]
    return mix(h + length.astype(U64)), first, out_bounds


def distinct_sets(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct values of every row."""
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def shingle_sets(piece: Slice, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct word shingles (A-Z lowered) of every row."""
    found = words(piece)
    hashes = span_hashes(piece.data, found, fold=True)
    h, _, bounds = windows(hashes, found.bounds, size, whole_if_shorter=True)
    return distinct_sets(h, bounds)


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive values per row."""
    total = np.concatenate([np.zeros(1, dtype=values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` with ``fn`` giving dicts of columns for every non-empty batch."""
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for columns in fn(batch):
                    arrays = [_as(columns[f.name], f.type) for f in target]
                    yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)


def _as(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column out of one array per row."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64) if flat.dtype == U64 else flat).cast(kind))


def added(schema: T.StructType, extra: list[T.StructField]) -> tuple[list[str], T.StructType]:
    """Columns kept from a frame, and the schema with ``extra`` put behind them; a clashing column is replaced."""
    names = {f.name.lower() for f in extra}
    kept = [f for f in schema.fields if f.name.lower() not in names]
    return [f.name for f in kept], T.StructType(kept + extra)
