"""Token ids of a byte-level BPE vocabulary for whole batches.

The vocabulary's pre-tokenizer cuts a text into chunks that are encoded on their own. The cutting is done for a slice
of texts at once on arrays of code points, and the ``tokenizers`` library encodes each different chunk once; ids are
remembered by chunk in a table of fixed size. Texts that name a special token or hold a code point whose kind is not
settled between Unicode versions are given to the library whole, so ids are always the library's.

Chunks are remembered by 64-bit hash: a look-up of a chunk that is not there errs with probability 2**-43.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from tallywind.llm import text as X

SLOTS = 1 << 20
POOL = 1 << 23

# The pre-tokenizer's contractions, and Unicode's white space.
CONTRACTIONS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]
WHITE_RANGES = [(9, 13), (32, 32), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]

OTHER, LETTER, NUMBER, SPACE, WHITE, UNSETTLED = range(6)


def kinds() -> np.ndarray:
    """Kind of every code point; what this Unicode version leaves unassigned is unsettled."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))
        out[c] = {"L": LETTER, "N": NUMBER}.get(category[0], UNSETTLED if category == "Cn" else OTHER)
    # Letters and numbers of the newest versions are judged by the library.
    newer = [c for c in range(0x110000) if out[c] in (LETTER, NUMBER) and unicodedata.ucd_3_2_0.category(chr(c)) == "Cn"]
    out[newer] = UNSETTLED
    for low, high in WHITE_RANGES:
        out[low : high + 1] = WHITE
    out[32] = SPACE
    return out


def chunk_starts(points: np.ndarray, kind: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Where chunks start. ``edge`` marks text starts (one entry more than points)."""
    n = len(points)
    group = np.minimum(kind, SPACE)
    change = np.ones(n, dtype=bool)
    change[1:] = group[1:] != group[:-1]
    change |= edge[:n]
    starts = change.copy()
    # White space before a word: its last character stands alone or, if a space, joins the word.
    at = np.flatnonzero(change)
    end = np.append(at[1:], n)
    white = (group[at] == SPACE) & (end < n)
    end = end[white]
    end = end[~edge[end]]
    starts[end - 1] = True
    starts[end[kind[end - 1] == SPACE]] = False
    # Contractions: a quote that starts a chunk alone takes the letters that belong to it.
    quote = np.flatnonzero((points == 0x27) & starts)
    quote = quote[quote + 1 < n]
    quote = quote[change[quote + 1] & ~edge[quote + 1]]
    if len(quote):
        first = points[quote + 1]
        after = np.minimum(quote + 2, n - 1)
        second = np.where((quote + 2 < n) & ~edge[after], points[after], 0)
        for word in CONTRACTIONS:
            hit = first == ord(word[1])
            if len(word) == 3:
                hit &= second == ord(word[2])
            place = quote[hit]
            starts[place + 1] = False
            place = place + len(word)
            starts[place[place < n]] = True
    return np.flatnonzero(starts)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [str(t.content).encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kinds = kinds()
        self.letters = X.mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(SLOTS, dtype=np.uint64)
        self.at = np.zeros(SLOTS, dtype=np.int64)
        self.length = np.zeros(SLOTS, dtype=np.int64)
        self.pool = np.zeros(POOL, dtype=np.int32)
        self.used = 0

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids as the library gives them for whole texts."""
        return [np.array(e.ids, dtype=np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, piece: X.Slice) -> list[np.ndarray]:
        """Ids of every text of a slice."""
        raw = piece.data.tobytes()
        try:
            points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        except UnicodeDecodeError:
            return self.whole([piece.text(r) for r in range(piece.rows)])
        if not len(points):
            return [np.zeros(0, dtype=np.int32)] * piece.rows
        begins = np.concatenate([[0], np.cumsum((piece.data & 0xC0) != 0x80)])[piece.offsets]
        edge = np.zeros(len(points) + 1, dtype=bool)
        edge[begins] = True
        kind = self.kinds[points]
        alone = X.row_sums((kind == UNSETTLED).astype(np.int64), begins) > 0
        if any(word in raw for word in self.special):
            alone |= [any(word in piece.data[a:b].tobytes() for word in self.special) for a, b in zip(piece.offsets[:-1], piece.offsets[1:], strict=True)]
        start = chunk_starts(points, kind, edge)
        end = np.append(start[1:], len(points))
        row_chunks = np.searchsorted(start, begins)
        ids, bounds = self._chunks(points, start, end)
        out = np.split(ids, bounds[row_chunks][1:-1])
        for row, found in zip(np.flatnonzero(alone), self.whole([piece.text(r) for r in np.flatnonzero(alone)]), strict=True):
            out[row] = found
        return out

    def _chunks(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks end to end, and where each chunk's begin."""
        forth, back = X._power(len(points) + 1)
        sums = np.empty(len(points) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(self.letters[points] * forth[: len(points)], out=sums[1:])
        h = X.mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
        h[h == 0] = 1
        slot = (h >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
        missing = np.flatnonzero(self.keys[slot] != h)
        begin, size = self.at[slot], self.length[slot]
        if len(missing):
            fresh, first, which = np.unique(h[missing], return_index=True, return_inverse=True)
            place = missing[first]
            found = self.whole([points[a:b].tobytes().decode("utf-32-le") for a, b in zip(start[place], end[place], strict=True)])
            sizes = np.array([len(f) for f in found], dtype=np.int64)
            if self.used + sizes.sum() > POOL:
                self._clear()
                if sizes.sum() > POOL:
                    self.pool = np.zeros(int(sizes.sum()), dtype=np.int32)
                return self._chunks(points, start, end)
            at = self.used + np.concatenate([[0], np.cumsum(sizes)[:-1]])
            self.pool[self.used : self.used + sizes.sum()] = np.concatenate(found)
            self.used += int(sizes.sum())
            to = (fresh >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
            self.keys[to], self.at[to], self.length[to] = fresh, at, sizes
            begin[missing], size[missing] = at[which], sizes[which]
        bounds = np.concatenate([[0], np.cumsum(size)])
        where = np.repeat(begin - bounds[:-1], size) + np.arange(bounds[-1])
        return self.pool[where], bounds


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per vocabulary file and Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
