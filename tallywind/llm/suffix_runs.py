"""Sorted runs of suffixes: front coding, and a merge by a loser tree that knows common prefixes.

All keys of a run have one width, are distinct and ascending. A run is kept front-coded: for every key the length of the
prefix it has in common with the key before it, and the rest of its bytes.

The tree merges runs without looking at a known prefix twice. Every run's head carries the length of its common prefix
with the key given out last; for a run's next key that is the length its front coding states. Of two heads the one with
the longer prefix is smaller. Only at equal lengths are bytes compared, from that length on, and the place where they
differ becomes the prefix length of the loser. Equal keys of several runs come out one after the other with the whole width
as common prefix, so duplicates are met without any comparison of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_CODEC = "zstd"


def packed(*arrays: np.ndarray) -> bytes:
    """Some arrays as one compressed value; ``unpacked`` takes their types in the same order."""
    sizes = np.array([len(arrays), *[a.nbytes for a in arrays]], dtype=np.int64)
    raw = sizes.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec=_CODEC, asbytes=True)


def unpacked(body: bytes, *kinds: str) -> list[np.ndarray]:
    raw = pa.decompress(body[8:], int.from_bytes(body[:8], "little"), codec=_CODEC, asbytes=True)
    count = int.from_bytes(raw[:8], "little")
    sizes = np.frombuffer(raw, dtype=np.int64, count=count, offset=8)
    at, out = 8 * (count + 1), []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(raw, dtype=kind, count=size // np.dtype(kind).itemsize, offset=at))
        at += size
    return out


def sort_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, whether a key is new) for the rows of a byte matrix."""
    n, width = keys.shape
    order = np.argsort(np.ascontiguousarray(keys).view(f"S{width}").ravel(), kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = (keys[order[1:]] != keys[order[:-1]]).any(axis=1)
    return order, new


def common_prefixes(keys: np.ndarray) -> np.ndarray:
    """For each of some distinct sorted keys the length of its common prefix with the one before; 0 for the first."""
    out = np.zeros(len(keys), dtype=np.uint8)
    out[1:] = (keys[1:] != keys[:-1]).argmax(axis=1)
    return out


def front_coded(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix lengths, the rests end to end) of distinct sorted keys."""
    known = common_prefixes(keys)
    return known, keys[np.arange(keys.shape[1]) >= known[:, None]]


def merged(runs: list[tuple[np.ndarray, bytes]], width: int) -> Iterator[tuple[int, int, int, bytes]]:
    """All keys of front-coded runs in order: (common prefix with the key before, run, place in the run, key)."""
    count = len(runs)
    if not count:
        return
    size = 1 << max(0, (count - 1).bit_length())
    known = [r[0].tolist() for r in runs]
    rest = [bytes(r[1]) for r in runs]
    place, at = [0] * count, [0] * count
    key: list[bytes] = [b""] * size
    prefix = [-1] * size  # an ended run loses to every other
    for r in range(count):
        if known[r]:
            key[r], prefix[r], at[r] = rest[r][:width], 0, width
    losers = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two heads; the loser's prefix is then that with the winner."""
        if prefix[a] != prefix[b]:
            return (a, b) if prefix[a] > prefix[b] else (b, a)
        i = prefix[a]
        if i < 0:
            return a, b
        x, y = key[a], key[b]
        while i < width and x[i : i + 8] == y[i : i + 8]:
            i += 8
        if i >= width:
            prefix[b] = width
            return a, b
        while x[i] == y[i]:
            i += 1
        if x[i] < y[i]:
            prefix[b] = i
            return a, b
        prefix[a] = i
        return b, a

    winners = list(range(size))
    while len(winners) > 1:
        level = len(winners) // 2
        pairs = [play(winners[2 * i], winners[2 * i + 1]) for i in range(level)]
        losers[level : 2 * level] = [loser for _, loser in pairs]
        winners = [winner for winner, _ in pairs]
    head = winners[0]
    while prefix[head] >= 0:
        yield prefix[head], head, place[head], key[head]
        place[head] += 1
        if place[head] < len(known[head]):
            same = known[head][place[head]]
            start = at[head]
            at[head] = start + width - same
            key[head] = key[head][:same] + rest[head][start : at[head]]
            prefix[head] = same
        else:
            key[head], prefix[head] = b"", -1
        node = (head + size) >> 1
        while node:
            other = losers[node]
            # The frequent cases of play(), without a call.
            if prefix[other] < prefix[head]:
                pass
            elif prefix[other] > prefix[head]:
                losers[node], head = head, other
            else:
                head, losers[node] = play(head, other)
            node >>= 1
