"""Words of many texts at once in numpy: places and 64-bit hashes, used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import xxhash

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
BATCH_BYTES = 1 << 19
"""Bytes of text that are handled at once. A longer text makes a batch of its own."""

LONG_WORD = 32
"""Longer words are hashed one by one: on long regular words, a polynomial modulo 2 ** 64 gives equal values."""

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, 1 << max(19, int(n).bit_length()))[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Words of a batch: `starts` and `ends` in `raw`; words of text i are offsets[i] to offsets[i + 1]."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray


def encode(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def words_of(texts: list[bytes], lower: bool = False) -> Words:
    """Words of texts. They never run across texts."""
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        raw = LOWER[raw]
    space = IS_SPACE[raw]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
    summed = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), out=summed[1:])
    hashes = mix((summed[ends] - summed[starts]) * powers(INVERSE, len(raw))[starts] + (ends - starts).astype(np.uint64))
    view = memoryview(raw)
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(view[starts[i] : ends[i]])
    return Words(raw, starts, ends, offsets, hashes)


def sequences(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from every place on; the last k - 1 places are left out."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out += hashes[i : i + n] * np.uint64(pow(INVERSE, i + 2, 1 << 64))
    return mix(out + np.uint64(k))


def batches(sizes: list[int], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about `limit` bytes each."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
