"""Words and n-grams of many texts at once, on the bytes of an Arrow column.

Texts stay the UTF-8 bytes that Arrow holds; words are found by a table over
byte values, so that one numpy step covers all texts of a piece. A piece holds
a bounded number of text bytes (one text at least), which bounds memory.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words that end at ASCII white space only.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words of ASCII letters, digits, and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def draws(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit values, the same on every machine."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = draws(256, 11)
_BASE = np.uint64(0xD1342543DE82EF95)  # odd, so it has an inverse
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE_BYTES + 1), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 2 * PIECE_BYTES:
            _powers[int(base)] = have
    return have[:n]


@dataclass
class Words:
    """Words in order: where each starts and ends, its text's index, its hash."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # index of each text's first word; one more entry than texts


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins; null counts as empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` text bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < len(total):
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def freed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The batch function, after which a reused worker gives its memory back.

    Otherwise what one task held stays with the process through all later stages.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    """Return freed memory to the system."""
    _powers.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def find_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: bool = True) -> Words:
    """Maximal runs of bytes in the table ``inside``; never across texts."""
    n = len(data)
    texts = len(offsets) - 1
    if n == 0:
        empty = np.zeros(0, np.int64)
        return Words(empty, empty, empty, np.zeros(0, np.uint64), np.zeros(texts + 1, np.int64))
    if lower:
        data = LOWER[data]
    is_in = inside[data]
    begins = is_in.copy()
    begins[1:] &= ~is_in[:-1]
    stops = is_in.copy()
    stops[:-1] &= ~is_in[1:]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    begins[filled] = is_in[filled]
    lasts = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    stops[lasts] = is_in[lasts]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(stops) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(texts), np.diff(first))
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power(_BASE, n), out=total[1:])
        value = mix((total[end] - total[start]) * _power(_INVERSE, n)[start] + (end - start).astype(np.uint64))
    return Words(start, end, doc, value, first)


_STEP = draws(64, 23) | np.uint64(1)


def ngrams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every run of n words within a text, in order."""
    count = len(words.hash) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        value = words.hash[:count] * _STEP[0]
        for k in range(1, n):
            value = value + words.hash[k : k + count] * _STEP[k % 64]
    kept = words.doc[:count] == words.doc[n - 1 : n - 1 + count]
    return mix(value[kept]), words.doc[:count][kept]


def per_text(values: np.ndarray, docs: np.ndarray, texts: int) -> np.ndarray:
    """Where each text's values begin in ``values``; one more entry than texts."""
    return np.searchsorted(docs, np.arange(texts + 1))
