"""Vectorised word and shingle hashing over Arrow string batches.

A batch is read as one byte buffer plus document offsets; hashes of words are
differences of a running polynomial sum (arithmetic modulo 2**64), so no
Python loop runs over characters or words. NULL text counts as empty text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15                     # odd, so it has an inverse modulo 2**64
BASE_INV = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 2 << 20
WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (bijective xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: One random 64-bit value per byte value, made by rule.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i <= n, kept for the largest n asked so far."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = _powers[base] = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return have


def forget() -> None:
    """Free the kept powers (32 MB and more): a worker that goes on to other work has no use for them."""
    _powers.clear()


def give_back() -> None:
    """Hand freed memory back to the system; otherwise Arrow and the C library keep it (some 170 MB after encoding) for a worker that may not ask again."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):       # glibc has it
        trim(0)


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]] if len(column) else raw[:0], offsets - offsets[0]


def blocks(raw: np.ndarray, offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, end document, bytes, offsets) of runs of whole documents of about ``size`` bytes."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        yield first, end, raw[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def word_hashes(raw: np.ndarray, offsets: np.ndarray, split_marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word index of each document plus the end).

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; with ``split_marks``
    runs of ASCII punctuation are words of their own.
    """
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    lower = _LOWER[raw]
    inside = ~_SPACE[raw]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    starts_at, ends_at = inside.copy(), inside.copy()
    starts_at[1:] &= ~inside[:-1]
    starts_at[cuts] = inside[cuts]
    ends_at[:-1] &= ~inside[1:]
    ends_at[cuts - 1] = inside[cuts - 1]
    if split_marks:
        mark = _MARK[raw]
        turn = inside[1:] & inside[:-1] & (mark[1:] != mark[:-1])
        starts_at[1:] |= turn
        ends_at[:-1] |= turn
    starts, ends = np.flatnonzero(starts_at), np.flatnonzero(ends_at) + 1
    up, down = powers(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[lower] * up[:len(raw)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets).astype(np.int64)


def shingle_hashes(words: np.ndarray, first: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each n-word shingle, first shingle index of each document plus the end).

    A document of fewer than ``n`` words has one shingle, its whole sequence;
    one without words has none.
    """
    counts = np.diff(first)
    out_counts = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    out_first = np.zeros(len(first), np.int64)
    np.cumsum(out_counts, out=out_first[1:])
    total = int(out_first[-1])
    doc = np.repeat(np.arange(len(counts)), out_counts)
    at = first[:-1][doc] + (np.arange(total) - out_first[:-1][doc])
    length = np.minimum(counts[doc], n)
    h = np.full(total, 0x2545F4914F6CDD1D, np.uint64)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    for k in range(n):
        use = length > k
        h = np.where(use, mix(h * np.uint64(BASE) + padded[at + k]), h) if not use.all() else mix(h * np.uint64(BASE) + padded[at + k])
    return h, out_first
