"""Whole-text token ids of a batch of documents with the ``tokenizers`` library.

Both tokenizers used here split a text before byte-pair merging, and never
across the start of a run of white space or between an ASCII letter and ASCII
punctuation other than the apostrophe. A batch is cut at these places, each
distinct chunk is encoded once, and ids are gathered back in text order. This
gives the ids of encoding the whole text (tested), without encoding the same
word thousands of times. A text holding non-ASCII white space is one chunk.
The library takes the strings of special tokens out of a text first; so texts are cut
around them before anything else, unless they are to count as plain text.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shortfall.llm.text import blocks, buffers, forget, give_back

BLOCK_BYTES = 4 << 20
#: Bound of a worker's memory of encoded chunks, in bytes with their offsets.
KEPT_BYTES = 16 << 20
_KEPT_EACH = 16
#: Chunks given to the tokenizer at once; what it makes of them is many times as large.
_AT_ONCE = 8192
_kept: dict[str, tuple[pa.Array, pa.Array]] = {}

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def forget_all() -> None:
    """Free the kept chunks and tokenizers: for other work that goes on in a worker that has encoded texts."""
    _kept.clear()
    literals.cache_clear()
    load.cache_clear()
    give_back()


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer of a file; chunks that look like special tokens are ordinary text to it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@lru_cache(maxsize=4)
def literals(path: str) -> dict[bytes, int]:
    """Strings of the special tokens with their ids."""
    added = load(path).get_added_tokens_decoder()
    if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
        raise ValueError("special tokens that take their surroundings are not supported")
    return {t.content.encode(): i for i, t in added.items()}


def _find_literals(data: bytes, offsets: np.ndarray, path: str) -> list[tuple[int, int]]:
    """(start, end) of special tokens' strings that lie inside one text, in order and without overlap."""
    found = []
    for literal in literals(path):
        at = data.find(literal)
        while at >= 0:
            found.append((at, at + len(literal)))
            at = data.find(literal, at + 1)
    out, last = [], 0
    for start, end in sorted(found, key=lambda x: (x[0], -x[1])):
        text = int(np.searchsorted(offsets, start, side="right")) - 1
        if start >= last and end <= offsets[text + 1]:
            out.append((start, end))
            last = end
    return out


def _wide_space(raw: np.ndarray) -> np.ndarray:
    """Byte positions of non-ASCII white space."""
    at = np.flatnonzero((raw == 0xC2) | (raw == 0xE1) | (raw == 0xE2) | (raw == 0xE3))
    if not len(at):
        return at
    padded = np.concatenate([raw, np.zeros(2, np.uint8)])
    a, b, c = raw[at], padded[at + 1], padded[at + 2]
    return at[((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
              | ((a == 0xE2) & (((b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F))))
              | ((a == 0xE3) & (b == 0x80) & (c == 0x80))]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of many ranges, one after another."""
    ends = np.cumsum(lengths)
    out = np.arange(ends[-1] if len(ends) else 0)
    return out + np.repeat(starts - (ends - lengths), lengths)


def taken(entries: list[bytes] | pa.Array, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the entries of ``codes``, one after another."""
    entries = entries if isinstance(entries, pa.Array) else pa.array(entries, pa.large_binary())
    out = entries.take(pa.array(codes))
    offsets = np.frombuffer(out.buffers()[1], np.int64)[:len(codes) + 1]
    data = out.buffers()[2]
    return (np.frombuffer(data, np.uint8)[:offsets[-1]] if data is not None else np.zeros(0, np.uint8)), offsets


def _encode_new(path: str, chunks: pa.Array) -> pa.Array:
    """Ids of each chunk, by the tokenizer."""
    parts = [pa.array([], pa.large_binary())]
    for i in range(0, len(chunks), _AT_ONCE):
        words = chunks.slice(i, _AT_ONCE).to_pylist()
        encoded = load(path).encode(words, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(encoded.ids, np.uint32)
        ends = np.searchsorted(np.array(encoded.word_ids, np.int64), np.arange(len(words)), side="right") * 4
        parts.append(pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(np.r_[0, ends]), pa.py_buffer(ids)]))
    return pa.concat_arrays(parts)


def _encode_chunks(path: str, chunks: pa.Array, most: int) -> tuple[pa.Array, np.ndarray]:
    """(lists of ids, which of them each distinct chunk has); a worker keeps those of its first chunks, up to ``most`` bytes."""
    kept, ids = _kept.get(path) or (chunks.slice(0, 0), pa.array([], pa.large_binary()))
    found = pc.index_in(kept, chunks)                             # the side that is hashed is bounded by the block
    at, there = np.full(len(chunks), -1), np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
    at[found.drop_null().to_numpy()] = there
    new = np.flatnonzero(at < 0)
    at[new] = len(kept) + np.arange(len(new))
    fresh = chunks.take(pa.array(new))
    entries = pa.concat_arrays([ids, _encode_new(path, fresh)])
    if len(new) and (room := most - kept.nbytes - ids.nbytes) > 0:
        sizes = pc.add(pc.binary_length(fresh), pc.binary_length(entries.slice(len(kept)))).to_numpy() + _KEPT_EACH
        more = int(np.searchsorted(np.cumsum(sizes), room))
        _kept[path] = pa.concat_arrays([kept, fresh.slice(0, more)]), pa.concat_arrays([entries.slice(0, len(kept) + more)])
    return entries, at


def _encode_block(raw: np.ndarray, offsets: np.ndarray, path: str, lower: bool, special: bool, kept_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets into them per text) of a block of texts."""
    space, cut = _SPACE[raw], np.zeros(len(raw) + 1, bool)
    cut[1:-1] = (space[1:] & ~space[:-1]) | (_LETTER[raw[:-1]] & _MARK[raw[1:]])
    del space
    data = np.ascontiguousarray(_LOWER[raw] if lower else raw)
    for doc in np.unique(np.searchsorted(offsets, _wide_space(raw), side="right") - 1).tolist():
        whole = slice(offsets[doc], offsets[doc + 1])
        cut[whole] = False
        if lower:
            data[whole] = raw[whole]                           # nothing may look like a special token only now
    apart = _find_literals(raw.tobytes(), offsets, path) if special else []
    for a, b in apart:
        cut[a:b] = False
        cut[[a, b]] = True
    cut[offsets] = True
    bounds = np.flatnonzero(cut)
    del cut
    chunks = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
    entries, places = _encode_chunks(path, chunks.dictionary, kept_bytes)
    codes = places[chunks.indices.to_numpy()]
    del chunks, data
    if apart:
        ids = literals(path)
        codes[np.searchsorted(bounds, [a for a, _ in apart])] = len(entries) + np.arange(len(apart))
        entries = pa.concat_arrays([entries, pa.array([np.uint32(ids[raw[a:b].tobytes()]).tobytes() for a, b in apart], pa.large_binary())])
    ids, ends = taken(entries, codes)
    return ids.view(np.uint32), ends[np.searchsorted(bounds, offsets)] // 4


def encode(column: pa.Array, path: str, lower: bool = False, special: bool = True, kept_bytes: int = KEPT_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids as uint32, offsets into them per row) for runs of rows of about 4 MB.

    ``lower`` says that the tokenizer lower-cases, so that chunks may be lower-cased before they are compared.
    ``special`` gives the strings of special tokens their ids, as the library does by default.
    """
    forget()
    give_back()
    for first, end, raw, offsets in blocks(*buffers(column), BLOCK_BYTES):
        n = end - first
        if not len(raw):
            yield first, np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
            continue
        yield first, *_encode_block(raw, offsets, path, lower, special, kept_bytes)
        give_back()
