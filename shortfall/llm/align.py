"""Cross-tokenizer alignment by white-space anchors (operator 13).

Every text, with a space before it, is encoded whole by a byte-level BPE (A) and a SentencePiece model (B, which adds
the space itself). Both give the same bytes, so a byte offset where tokens of both end cuts them into groups.

* Anchors: shared ends before a token that begins with a space. They split a text into windows of token ids, in
  practice words.
* The windows of a block of texts are remembered by their id tuples (ids of A, ids of B): each distinct one is aligned
  once, all of them together, and the alignment of a text is gathered from its windows.
* A link joins the two tokens that end at a shared offset, so the bytes of one end with those of the other. The id
  pairs that can ever be linked are thus bounded by the two vocabularies (:class:`Pairs`), whatever the corpus, and a link is stored as
  the number of its pair. Corpus-wide counts are one number a pair: summed per task, then over tasks.

Defined results: texts that are NULL, empty or not given back byte by byte by both tokenizers have no tokens (zeros, empty
groups); rows are independent, so NULL and repeated doc_ids come through; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.llm import pieces, tokens
from shortfall.llm.text import blocks, buffers
from shortfall.llm.tokens import ragged, taken
from shortfall.session import pin, pin_folder

BLOCK_BYTES = 1 << 20
#: Bound of what a worker keeps of each tokenizer's chunks: here it holds both.
KEPT_BYTES = 20 << 20


class Vocabulary:
    """Bytes of each id, one after another."""

    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.lengths = np.array([len(x) for x in entries], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)
        self.array = pa.array(entries, pa.large_binary())


@lru_cache(maxsize=2)
def byte_level(path: str) -> Vocabulary:
    """Entries of a byte-level vocabulary: printable bytes stand for themselves, the others for code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    vocabulary = tokens.load(path).get_vocab(with_added_tokens=False)
    entries = [b""] * (max(vocabulary.values()) + 1)
    for text, i in vocabulary.items():
        entries[i] = bytes(byte_of[c] for c in text) if all(c in byte_of for c in text) else b""
    return Vocabulary(entries)


@lru_cache(maxsize=2)
def piece_level(path: str) -> Vocabulary:
    model = pieces.load(path)
    return Vocabulary(model.raw)


class Pairs:
    """The id pairs that can be linked: the bytes of one entry end with those of the other. There are at most as many
    as the vocabularies have bytes (times the ids that share their bytes)."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        def by_bytes(v: Vocabulary) -> dict[bytes, list[int]]:
            out: dict[bytes, list[int]] = {}
            for i, x in enumerate(v.entries):
                if x:
                    out.setdefault(x, []).append(i)
            return out

        of_a, of_b = by_bytes(a), by_bytes(b)
        found = array("q", (i << 32 | j for x, ids in of_a.items() for k in range(len(x)) for j in of_b.get(x[k:], ()) for i in ids))
        found.extend(i << 32 | j for x, ids in of_b.items() for k in range(len(x)) for i in of_a.get(x[k:], ()) for j in ids)
        self.key = np.unique(np.array(found, np.int64))

    def __len__(self) -> int:
        return len(self.key)

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.key, a.astype(np.int64) << np.int64(32) | b.astype(np.int64)).astype(np.int32)

    @property
    def b(self) -> np.ndarray:
        return self.key & np.int64(0xFFFFFFFF)

    @property
    def a(self) -> np.ndarray:
        return self.key >> np.int64(32)


@lru_cache(maxsize=2)
def linkable(a_path: str, b_path: str) -> Pairs:
    return Pairs(byte_level(a_path), piece_level(b_path))


@lru_cache(maxsize=2)
def _digits(n: int) -> Vocabulary:
    return Vocabulary([str(i).encode() for i in range(n)])


def _whole(parts: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of all runs that an encoder gives."""
    ids, counts = [], []
    for _, x, at in parts:
        ids.append(x)
        counts.append(np.diff(at))
    return np.concatenate(ids).astype(np.int64), np.r_[0, np.cumsum(np.concatenate(counts))].astype(np.int64)


def _given_back(raw: bytes, offsets: list[int], vocabulary: Vocabulary, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per text: whether its tokens' bytes are its bytes."""
    joined, ends = taken(vocabulary.array, ids)
    joined, ends = joined.tobytes(), ends[at].tolist()
    return np.array([joined[a:b] == raw[x:y] for a, b, x, y in zip(ends, ends[1:], offsets, offsets[1:])], bool)


def _groups(ids: np.ndarray, last: np.ndarray, digits: Vocabulary, inner: bytes, outer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, length per token) of ids in decimals, each followed by ``inner`` or, where ``last``, ``outer``."""
    size = digits.lengths[ids] + 1
    out = np.empty(int(size.sum()), np.uint8)
    end = np.cumsum(size)
    out[ragged(end - size, size - 1)] = digits.bytes[ragged(digits.starts[ids], size - 1)]
    out[end - 1] = np.where(last, outer[0], inner[0])
    return out, size


def _align(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, a_shared: np.ndarray, b_shared: np.ndarray,
           pairs: Pairs, digits: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(groups as bytes, offsets per window, pair numbers, offsets per window) of windows of tokens, given which tokens end at shared offsets."""
    a_text, a_size = _groups(a, a_shared, digits, b",", b"|")
    b_text, b_size = _groups(b, b_shared, digits, b",", b";")
    # a group is its tokens of A, then those of B
    a_group, b_group = np.cumsum(a_shared) - a_shared, np.cumsum(b_shared) - b_shared
    count = int(a_shared.sum())
    a_len = np.bincount(a_group, a_size, count).astype(np.int64)
    b_len = np.bincount(b_group, b_size, count).astype(np.int64)
    both = a_len + b_len
    start = np.cumsum(both) - both
    out = np.empty(len(a_text) + len(b_text), np.uint8)
    out[ragged(start, a_len)], out[ragged(start + a_len, b_len)] = a_text, b_text
    numbers = pairs.numbers(a[a_shared], b[b_shared])
    groups_at = np.r_[0, np.cumsum(a_shared)][a_at]                # groups before each window
    return out, np.r_[0, np.cumsum(both)][groups_at], numbers, groups_at


def _coded(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, int]:
    """(code per window, number of codes): windows of the same ids have the same code."""
    data = ids.astype(np.uint16 if len(ids) and ids.max() < 1 << 16 else np.uint32)
    windows = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * data.itemsize).astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
    return windows.indices.to_numpy().astype(np.int64), len(windows.dictionary)


def align_block(column: pa.Array, a_path: str, b_path: str) -> tuple[np.ndarray, ...]:
    """(n_a, n_b, n_groups per text; groups as bytes ending in ';', offsets; pair numbers, offsets) of a run of texts."""
    n = len(column)
    text = pc.fill_null(column, "").cast(pa.large_string())
    spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string()))
    a, a_at = _whole(tokens.encode(spaced, a_path, special=False, kept_bytes=KEPT_BYTES // 4))
    b, b_at = _whole(pieces.encode(text, b_path, KEPT_BYTES))
    raw, offsets = buffers(spaced)
    va, vb = byte_level(a_path), piece_level(b_path)
    data, ends = raw.tobytes(), offsets.tolist()
    good = (np.diff(offsets) > 1) & _given_back(data, ends, va, a, a_at) & _given_back(data, ends, vb, b, b_at)
    keep = lambda ids, at: ids[np.repeat(good, np.diff(at))]
    n_a, n_b = np.where(good, np.diff(a_at), 0), np.where(good, np.diff(b_at), 0)
    a, b = keep(a, a_at), keep(b, b_at)
    zeros = np.zeros(n + 1, np.int64)
    if not len(a):
        return n_a, n_b, zeros[1:], np.zeros(0, np.uint8), zeros, np.zeros(0, np.int32), zeros
    raw = raw[np.repeat(good, np.diff(offsets))]

    # shared ends, and the windows between anchors
    a_end, b_end = np.cumsum(va.lengths[a]), np.cumsum(vb.lengths[b])
    mark = np.zeros(len(raw) + 1, np.uint8)
    mark[a_end] = 1
    mark[b_end] += 2
    a_shared, b_shared = mark[a_end] == 3, mark[b_end] == 3
    begins = np.r_[raw == 0x20, True]
    begins[np.cumsum(np.diff(offsets)[good])] = True               # a text's end is an anchor, too
    a_last, b_last = np.flatnonzero(a_shared & begins[a_end]), np.flatnonzero(b_shared & begins[b_end])
    a_win, b_win = np.r_[0, a_last + 1], np.r_[0, b_last + 1]
    window_end = np.r_[0, a_end[a_last]]

    # windows by their id tuples: each is aligned once
    a_code, _ = _coded(a, a_win)
    b_code, b_codes = _coded(b, b_win)
    _, w, code = np.unique(a_code * np.int64(b_codes) + b_code, return_index=True, return_inverse=True)
    pick = lambda win: (ragged(win[w], win[w + 1] - win[w]), np.r_[0, np.cumsum(win[w + 1] - win[w])])
    (ai, a_new), (bi, b_new) = pick(a_win), pick(b_win)
    known, known_at, numbers, numbers_at = _align(a[ai], a_new, b[bi], b_new, a_shared[ai], b_shared[bi], linkable(a_path, b_path), _digits(1 << 16))

    def gather(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        windows = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at * flat.itemsize), pa.py_buffer(flat)])
        data, ends = taken(windows, code)
        return data.view(flat.dtype), ends // flat.itemsize

    groups, groups_at = gather(known, known_at)
    links, links_at = gather(numbers, numbers_at)
    text_end = np.r_[0, np.cumsum(np.where(good, np.diff(offsets), 0))]
    window = np.searchsorted(window_end, text_end)                 # texts begin and end at anchors
    return n_a, n_b, np.diff(links_at[window]), groups, groups_at[window], links, links_at[window]


def align(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups_sha256, links[, groups]) of every text; ``links`` are pair numbers of :func:`linkable`,
    ``groups`` is ``a1,a2|b1;a3|b2`` in decimal ids."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links", "groups"][:6 + with_groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = buffers(batch.column(1))
            for first, end, _, _ in blocks(np.zeros(int(offsets[-1]), np.bool_), offsets, BLOCK_BYTES):
                pa.default_memory_pool().release_unused()
                n_a, n_b, n_groups, groups, at, links, links_at = align_block(batch.column(1).slice(first, end - first), a_path, b_path)
                data, ends = groups.tobytes(), at.tolist()
                each = [data[a:max(a, b - 1)] for a, b in zip(ends, ends[1:])]   # without the last ';'
                columns = [batch.column(0).slice(first, end - first), pa.array(n_a), pa.array(n_b), pa.array(n_groups),
                           pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in each], pa.string()),
                           pa.ListArray.from_arrays(pa.array(links_at.astype(np.int32)), pa.array(links))]
                if with_groups:
                    columns.append(pa.array([x.decode() for x in each], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<int>" + ", groups string" * with_groups
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _sliced(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in parts of a few texts, so that arrays with a number a link stay small."""
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def pair_counts(aligned: DataFrame, size: int) -> DataFrame:
    """(pair, n): how many links of all texts join each id pair; a task sums its links before they travel."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in _sliced(batch):
                total += np.bincount(part.column(0).flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(total)
        for part in np.array_split(some, max(1, len(some) // 50_000)):
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["pair", "n"])

    return aligned.select("links").mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def score(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``aligned`` with n_links, n_best and count_sum in place of its links."""
    pairs = linkable(a_path, b_path)
    rows = pair_counts(aligned, len(pairs)).toArrow()              # at most a row per linkable pair: bounded by the vocabularies
    counts = np.zeros(len(pairs), np.int64)
    counts[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    most = np.zeros(int(pairs.b.max()) + 1, np.int64)
    np.maximum.at(most, pairs.b, counts)
    shared = aligned.sparkSession.sparkContext.broadcast((counts, counts == most[pairs.b]))
    names = [c for c in aligned.columns if c != "links"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, best = shared.value
        for batch in (part for whole in batches for part in _sliced(whole)):
            links = batch.column("links")
            at = links.offsets.to_numpy().astype(np.int64)
            of = links.flatten().to_numpy()
            sums = lambda x: np.diff(np.r_[0, np.cumsum(x[of])][at - at[0]])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(np.diff(at)), pa.array(sums(best.astype(np.int64))), pa.array(sums(n))],
                                             [*names, "n_links", "n_best", "count_sum"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema if f.name != "links")
    return aligned.select(*names, "links").mapInArrow(add, schema + ", n_links long, n_best long, count_sum long")


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text."""
    aligned = pin(align(docs, a_path, b_path), "aligned", pin_folder(docs.sparkSession))
    return score(aligned, a_path, b_path).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
