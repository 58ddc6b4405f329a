"""Benchmark decontamination (operator 7): size-partitioned MinHash containment
search for short test items inside long documents, verified exactly.

A long document has a tiny Jaccard similarity to a short item, so domains are
partitioned by size: for items of up to ``s`` shingles (``s`` a power of two) a
document is searched as windows of ``2 s`` shingles at a stride of ``s``. Any
stretch of ``s`` shingles lies in one window, hence an item with containment
``t`` in a stretch has a Jaccard similarity of at least
``t q / (2 s + q - t q)`` to that window, about 0.18 at the worst for ``t`` = 0.75.
With ``HASHES`` min-hashes compared one by one (bands of one row) a window as
similar as that is missed with a probability of 4e-6. Windows of all sizes come from one
pass: the minimum over a window is the minimum over its halves.

Candidates are verified by the share of the item's distinct 5-word shingles that
occur in the whole document. The items are taken in blocks of at most
``BLOCK_SHINGLES`` shingles (one pass over the documents each), so what is broadcast is bounded.

Defined results: NULL or empty texts and items match nothing; an item of fewer than five words is one shingle, its whole
sequence, which only a text of just these words holds; repeated rows are reported once per row of the document and distinct item row; empty tables
give no rows; ``item_id`` or ``doc_id`` may be NULL and is returned as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.llm import text as T

CONTAINMENT = 0.75
HASHES = 64
BLOCK_SHINGLES = 1 << 20
LEAST_WINDOW = 8
_FILTER_BITS = 22

_MULTIPLY = (T.mix(np.arange(1, HASHES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ADD = (T.mix(np.arange(1001, HASHES + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_NONE = np.uint32(0xFFFFFFFF)


def _min_hash(short: np.ndarray, k: int) -> np.ndarray:
    """Hash ``k`` of 32-bit shingle hashes."""
    x = short * _MULTIPLY[k] + _ADD[k]
    x ^= x >> np.uint32(15)
    return x * np.uint32(0x85EBCA6B)


def _short(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32)


def _slot(values: np.ndarray, k: int) -> np.ndarray:
    return (values ^ _ADD[k]) >> np.uint32(32 - _FILTER_BITS)


class ItemBlock:
    """Shingles and min-hash keys of a bounded block of items, by size class."""

    def __init__(self, items: list[tuple[int, str]], n: int):
        raw, offsets = T.buffers(pa.array([t for _, t in items], pa.string()))
        words, first = T.word_hashes(raw, offsets)
        hashes, at = T.shingle_hashes(words, first, n)
        enough = np.diff(at) > 0                # fewer words than n: the whole sequence is one shingle
        self.ids, self.sets = [], []
        for i, (item, _) in enumerate(items):
            if enough[i]:
                self.ids.append(item)
                self.sets.append(np.unique(hashes[at[i]:at[i + 1]]))
        self.classes = {}                       # s -> for each hash: sorted least values, item of each
        sizes = np.array([max(LEAST_WINDOW, 1 << (len(s) - 1).bit_length()) for s in self.sets], np.int64)
        for s in np.unique(sizes).tolist():
            members = np.flatnonzero(sizes == s)
            tables = []
            for k in range(HASHES):
                values = np.array([_min_hash(_short(self.sets[i]), k).min() for i in members], np.uint32)
                order = np.argsort(values, kind="stable")
                tables.append((values[order], members[order]))
            self.classes[s] = tables
        self.filters: dict[int, np.ndarray] = {}

    def __getstate__(self):
        return {**self.__dict__, "filters": {}}                # made anew on the executors

    def filter(self, s: int) -> np.ndarray:
        """Hashed set of all least values of a size class, to pass over most windows at once."""
        if s not in self.filters:
            seen = self.filters[s] = np.zeros(1 << _FILTER_BITS, bool)
            for k, (values, _) in enumerate(self.classes[s]):
                seen[_slot(values, k)] = True
        return self.filters[s]

    def candidates(self, hashes: np.ndarray, at: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs that share a min-hash in some window."""
        counts = np.diff(at)
        parts = -(-counts // LEAST_WINDOW)                           # least half-windows of each document
        begin = np.cumsum(parts) - parts
        short = np.full(int(parts.sum()) * LEAST_WINDOW, _NONE, np.uint32)
        filled = np.zeros(len(short), bool)
        doc = np.repeat(np.arange(len(counts)), counts)
        place = begin[doc] * LEAST_WINDOW + (np.arange(len(hashes)) - at[:-1][doc])
        short[place], filled[place] = _short(hashes), True
        full = bool(filled.all())
        found: set[tuple[int, int]] = set()
        if not len(short) or not self.classes:
            return found
        for k in range(HASHES):
            level = _min_hash(short, k)
            if not full:
                level[~filled] = _NONE
            level = level.reshape(-1, LEAST_WINDOW).min(axis=1)
            owner, heads, size = np.repeat(np.arange(len(counts)), parts), begin, LEAST_WINDOW
            for s in sorted(self.classes):
                while size < s:                                       # halves of the next class: pairs within a document
                    odd = np.zeros(len(level), bool)
                    odd[1:] = owner[1:] == owner[:-1]
                    index = np.arange(len(level)) - heads[owner]
                    lead = index % 2 == 0
                    has_next = np.append(odd[1:], False)
                    joined = np.where(has_next, np.minimum(level, np.append(level[1:], _NONE)), level)
                    level, owner = joined[lead], owner[lead]
                    sizes = np.bincount(owner, minlength=len(counts))
                    heads, size = np.cumsum(sizes) - sizes, size * 2
                same = np.append(owner[1:] == owner[:-1], False)
                window = np.where(same, np.minimum(level, np.append(level[1:], _NONE)), level)
                values, members = self.classes[s][k]
                hit = np.flatnonzero(self.filter(s)[_slot(window, k)])
                if len(hit):
                    low, high = np.searchsorted(values, window[hit], "left"), np.searchsorted(values, window[hit], "right")
                    for j in np.flatnonzero(high > low):
                        found.update((int(owner[hit[j]]), int(m)) for m in members[low[j]:high[j]])
        return found


def leaks(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT, n: int = T.WORDS) -> DataFrame:
    """(doc_id, item_id, containment) of every document and item of which it holds at least ``containment``."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("length(text) > 0").distinct()
    sized = items.withColumn("size", F.length("text"))
    blocks = max(1, -(-(sized.agg(F.sum("size")).first()[0] or 0) // BLOCK_SHINGLES))      # a shingle has at least one character
    found = None
    for k in range(blocks):
        rows = [(r["item_id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).collect()]
        part = _search(docs, spark.sparkContext.broadcast(ItemBlock(rows, n)), containment, n)
        found = part if found is None else found.union(part)
    return found


def _search(docs: DataFrame, shared, containment: float, n: int) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            ids = batch.column(0)
            for first, _, raw, offsets in T.blocks(*T.buffers(batch.column(1))):
                hashes, at = T.shingle_hashes(*T.word_hashes(raw, offsets), n)
                rows = []
                for doc, item in sorted(block.candidates(hashes, at)):
                    wanted = block.sets[item]
                    share = float(np.isin(wanted, hashes[at[doc]:at[doc + 1]]).sum()) / len(wanted)
                    if share >= containment:
                        rows.append((ids[first + doc].as_py(), block.ids[item], share))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64()))], ["doc_id", "item_id", "containment"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(search, "doc_id long, item_id long, containment double")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT, n: int = T.WORDS) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item (rows with NULL doc_id are kept)."""
    return docs.join(leaks(docs, benchmark, containment, n).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
