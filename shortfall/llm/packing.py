"""Best-fit packing of token pieces into sequences (operator 3).

The plan is made on the histogram of piece lengths (at most ``capacity`` rows,
whatever the corpus size). First a dominance reduction in the manner of
Martello and Toth fixes, in bulk, small sets that no alternative beats: a
piece that fits with nothing, a pair that fills a sequence, or a piece with its
largest companion where no two companions can do better. What is left is
packed best-fit in descending length. Pieces then find their place by their
rank among pieces of their length, on the executors.

Defined results: NULL or empty text is one piece holding the end id; repeated
rows are packed once each; an empty table gives no rows; ties in length go by
(doc_id, piece). A document longer than ``capacity`` is cut so that only its
first piece may be shorter.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shortfall.llm import tokens
from shortfall.session import pin, pin_folder

CAPACITY = 1024
#: Rows of one length ranked in one group; longer ones are split into so many rows each.
RANK_ROWS = 200_000


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document's ids plus ``end_id``."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column(0)
            for first, ids, offsets in tokens.encode(batch.column(1), tokenizer):
                n = len(offsets) - 1
                ids = np.insert(ids, offsets[1:], np.uint32(end_id))
                offsets = offsets + np.arange(n + 1)
                sizes = np.diff(offsets)
                parts = -(-sizes // capacity)
                doc = np.repeat(np.arange(n), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                head = sizes - (parts - 1) * capacity
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                at = (offsets[doc] + start).tolist()
                data = memoryview(ids.astype("<u4", copy=False).view(np.uint8))
                crc = [zlib.crc32(data[4 * a:4 * (a + k)]) for a, k in zip(at, length.tolist())]
                columns = [doc_ids.slice(first, n).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(columns)])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, list[int]]], dict[int, int]]:
    """(fixed groups of equal sequences as (how many, lengths), counts that remain)."""
    left, fixed = {k: n for k, n in counts.items() if n}, []
    changed = True
    while changed:
        changed = False
        for a in sorted(left, reverse=True):
            while left.get(a, 0):
                left[a] -= 1                                    # one copy is the item looked at
                present = sorted(k for k, n in left.items() if n)
                left[a] += 1
                room = capacity - a
                at = bisect.bisect_right(present, room)
                if not at:                                      # it fits with nothing
                    fixed.append((left[a], [a]))
                    left[a] = 0
                    changed = True
                    break
                b = present[at - 1]
                small = present[0]
                spare = left[small] - (small == a)
                second = small if spare > 1 else present[1] if len(present) > 1 else capacity + 1
                if a + b != capacity and small + second <= room and not _beats_pairs(left, present[:at], b, room, a):
                    break
                n = left[a] // 2 if a == b else min(left[a], left[b])
                fixed.append((n, [a, b]))
                left[a] -= n
                left[b] -= n
                changed = True
        left = {k: n for k, n in left.items() if n}
    return fixed, left


def _beats_pairs(left: dict[int, int], small: list[int], b: int, room: int, a: int) -> bool:
    """No three companions fit, and no two hold more than the single companion ``b``."""
    have = lambda k: left[k] - (k == a)
    least = [k for k in small[:3] for _ in range(min(3, have(k)))][:3]
    if len(least) == 3 and sum(least) <= room:
        return False
    for x in small:
        at = bisect.bisect_right(small, room - x) - 1
        while at >= 0 and small[at] == x and have(x) < 2:
            at -= 1
        if at >= 0 and x + small[at] > b:
            return False
    return True


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Best-fit decreasing on counts: groups of equal sequences as (how many, lengths)."""
    bins: dict[int, list[tuple[int, list[int]]]] = {}
    rooms: list[int] = []                                       # rooms with bins, ascending

    def put(room: int, n: int, lengths: list[int]) -> None:
        if room not in bins:
            bins[room] = []
            bisect.insort(rooms, room)
        bins[room].append((n, lengths))

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                put(capacity, -(-n // (capacity // size)), [])
                continue
            room = rooms[at]
            have, lengths = bins[room].pop()
            if not bins[room]:
                del bins[room]
                rooms.pop(at)
            each = room // size                                 # best fit refills the bin it has just used
            full = min(have, n // each)
            if full:
                put(room - each * size, full, lengths + [size] * each)
                n -= full * each
            if have > full:
                last = min(n, each) if n < each else 0
                if last:
                    put(room - last * size, 1, lengths + [size] * last)
                    n -= last
                if have - full - bool(last):
                    put(room, have - full - bool(last), lengths)
    return [(n, lengths) for room in rooms for n, lengths in bins[room] if lengths]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def slots(groups: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: (first rank, first sequence, offset) of each run of places; size follows the plan, not the corpus."""
    used: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for n, lengths in groups:
        offset = 0
        for size in lengths:
            rank = used.get(size, 0)
            out.setdefault(size, []).append((rank, base, offset))
            used[size] = rank + n
            offset += size
        base += n
    return {size: tuple(np.array(x, np.int64) for x in zip(*runs)) for size, runs in out.items()}


def assign(parts: DataFrame, groups: list[tuple[int, list[int]]]) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``: ranks within a length are counted in
    salted groups first, so a length holding a third of all pieces is many tasks."""
    total = sum(n * len(lengths) for n, lengths in groups)
    salts = max(1, -(-total // RANK_ROWS))
    salted = parts.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    ahead = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = (salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
              .select("length", "_salt", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    ranked = (salted.withColumn("_row", F.row_number().over(inside)).join(before, ["length", "_salt"])
              .withColumn("_rank", F.col("_row") - 1 + F.col("_before")).drop("_salt", "_row", "_before"))
    names = [c for c in parts.columns]
    place = slots(groups)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts):
                ranks, firsts, offsets = place[int(length[rows[0]])]
                run = np.searchsorted(ranks, rank[rows], side="right") - 1
                sequence[rows], offset[rows] = firsts[run] + rank[rows] - ranks[run], offsets[run]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)], names + ["sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema) + ", sequence_id long, offset long"
    return ranked.select(*names, "_rank").mapInArrow(put, schema)


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    spark = docs.sparkSession
    parts = pin(pieces(docs, tokenizer, end_id, capacity, with_ids), "pieces", pin_folder(spark))
    counts = {int(r["length"]): int(r["n"]) for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    return assign(parts, plan(counts, capacity))
