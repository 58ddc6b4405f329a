"""Removal of repeated substrings by sparse suffix sorting (operator 8).

A byte goes if a string of ``length`` bytes that covers it also starts earlier
(smaller doc_id, for one doc_id smaller hash of the text, or same document and earlier start). Documents are compared as UTF-8
bytes; matches never cross documents.

1. Every window of ``length`` bytes has an anchor, the leftmost smallest hashed
   ``GRAM``-gram in it, so equal windows have equal anchors at equal places. Windows
   of a document with one anchor are one block; there are about 1/40 as many blocks as bytes.
2. Blocks meet at their anchor gram. A block equal to an earlier one is removed
   whole; a gram all of whose blocks are equal is finished.
3. Only the first of each of several different blocks of a gram is looked at byte by byte:
   the suffixes at its windows are sorted deep-shallow. Multikey partitioning by words of eight bytes
   runs to a shallow depth, then blind tries order what still shares a prefix. Suffixes
   equal over ``length`` bytes are one class, of which the earliest stays.
   Grams with very many different blocks are spread over tasks by window instead.

Defined results: NULL and empty text have no bytes and nothing removed; rows that repeat a
doc_id with the same text count as one document, each gets the same result; rows of one doc_id with
different texts are different documents, in the order of the texts' hashes; NULL doc_id counts as the smallest; an empty table gives no rows; texts shorter than ``length`` stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shortfall.llm import text as T
from shortfall.session import pin, pin_folder

LENGTH = 100
GRAM = 24
SHALLOW = 32
#: Blocks of a gram from which its windows are spread over tasks.
MANY = 512
_NO_ID = -(1 << 63)


def blocks(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, block hash, document, first window, last window) of every block; windows count from the document's start."""
    n = len(raw)
    if n < length:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    up, down = T.powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(T.BYTE_VALUE[raw] * up[:n], out=total[1:])
    h = T.mix((total[gram:] - total[:-gram]) * down[:n - gram + 1])
    bits = np.uint64(max(21, n.bit_length()))
    least = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    wide, size = length - gram + 1, 1
    while 2 * size <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if wide > size:
        least = np.minimum(least[:size - wide], least[wide - size:])
    edge = np.zeros(n + 1, np.int32)                        # windows that would cross a document's end
    np.add.at(edge, np.maximum(offsets[1:] - length + 1, offsets[:-1]), 1)
    np.add.at(edge, offsets[1:], -1)
    at = np.flatnonzero(np.cumsum(edge[:len(least)]) == 0)
    if not len(at):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    anchor = (least[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    turn = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(at) != 1)) + 1
    lo, hi = at[np.concatenate([[0], turn])], at[np.concatenate([turn - 1, [len(at) - 1]])]
    anchor = anchor[np.concatenate([[0], turn])]
    shape = ((hi - lo) << 32 | (anchor - lo)).astype(np.uint64)
    whole = T.mix((total[hi + length] - total[lo]) * down[lo] + T.mix(shape))
    doc = np.searchsorted(offsets, lo, side="right") - 1
    return h[anchor], whole, doc, lo - offsets[doc], hi - offsets[doc]


def _runs(doc: np.ndarray, sub: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows lo..hi as byte spans, with spans of windows that follow each other joined; rows are in order."""
    if not len(doc):
        return doc, sub, lo, hi
    turn = np.flatnonzero((doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1]) | (lo[1:] > hi[:-1] + 1)) + 1
    first, last = np.concatenate([[0], turn]), np.concatenate([turn - 1, [len(doc) - 1]])
    return doc[first], sub[first], lo[first], hi[last] + length


def anchored(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(kg, bh, doc, sub, lo, hi, done): blocks; blocks that repeat in a batch are reported as spans
    that go (``done``, with the span in lo and hi) and leave only their first."""
    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, subs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            parts = []
            for first, _, raw, offsets in T.blocks(*T.buffers(batch.column(2))):
                kg, bh, doc, lo, hi = blocks(raw, offsets, length, gram)
                parts.append((kg, bh, ids[first + doc], subs[first + doc], lo, hi))
            if not parts:
                continue
            kg, bh, doc, sub, lo, hi = (np.concatenate(x) for x in zip(*parts))
            even = doc[1:] == doc[:-1]
            if ((doc[1:] < doc[:-1]) | (even & (sub[1:] < sub[:-1])) | (even & (sub[1:] == sub[:-1]) & (lo[1:] <= lo[:-1]))).any():
                order = np.lexsort((lo, sub, doc))
                kg, bh, doc, sub, lo, hi = kg[order], bh[order], doc[order], sub[order], lo[order], hi[order]
            by = np.argsort(T.mix(kg + bh * np.uint64(T.BASE)), kind="stable")
            same = np.zeros(len(kg), bool)
            k, b, d, u, at = kg[by], bh[by], doc[by], sub[by], lo[by]
            equal = (k[1:] == k[:-1]) & (b[1:] == b[:-1])
            head = np.maximum.accumulate(np.where(np.concatenate([[True], ~equal]), np.arange(len(k)), 0)) if len(k) else np.zeros(0, np.int64)
            same[by] = (d != d[head]) | (u != u[head]) | (at != at[head])
            gone, gone_sub, start, end = _runs(doc[same], sub[same], lo[same], hi[same], length)
            columns = [np.concatenate([kg[~same], T.mix(gone.astype(np.uint64) * np.uint64(T.BASE) + start.astype(np.uint64))]).view(np.int64),
                       np.concatenate([bh[~same], np.zeros(len(gone), np.uint64)]).view(np.int64),
                       np.concatenate([doc[~same], gone]), np.concatenate([sub[~same], gone_sub]), np.concatenate([lo[~same], start]), np.concatenate([hi[~same], end]),
                       np.concatenate([np.zeros(len(doc) - same.sum(), bool), np.ones(len(gone), bool)])]
            yield pa.RecordBatch.from_arrays([pa.array(c) if i < 4 or i == 6 else pa.array(c.astype(np.int32)) for i, c in enumerate(columns)], ["kg", "bh", "doc", "sub", "lo", "hi", "done"])

    return docs.mapInArrow(anchor, "kg long, bh long, doc long, sub long, lo int, hi int, done boolean")


def met(rows: DataFrame) -> DataFrame:
    """What is left to do of each block: ``done`` rows are spans that go, the others first blocks of a
    gram with several different ones (``peers`` of them, counted with repeats)."""
    gram, block = Window.partitionBy("kg"), Window.partitionBy("kg", "bh").orderBy("doc", "sub", "lo")
    seen = (rows.withColumn("first_doc", F.first("doc").over(block)).withColumn("first_sub", F.first("sub").over(block)).withColumn("first_lo", F.first("lo").over(block))
            .withColumn("least", F.min("bh").over(gram)).withColumn("most", F.max("bh").over(gram)).withColumn("peers", F.count("*").over(gram)))
    later = (F.col("doc") != F.col("first_doc")) | (F.col("sub") != F.col("first_sub")) | (F.col("lo") != F.col("first_lo"))
    return (seen.where(F.col("done") | later | (F.col("least") != F.col("most")))
            .select("kg", "doc", "sub", "lo", "hi", "peers", "done", (~F.col("done") & later).alias("later")))


class BlindTrie:
    """Strings of equal length; a node holds the depth at which its children differ, so an
    insertion compares whole strings once, at the leaf that the blind descent reaches."""

    class Node:
        __slots__ = ("depth", "kids")

        def __init__(self, depth: int, kids: dict):
            self.depth, self.kids = depth, kids

    def __init__(self) -> None:
        self.root = None

    def insert(self, text: bytes, name: int) -> None:
        if self.root is None:
            self.root = (text, [name])
            return
        node = self.root
        while isinstance(node, BlindTrie.Node):
            child = node.kids.get(text[node.depth])
            node = child if child is not None else next(iter(node.kids.values()))
        other, names = node
        if other == text:
            names.append(name)
            return
        common = len(text) - ((int.from_bytes(text, "big") ^ int.from_bytes(other, "big")).bit_length() + 7) // 8
        above, node = None, self.root
        while isinstance(node, BlindTrie.Node) and node.depth < common:
            above, node = node, node.kids[text[node.depth]]
        if isinstance(node, BlindTrie.Node) and node.depth == common:
            node.kids[text[common]] = (text, [name])
            return
        fork = BlindTrie.Node(common, {text[common]: (text, [name]), other[common]: node})
        if above is None:
            self.root = fork
        else:
            above.kids[text[above.depth]] = fork

    def classes(self) -> Iterator[list[int]]:
        """Names of equal strings, in the order of the strings."""
        todo = [self.root] if self.root is not None else []
        while todo:
            node = todo.pop()
            if isinstance(node, BlindTrie.Node):
                todo.extend(node.kids[k] for k in sorted(node.kids, reverse=True))
            else:
                yield node[1]


def equal_suffixes(raw: np.ndarray, at: np.ndarray, group: np.ndarray, length: int, shallow: int = SHALLOW) -> Iterator[np.ndarray]:
    """Classes of at least two positions of ``at`` (as indices) in one group whose next ``length`` bytes are equal."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = padded[:len(raw)]
    for k in range(1, 8):
        words = words << np.uint64(8) | padded[k:k + len(raw)]
    left, part = np.arange(len(at)), group
    for depth in range(0, min(shallow, length - 7), 8):              # shallow: one word of all parts at a time
        key = words[at[left] + depth]
        order = np.lexsort((key, part))
        left, part, key = left[order], part[order], key[order]
        new = np.concatenate([[True], (part[1:] != part[:-1]) | (key[1:] != key[:-1])]) if len(left) else np.zeros(0, bool)
        part = np.cumsum(new)
        many = np.bincount(part)[part] > 1 if len(part) else np.zeros(0, bool)
        left, part = left[many], part[many]
    order = np.argsort(part, kind="stable")
    left, part = left[order], part[order]
    data = raw.tobytes()
    for names in np.split(left, np.flatnonzero(np.diff(part)) + 1):  # deep: a blind trie for each part
        if len(names) > 1:
            trie = BlindTrie()
            for i, p in zip(names.tolist(), at[names].tolist()):
                trie.insert(data[p:p + length], i)
            yield from (np.array(c) for c in trie.classes() if len(c) > 1)


def _contents(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(key, doc, sub, lo, bytes) of the blocks listed in each document's row; windows one by one for grams with many blocks."""
    for batch in batches:
        raw, offsets = T.buffers(batch.column("text"))
        keys, docs, subs, starts, parts = [], [], [], [], []
        for base, end, doc, sub, todo in zip(offsets.tolist(), offsets[1:].tolist(), batch.column("doc").to_pylist(), batch.column("sub").to_pylist(), batch.column("todo").to_pylist()):
            data = raw[base:end].tobytes()
            for b in todo:
                lo, hi = b["lo"], b["hi"]
                if b["peers"] <= MANY:
                    keys.append(b["kg"])
                    docs.append(doc)
                    subs.append(sub)
                    starts.append(lo)
                    parts.append(data[lo:hi + length])
                else:
                    for p in range(lo, hi + 1):
                        part = data[p:p + length]
                        keys.append(int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little", signed=True))
                        docs.append(doc)
                        subs.append(sub)
                        starts.append(p)
                        parts.append(part)
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(docs, pa.int64()), pa.array(subs, pa.int64()), pa.array(starts, pa.int32()), pa.array(parts, pa.binary())], ["key", "doc", "sub", "lo", "bytes"])


def _later_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans of windows that have an earlier equal one; rows come sorted by key. The last key of a batch
    goes on with the next batch, with the first of each of its classes only."""
    held: tuple[list, list, list, list, list] = ([], [], [], [], [])

    def settle(keys: np.ndarray, docs: np.ndarray, subs: np.ndarray, starts: np.ndarray, parts: list[bytes]) -> tuple[pa.RecordBatch | None, np.ndarray]:
        """(spans that go, for each row whether all its windows go)."""
        raw = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(p) for p in parts], np.int64)
        begin = np.cumsum(sizes) - sizes
        counts = sizes - length + 1
        row = np.repeat(np.arange(len(parts)), counts)
        inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        at, doc, sub, start = begin[row] + inside, docs[row], subs[row], starts[row] + inside
        group = np.cumsum(np.concatenate([[True], keys[1:] != keys[:-1]]))[row]
        gone = np.zeros(len(row), bool)
        for names in equal_suffixes(raw, at, group, length):
            d, u, s = doc[names], sub[names], start[names]
            first = np.lexsort((s, u, d))[0]
            gone[names[(d != d[first]) | (u != u[first]) | (s != s[first])]] = True
        spent = np.bincount(row[gone], minlength=len(parts)) == counts
        if not gone.any():
            return None, spent
        order = np.lexsort((start[gone], sub[gone], doc[gone]))
        d, u, s = doc[gone][order], sub[gone][order], start[gone][order]
        d, u, s, e = _runs(d, u, s, s, length)
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(u), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))], ["doc", "sub", "start", "end"]), spent

    def rows(columns) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        return *(np.array(c, np.int64) for c in columns[:4]), columns[4]

    for batch in batches:
        if not batch.num_rows:
            continue
        joined = tuple(h + c.to_pylist() for h, c in zip(held, batch.columns))
        out, spent = settle(*rows(joined))
        if out is not None:
            yield out
        last = joined[0][-1]
        keep = [i for i in range(len(joined[0]) - 1, -1, -1) if joined[0][i] == last and not spent[i]] if joined[0][-1] == last else []
        held = tuple([c[i] for i in keep] for c in joined)
    # what is held has been compared with everything of its key


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, sub, start, end): byte spans that go, possibly overlapping; ``doc`` is doc_id with NULL as the smallest number, ``sub`` the text's hash."""
    spark = docs.sparkSession
    left = pin(met(anchored(docs, length, gram)), "blocks", pin_folder(spark))
    whole = left.where("done").select("doc", "sub", F.col("lo").alias("start"), F.col("hi").alias("end")).union(
        left.where("later").select("doc", "sub", "lo", F.col("hi") + length))
    todo = left.where("NOT done AND NOT later").groupBy("doc", "sub").agg(F.collect_list(F.struct("kg", "lo", "hi", "peers")).alias("todo"))   # blocks of one document
    contents = docs.join(todo, ["doc", "sub"]).mapInArrow(lambda b: _contents(b, length), "key long, doc long, sub long, lo int, bytes binary")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_keys = contents.repartition(n, "key").sortWithinPartitions("key")
    return whole.union(sorted_keys.mapInArrow(lambda b: _later_windows(b, length), "doc long, sub long, start int, end int"))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, sub, text): doc_id alone does not tell rows with different texts apart, so the text's hash goes with it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64(text).alias("sub"), text.alias("text"))


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every document."""
    if not 8 <= gram <= length:
        raise ValueError("gram must be at least 8 and at most length")
    base = keyed(docs)
    gone = spans(base, length, gram).groupBy("doc", "sub").agg(F.collect_list(F.struct("start", "end")).alias("gone"))    # spans of one document

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = T.buffers(batch.column("text"))
            out: list[list] = [[] for _ in range(5)]
            for base_, end, lost in zip(offsets.tolist(), offsets[1:].tolist(), batch.column("gone").to_pylist()):
                data, at, removed, n = raw[base_:end].tobytes(), 0, 0, 0
                parts, stop = [], -1
                for a, b in sorted((s["start"], s["end"]) for s in lost or ()):
                    if a > stop:                                    # a new run; spans that touch are one run
                        n += 1
                        parts.append(data[at:a])
                    removed += max(0, b - max(a, stop))
                    stop = at = max(stop, b)
                kept = b"".join(parts) + data[at:]
                for c, v in zip(out, (len(data), removed, n, hashlib.sha256(kept).hexdigest(), kept)):
                    c.append(v)
            ids = pa.array([None if d == _NO_ID else d for d in batch.column("doc").to_pylist()], pa.int64())
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = [ids, *(pa.array(c, t) for c, t in zip(out, types))][:5 + with_bytes]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:5 + with_bytes])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    return base.join(gone, ["doc", "sub"], "left").mapInArrow(keep, schema)
