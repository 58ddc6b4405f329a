"""Token-id files with a shared zstandard dictionary (operator 9).

A file set is a folder of Parquet-held binary tables:

* ``dictionary``: one row (dictionary bytes, their SHA-256, bytes per id, end id);
* ``blocks``: per shard (ascending doc_id ranges) and block of about 4 MB, the
  zstandard frames of the block's documents back to back, the offset index (doc_ids,
  end offset and number of ids of each frame) and the dictionary hash.

Each document is its own frame, so a short document is read by finding its
block (doc_id range pushed to the scan), slicing its frame and decoding only that.
The dictionary is trained on at most ``TRAINING_DOCS`` documents' id arrays (those with the smallest hash of doc_id).

Defined results: NULL and empty text hold the end id only; repeated doc_ids
are written once per row, next to each other; NULL doc_ids come first; an empty table writes an empty set.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shortfall.llm import tokens

TRAINING_DOCS = 2_000
TRAINING_IDS = 2_048              # ids of each training document, at most
DICTIONARY_BYTES = 64 << 10
BLOCK_BYTES = 4 << 20
LEVEL = 3

BLOCKS = "shard int, block int, first_doc long, last_doc long, n_tokens long, doc_ids array<long>, ends array<int>, counts array<int>, frames binary, dictionary_sha256 string"


def train_dictionary(docs: DataFrame, tokenizer: str, lower: bool, end_id: int, width: int) -> bytes:
    """A dictionary from a bounded sample; empty bytes if the sample is too small to train on."""
    import zstandard

    sample = (docs.where("length(text) > 0").select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(TRAINING_DOCS))
    rows = docs.join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi").select("text")

    def serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ids, offsets in tokens.encode(batch.column(0), tokenizer, lower):
                parts = [ids[a:min(b, a + TRAINING_IDS)].astype(f"<u{width}").tobytes() for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["ids"])

    samples = [r["ids"] for r in rows.mapInArrow(serialise, "ids binary").limit(TRAINING_DOCS).collect()]
    if sum(map(len, samples)) < 10 * DICTIONARY_BYTES or len(samples) < 100:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, lower: bool = False, width: int = 2) -> None:
    """Encode, append ``end_id``, compress and write ``docs`` in ascending doc_id order."""
    import zstandard

    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dictionary = train_dictionary(rows, tokenizer, lower, end_id, width)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(bytearray(dictionary), digest, width, end_id)], "dictionary binary, sha256 string, id_bytes int, end_id int").coalesce(1).write.parquet(f"{path}/dictionary")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, block = TaskContext.get().partitionId(), 0
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if known:
            known.precompute_compress(level=LEVEL)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=True, write_dict_id=False)
        doc_ids, frames, counts, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal block, doc_ids, frames, counts, held
            values = [shard, block, doc_ids[0], doc_ids[-1], sum(counts), doc_ids, np.cumsum([len(x) for x in frames]).tolist(), counts, b"".join(frames), digest]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.string()]
            out = pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], [f.split()[0] for f in BLOCKS.split(", ")])
            block, doc_ids, frames, counts, held = block + 1, [], [], [], 0
            return out

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, ids, offsets in tokens.encode(batch.column(1), tokenizer, lower):
                for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                    frame = packer.compress(np.append(ids[a:b], np.uint32(end_id)).astype(f"<u{width}").tobytes())
                    doc_ids.append(names[first + i])
                    frames.append(frame)
                    counts.append(b - a + 1)
                    held += len(frame)
                    if held >= BLOCK_BYTES:
                        yield flush()
        if doc_ids:
            yield flush()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(build, BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) per document, decoded from the files.

    With ``doc_ids`` only blocks whose range holds one of them are read, and only their frames decoded.
    """
    import zstandard

    kept = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, digest, width = bytes(kept["dictionary"]), kept["sha256"], kept["id_bytes"]
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    wanted = None if doc_ids is None else frozenset(doc_ids)
    if wanted is not None:
        hit = F.lit(False)
        for d in wanted:
            hit = hit | ((F.col("first_doc") <= d) & (F.col("last_doc") >= d))
        chosen = blocks.where(hit)
    else:
        chosen = blocks
    shard_sizes = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))                     # one row per shard
    before = shard_sizes.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shard_start"))
    in_shard = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", F.coalesce(F.sum("n_tokens").over(in_shard), F.lit(0)).alias("in_shard")).join(before, "shard")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpacker = zstandard.ZstdDecompressor(dict_data=known)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_sha256"] != digest:
                    raise ValueError("block was written with another dictionary")
                data, at, start, out = memoryview(row["frames"]), 0, 0, []
                for doc, end, n in zip(row["doc_ids"], row["ends"], row["counts"]):
                    if wanted is None or doc in wanted:
                        ids = np.frombuffer(unpacker.decompress(data[at:end]), f"<u{width}").astype("<u4")
                        if len(ids) != n:
                            raise ValueError(f"document {doc}: {len(ids)} ids, the index says {n}")
                        out.append((row["shard"], row["block"], doc, start, n, zlib.crc32(ids.tobytes())) + ((ids.astype(np.int32).tolist(),) if with_ids else ()))
                    at, start = end, start + n
                if out:
                    names = ["shard", "block", "doc_id", "inside", "n_tokens", "ids_crc32", "ids"]
                    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names[:6 + with_ids])

    schema = "shard int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    decoded = chosen.select("shard", "block", "doc_ids", "ends", "counts", "frames", "dictionary_sha256").mapInArrow(decode, schema)
    return decoded.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("shard_start") + F.col("in_shard") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
