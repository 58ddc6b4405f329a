"""Quality classifier by importance resampling (operator 2).

Hashed unigrams and bigrams of every document give the raw text's generative
model; those of labelled good documents give the target's. A document's n-gram
log ratios (whole text) are summarised, and two logistic models fitted on labelled
documents held out from the target turn the summary into the log odds that the
document is target text (well written, and not toxic): its log importance
weight. Gumbel noise is added and the top k documents are kept, where k is the
sum of the target probabilities of all documents.

The labelled rows used are the ``LABELLED_ROWS`` (at most) with the smallest hash of
doc_id, two thirds for the target model and one third for the logistic models; counts of the
raw model, weights and k come from all documents.

Defined results: a document without words has no weight and is rejected; equal
keys at rank k are all kept; without a labelled target document or without
held-out rows every document with words has weight 0 and is kept; labels with
NULLs are not used, and of several labels of a document the worse counts.
Repeated doc_ids get the same noise. All columns of the input are kept by
:func:`select`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from shortfall.llm import text as T
from shortfall.llm import tokens
from shortfall.llm.rowkeys import fresh
from shortfall.session import pin, pin_folder

BUCKETS = 1 << 20
LABELLED_ROWS = 30_000
SEED = 17
SMOOTHING = 1.0
#: A log ratio below this is evidence against a document by itself.
DOUBT = -0.5
_SLICE = 4096
#: Bytes of text taken at a time; the arrays made of them are a hundred times as large.
BLOCK_BYTES = 1 << 20


@dataclass
class Model:
    ratio: np.ndarray | None          # log ratio per bucket
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    quality: np.ndarray | None = None
    clean: np.ndarray | None = None


def _grams(raw: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(unigram buckets, bigram buckets, whether a word starts a bigram, first word of each document)."""
    words, first = T.word_hashes(raw, offsets, split_marks=True)
    pairs = T.mix(words * np.uint64(T.BASE) + np.concatenate([words[1:], words[:1]]))
    starts = np.ones(len(words), bool)
    starts[(first[1:] - 1)[np.diff(first) > 0]] = False
    m = np.uint64(buckets - 1)
    return (words & m).astype(np.int64), (pairs & m).astype(np.int64), starts, first


def _sample(labels: DataFrame, rows: int, seed: int) -> DataFrame:
    """(label_doc, good, toxic, fit): at most ``rows`` labelled documents, so it may be broadcast."""
    h = F.xxhash64("doc_id", F.lit(seed))
    one = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
           .groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t")))
    return (one.orderBy(h, "doc_id").limit(rows)
            .select(F.col("doc_id").alias("label_doc"), (F.col("q") == 1).alias("good"), (F.col("t") == 1).alias("toxic"),
                    (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(3)) < 2).alias("fit")))


def _count(docs: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all documents and over the target's; each task sends its counts in
    slices, and the sums (one row per slice) go to the driver."""
    slices = max(1, buckets // _SLICE)
    width = buckets // slices

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget_all()                                       # the worker may come from encoding texts
        raw_n, target_n, seen = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64), False
        for batch in batches:
            target = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, end, raw, offsets in T.blocks(*T.buffers(batch.column(0)), BLOCK_BYTES):
                uni, bi, starts, at = _grams(raw, offsets, buckets)
                wanted = np.repeat(target[first:end], np.diff(at))
                for grams, keep in ((uni, None), (bi, starts)):
                    raw_n += np.bincount(grams if keep is None else grams[keep], minlength=buckets)
                    if wanted.any():
                        target_n += np.bincount(grams[wanted if keep is None else wanted & keep], minlength=buckets)
                seen = True
        if seen:
            for i in range(slices):
                a, b = raw_n[i * width:(i + 1) * width], target_n[i * width:(i + 1) * width]
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([a.astype("<u4" if a.max() < 1 << 32 else "<u8").tobytes()]),
                                                  pa.array([b.astype("<u4" if b.max() < 1 << 32 else "<u8").tobytes()])], ["slice", "raw", "target"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        wide = lambda x: np.frombuffer(x, "<u4" if len(x) == 4 * width else "<u8").astype(np.int64)
        for batch in batches:
            for i, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                have = sums.setdefault(i, [np.zeros(width, np.int64), np.zeros(width, np.int64)])
                have[0] += wide(a)
                have[1] += wide(b)
        for i, (a, b) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([a.tobytes()]), pa.array([b.tobytes()])], ["slice", "raw", "target"])

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "slice long, raw binary, target binary"
    summed = docs.select("text", "target").mapInArrow(count, schema).repartition(min(n, slices), "slice").mapInArrow(add, schema)
    out = np.zeros((2, buckets), np.int64)
    for row in summed.collect():                                  # one row per slice
        out[0, row["slice"] * width:(row["slice"] + 1) * width] = np.frombuffer(row["raw"], np.int64)
        out[1, row["slice"] * width:(row["slice"] + 1) * width] = np.frombuffer(row["target"], np.int64)
    return out[0], out[1]


def _signed_log(x: np.ndarray) -> np.ndarray:
    return np.sign(x) * np.log1p(np.abs(x))


def _features(column: pa.Array, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a row of features for each document, its number of words)."""
    rows, words = [], []
    for _, _, raw, offsets in T.blocks(*T.buffers(column), BLOCK_BYTES):
        uni, bi, starts, at = _grams(raw, offsets, len(ratio))
        n = np.diff(at)
        doc = np.repeat(np.arange(len(n)), n)
        u, b = ratio[uni], np.where(starts, ratio[bi], 0)
        total = lambda x: np.bincount(doc, weights=x, minlength=len(n))
        one, two, mean = total(np.minimum(0, u - DOUBT)), total(np.where(starts, np.minimum(0, b - DOUBT), 0)), total(u + b)
        size = np.maximum(n, 1)
        rows.append(np.column_stack([_signed_log(two), _signed_log(one), np.log(size), _signed_log(100 * mean / size),
                                     _signed_log(100 * one / size), _signed_log(100 * two / size)]))
        words.append(n)
    return (np.concatenate(rows), np.concatenate(words)) if rows else (np.zeros((0, 6)), np.zeros(0, np.int64))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray | None:
    """Weights (the last is the intercept) by Newton's method with a small ridge; None for one class."""
    if not len(y) or y.all() or not y.any():
        return None
    x, w = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (p - y) + 1e-2 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _log_weight(model: Model, features: np.ndarray) -> np.ndarray:
    """Log odds of the target: both logistic models must agree."""
    if model.centre is None:
        return np.zeros(len(features))
    x = np.column_stack([(features - model.centre) / model.scale, np.ones(len(features))])
    log_p = np.zeros(len(x))
    for w in (model.quality, model.clean):
        if w is not None:
            log_p -= np.logaddexp(0, -np.clip(x @ w, -30, 30))
    return log_p - np.log(np.maximum(-np.expm1(log_p), 1e-13))


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, rows: int = LABELLED_ROWS, seed: int = SEED) -> Model:
    if buckets < 1 or buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    spark = docs.sparkSession
    sample = F.broadcast(pin(_sample(labels, rows, seed), "labelled", pin_folder(spark)))      # at most `rows` rows
    base = docs.select(F.col("doc_id").alias("_doc"), F.col("text").cast("string").alias("text"))
    target = base.join(sample, F.col("_doc") == F.col("label_doc"), "left").select(
        "text", F.coalesce(F.col("good") & ~F.col("toxic") & F.col("fit"), F.lit(False)).alias("target"))
    raw_n, target_n = _count(target, buckets)
    if not target_n.sum():
        return Model(None)
    share = target_n.sum() / raw_n.sum()
    model = Model(np.log((target_n + SMOOTHING) / (raw_n * share + SMOOTHING)).astype(np.float32))
    ratio = spark.sparkContext.broadcast(model.ratio)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget_all()                                       # the worker may come from encoding texts
        for batch in batches:
            x, n = _features(batch.column(0), ratio.value)
            rows_ = pa.ListArray.from_arrays(pa.array(np.arange(0, 6 * len(x) + 1, 6, dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([rows_, batch.column(1), batch.column(2), pa.array(n)], ["x", "good", "toxic", "n"])

    held = (base.join(sample, F.col("_doc") == F.col("label_doc")).where(~F.col("fit")).select("text", "good", "toxic")
            .mapInArrow(summarise, "x array<double>, good boolean, toxic boolean, n long").where("n > 0").collect())  # at most the sample's documents
    if held:
        x, good, toxic = np.array([r["x"] for r in held]), np.array([r["good"] for r in held]), np.array([r["toxic"] for r in held])
        model.centre, model.scale = x.mean(0), x.std(0) + 1e-9
        z = (x - model.centre) / model.scale
        model.quality, model.clean = _logistic(z, good.astype(float)), _logistic(z[good], (~toxic[good]).astype(float))
    return model


def gumbel_key(log_weight: Column, seed: int = SEED) -> Column:
    """log weight + Gumbel noise drawn from a hash of doc_id."""
    u = (F.pmod(F.xxhash64("doc_id", F.lit("gumbel"), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return log_weight - F.log(-F.log(u))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, log_weight) of every document; NULL without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget_all()                                       # the worker may come from encoding texts
        m = shared.value
        for batch in batches:
            x, n = _features(batch.column(1), m.ratio if m.ratio is not None else np.zeros(1, np.float32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_log_weight(m, x), mask=n == 0)], ["doc_id", "log_weight"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, "doc_id long, log_weight double")


def threshold(keyed: DataFrame, k: int, bins: int = 4096, few: int = 10_000) -> float:
    """The k-th largest key: histograms are narrowed until the bin that holds it has few rows or one value."""
    low, high, n = keyed.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if n == 0 or k <= 0:
        return math.inf
    if k >= n:
        return low
    above = 0
    while True:
        inside = keyed.where((F.col("key") >= low) & (F.col("key") <= high))
        width = (high - low) / bins
        bin_no = F.least(F.floor((F.col("key") - low) / width), F.lit(bins - 1)).cast("int")
        for row in inside.groupBy(bin_no.alias("b")).agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy(F.desc("b")).collect():
            if above + row["n"] >= k:
                break
            above += row["n"]
        low, high = row["lo"], row["hi"]
        if low == high:
            return low
        if row["n"] <= few:
            values = sorted((r["key"] for r in keyed.where((F.col("key") >= low) & (F.col("key") <= high)).select("key").collect()), reverse=True)
            return values[k - above - 1]


def resample(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, rows: int = LABELLED_ROWS, seed: int = SEED) -> tuple[DataFrame, Model, float]:
    """(doc_id, log_weight, key of the kept documents; the model; the smallest key kept)."""
    spark: SparkSession = docs.sparkSession
    model = fit(docs, labels, buckets, rows, seed)
    keyed = pin(scores(docs, model).where("log_weight IS NOT NULL").withColumn("key", gumbel_key(F.col("log_weight"), seed)), "weights", pin_folder(spark))
    if model.centre is None:
        return keyed, model, -math.inf
    expected = keyed.agg(F.sum(1 / (1 + F.exp(-F.col("log_weight"))))).first()[0] or 0.0
    least = threshold(keyed.select("key"), round(expected))
    return keyed.where(F.col("key") >= least), model, least


def select(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, rows: int = LABELLED_ROWS, seed: int = SEED) -> DataFrame:
    """The kept rows of ``docs`` with all their columns; texts are scored again rather than shuffled."""
    _, model, least = resample(docs, labels, buckets, rows, seed)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    weight = fresh("_log_weight", names)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget_all()                                       # the worker may come from encoding texts
        m = shared.value
        for batch in batches:
            x, n = _features(batch.column(names.index("text")), m.ratio if m.ratio is not None else np.zeros(1, np.float32))
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(_log_weight(m, x), mask=n == 0)], [*names, weight])
            yield out.filter(pa.array(n > 0))

    schema = StructType([*docs.schema.fields, StructField(weight, DoubleType())])
    scored = docs.mapInArrow(score, schema)
    docs_kept = scored if math.isinf(least) and least < 0 else scored.where(gumbel_key(F.col(weight), seed) >= least)
    return docs_kept.select(*[F.col(f"`{c}`") for c in names])
