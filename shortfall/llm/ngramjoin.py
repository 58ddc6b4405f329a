"""N-gram Jaccard join (operator 10): every pair of documents whose sets of
distinct 5-word shingles have a Jaccard similarity of at least 75 %.

1. A document's shingles are put in one global order (crowded shingles last, by hash otherwise),
   and its prefix is so long that two linked documents share a prefix shingle. Crowded are the shingles that more than
   ``CROWDED`` documents would have in or near their prefixes: all documents are counted, those whose crowded shingles
   use up what is near the prefix are counted again with all their shingles, and the shingles are kept in a
   Bloom filter of bounded size. A shingle that the filter holds by mistake comes last for every document; any order
   that all documents share gives the same links, it only steers the amount of work.
2. Documents that share a prefix shingle form a tile. Near copies share many of them; shingles of the same documents make
   one tile, so what follows grows with the pairs that meet, not with the shingles they share. First every document is compared
   with one document, the smallest of its tiles' first documents; a large group of copies thus needs as many comparisons as it has documents.
3. Tiles whose documents all lie in one component are done. In the others, documents outside the component of
   the tile's first document are compared with that document, then with the rest of the tile: by tile and size
   band, across components only. Components are all that is asked for, so no link is lost. A pair is taken up at a shingle
   only if what both sets have from there on in the order is enough for a link; two linked documents pass at the first shingle they share.
4. A comparison checks the size band, then bounds the overlap from above by bit
   counts of hashed bitmap signatures, then intersects the sorted shingle arrays.

Defined results: NULL text is empty text; a document without words has size 0,
links with nothing and is its own component; fewer than five words are one
shingle; repeated rows are linked (equal sets); NULL doc_id links with nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shortfall.llm import text as T
from shortfall.llm.graph import components, free_shuffles
from shortfall.session import pin, pin_folder

PERCENT = 75
#: Length of a signature in 64-bit words, for sets of up to so many shingles and for larger ones (a short signature of
#: a large set is full and bounds nothing).
SHORT_WORDS, SHORT_SET, LONG_WORDS = 8, 512, 64
#: Documents from which on a shingle is crowded; largest Bloom filter of crowded shingles, in bits (16 MB).
CROWDED = 16
FILTER_BITS = 1 << 27
#: Documents whose ids may be broadcast to read their texts again; beyond it texts are shuffled.
BROADCAST_DOCS = 500_000


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each document of (doc_id, text)."""
    for first, end, raw, offsets in T.blocks(*T.buffers(batch.column(1))):
        hashes, at = T.shingle_hashes(*T.word_hashes(raw, offsets), n)
        for i in range(end - first):
            yield first + i, np.unique(hashes[at[i]:at[i + 1]])


def _prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _filter_places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (h & mask).astype(np.int64), (T.mix(h) & mask).astype(np.int64)


def in_filter(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which hashes the Bloom filter holds."""
    if not len(words):
        return np.zeros(len(h), bool)
    hit = np.ones(len(h), bool)
    for at in _filter_places(h, 64 * len(words)):
        hit &= (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
    return hit


def crowded_filter(docs: DataFrame, percent: int = PERCENT, n: int = T.WORDS) -> np.ndarray:
    """Bloom filter (64-bit words) of the shingles that more than ``CROWDED`` documents have in or near the prefix by hash."""
    spark, folder = docs.sparkSession, pin_folder(docs.sparkSession)
    texts = docs.select("doc_id", "text")

    def counted(wanted: Callable[[np.ndarray, int], np.ndarray], name: str) -> DataFrame:
        """(h): shingles that more than ``CROWDED`` documents have among the ``wanted`` ones of (set, size near the prefix)."""
        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = []
                for _, h in _sets(batch, n):
                    size = _prefix_size(len(h), percent)
                    parts.append(wanted(h, size + size // 3 + 8))      # crowded ones make way for what comes next
                if parts:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64))], ["h"])

        return pin(texts.mapInArrow(emit, "h long").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).select("h"), name, folder)

    first = counted(lambda h, near: h[:near], "crowded")
    words = _filled(first)
    if not len(words):
        return words
    shared = spark.sparkContext.broadcast(words)                   # at most FILTER_BITS

    def beyond(h: np.ndarray, near: int) -> np.ndarray:
        """What comes next where too few uncrowded shingles are left: copies of one text share that, too."""
        left = len(h[:near]) - int(in_filter(h[:near], shared.value).sum())
        return h[near:] if left < _prefix_size(len(h), percent) else h[:0]

    second = counted(beyond, "crowded2")
    return words if second.isEmpty() else _filled(first.union(second))


def _filled(hashes: DataFrame) -> np.ndarray:
    """Bloom filter (64-bit words) of the column ``h``; empty without rows."""
    count = hashes.count()
    if not count:
        return np.zeros(0, np.uint64)
    bits = min(FILTER_BITS, 1 << max(12, (16 * count).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(_filter_places(batch.column(0).to_numpy().view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], ["word", "mask"])

    found = hashes.mapInArrow(places, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()     # at most bits / 64 rows
    words = np.zeros(bits // 64, np.uint64)
    words[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return words


def signatures(docs: DataFrame, crowded: np.ndarray, percent: int = PERCENT, n: int = T.WORDS) -> DataFrame:
    """(doc_id, n, h1, h2, bits, prefix, hot, copy_of): size, 128-bit hash of the set, parity
    bitmap, prefix shingles (crowded ones apart). Equal sets of a batch share one
    prefix: the others only name the document they equal."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(crowded)                 # at most FILTER_BITS

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            first_of: dict[tuple[int, int, int], int] = {}
            cols: list[list] = [[] for _ in range(8)]
            for row, h in _sets(batch, n):
                h1, h2 = int(T.mix(h).sum(dtype=np.uint64)), int(T.mix(h ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                bit_count = 64 * (SHORT_WORDS if len(h) <= SHORT_SET else LONG_WORDS)
                parity = np.bincount((h >> np.uint64(40)).astype(np.int64) % bit_count, minlength=bit_count) & 1
                key = (len(h), h1, h2)
                mine = first_of.setdefault(key, ids[row]) if ids[row] is not None else None
                prefix, hot = h[:0], h[:0]
                if len(h) and ids[row] is not None and mine == ids[row]:
                    size, last = _prefix_size(len(h), percent), in_filter(h, words)
                    prefix = h[~last][:size]
                    hot = h[last][:size - len(prefix)]
                for c, v in zip(cols, (ids[row], len(h), h1, h2, np.packbits(parity.astype(np.uint8)).view(np.int64), prefix.view(np.int64), hot.view(np.int64), mine)):
                    c.append(v)
            lists = lambda xs: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in xs])]).astype(np.int32)), pa.array(np.concatenate(xs) if xs else np.zeros(0, np.int64)))
            whole = lambda xs: pa.array(np.array(xs, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), whole(cols[2]), whole(cols[3]), *(lists(c) for c in cols[4:7]), pa.array(cols[7], pa.int64())],
                ["doc_id", "n", "h1", "h2", "bits", "prefix", "hot", "copy_of"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        sign, "doc_id long, n long, h1 long, h2 long, bits array<long>, prefix array<long>, hot array<long>, copy_of long")


def _tiles(signed: DataFrame) -> DataFrame:
    """(members, doc, n, rest, least, least_n, peers): a row for each document and prefix shingle that at least two documents have,
    with a hash of the shingle's documents, the number of the document's shingles from this one on, the smallest document, its set size
    and the number of rows. Crowded shingles are aggregated first (a row a task and shingle), so no tile is one task."""
    rare = signed.select(F.col("doc_id").alias("doc"), "n", F.posexplode("prefix").alias("at", "token"))
    hot = signed.select(F.col("doc_id").alias("doc"), "n", F.size("prefix").alias("before"), F.posexplode("hot").alias("at", "token"))
    rare = rare.select("token", "doc", "n", (F.col("n") - F.col("at")).alias("rest"))
    hot = hot.select("token", "doc", "n", (F.col("n") - F.col("before") - F.col("at")).alias("rest"))     # behind all the others
    by_token = Window.partitionBy("token")
    cold = (rare.withColumn("head", F.min(F.struct("doc", "n")).over(by_token)).withColumn("most", F.max("doc").over(by_token))
            .withColumn("peers", F.count("*").over(by_token)).withColumn("members", F.bit_xor(F.xxhash64("doc")).over(by_token)))
    heads = hot.groupBy("token").agg(F.min(F.struct("doc", "n")).alias("head"), F.max("doc").alias("most"), F.count("*").alias("peers"),
                                     F.bit_xor(F.xxhash64("doc")).alias("members"))
    warm = hot.join(heads, "token")
    return (cold.unionByName(warm).where("head.doc <> most")
            .select("members", "doc", "n", "rest", F.col("head.doc").alias("least"), F.col("head.n").alias("least_n"), "peers"))


def _merged(tiles: DataFrame) -> DataFrame:
    """The rows of :func:`_tiles` with one tile for all shingles of the same documents, seen from the first of them on: there every
    document has most shingles left, so two documents that are compared at any of them are compared at the first. A tile is
    (members, least); should two sets of documents have one hash, their tile holds both, and no pair is lost."""
    return tiles.groupBy("members", "least", "least_n", "doc", "n").agg(F.max("rest").alias("rest"), F.max("peers").alias("peers"))


def _open(tiles: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of tiles that span several components, with the components ``c`` of the document and ``head_c`` of the smallest one."""
    placed = tiles.join(known, tiles["doc"] == known["node"], "left").withColumn("c", F.coalesce("component", "doc")).drop("node", "component")
    spans = placed.groupBy("members", "least").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min(F.struct("doc", "c")).alias("head"))
    spans = spans.where("low <> high").select("members", "least", F.col("head.c").alias("head_c"))
    return placed.join(spans, ["members", "least"])


def _may_reach(n: str, m: str, percent: int) -> Column:
    """Size band: the smaller set is large enough for the larger one."""
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent)


def _bounded(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """(a, b, equal): the pairs that may be linked by size band and signature; equal sets need no look."""
    narrow = signed.select("doc_id", "n", "h1", "h2", "bits")
    side = lambda x: narrow.select(F.col("doc_id").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("n", "h1", "h2", "bits")])
    differing = F.when(F.size("a_bits") == F.size("b_bits"), F.aggregate(
        F.zip_with("a_bits", "b_bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)).otherwise(0)
    bound = F.floor((F.col("a_n") + F.col("b_n") - differing) / 2)
    # overlap >= percent / (100 + percent) of the sizes' sum is the same as Jaccard >= percent
    return (pairs.join(side("a"), "a").join(side("b"), "b").where(_may_reach("a_n", "b_n", percent))
            .where(bound * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent)
            .select("a", "b", (F.struct("a_n", "a_h1", "a_h2") == F.struct("b_n", "b_h1", "b_h2")).alias("equal")).distinct())


def _sorted_sets(docs: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """(doc_id, set): sorted shingle hashes of the documents of ``pairs``."""
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    if wanted.count() <= BROADCAST_DOCS:
        wanted = F.broadcast(wanted)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [h for _, h in _sets(batch, n)]
            if sets:
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))], ["doc_id", "set"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.join(wanted, "doc_id", "left_semi").mapInArrow(collect, "doc_id long, set array<long>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of the pairs (a, b), by intersecting sorted arrays."""
    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("a_set"), batch.column("b_set")
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = left[i].values.to_numpy().view(np.uint64), right[i].values.to_numpy().view(np.uint64)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[at] == y).sum())
                linked[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(linked))

    return (pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("b_set")), "b")
            .join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("a_set")), "a")
            .select("a", "b", "a_set", "b_set").mapInArrow(intersect, "a long, b long"))


def join(docs: DataFrame, percent: int = PERCENT, n: int = T.WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    folder = pin_folder(docs.sparkSession)
    signed = pin(signatures(docs, crowded_filter(docs, percent, n), percent, n), "signed", folder)
    copies = signed.where("n > 0 AND copy_of <> doc_id").select(F.col("copy_of").alias("a"), F.col("doc_id").alias("b"))
    heads = signed.where("n > 0 AND copy_of = doc_id")
    least = heads.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a <> z")
    copies = copies.union(heads.join(least.drop("z"), ["h1", "h2", "n"]).where("a <> doc_id").select("a", F.col("doc_id").alias("b")))
    by_shingle = pin(_tiles(signed.where("n > 0")), "by_shingle", folder)
    free_shuffles(docs.sparkSession)
    tiles = pin(_merged(by_shingle), "tiles", folder)
    free_shuffles(docs.sparkSession)

    def compare(pairs: DataFrame, name: str) -> DataFrame:
        """The linked ones of ``pairs`` (a, b)."""
        near = pin(_bounded(pairs, signed, percent), f"{name}-near", folder)
        open_ = near.where(~F.col("equal")).select("a", "b")
        sets = pin(_sorted_sets(docs, open_, n), f"{name}-sets", folder)
        return pin(near.where("equal").select("a", "b").union(_linked(open_, sets, percent)), f"{name}-links", folder)

    # one comparison for each document
    reach = tiles.where((F.col("doc") != F.col("least")) & _may_reach("n", "least_n", percent))
    one = pin(reach.groupBy(F.col("doc").alias("b")).agg(F.min("least").alias("a")).select("a", "b"), "one", folder)
    links = copies.union(compare(one, "one"))
    known = pin(components(links), "known", folder)
    free_shuffles(docs.sparkSession)

    # tiles that still span components: with their first documents, then, by size bands, with the others
    open_tiles = pin(_open(tiles, known), "open", folder)
    stars = (open_tiles.where((F.col("doc") != F.col("least")) & (F.col("c") != F.col("head_c")) & _may_reach("n", "least_n", percent))
             .select(F.col("least").alias("a"), F.col("doc").alias("b")).distinct().join(one, ["a", "b"], "left_anti"))
    found = compare(stars, "stars")
    if not found.isEmpty():
        links = links.union(found)
        known = pin(components(links), "most", folder)
        open_tiles = pin(_open(open_tiles.drop("c", "head_c"), known), "open2", folder)
    free_shuffles(docs.sparkSession)
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + F.lit(1e-9))
    banded = open_tiles.where("doc <> least AND peers > 2").withColumn("band", F.explode(F.array(band, band + 1)))    # sets that may be linked lie in one band or two next to each other
    outside = banded.where("c <> head_c").select("members", "least", "band", F.col("doc").alias("a"), F.col("n").alias("a_n"), F.col("rest").alias("a_rest"), F.col("c").alias("a_c"))
    inside = banded.select("members", "least", "band", F.col("doc").alias("b"), F.col("n").alias("b_n"), F.col("rest").alias("b_rest"), F.col("c").alias("b_c"), (F.col("c") == F.col("head_c")).alias("member"))
    # of two linked sets' first common shingle on, both have at least the overlap they need
    enough = F.least("a_rest", "b_rest") * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent
    rest = (outside.join(inside, ["members", "least", "band"]).where((F.col("a_c") != F.col("b_c")) & (F.col("member") | (F.col("a") < F.col("b"))) & enough & _may_reach("a_n", "b_n", percent))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    more = compare(rest, "rest")
    if not more.isEmpty():
        known = components(links.union(more))
    return (signed.select("doc_id", F.col("n").alias("n_shingles")).join(known, F.col("doc_id") == F.col("node"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
