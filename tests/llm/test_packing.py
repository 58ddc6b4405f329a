import random
import zlib
from array import array

import public_tokenizers
import pytest
from conftest import SF_SMALL
from shortfall.llm import packing as P
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "text string, doc_id long, length long, piece int"


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_sequences_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = P.pack(docs, PATH, 2).collect()
    tokenizer = Tokenizer.from_file(PATH)
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}
    want = {}
    for d in docs.collect():
        ids = tokenizer.encode(d["text"], add_special_tokens=False).ids + [2]
        cuts = list(range(len(ids) % 1024 or min(1024, len(ids)), len(ids) + 1, 1024))
        for piece, (a, b) in enumerate(zip([0] + cuts, cuts)):
            want[d["doc_id"], piece] = (a, b - a, zlib.crc32(array("I", ids[a:b]).tobytes()))
    assert got == want and len(rows) == len(got)
    total = sum(r["length"] for r in rows)
    assert check_packing(rows, 1024) <= -(-total // 1024) + 2


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 24, 100])
    counts = {rng.randrange(1, capacity + 1): rng.randrange(1, 50) for _ in range(rng.randrange(1, 40))}
    groups = P.plan(counts, capacity)
    placed = {}
    for n, lengths in groups:
        assert n > 0 and sum(lengths) <= capacity
        for k in lengths:
            placed[k] = placed.get(k, 0) + n
    assert placed == counts
    bins = sum(n for n, _ in groups)
    first_fit = []
    for k in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        for i, room in enumerate(first_fit):
            if room >= k:
                first_fit[i] -= k
                break
        else:
            first_fit.append(capacity - k)
    assert bins <= len(first_fit) + 1 and bins >= -(-sum(k * n for k, n in counts.items()) // capacity)


def least_bins(items, capacity):
    best = [len(items)]

    def search(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= items[i]:
                rooms[j] -= items[i]
                search(i + 1, rooms)
                rooms[j] += items[i]
        search(i + 1, rooms + [capacity - items[i]])

    search(0, [])
    return best[0]


def test_reduction_keeps_an_optimum():
    rng = random.Random(11)
    for _ in range(150):
        capacity = rng.randrange(6, 20)
        items = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))), reverse=True)
        counts = {k: items.count(k) for k in items}
        fixed, rest = P.reduce_by_dominance(counts, capacity)
        remaining = sorted((k for k, n in rest.items() for _ in range(n)), reverse=True)
        assert sum(n for n, _ in fixed) + (least_bins(remaining, capacity) if remaining else 0) == least_bins(items, capacity)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(P, "RANK_ROWS", 3)                      # several salted groups
    rows = [(None, 1), ("", 2), ("word " * 5000, 3), ("word " * 5000, 3), ("a", None), ("a b c", 7)] + [("x y", 100 + i) for i in range(40)]
    out = P.pack(spark.createDataFrame([(t, k, 0, 0) for t, k in rows], SCHEMA), PATH, 2, with_ids=True).collect()
    assert check_packing(out, 1024) >= 1
    assert [(r["length"], r["ids"]) for r in out if r["doc_id"] in (1, 2)] == [(1, [2])] * 2
    assert sum(1 for r in out if r["doc_id"] == 3) == 2 * max(r["piece"] + 1 for r in out if r["doc_id"] == 3)
    assert P.pack(spark.createDataFrame([], SCHEMA), PATH, 2).count() == 0
