import random

import numpy as np
import pytest
from brute import jaccard_components
from shortfall.llm import ngramjoin as N
from shortfall.llm.graph import components

from conftest import SF_SMALL

SCHEMA = "extra string, doc_id long, text string, n long"


def result(df):
    rows = df.collect()
    assert len(rows) == len({r["doc_id"] for r in rows})
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert result(N.join(docs)) == jaccard_components([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("crowded", [2, 10 ** 9])
def test_near_copies_chains_and_edges(spark, crowded, monkeypatch):
    monkeypatch.setattr(N, "CROWDED", crowded)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    docs = [(0, None), (1, ""), (2, " \n\t"), (3, "one two"), (4, "ONE two"), (5, "one two three four five"), (6, "É x"), (7, "é x")]
    for group in range(6):
        base = [word() for _ in range(60)]
        for _ in range(30):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(60)] = word()
            if rng.random() < 0.3:
                base = copy                                         # chains: links only between neighbours
            docs.append((len(docs), " ".join(copy)))
    passage = [word() for _ in range(30)]
    docs += [(len(docs) + i, " ".join(passage + [word() for _ in range(25)])) for i in range(40)]
    df = spark.createDataFrame([("x", k, t, k) for k, t in docs], SCHEMA).repartition(3)
    assert result(N.join(df)) == jaccard_components(docs)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = N.join(df)
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0


def test_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([("", 1, "a b c d e f", 0), ("", 1, "a b c d e f", 0), ("", 2, "a b c d e f", 0), ("", None, "a b c d e f", 0)], SCHEMA)
    rows = sorted(map(tuple, N.join(df).collect()), key=str)
    assert rows == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 2, None)], key=str)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_filter_holds_what_is_put_in():
    h = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    words = np.zeros(1 << 10, np.uint64)
    for at in N._filter_places(h[:1000], 64 << 10):
        np.bitwise_or.at(words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    held = N.in_filter(h, words)
    assert held[:1000].all() and held[1000:].mean() < 0.01 and not N.in_filter(h, words[:0]).any()


@pytest.mark.parametrize("crowded", [3, 10 ** 9])
def test_shared_passages_and_half_copies(spark, crowded, monkeypatch):
    monkeypatch.setattr(N, "CROWDED", crowded)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passages = [[word() for _ in range(30)] for _ in range(3)]
    docs = []
    for k in range(60):                                         # a passage makes up a half to nine tenths of a document
        own = [word() for _ in range(rng.choice([3, 6, 10, 30]))]
        docs.append((k, " ".join(own + passages[k % 3] + rng.choice([[], passages[(k + 1) % 3]]))))
    docs += [(100 + k, docs[k % 7][1] + " tail " * (k % 3)) for k in range(20)]
    df = spark.createDataFrame([("x", k, t, k) for k, t in docs], SCHEMA).repartition(4)
    assert result(N.join(df)) == jaccard_components(docs)


def test_unlinked_copies_of_one_text_are_not_paired(spark, monkeypatch):
    """Each copy has six words of its own: it shares most shingles with all the others, and is linked with none."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for k in range(120):
        words = list(base)
        for i in rng.sample(range(5, 145), 6):
            words[i] = f"own{k}x{i}"
        docs.append((k, " ".join(words)))
    docs += [(200 + k, docs[k][1] + " end") for k in range(0, 120, 7)]
    seen = []
    bounded = N._bounded
    monkeypatch.setattr(N, "_bounded", lambda pairs, *more: seen.append(pairs.count()) or bounded(pairs, *more))
    df = spark.createDataFrame([("x", k, t, k) for k, t in docs], SCHEMA).repartition(3)
    assert result(N.join(df)) == jaccard_components(docs)
    assert max(seen) <= 4 * len(docs)


def test_shingles_of_the_same_documents_make_one_tile(spark, monkeypatch):
    """Near copies share some hundred prefix shingles: their tiles are kept once, not once a shingle."""
    rng = random.Random(11)
    docs = []
    for k in range(30):
        words = [f"g{k}w{rng.randrange(10 ** 6)}" for _ in range(400)]
        for _ in range(3):
            words[rng.randrange(400)] = f"own{len(docs)}"
            docs.append((len(docs), " ".join(words)))               # each differs from the one before by a word
    rows = {}
    pin = N.pin
    monkeypatch.setattr(N, "pin", lambda df, name, folder=None: rows.setdefault(name, []).append(out := pin(df, name, folder)) or out)
    df = spark.createDataFrame([("x", k, t, k) for k, t in docs], SCHEMA).repartition(3)
    assert result(N.join(df)) == jaccard_components(docs)
    assert rows["tiles"][0].count() <= 12 * len(docs)


def test_a_tile_of_two_sets_of_rows_keeps_all_rows(spark):
    """Rows of two sets of documents that have one hash, one with a repeated row: the tile holds the rows of both."""
    tiles = spark.createDataFrame([(7, d, 9, r, 1, 9, 4) for d, r in [(1, 5), (1, 5), (2, 4), (3, 6)]] + [(7, d, 9, r, 1, 9, 2) for d, r in [(1, 8), (4, 8)]],
                                  "members long, doc long, n long, rest long, least long, least_n long, peers long")
    got = sorted((r["doc"], r["rest"], r["peers"]) for r in N._merged(tiles).collect())
    assert got == [(1, 8, 4), (2, 4, 4), (3, 6, 4), (4, 8, 2)]
