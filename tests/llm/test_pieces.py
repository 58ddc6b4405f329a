"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import SF_MID, SF_SMALL
from shortfall.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "text string, ids string, doc_id long, n_tokens string"


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def encoded(texts):
    out = []
    for _, ids, at in P.encode(pa.array(texts, pa.string()), PATH):
        out += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
    return out


EDGES = ["", " ", "  ", "a", " a", "a  b", "a ", "▁a b▁", " ▁ ▁▁ x▁y", "\n\t a\r\n", "<s> </s> <unk> <0x41> <|endoftext|>", "a\0b", "é ﬁ ①", "日本語 𐍈 🙂🙂", " x y",
         "﻿x", "⁇", "a" * 3000, " " * 700, "▁" * 50 + "t", "ab" * 2000, "aab" * 999, None, "the " * 500, "=" * 333, "-" * 64 + " " * 17 + "z", "́́a", "x" + "\U0010ffff" * 40]


def test_edge_texts_equal_the_library(lib):
    assert encoded(EDGES) == [lib.encode(t or "") for t in EDGES]


@pytest.mark.parametrize("seed", range(6))
def test_random_texts_without_spaces_equal_the_library(lib, seed):
    rng = random.Random(seed)
    alphabet = rng.choice(["ab", "aeinrst", "abcdefghijklmnopqrstuvwxyz", "01", "=-_", "▁ a", "èéàüñ", "ththeinerand", "   the"])
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 4000))) for _ in range(12)]
    words = [p.replace("▁", " ") for p in P.load(PATH).pieces[300:4000]]
    texts += ["".join(rng.choice(words).strip() for _ in range(800)), "".join(rng.choice(words) for _ in range(800))]
    assert encoded(texts) == [lib.encode(t) for t in texts]


def test_documents_equal_the_library(spark, lib):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = {r["doc_id"]: r for r in P.round_trip(docs, PATH).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for d in rows:
        ids = lib.encode(d["text"] or "")
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("seed", range(4))
def test_any_ids_decode_like_the_library(lib, seed):
    rng = random.Random(seed)
    runs = [[rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(131, 259), rng.choice([0, 1, 2, 259, 28705, 264])]) for _ in range(rng.randrange(0, 12))] for _ in range(400)]
    flat = np.array([i for r in runs for i in r], np.int64)
    at = np.r_[0, np.cumsum([len(r) for r in runs])].astype(np.int64)
    assert P.decode(flat, at, PATH) == [lib.decode(r) for r in runs]


def test_encode_then_decode_as_tables(spark, lib):
    rows = [(t, "clash", i, "clash") for i, t in enumerate(EDGES)] + [("again", "x", None, ""), ("again", "x", None, ""), ("other", "x", 3, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    ids = P.encode_documents(docs, PATH)
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in ids.collect()) == sorted((str(d), lib.encode(t or "")) for t, _, d, _ in rows)
    texts = P.decode_documents(ids, PATH)
    assert sorted((str(r["doc_id"]), r["text"]) for r in texts.collect()) == sorted((str(d), lib.decode(lib.encode(t or ""))) for t, _, d, _ in rows)
    assert P.round_trip(docs.limit(0), PATH).collect() == [] and P.decode_documents(ids.limit(0), PATH).collect() == []
    assert P.round_trip(spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0), PATH).schema.names == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyz", "ACGT", "0123456789abcdef"])
def test_long_texts_without_spaces_finish_merge_by_merge(lib, alphabet):
    rng = random.Random(3)
    text = "".join(rng.choice(alphabet) for _ in range(60_000))
    assert encoded([text, "some words", text + " " + text[:9]]) == [lib.encode(t) for t in (text, "some words", text + " " + text[:9])]


def test_a_text_over_the_block_size(spark, lib):
    text = "Long text, ünd words. " * 150_000                       # 3.4 MB, over a block
    r = P.round_trip(spark.createDataFrame([(text, "", 1, "")], SCHEMA), PATH).collect()[0]
    assert r["n_tokens"] == len(lib.encode(text)) and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
