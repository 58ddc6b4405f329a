import zlib
from array import array

import public_tokenizers
from conftest import SF_MID, SF_SMALL
from shortfall.llm import idfiles as I
from shortfall.llm import tokens
from tokenizers import Tokenizer
import pyarrow as pa

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "text string, doc_id long, ids string, start long"


def want(docs, end):
    tokenizer, out, start = Tokenizer.from_file(PATH), [], 0
    for k, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [end]
        out.append((k, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    return out


def test_round_trip_of_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "BLOCK_BYTES", 20_000)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    I.write(docs, f"{tmp_path}/set", PATH, 1, lower=True)
    kept = spark.read.parquet(f"{tmp_path}/set/dictionary").first()
    assert len(kept["dictionary"]) > 1000 and spark.read.parquet(f"{tmp_path}/set/blocks").count() > 10
    exact = want([(r["doc_id"], r["text"]) for r in docs.collect()], 1)
    got = sorted(map(tuple, I.read(spark, f"{tmp_path}/set").collect()))
    assert got == exact
    some = sorted(map(tuple, I.read(spark, f"{tmp_path}/set", [7, 512, 99999]).collect()))
    assert some == [r for r in exact if r[0] in (7, 512)]
    ids = I.read(spark, f"{tmp_path}/set", [7], with_ids=True).first()["ids"]
    assert zlib.crc32(array("I", ids).tobytes()) == exact[7][3]


def test_edges(spark, tmp_path):
    rows = [(None, 4), ("", 3), ("b a", None), ("x", 9), ("x", 9)]
    I.write(spark.createDataFrame([(t, k, "", 0) for t, k in rows], SCHEMA), f"{tmp_path}/a", PATH, 1, lower=True)
    got = sorted(map(tuple, I.read(spark, f"{tmp_path}/a").collect()), key=lambda r: r[1])
    assert got == want([(k, t) for t, k in rows], 1)
    I.write(spark.createDataFrame([], SCHEMA), f"{tmp_path}/b", PATH, 1, lower=True)
    assert I.read(spark, f"{tmp_path}/b").count() == 0


def test_chunked_encoding_equals_whole_texts(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    texts += [None, "", "a \n b  c", "x  \n\n y", "don't, it's.'s fine", " 's 12,3a.b  ", "\n\n", "n o,   p", "a \n b", "<|endoftext|> a", "é.É ́x Σ.", "a" * 3000]
    for name, lower in (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)):
        path = public_tokenizers.path(name)
        for special in (True, False):
            whole = Tokenizer.from_file(path)                   # the library as it comes: special tokens' strings get their ids
            whole.encode_special_tokens = not special
            out = []
            for _, ids, offsets in tokens.encode(pa.array(texts), path, lower, special):
                out += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
            assert out == [e.ids for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]
