"""The whole pipeline against plain versions of its stages, each on what the plain stage before it kept."""

import zlib
from array import array

import corpus_pipeline as C
import plain_quality
import public_tokenizers
import test_decontam
import test_linededup
from brute import jaccard_components
from conftest import SF_SMALL
from shortfall.llm import quality
from test_packing import check_packing
from tokenizers import Tokenizer


def without_repeated_lines(docs):
    classes = test_linededup.brute(docs, min_chars=1, min_edit=10)
    out = []
    for k, text in docs:
        lines = (text or "").split("\n")
        kept = [line for i, line in enumerate(lines) if classes.get((k, i), (k, i)) == (k, i) or not line.strip(" \t\r")]
        if len(kept) == len(lines):
            out.append((k, text))
        elif "\n".join(kept).strip(" \t\r\n"):
            out.append((k, "\n".join(kept)))
    return out


def pieces(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = {}
    for k, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or min(1024, len(ids))
        ends = range(first, len(ids) + 1, 1024)
        for piece, (a, b) in enumerate(zip([0, *ends], ends)):
            out[k, piece] = (a, b - a, zlib.crc32(array("I", ids[a:b]).tobytes()))
    return out


def test_every_stage_equals_its_plain_version(spark, monkeypatch):
    seen, pin = {}, C.pin
    monkeypatch.setattr(C, "pin", lambda df, name, folder: seen.setdefault(name, pin(df, name, folder)))
    rows = C.run(spark, SF_SMALL).collect()
    got = lambda k: {r["doc_id"]: r["text"] for r in seen[f"stage{k}"].collect()}
    table = lambda name: spark.read.parquet(f"{SF_SMALL}/{name}.parquet").collect()

    docs = [(r["doc_id"], r["text"]) for r in table("documents")]
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in table("labels")]
    kept = plain_quality.resample(docs, labels, quality.BUCKETS, quality.LABELLED_ROWS, quality.SEED)[3]
    docs = [d for i, d in enumerate(docs) if i in kept]
    assert got(0) == dict(docs)
    docs = without_repeated_lines(docs)
    assert got(1) == dict(docs)
    groups = jaccard_components(docs)
    docs = [(k, t) for k, t in docs if groups[k][1] == k]
    assert got(2) == dict(docs)
    leaks = {d for d, _, _ in test_decontam.brute(docs, [(r["item_id"], r["text"]) for r in table("benchmark")])}
    docs = [(k, t) for k, t in docs if k not in leaks]
    assert got(3) == dict(docs)
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == pieces(docs)
    total = sum(r["length"] for r in rows)
    assert -(-total // 1024) <= check_packing(rows, 1024) <= -(-total // 1024) + 2
