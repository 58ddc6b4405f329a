import hashlib
import random

import numpy as np
import pytest
from conftest import SF_SMALL
from shortfall.llm import suffixes as S

SCHEMA = "doc_id long, text string, doc long, kg string"


def brute(docs, length):
    seen, out = set(), {}
    for k, t in sorted(docs):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        n = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[k] = (len(data), sum(gone), n, hashlib.sha256(kept).hexdigest())
    return out


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 100)
    assert sum(x[1] for x in want.values()) > 1000 and got(S.dedup(docs.repartition(5))) == want


@pytest.mark.parametrize("many", [512, 1])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh é"])
def test_random_texts_with_shared_passages(spark, many, letters, monkeypatch):
    monkeypatch.setattr(S, "MANY", many)
    rng = random.Random(many + len(letters))
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [text(rng.randrange(20, 120)) for _ in range(8)] + ["a" * 90, "ab" * 40]
    docs = [(0, None), (1, ""), (2, "a" * 19), (3, "a" * 20), (4, "a" * 60)]
    for _ in range(60):
        docs.append((len(docs), "".join(rng.choice([text(rng.randrange(30)), rng.choice(passages), rng.choice(passages)[5:50]]) for _ in range(rng.randrange(8)))))
    docs += [(len(docs) + i, docs[20 + i][1]) for i in range(10)]
    rng.shuffle(docs)
    df = spark.createDataFrame([(k, t, 0, "") for k, t in docs], SCHEMA).repartition(4)
    assert got(S.dedup(df, length=20, gram=9)) == brute(docs, 20)


def test_kept_bytes_null_ids_repeated_rows_and_empty_table(spark):
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdef") for _ in range(150))
    rows = [(None, shared + "xyz"), (5, shared), (5, shared), (9, "q" + shared[20:140] + "r")]
    df = spark.createDataFrame([(k, t, 0, "") for k, t in rows], SCHEMA)
    out = sorted(S.dedup(df, with_bytes=True).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert [(r["doc_id"], r["n_removed"], bytes(r["kept"])) for r in out] == [(None, 0, rows[0][1].encode()), (5, 150, b""), (5, 150, b""), (9, 120, b"qr")]
    assert S.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_deep_shallow_classes():
    rng = random.Random(3)
    raw = np.array([rng.choice(b"ab") for _ in range(500)] + [97] * 100, np.uint8)
    at = np.arange(0, 560)
    group = np.array([rng.randrange(3) for _ in at])
    want = {}
    for i, (p, g) in enumerate(zip(at, group)):
        want.setdefault((g, raw[p:p + 40].tobytes()), []).append(i)
    have = sorted(sorted(c.tolist()) for c in S.equal_suffixes(raw, at, group, 40, shallow=16))
    assert have == sorted(v for v in want.values() if len(v) > 1)
