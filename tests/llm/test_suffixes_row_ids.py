import hashlib
import random

import pytest
from pyspark.sql import functions as F
from shortfall.llm import suffixes as S
from test_suffixes import SCHEMA


def kept(rows, length):
    """{(doc_id, text): kept bytes} by reading the distinct (doc_id, hash of the text, text) in order."""
    seen, out = set(), {}
    for k, h, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        data = t.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p:p + length] in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(data[p:p + length])
        out[k, hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest(), len(data)] = sum(gone)
    return out


@pytest.mark.parametrize("parts,many", [(1, 512), (4, 512), (3, 1)])
def test_null_and_repeated_ids_with_different_texts(spark, parts, many, monkeypatch):
    monkeypatch.setattr(S, "MANY", many)
    rng = random.Random(parts)
    text = lambda n: "".join(rng.choice("abcdef") for _ in range(n))
    shared = [text(60) for _ in range(4)]
    rows = [(None, shared[0] + text(200)), (None, text(9)), (None, shared[0] + text(5)), (7, shared[1] + "x"), (7, shared[1] + text(300) + shared[1]), (7, text(30))]
    for i in range(30):
        rows.append((rng.choice([None, 7, 8, i]), "".join(rng.choice([text(rng.randrange(40)), rng.choice(shared), rng.choice(shared)[3:50]]) for _ in range(rng.randrange(6)))))
    rows += rows[:9]
    df = spark.createDataFrame([(k, t, 0, "") for k, t in rows], SCHEMA).repartition(parts)
    hashed = [(r["doc_id"], r["h"], r["text"]) for r in df.select("doc_id", F.xxhash64("text").alias("h"), "text").collect()]
    found = S.dedup(df, length=20, gram=9).collect()
    assert len(found) == len(rows)
    assert {(r["doc_id"], r["kept_sha256"], r["n_bytes"]): r["n_removed"] for r in found} == kept(hashed, 20)


def test_spans_of_equal_rows_in_one_batch(spark):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdef") for _ in range(n))
    a, b = text(40), text(40)
    rows = [(1, a + text(30) + b)] + [(2, text(50) + a + text(30) + b + text(10))] * 3
    rows[1:] = [rows[1]] * 3
    out = S.dedup(spark.createDataFrame([(k, t, 0, "") for k, t in rows], SCHEMA).coalesce(1), length=20, gram=9).where("doc_id = 2").collect()
    assert [(r["n_removed"], r["n_spans"]) for r in out] == [(80, 2)] * 3
