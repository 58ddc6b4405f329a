import hashlib
import random
import re

from conftest import SF_SMALL
from shortfall.llm import fingerprint as P

SCHEMA = "doc_id long, text string, k long, mark long"


def edited(docs):
    """{doc_id: edited text} for distinct doc_ids."""
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for i, (k, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        out[k] = t[:len(t) - half] + after[:half]
    return out


def bag(text):
    out = {}
    for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()):
        out[w] = out.get(w, 0) + 1
    return out


def similarity(a, b):
    a, b = bag(a), bag(b)
    words = set(a) | set(b)
    return sum(min(a.get(w, 0), b.get(w, 0)) for w in words) / max(1, sum(max(a.get(w, 0), b.get(w, 0)) for w in words))


def test_edits_and_likeness_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = P.fingerprint_edits(docs.repartition(3)).collect()
    want = edited(list(texts.items()))
    ids = sorted(texts, reverse=True)
    after = {k: ids[(i + 1) % len(ids)] for i, k in enumerate(ids)}
    assert len(rows) == len(texts)
    by_text, errors = {}, []
    for r in rows:
        k = r["doc_id"]
        assert r["n_chars"] == len(texts[k]) and r["edited_sha256"] == hashlib.sha256(want[k].encode()).hexdigest()
        assert by_text.setdefault(texts[k], r["fingerprint"]) == r["fingerprint"] and len(r["fingerprint"]) == 8 * P.SAMPLES
        errors.append((r["near_edited"] - similarity(texts[k], want[k]), r["near_next"] - similarity(texts[k], texts[after[k]])))
    for side in zip(*errors):
        assert abs(sum(side) / len(side)) < 0.02                        # no bias
        assert (sum(e * e for e in side) / len(side)) ** 0.5 < 0.5 / P.SAMPLES ** 0.5 * 1.2


def test_edges(spark):
    rows = [(None, "a b"), (1, None), (2, ""), (3, "x"), (4, "é😀é😀é"), (5, "same words here"), (6, "SAME words\there"), (7, "t1 t1 t1 t2")]
    df = spark.createDataFrame([(k, t, 0, 0) for k, t in rows], SCHEMA)
    out = {r["doc_id"]: r for r in P.fingerprint_edits(df).collect()}
    assert set(out) == {k for k, _ in rows}
    assert out[1]["fingerprint"] == out[2]["fingerprint"] == "" and out[2]["near_next"] == 1.0 and out[3]["near_next"] == 0.0
    assert out[5]["fingerprint"] == out[6]["fingerprint"] and out[6]["near_next"] == 1.0
    assert out[4]["edited_sha256"] == hashlib.sha256("é😀éx".encode()).hexdigest() and out[4]["n_chars"] == 5
    assert out[1]["edited_sha256"] == hashlib.sha256(b"").hexdigest()
    assert out[None]["edited_sha256"] == hashlib.sha256(b"a t").hexdigest()


def test_repeated_rows_one_row_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d", 0, 0)] * 3 + [(1, "other", 0, 0)], SCHEMA)
    out = P.fingerprint_edits(df).collect()
    assert len(out) == 2 and {r["n_chars"] for r in out} == {5, 7}
    only = P.fingerprint_edits(spark.createDataFrame([(9, "a b c d", 0, 0)], SCHEMA)).collect()
    assert len(only) == 1 and only[0]["near_next"] == 1.0
    assert P.fingerprint_edits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_collision_rate_is_generalised_jaccard(spark):
    rng = random.Random(4)
    pairs = []
    for i in range(60):
        words = [f"w{i}_{j}" for j in range(20)]
        pairs.append((" ".join(w for w in words for _ in range(rng.randrange(6))), " ".join(w for w in words for _ in range(rng.randrange(6)))))
    rows = [(i, s, t) for i, p in enumerate(pairs) for s, t in enumerate(p)]
    prints = {(r["i"], r["s"]): r["fingerprint"] for r in P.fingerprints(spark.createDataFrame(rows, "i int, s int, text string"), ["i", "s"], 64).collect()}
    errors = []
    for i, (a, b) in enumerate(pairs):
        x, y = prints[i, 0], prints[i, 1]
        errors.append(sum(x[j:j + 8] == y[j:j + 8] for j in range(0, len(x), 8)) / 64 - similarity(a, b))
    assert abs(sum(errors) / len(errors)) < 0.03
