import random

from brute import WORD, lower, shingles
from conftest import SF_MID
from shortfall.llm import decontam as D

DOCS, ITEMS = "x string, doc_id long, text string, item_id long", "item_id long, text string, doc_id long"


def brute(docs, items, t=0.75):
    out = set()
    sets = {}
    for i, text in items:
        if len(WORD.findall(lower(text or ""))) >= 5:
            sets[i] = shingles(text)
    for d, text in docs:
        have = shingles(text)
        for i, s in sets.items():
            share = len(s & have) / len(s)
            if share >= t:
                out.add((d, i, round(share, 9)))
    return out


def got(df):
    return {(r["doc_id"], r["item_id"], round(r["containment"], 9)) for r in df.collect()}


def test_equals_brute_force_on_documents(spark):
    docs, items = spark.read.parquet(f"{SF_MID}/documents.parquet"), spark.read.parquet(f"{SF_MID}/benchmark.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert len(want) > 3 and got(D.leaks(docs, items)) == want


def test_items_of_all_sizes_anywhere_in_long_documents(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(size))) for k, size in enumerate([5, 6, 9, 14, 20, 33, 40, 64, 70, 150, 300])] + [(50, None), (51, ""), (52, "one two")]
    docs = [(0, None), (1, ""), (2, "a b c")]
    for k, text in items[:11]:
        for _ in range(3):
            words = text.split()
            if len(words) > 30:
                words[rng.randrange(len(words))] = word()
            docs.append((len(docs), " ".join([word() for _ in range(rng.randrange(4000))] + [w.upper() for w in words] + [word() for _ in range(rng.randrange(500))])))
        half = text.split()[: len(text.split()) // 2]
        docs.append((len(docs), " ".join([word() for _ in range(300)] + half)))
    d = spark.createDataFrame([("", k, t, None) for k, t in docs], DOCS)
    i = spark.createDataFrame([(k, t, 0) for k, t in items], ITEMS)
    want = brute(docs, items)
    assert len(want) >= 30 and got(D.leaks(d, i)) == want
    monkeypatch.setattr(D, "BLOCK_SHINGLES", 1500)                 # several blocks of items
    assert got(D.leaks(d, i)) == want
    kept = {r["doc_id"] for r in D.remove_leaks(d, i).collect()}
    assert kept == {k for k, _ in docs} - {x[0] for x in want}
    assert D.remove_leaks(d, i).columns == d.columns


def test_empty_tables(spark):
    d, i = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    one = spark.createDataFrame([("", 1, "a b c d e f", 0)], DOCS)
    assert D.leaks(d, i).count() == 0 and D.leaks(one, i).count() == 0 and D.remove_leaks(one, i).count() == 1
