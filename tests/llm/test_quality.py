import math

from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F
from shortfall.llm import quality as Q

SCHEMA = "doc_id long, text string, key double, log_weight double"
LABELS = "doc_id long, quality int, toxic int, text string"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(4)) == 0
    kept = {r["doc_id"] for r in Q.resample(docs, labels.where(~held))[0].select("doc_id").collect()}
    rate = {(q, t): [] for q in (0, 1) for t in (0, 1)}
    for r in labels.where(held).collect():
        rate[r["quality"], r["toxic"]].append(r["doc_id"] in kept)
    share = {k: sum(v) / len(v) for k, v in rate.items()}
    assert share[1, 0] > 0.97 and share[0, 0] < 0.05 and share[0, 1] < 0.1 and share[1, 1] < 0.4


def test_select_keeps_the_same_rows_and_all_columns(spark):
    docs, labels = spark.read.parquet(f"{SF_MID}/documents.parquet"), spark.read.parquet(f"{SF_MID}/labels.parquet")
    kept = Q.resample(docs.repartition(3), labels)[0].collect()
    out = Q.select(docs, labels)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in kept) == sorted(r["doc_id"] for r in out.collect())


def test_threshold_is_the_kth_largest_key(spark):
    values = [math.sin(i) * 10 for i in range(997)] + [3.0] * 20
    df = spark.createDataFrame([(v,) for v in values], "key double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 300, 500, 996, len(values)):
        for few in (1, 10_000):
            assert Q.threshold(df, k, bins=16, few=few) == ordered[k - 1]
    assert Q.threshold(df, 0) == math.inf


def test_edges(spark):
    docs = spark.createDataFrame([(1, "good words", 0.0, 0.0), (2, None, 0.0, 0.0), (3, " ", 0.0, 0.0), (None, "x", 0.0, 0.0), (1, "good words", 0.0, 0.0)], SCHEMA)
    none = spark.createDataFrame([(None, 1, 0, ""), (1, None, 0, "")], LABELS)
    assert sorted((r["doc_id"] or 0) for r in Q.select(docs, none).collect()) == [0, 1, 1]
    assert Q.resample(docs.limit(0), none)[0].count() == 0 and Q.select(docs.limit(0), none).count() == 0
    labelled = spark.createDataFrame([(1, 1, 0, ""), (1, 0, 0, ""), (2, 1, 1, "")], LABELS)
    assert Q.select(docs, labelled).columns == docs.columns
    small = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert Q.select(small, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).count() <= small.count()


def test_encoding_leaves_nothing_once_it_is_forgotten():
    from shortfall.llm import queries, tokens
    tokens.load(queries.tokenizer("byte_bpe_50k.json"))
    tokens._kept["x"] = ({"a": b"1"}, [1])
    tokens.forget_all()
    assert not tokens._kept and tokens.load.cache_info().currsize == 0 and Q.BLOCK_BYTES < Q.T.BLOCK_BYTES
