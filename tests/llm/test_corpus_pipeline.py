import __spark_entry__ as E
import corpus_pipeline as C
from conftest import SF_SMALL


def test_stages_hand_documents_on(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = docs.columns
    for name, stage in C.STAGES[:-1]:
        after = stage(spark, docs, SF_SMALL)
        assert after.columns == before and after.schema.simpleString() == docs.schema.simpleString(), name
        n, m = docs.count(), after.count()
        assert 0 < m <= n, name
    pieces = C.run(spark, SF_SMALL)
    assert pieces.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"] and pieces.count() > 0
    assert C.ORACLE_SQL is None


def test_registered():
    queries = E.queries()
    assert "pipeline" in queries and [sum(q.startswith(f"op{n}_") for q in queries) for n in range(1, 11)] == [1] * 10
    assert [n for n, _ in C.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
