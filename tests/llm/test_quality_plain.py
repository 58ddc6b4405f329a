from collections import Counter

import numpy as np
import plain_quality as P
import pytest
from conftest import SF_SMALL
from shortfall.llm import quality as Q
from shortfall.llm import queries


@pytest.mark.parametrize("buckets,rows", [(1 << 20, Q.LABELLED_ROWS), (1 << 10, 60)])
def test_counts_ratios_weights_and_kept_rows_equal_plain_python(spark, buckets, rows):
    table = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    table += [(None, "a row without an id"), (100_001, None), (100_002, " \t\n"), table[3], (table[4][0], "Other text -- of the same id!"), (100_003, "Größe, naïve; 数据?!")]
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()]
    labels += [(None, 1, 0), (100_003, None, 0), (labels[0][0], 0, 1)]
    ratio, weights, k, kept = P.resample(table, labels, buckets, rows, Q.SEED)
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got, model, least = Q.resample(docs, marked, buckets, rows)
    assert np.allclose(model.ratio, ratio, atol=1e-6)
    found = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["log_weight"], r["key"]) for r in got.collect()))
    want = sorted((table[i][0] is None, table[i][0] or 0, *weights[i]) for i in kept)
    assert [f[:2] for f in found] == [w[:2] for w in want] and 0 < k < len(weights)
    assert np.allclose([f[2:] for f in found], [w[2:] for w in want], atol=1e-4)
    assert least == pytest.approx(min(w[3] for w in want), abs=1e-4)
    out = Q.select(docs, marked, buckets, rows).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(table[i] for i in kept)


def test_query_equals_plain_python(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()]
    _, _, _, kept = P.resample(docs, labels, Q.BUCKETS, Q.LABELLED_ROWS, Q.SEED)
    got = queries.QUERIES["op2_quality_classifier"](spark, SF_SMALL)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(docs[i][0] for i in kept)
