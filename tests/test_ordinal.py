"""Order-dependent operators: agreement with window functions, and the same
result whatever the partitioning (1, 4 or 16 shuffle partitions)."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shortfall.operators.ordinal import latest_per_key, sequence


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = [(f"k{rnd.randint(0, 30)}", rnd.choice([None, rnd.randint(0, 50)]), i, f"p{i}") for i in range(3000)]
    # one hot key holding a third of all rows
    rows += [("hot", rnd.randint(0, 1000), 10_000 + i, f"h{i}") for i in range(1500)]
    return spark.createDataFrame(rows, "k string, s int, t int, payload string")


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_latest_per_key_matches_window(spark, data, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {tuple(r) for r in latest_per_key(data.repartition(parts), ["k"], ["s", "t"]).collect()}
        w = Window.partitionBy("k").orderBy(F.col("s").desc_nulls_last(), F.col("t").desc_nulls_last())
        want = {tuple(r) for r in data.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn").collect()}
        assert got == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_sequence_is_dense_and_ordered(spark, data, parts):
    out = sequence(data.orderBy(F.rand(parts)), [F.col("payload").asc()], partitions=parts)
    got = [(r.payload, r.row_id) for r in out.collect()]
    assert sorted(i for _, i in got) == list(range(1, data.count() + 1))
    want = {p: i + 1 for i, p in enumerate(sorted(r.payload for r in data.collect()))}
    assert all(want[p] == i for p, i in got)
