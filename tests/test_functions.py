"""Null / NaN / infinity rules of the expression helpers."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shortfall import functions as X


def one(spark, expr, schema="a double, b double", data=((1.0, 2.0),)):
    return [r[0] for r in spark.createDataFrame(list(data), schema).select(expr).collect()]


def test_ieee_div(spark):
    data = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, None), (6.0, 3.0),
            (float("inf"), float("inf"))]
    got = one(spark, X.ieee_div("a", "b"), data=data)
    assert got[0] == math.inf and got[1] == -math.inf
    assert got[2] is None and got[3] is None and got[4] is None
    assert got[5] == 2.0
    assert got[6] is None  # inf/inf is NaN -> NULL


def test_ceil_double_keeps_inf_and_type(spark):
    data = [(2.1, 0.0), (float("inf"), 0.0), (float("-inf"), 0.0), (None, 0.0)]
    df = spark.createDataFrame(data, "a double, b double").select(X.ceil_double("a").alias("c"))
    assert dict(df.dtypes)["c"] == "double"
    got = [r[0] for r in df.collect()]
    assert got[:3] == [3.0, math.inf, -math.inf] and got[3] is None


def test_clamp_min0_keeps_null(spark):
    got = one(spark, X.clamp_min0("a"), data=[(-5.0, 0.0), (float("-inf"), 0.0), (None, 0.0), (3.0, 0.0)])
    assert got == [0.0, 0.0, None, 3.0]


def test_safe_ops(spark):
    got = one(spark, X.safe_sub("a", "b"), data=[(float("inf"), float("inf"))])
    assert got == [None]
    got = one(spark, X.safe_mul("a", "b"), data=[(float("inf"), 0.0)])
    assert got == [None]


def test_floor_days_negative_partial_day(spark):
    df = spark.createDataFrame([(datetime(2026, 3, 18), datetime(2026, 3, 22))], "d timestamp_ntz, e timestamp_ntz")
    as_of = X.ts_lit("2026-03-18 11:30:00")
    got = df.select(X.floor_days("d", as_of), X.floor_days("e", as_of)).collect()[0]
    assert tuple(got) == (-1.0, 3.0)


def test_review_flag_nulls_and_nan_are_okay(spark):
    data = [(-2.0, 0.0), (-10.0, 0.0), (-12.0, 0.0), (None, 0.0), (float("nan"), 0.0), (float("inf"), 0.0)]
    got = one(spark, X.review_flag("a", -10), data=data)
    assert got == ["Review", "Review", "Okay", "Okay", "Okay", "Review"]


@pytest.mark.parametrize("lst,tok,want", [
    ("CA,BX", "BX", "CA"), ("BX,BX", "BX", ""), ("CA, BX", "CA", "BX"), (None, "BX", None), ("CA", None, "CA"),
])
def test_remove_token(spark, lst, tok, want):
    got = one(spark, X.remove_token("a", "b"), schema="a string, b string", data=[(lst, tok)])
    assert got == [want]


def test_stamp_text(spark):
    got = one(spark, X.stamp_text(F.col("a")), schema="a timestamp_ntz",
              data=[(datetime(2026, 3, 18, 10, 0, 1, 500000),), (None,)])
    assert got == ["2026-03-18T10:00:01", None]


def test_strict_casts_raise_lenient_casts_null(spark):
    df = spark.createDataFrame([("abc",)], "a string")
    with pytest.raises(Exception):
        df.select(X.strict_double("a")).collect()
    with pytest.raises(Exception):
        df.select(X.strict_timestamp("a")).collect()
    assert df.select(X.lenient_double("a"), X.lenient_timestamp("a")).collect()[0] == (None, None)
    ok = spark.createDataFrame([("2026-03-22", "12.5"), (None, None)], "d string, n string")
    got = ok.select(X.strict_timestamp("d"), X.strict_double("n")).collect()
    assert got[0][0] == datetime(2026, 3, 22) and got[0][1] == 12.5 and tuple(got[1]) == (None, None)


def test_na_tokens(spark):
    got = one(spark, X.na_normalise("a"), schema="a string", data=[("",), ("N/A",), ("NULL",), ("x",)])
    assert got == [None, None, None, "x"]


def test_date_layouts(spark):
    data = [("2026-03-22",), ("2026-03-22 10:11:12",), ("2026-03-22T10:11:12",), ("03/22/2026",),
            ("03/22/2026 10:11:12",)]
    got = [r[0] for r in spark.createDataFrame(data, "s string").select(X.strict_timestamp("s")).collect()]
    assert got == [datetime(2026, 3, 22), datetime(2026, 3, 22, 10, 11, 12), datetime(2026, 3, 22, 10, 11, 12),
                   datetime(2026, 3, 22), datetime(2026, 3, 22, 10, 11, 12)]


def test_cluster_conf_bounds():
    from shortfall.session import cluster_conf
    small = cluster_conf(10 * 2**30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 120          # 3 per core
    big = cluster_conf(100 * 2**40)
    assert int(big["spark.sql.shuffle.partitions"]) == 50_000          # capped
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)
