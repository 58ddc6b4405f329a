"""Property tests: the Spark expressions against plain-Python models of the
spreadsheet float semantics (NaN shown as NULL)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shortfall import functions as X

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)
special = st.sampled_from([0.0, -0.0, math.inf, -math.inf, math.nan])
num = st.one_of(st.none(), finite, special)
SETTINGS = dict(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))


def py_div(n, d):
    if n is None or d is None or math.isnan(n) or math.isnan(d):
        return None
    if d == 0:
        return math.inf if n > 0 else -math.inf if n < 0 else None
    r = n / d
    return None if math.isnan(r) else r


def py_ceil(x):
    if x is None or math.isinf(x):
        return x
    return float(math.ceil(x))


def py_clamp(x):
    return None if x is None or math.isnan(x) else max(x, 0.0)


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    return a == b or (math.isclose(a, b, rel_tol=1e-12, abs_tol=0.0))


@settings(**SETTINGS)
@given(st.lists(st.tuples(num, num), min_size=1, max_size=200))
def test_division_ceil_clamp(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double")
    out = df.select(X.ieee_div("a", "b").alias("q"), X.ceil_double(X.ieee_div("a", "b")).alias("c"),
                    X.clamp_min0("a").alias("k"), X.safe_sub("a", "b").alias("s")).collect()
    for (a, b), r in zip(pairs, out):
        assert same(r.q, py_div(a, b))
        assert same(r.c, py_ceil(py_div(a, b)))
        assert same(r.k, py_clamp(a))
        diff = None if a is None or b is None else a - b
        assert same(r.s, None if diff is None or math.isnan(diff) else diff)


uoms = st.sampled_from(["EA", "BX", "CA", "CS", "PK", " BX", "BX ", ""])


def py_remove(lst, tok):
    if lst is None or tok is None:
        return lst
    parts = [u.strip() for u in lst.split(",") if u.strip()]
    return ",".join(u for u in parts if u != tok.strip())


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.one_of(st.none(), st.lists(uoms, max_size=5).map(",".join)),
                          st.one_of(st.none(), uoms)), min_size=1, max_size=100))
def test_remove_token(spark, pairs):
    df = spark.createDataFrame(pairs, "l string, t string")
    out = [r[0] for r in df.select(X.remove_token("l", "t")).collect()]
    assert out == [py_remove(lst, tok) for lst, tok in pairs]
