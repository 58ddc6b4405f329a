import random

import pytest
from brute import Union
from conftest import SF_SMALL
from shortfall.llm import linededup as L
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, n_chars long, line string, h long"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def within(a, b, k):
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    a, b = a[n:], b[n:]
    if not a or not b or not k:
        return max(len(a), len(b)) <= k
    return within(a[1:], b[1:], k - 1) or within(a[1:], b, k - 1) or within(a, b[1:], k - 1)


def brute(docs, edits=2, min_chars=10, min_edit=30):
    """{(doc_id, line_no): (class_doc, class_line)} of lines in classes of two occurrences or more."""
    at = {}
    for k, t in docs:
        if k is not None and t is not None:
            for i, line in enumerate(t.split("\n")):
                if len(line) >= min_chars:
                    at.setdefault(line, set()).add((k, i))
    union, by_length = Union(), {}
    for line in at:
        union.find(line)
        if len(line) >= min_edit:
            by_length.setdefault(len(line), []).append(line)
    for n, some in by_length.items():
        for other in (m for m in range(n, n + edits + 1) if m in by_length):
            for a in some:
                for b in by_length[other]:
                    if (a < b or n != other) and n >= 10:
                        if within(a, b, min(edits, min(len(a), len(b)) // 10)):
                            union.join(a, b)
    groups = {}
    for line, places in at.items():
        groups.setdefault(union.find(line), set()).update(places)
    return {p: min(g) for g in groups.values() if len(g) > 1 for p in g}


def got(df):
    rows = df.collect()
    for r in rows:
        assert r["removed"] == ((r["doc_id"], r["line_no"]) != (r["class_doc"], r["class_line"]))
    return {(r["doc_id"], r["line_no"]): (r["class_doc"], r["class_line"]) for r in rows}


def test_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert len(want) > 50 and got(L.classes(docs)) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_lines_chains_and_edges(spark, seed):
    rng = random.Random(seed)
    char = lambda: rng.choice("abcdefgh é😀")
    pool = ["".join(char() for _ in range(n)) for n in (9, 10, 12, 29, 30, 31, 32, 33, 45, 60, 61, 90)]

    def edit(line):
        s = list(line)
        for _ in range(rng.randrange(4)):
            at, kind = rng.randrange(len(s)), rng.randrange(3)
            if kind == 0:
                s[at] = char()
            elif kind == 1:
                s.insert(at, char())
            else:
                del s[at]
        return "".join(s)

    docs = [(0, None), (1, ""), (2, "\n\n"), (None, pool[8]), (3, pool[8])]
    for _ in range(60):
        picked = [edit(rng.choice(pool)) if rng.random() < 0.7 else rng.choice(pool) for _ in range(rng.randrange(5))]
        if picked and rng.random() < 0.3:
            pool.append(picked[0])                        # chains
        docs.append((len(docs), "\n".join(picked)))
    want = brute(docs)
    df = spark.createDataFrame([(k, t, len(t or ""), "", 0) for k, t in docs], SCHEMA).repartition(3)
    assert got(L.classes(df)) == want
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in L.remove_lines(df).where("doc_id IS NOT NULL").collect()}
    for k, t in docs:
        if k is None:
            continue
        lines = [x for i, x in enumerate((t or "").split("\n")) if want.get((k, i), (k, i)) == (k, i)]
        text = t if t is None or len(lines) == len(t.split("\n")) else "\n".join(lines)
        if text == "" and t != "":
            assert k not in kept
        else:
            assert kept[k] == (text, len(text or ""))


def test_banded_distance_equals_the_matrix(spark):
    rng = random.Random(7)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(12)))
        b = "".join(rng.choice("ab") for _ in range(rng.randrange(12))) if rng.random() < 0.5 else a[:5] + "b" + a[6:]
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    for edits in (0, 1, 2, 3):
        have = sorted(map(tuple, L.within_edits(df, "a", "b", edits).collect()))
        assert have == sorted(p for p in pairs if distance(*p) <= edits)


def test_banded_distance_with_a_limit_for_each_row(spark):
    rng = random.Random(11)
    texts = lambda: "".join(rng.choice("ab") for _ in range(rng.randrange(9)))
    for edits in (2, 3):
        pairs = [(texts(), texts(), rng.randrange(edits + 1)) for _ in range(400)]
        df = spark.createDataFrame(pairs, "a string, b string, most int")
        have = sorted(map(tuple, L.within_edits(df, "a", "b", edits, F.col("most")).collect()))
        assert have == sorted(p for p in pairs if distance(*p[:2]) <= p[2])


def test_no_step_plans_the_others_again(spark, monkeypatch):
    """What the driver plans and compiles at once stays small: no step joins more than four times."""
    joins, pin = {}, L.pin

    def seen(df, name, folder=None):
        joins[name] = df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
        return pin(df, name, folder)

    monkeypatch.setattr(L, "pin", seen)
    rows = [(k, "\n".join("abcdefghij" * 4 + "xyz"[(k + i) % 3] * i for i in range(3)), 0, "", 0) for k in range(6)]
    L.classes(spark.createDataFrame(rows, SCHEMA), **L.ALL_LINES).count()
    assert {"links", "rest", "more"} <= joins.keys() and max(joins.values()) <= 4, joins


def test_native_plan_and_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert L.classes(df).count() == 0 and L.remove_lines(df).columns == df.columns
    plan = L.classes(spark.createDataFrame([(1, "a" * 40, 0, "", 0)], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan
