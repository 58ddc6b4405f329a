import corpus_pipeline as C
from conftest import SF_SMALL
from shortfall.llm import linededup as L
from shortfall.llm import queries
from test_linededup import SCHEMA, brute, got


def test_query_equals_brute_force_without_minima(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = brute([(r["doc_id"], r["text"]) for r in rows], min_chars=1, min_edit=10)
    text = {r["doc_id"]: r["text"].split("\n") for r in rows if r["text"]}
    assert any(len(text[k][i]) < 10 for k, i in want) and any(10 <= len(text[k][i]) < 30 for k, i in want)
    assert got(queries.op6_line_dedup(spark, SF_SMALL)) == {p: c for p, c in want.items() if text[p[0]][p[1]].strip(" \t\r")}


def test_short_lines_and_blank_lines(spark):
    docs = [(1, "Les.\n\n  \n}\nAre, is anwh reenen.\nab"), (2, "Les.\n\n  \n}\nAre. Is anwh reenen.\nabc"), (3, "quite another line of text\nab\nxyz w")]
    df = spark.createDataFrame([(k, t, len(t), "", 0) for k, t in docs], SCHEMA)
    kept = {r["doc_id"]: r["text"] for r in C.drop_repeated_lines(spark, df, "").collect()}
    assert kept == {1: docs[0][1], 2: "\n  \nabc", 3: "quite another line of text\nxyz w"}


def test_lines_just_longer_than_the_edits(spark):
    words = [a + b + c + d for a in "pq" for b in "rs" for c in ("", "tu", "vwxyz") for d in ("", "k", "lmnop")]
    docs = [(i, w) for i, w in enumerate(words * 2)]
    df = spark.createDataFrame([(k, t, len(t), "", 0) for k, t in docs], SCHEMA)
    assert got(L.classes(df, **L.ALL_LINES)) == brute(docs, min_chars=1, min_edit=10)


def test_short_lines_that_only_look_alike_stay(spark):
    docs = [(1, "Yes.\n$10\nv1.2"), (2, "No."), (3, "Die.\n$25"), (4, "Wh.\nv1.3"), (5, "As."), (6, "Yes.\nsome text of 10")]
    df = spark.createDataFrame([(k, t, len(t), "", 0) for k, t in docs], SCHEMA)
    kept = {r["doc_id"]: r["text"] for r in C.drop_repeated_lines(spark, df, "").collect()}
    assert kept == {**dict(docs), 6: "some text of 10"}


def test_the_shorter_line_says_how_many_edits(spark):
    a, b = "a line of 19 letter", "twenty characters ok"
    assert (len(a), len(b)) == (19, 20)
    docs = [(1, a), (2, a + "s"), (3, a[:-2] + "xxr"), (4, b), (5, b[:-2] + "xy"), (6, b[:-3] + "xyz"), (7, "nine char"), (8, "nine chat"), (9, "ten charac"), (10, "ten charak")]
    df = spark.createDataFrame([(k, t, len(t), "", 0) for k, t in docs], SCHEMA)
    assert got(L.classes(df, **L.ALL_LINES)) == brute(docs, min_chars=1, min_edit=10) == {
        (1, 0): (1, 0), (2, 0): (1, 0), (4, 0): (4, 0), (5, 0): (4, 0), (6, 0): (4, 0), (9, 0): (9, 0), (10, 0): (9, 0)}
