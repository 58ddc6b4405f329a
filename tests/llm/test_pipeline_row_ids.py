import random
from collections import Counter

import corpus_pipeline as C
from conftest import SF_SMALL

SCHEMA = "doc_id long, text string, n_chars long, source string"
rng = random.Random(11)


def words(n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n))


def run(spark, stage, rows):
    df = spark.createDataFrame([(k, t, len(t or ""), "s") for k, t in rows], SCHEMA).repartition(3)
    out = stage(spark, df, SF_SMALL)
    assert out.schema.simpleString() == df.schema.simpleString()
    kept = out.collect()
    assert all(r["n_chars"] == len(r["text"] or "") for r in kept)
    return Counter((r["doc_id"], r["text"]) for r in kept)


def test_line_dedup_of_null_and_repeated_ids(spark):
    one, two, three, four = (words(6) for _ in range(4))
    rows = [(1, one), (5, f"{one}\n{two}"), (5, f"{three}\n{four}"), (None, f"{four}\n\n{two}"), (None, None), (None, "x\n" + words(5)), (8, one), (8, one)]
    want = Counter([(1, one), (5, two), (5, f"{three}\n{four}"), (None, None), rows[5]])
    assert run(spark, C.drop_repeated_lines, rows) == want


def test_one_of_each_group_of_null_and_repeated_ids(spark):
    a, b, c, d = (words(60) for _ in range(4))
    rows = [(1, a), (1, a), (2, a + " end"), (None, a), (3, b), (3, c), (None, d), (None, d), (None, None), (4, None)]
    want = Counter([(1, a), (3, b), (3, c), (None, d), (None, None), (4, None)])
    assert run(spark, C.one_of_each_group, rows) == want


def test_leaks_of_null_and_repeated_ids(spark):
    item = next(r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect() if r["text"] and len(r["text"].split()) > 8)
    clean, leak = words(40), f"{words(20)} {item} {words(20)}"
    rows = [(None, leak), (None, clean), (7, leak), (7, clean + " x"), (9, clean + " y"), (None, None)]
    assert run(spark, C.drop_leaks, rows) == Counter([rows[1], rows[3], rows[4], rows[5]])


def test_columns_with_private_names_come_through(spark):
    names = ["_doc_id_of_row", "_row", "_gone", "_doc", "_log_weight", "_Doc_Id_Of_Row_"]
    df = spark.createDataFrame([(1, "one line of the text\nanother line", "a", *range(6)), (None, "one line of the text", "b", *range(6)), (1, "third line of it all", "c", *range(6))],
                               "doc_id long, text string, source string, " + ", ".join(f"{n} long" for n in names))
    for stage in (C.drop_repeated_lines, C.one_of_each_group, C.drop_leaks):
        out = stage(spark, df, SF_SMALL)
        assert out.columns == df.columns
        assert all(tuple(r[n] for n in names) == tuple(range(6)) for r in out.collect())


def test_short_benchmark_items_are_held_by_equal_texts_only(spark):
    from shortfall.llm import decontam

    docs = spark.createDataFrame([(1, "Blue  whales SING"), (2, "blue whales sing loudly"), (3, "x blue whales sing")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "blue whales sing"), (8, " "), (9, None)], "item_id long, text string")
    assert [tuple(r) for r in decontam.leaks(docs, items).collect()] == [(1, 7, 1.0)]
