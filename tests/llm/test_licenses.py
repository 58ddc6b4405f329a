import duckdb
from conftest import SF_MID
from shortfall.llm import licenses as L
from shortfall.llm import queries

SCHEMA = "path string, text string, license_id string, score double"


def scan(spark, rows, **more):
    df = spark.createDataFrame([(p, t, "", 0.0) for p, t in rows], SCHEMA)
    out = L.scan(df, L.template_table(spark), **more).collect()
    return {r["path"]: (r["license_id"], r["origin"], r["from_dir"]) for r in out}, out


def test_headers_files_and_nearest_ancestor(spark):
    apache, mit, gpl = L.TEMPLATES[1][1], L.TEMPLATES[8][1], L.TEMPLATES[6][1]
    code = "some ordinary words of a program that go on and on\nfor several lines of text\n"
    got, rows = scan(spark, [
        ("LICENSE", mit), ("a/b/LICENSE", gpl), ("a/b/NOTES", mit.lower() + "?!"), ("a/x.py", code), ("a/b/y.py", code), ("a/b/c/d/z.py", code),
        ("a/b/h.py", "# " + apache.upper() + "\n" + code * 3), ("q/two.py", code + gpl + "\n" + code), ("q/none.txt", ""), ("q/null.txt", None), (None, mit)])
    assert got["LICENSE"] == ("MIT", "file", None)
    assert got["a/x.py"] == ("MIT", "inherited", "") and got["q/none.txt"] == ("MIT", "inherited", "") and got["q/null.txt"] == ("MIT", "inherited", "")
    assert got["a/b/y.py"] == ("GPL-3.0", "inherited", "a/b") and got["a/b/c/d/z.py"] == ("GPL-3.0", "inherited", "a/b")
    assert got["a/b/h.py"] == ("Apache-2.0", "header", None) and got["q/two.py"] == ("GPL-3.0", "header", None)
    assert got[None] == (None, None, None)
    assert {r["score"] for r in rows if r["origin"] == "file"} == {1.0}


def test_whole_licence_file_spdx_lines_and_rights_reserved(spark):
    full = next(t for n, t in L.TEMPLATES if n == "MIT" and "WARRANTY" in t)
    file = "MIT License\n\nCopyright (c) 2024 Somebody\n\n" + full.replace(". ", ".\n")
    code = "\n".join(" ".join(f"word{i}{j}" for j in "abcdefgh") for i in range(12)) + "\n"
    got, _ = scan(spark, [("LICENSE", file), ("src/a.py", code), ("src/deep/b.py", code * 2), ("src/c.py", "# SPDX-License-Identifier: GPL-2.0\n" + code),
                          ("src/d.py", "All rights reserved.\n" + code * 3), ("src/e.py", "# SPDX-License-Identifier: BSD-2-Clause\n" + code)])
    assert got["LICENSE"] == ("MIT", "file", None)
    assert got["src/a.py"] == got["src/deep/b.py"] == ("MIT", "inherited", "")
    assert got["src/c.py"][:2] == ("GPL-2.0", "header") and got["src/e.py"][:2] == ("BSD-2-Clause", "header")
    assert got["src/d.py"] == ("LicenseRef-All-Rights-Reserved", "header", None)


def test_common_words_beside_a_notice_weigh_little(spark):
    common = [(f"x/{i}", "zuv wot bak lim neb ort " + " ".join(f"w{i}k{j}" for j in range(6))) for i in range(200)]
    got, _ = scan(spark, [*common, ("y/a", "zuv wot bak lim neb ort released under the mit license"), ("z/b", "qqq rrr sss ttt uuu vvv released under the mit license")])
    assert got["y/a"][:2] == ("MIT", "file") and got["z/b"][0] is None


def test_multi_line_header_is_a_paragraph(spark):
    text = L.TEMPLATES[7][1].replace(" of ", " of\n").replace("; ", ";\n")
    got, _ = scan(spark, [("p/a.c", "int main\n\n" + text + "\n \nreturn here and there\n" * 5)])
    assert got["p/a.c"] == ("GPL-3.0", "header", None)


def test_empty_tables_repeats_and_no_templates(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert L.scan(empty, L.template_table(spark)).count() == 0
    _, rows = scan(spark, [("d/a", "Released under the MIT License.")] * 2 + [("d/b", "nothing")])
    assert sorted((r["path"], r["license_id"], r["origin"]) for r in rows) == [("d/a", "MIT", "file")] * 2 + [("d/b", "MIT", "inherited")]
    none = L.scan(spark.createDataFrame([("d/a", "Released under the MIT License.", "", 0.0)], SCHEMA), L.template_table(spark).limit(0)).collect()
    assert [(r["license_id"], r["origin"]) for r in none] == [(None, None)]


def test_oracle_on_documents(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_MID}/documents.parquet'")
    want = sorted(con.execute(queries.oracle_sql()["op4_license_scan"]).fetchall(), key=str)
    got = sorted(map(tuple, queries.QUERIES["op4_license_scan"](spark, SF_MID).collect()), key=str)
    assert got == want and {r[3] for r in got} >= {"header"}


def test_texts_are_split_once(spark, monkeypatch):
    names, pin = [], L.pin
    monkeypatch.setattr(L, "pin", lambda df, name, folder=None: names.append(name) or pin(df, name, folder))
    got, _ = scan(spark, [("a/x", "code\n# Released under the MIT License.\nmore code\n\nnothing"), ("a/y", "plain")])
    assert got["a/x"][:2] == ("MIT", "header") and got["a/y"][0] is None and "counted" in names
