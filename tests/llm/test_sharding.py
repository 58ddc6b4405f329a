import hashlib

import duckdb
import pytest
from conftest import SF_SMALL
from shortfall.llm import sharding as S

SHARDS = [f"s{i}" for i in range(5)]


def fill(shards, m):
    """The lookup table by taking turns, one slot at a time."""
    h = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:13], 16)
    prefer = []
    for s in shards:
        offset, step = h(s + ":offset") % m, h(s + ":step") % (m - 1) + 1
        prefer.append(iter(sorted(range(m), key=lambda x: (x - offset) * step % m)))
    table, turn = {}, 0
    while len(table) < m:
        for slot in prefer[turn % len(shards)]:
            if slot not in table:
                table[slot] = shards[turn % len(shards)]
                break
        turn += 1
    return table


def test_table_equals_turn_taking_and_is_even(spark):
    for m in (5, 101, 1009):
        got = dict(map(tuple, S.lookup_table(spark, SHARDS, m).collect()))
        assert got == fill(SHARDS, m)
        sizes = [list(got.values()).count(s) for s in SHARDS]
        assert max(sizes) - min(sizes) <= 1


def test_oracle(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
    got = sorted(map(tuple, S.place(docs, "doc_id", SHARDS, 211).collect()))
    assert got == sorted(con.execute(S.oracle_sql(SHARDS, 211)).fetchall())


def test_removing_a_shard_moves_few_other_slots(spark):
    a, b = (dict(map(tuple, S.lookup_table(spark, x, 1009).collect())) for x in (SHARDS, SHARDS[:-1]))
    moved = sum(1 for k in a if a[k] != SHARDS[-1] and a[k] != b[k])
    assert moved < 0.15 * 1009


def test_edges(spark, tmp_path):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "key long, extra string")
    out = S.place(df, "key", SHARDS, 101).collect()
    assert len(out) == 3 and len({r["shard"] for r in out if r["key"] == 1}) == 1 and all(r["shard"] for r in out)
    assert S.place(df.limit(0), "key", SHARDS, 101).count() == 0
    with pytest.raises(ValueError):
        S.place(df.withColumnRenamed("extra", "Slot"), "key", SHARDS, 101)
    for shards, m in ((SHARDS, 100), ([], 101), (["a", "a"], 101), (SHARDS, 3)):
        with pytest.raises(ValueError):
            S.lookup_table(spark, shards, m)
    S.write_shards(S.place(df, "key", SHARDS, 101), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
    plan = S.place(df, "key", SHARDS, 101)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan
