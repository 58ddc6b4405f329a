"""Conversation repair against exhaustive search, whole conversations and cut ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from conftest import SF_SMALL
from shortfall.llm import dialogue as D

SCHEMA = "text string, conv_id long, role string, extra int, turn long, _conv string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")
LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")


def faults(rows):
    out = []
    for i, (role, text) in enumerate(rows):
        if not BLANK.search(text):
            out.append("blank")
        elif (role, text) in rows[:i]:
            out.append("duplicate")
        else:
            out.append("" if LAST.search(text).group(1) in ".!?" else "truncated")
    return out


def exhaustive(rows, inserts=3):
    """(cost, audit, repaired) of the cheapest edits by trying all of them."""
    wrong = faults(rows)
    choices = [[("D", None, None, 2)] + ([] if w in ("blank", "duplicate") else [
        ("K", role, text, 5 * (w == "truncated")), *(("R", r, text, 1 + 5 * (w == "truncated")) for r in ("user", "assistant"))])
        for (role, text), w in zip(rows, wrong)]
    best = None
    for steps in itertools.product(*choices):
        for n in range(inserts + 1):
            for places in itertools.combinations_with_replacement(range(len(rows) + 1), n):
                for roles in itertools.product(("user", "assistant"), repeat=n):
                    made, at = [], list(zip(places, roles))
                    for i in range(len(rows) + 1):
                        made += [("I", r, "", 5) for p, r in at if p == i]
                        if i < len(rows):
                            made.append(steps[i])
                    kept = [(r, t) for _, r, t, _ in made if r is not None]
                    if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in kept)) and all(r for r, _ in kept):
                        key = sum(c for *_, c in made), "".join(m for m, *_ in made), kept
                        best = min(best, key) if best else key
    return best


@pytest.mark.parametrize("seed", range(8))
def test_cheapest_edits_equal_exhaustive_search(seed):
    rng = random.Random(seed)
    for _ in range(12):
        rows = [(rng.choice(["user", "assistant", "system", "tool", "", " "]), rng.choice(["A.", "b", "", " \t", "C? ", " "])) for _ in range(rng.randrange(0, 4))]
        wrong = D._faults([{"role": r, "text": t} for r, t in rows])
        best = D.accept(D.parse(wrong))
        cost, audit, kept = exhaustive(rows)
        assert (best.cost, best.audit) == (cost, audit), rows
        assert [(t["role"], t["text"]) for t in D.apply(best.audit, [{"role": r, "text": t} for r, t in rows])] == kept


def plain(table):
    """The query's rows by whole conversations in plain Python."""
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, kind = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [t for t, _, _ in rows if t is not None]
        wrong = faults([r[1:] for r in rows])
        letters = [r[1][:1] for r in rows]
        as_rows = [{"role": r, "text": t} for _, r, t in rows]
        best = D.accept(D.parse(D._faults(as_rows)))
        text = "\n".join(f"{t['role']}:{t['text']}" for t in D.apply(best.audit, as_rows))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, wrong.count("blank"), wrong.count("duplicate"), wrong.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:])), best.cost, best.audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def got(df):
    names = [*D.NUMBERS, "audit", "repaired_sha256"]
    rows = df.collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def test_whole_table_equals_plain_version(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    assert got(D.repair_damaged(table)) == plain([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()])


@pytest.mark.parametrize("sizes", [{}, {"segment_rows": 3}, {"segment_rows": 7, "segment_bytes": 20}])
def test_long_and_odd_conversations_over_tasks_and_segments(spark, sizes):
    rng = random.Random(5)
    texts = ["Yes.", "no", "", " ", "What?\n", "Same again.", "▁  ", "x" * 500 + "!", None]
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", ""]
    table = [(c, t, rng.choice(roles), f"{rng.choice(texts)}" if rng.random() < .7 else f"turn {t} of {c}.") for c in range(12) for t in rng.sample(range(40), rng.randrange(1, 30))]
    table += [(77, t, ("user", "assistant")[t % 2], f"message {t % 50}.") for t in range(400)]          # one conversation, most of the rows
    table += [(None, t, "user", None) for t in range(3)] + [(5000, None, "user", "Hi."), (5001, None, None, None)]
    df = spark.createDataFrame([(x, c, r, 1, t, "clash") for c, t, r, x in table], SCHEMA).repartition(5)
    assert got(D.repair_damaged(df, **sizes)) == plain(table)


def test_ties_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([("Same.", 1, "user", 0, 3, ""), ("Same.", 1, "user", 0, 3, ""), ("B.", 1, "assistant", 0, 3, ""), ("A.", 1, "assistant", 0, 3, "")], SCHEMA)
    first, second = got(D.repair_damaged(df)), got(D.repair_damaged(df.repartition(4)))
    assert first == second and first[1][:4] == (0, 0, 1, 0)             # a repeated row is a duplicate
    assert D.repair_damaged(df.limit(0)).collect() == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    gone = spark.createDataFrame([("Hello.", dropped, "user", 0, 0, "")], SCHEMA)
    assert got(D.repair_damaged(gone)) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_turns_are_whole_outputs(spark):
    df = spark.createDataFrame([("Hi.", 9, "user", 0, 0, ""), ("Hello!", 9, "user", 0, 1, ""), ("Bye", 9, "assistant", 0, 2, "")], SCHEMA)
    part = D.repair(df).collect()
    assert len(part) == 1 and part[0]["last"] and part[0]["audit"] == "KRD"
    assert [(t["role"], t["text"]) for t in part[0]["turns"]] == [("user", "Hi."), ("assistant", "Hello!")]
