"""Cross-tokenizer alignment against a plain version with the libraries."""

import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from conftest import SF_SMALL
from shortfall.llm import align as A
from tokenizers import Tokenizer

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "text string, links string, doc_id long, n_a string"
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_values():
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def plain(texts):
    """Rows of the query for ``texts``, token by token."""
    a_lib = Tokenizer.from_file(A_PATH)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    table = byte_values()

    def piece(i):
        p = b_lib.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()

    found, groups = [], []
    for text in texts:
        links, cut = [], []
        if text:
            a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            a_bytes = [bytes(table[c] for c in a_lib.id_to_token(i)) for i in a]
            b_bytes = [piece(i) for i in b]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                i = j = x = y = i0 = j0 = 0
                while i < len(a) or j < len(b):
                    if x <= y and i < len(a):
                        x += len(a_bytes[i]); i += 1
                    else:
                        y += len(b_bytes[j]); j += 1
                    if x == y and i > i0 and j > j0:
                        cut.append((a[i0:i], b[j0:j]))
                        links.append((a[i - 1], b[j - 1]))
                        i0, j0 = i, j
        found.append(links)
        groups.append(cut)
    count = Counter(x for links in found for x in links)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for links, cut in zip(found, groups):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in cut)
        out.append((sum(len(a) for a, _ in cut), sum(len(b) for _, b in cut), len(cut), len(links), sum(count[x] == most[x[1]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if cut else ""))
    return out


EDGES = ["", " ", "  ", "a", " a", "a  b", "▁a b", "tab\tnew\n\nline \r\n", "<s> </s> <unk> <0x41> <|endoftext|>", "a\0b", "é ﬁ ①", "日本語 𐍈 🙂🙂", "x y", "a" * 3000, " " * 300,
         None, "don't  you'll", "́", "the " * 800, "\U0010ffff", "   lead and trail   "]


def rows(df, ids):
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in df.collect()}
    return [got[i] for i in ids]


def test_edge_texts(spark):
    docs = spark.createDataFrame([(t, "clash", i, "clash") for i, t in enumerate(EDGES)], SCHEMA)
    assert rows(A.align_tokenizers(docs, A_PATH, B_PATH), range(len(EDGES))) == plain(EDGES)


def test_documents_equal_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    own = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert rows(A.align_tokenizers(docs.repartition(3), A_PATH, B_PATH), [i for i, _ in own]) == plain([t for _, t in own])


def test_texts_over_the_block_size_and_repeated_rows(spark, monkeypatch):
    long_ = "Words, many words of  it; ünd so on.\n" * 70_000         # 2.6 MB
    texts = ["one two", long_, "one two", "<pad> x"]
    docs = spark.createDataFrame([(t, "", None if i == 3 else i, "") for i, t in enumerate(texts)] + [("one two", "", 0, "")], SCHEMA)
    want = plain([*texts, "one two"])
    got = sorted((str(r["doc_id"]), *(r[n] for n in NAMES)) for r in A.align_tokenizers(docs, A_PATH, B_PATH).collect())
    assert got == sorted((k, *w) for k, w in zip(("0", "1", "2", "None", "0"), want))


def test_groups_and_empty_tables(spark):
    docs = spark.createDataFrame([("Hello there, Wörld", "", 1, "")], SCHEMA)
    r = A.align(docs, A_PATH, B_PATH, with_groups=True).first()
    assert hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] and len(r["links"]) == r["n_groups"] == r["groups"].count("|")
    pairs = A.linkable(A_PATH, B_PATH)
    last = r["groups"].split(";")[-1].split("|")
    assert (pairs.a[r["links"][-1]], pairs.b[r["links"][-1]]) == (int(last[0].split(",")[-1]), int(last[1].split(",")[-1]))
    assert A.align_tokenizers(docs.limit(0), A_PATH, B_PATH).collect() == []


def test_pairs_are_bounded_by_the_vocabularies():
    va, vb = A.byte_level(A_PATH), A.piece_level(B_PATH)
    assert len(A.linkable(A_PATH, B_PATH)) <= 2 * int(va.lengths.sum() + vb.lengths.sum())
