import subprocess
import sys

import public_tokenizers
import pyarrow as pa
from shortfall.llm import tokens
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")

GROWTH = """
import random, resource, sys
sys.path.insert(0, sys.argv[1])
import pyarrow as pa
from shortfall.llm import tokens
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10
rng = random.Random(5)
texts = pa.array([" ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(250)) for _ in range(4_000)])
list(tokens.encode(texts.slice(0, 1), sys.argv[2]))
before = peak()
for _ in tokens.encode(texts, sys.argv[2]):
    pass
print(peak() - before)
"""


def test_a_worker_needs_little_memory_for_many_distinct_words():
    """8 MB of text, all words distinct: 627 MB when all new chunks of 8 MB were encoded at once and kept as objects."""
    repo = tokens.__file__.rsplit("/shortfall/", 1)[0]
    out = subprocess.run([sys.executable, "-c", GROWTH, repo, PATH], capture_output=True, text=True, check=True, timeout=300)
    assert int(out.stdout) < 200, out.stdout


def test_kept_chunks_stay_in_their_bound_and_change_no_ids(monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 60)
    monkeypatch.setattr(tokens, "_AT_ONCE", 3)
    texts = [f"word{i % 7} other{i} é x, <|endoftext|> a{'b' * (i % 5)}" for i in range(60)] + [None, "", "word1"]
    whole = Tokenizer.from_file(PATH)
    want = [e.ids for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for most in (0, 150, 400, 1 << 20):
        tokens.forget_all()
        for _ in range(2):                                        # the second time with what the first one kept
            out = []
            for _, ids, offsets in tokens.encode(pa.array(texts), PATH, kept_bytes=most):
                out += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
            assert out == want
            assert sum(x.nbytes for x in tokens._kept.get(PATH, ())) <= most
            assert (PATH in tokens._kept) == (most > 0)
    tokens.forget_all()
