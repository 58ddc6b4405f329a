"""Plain-Python definitions the operators are compared with."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, n=5):
    w = WORD.findall(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def jaccard_components(docs, percent=75):
    """{doc_id: (n_shingles, component)} by comparing all pairs that share a shingle."""
    sets = {k: shingles(t) for k, t in docs}
    having = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            having[x].append(k)
    union, seen = Union(), set()
    for ks in having.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1:]:
                if (a, b) in seen:
                    continue
                seen.add((a, b))
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    union.join(a, b)
    return {k: (len(s), union.find(k)) for k, s in sets.items()}
