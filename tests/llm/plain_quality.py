"""Importance resampling in plain Python, one document and one word at a time."""

import math
import re
import struct
from collections import Counter

import numpy as np
import xxhash
from brute import lower

FULL = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
TOKEN = re.compile(r"[!-/:-@\[-`{-~]+|[^\x20\x09-\x0D!-/:-@\[-`{-~]+")


def mix(x):
    x ^= x >> 32
    x = x * 0xD6E8FEB86659FD93 & FULL
    x ^= x >> 32
    x = x * 0xD6E8FEB86659FD93 & FULL
    return x ^ (x >> 32)


BYTE = [mix((c + 1) * 0xA24BAED4963EE407 & FULL) for c in range(256)]


def word_hash(word, seen={}):
    if word not in seen:
        total, power = 0, 1
        for c in word.encode():
            total, power = total + BYTE[c] * power, power * BASE & FULL
        seen[word] = mix((total + len(word.encode())) & FULL)
    return seen[word]


def grams(text, buckets):
    """(buckets of the words, buckets of the pairs of words)."""
    h = [word_hash(w) for w in TOKEN.findall(lower(text or ""))]
    return [x % buckets for x in h], [mix((x * BASE + y) & FULL) % buckets for x, y in zip(h, h[1:])]


def spark_hash(*values):
    """xxhash64 of the values as Spark chains it; bytes for strings and numbers, None is passed over."""
    h = 42
    for v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(v, seed=h)
    return h - (1 << 64) if h >> 63 else h


def long(v):
    return None if v is None else struct.pack("<q", v)


def logistic(x, y):
    """The minimum of the penalised loss, by Newton steps that are halved until the loss falls."""
    if not len(y) or len(set(y)) < 2:
        return None
    x, y = np.column_stack([x, np.ones(len(x))]), np.array(y, float)
    loss = lambda w: np.logaddexp(0, np.where(y == 1, -1, 1) * (x @ w)).sum() + 5e-3 * (w @ w)
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-(x @ w)))
        slope = x.T @ (p - y) + 1e-2 * w
        step, size = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w)), slope), 1.0
        while loss(w - size * step) > loss(w) and size > 1e-9:
            size /= 2
        w = w - size * step
    assert np.abs(slope).max() < 1e-6
    return w


def features(text, ratio):
    uni, bi = grams(text, len(ratio))
    u, b = [ratio[i] for i in uni], [ratio[i] for i in bi]
    half = np.float32(0.5)
    one, two = sum(min(0.0, float(v + half)) for v in u), sum(min(0.0, float(v + half)) for v in b)
    mean, n = sum(map(float, u)) + sum(map(float, b)), max(len(u), 1)
    squash = lambda v: math.copysign(math.log1p(abs(v)), v)
    return [squash(two), squash(one), math.log(n), squash(100 * mean / n), squash(100 * one / n), squash(100 * two / n)]


def resample(docs, labels, buckets, rows, seed):
    """(log ratios, {row: (log weight, key)} of all rows with words, k, kept rows) of docs (doc_id, text) and labels (doc_id, quality, toxic)."""
    worst = {}
    for k, q, t in labels:
        if None not in (k, q, t):
            have = worst.setdefault(k, (q, t))
            worst[k] = (min(have[0], q), max(have[1], t))
    number = struct.pack("<i", seed)
    sample = sorted(worst, key=lambda k: (spark_hash(long(k), number), k))[:rows]
    fits = {k for k in sample if spark_hash(number, long(k)) % 3 < 2}
    good = {k for k in sample if worst[k][0] == 1}
    clean = {k for k in sample if worst[k][1] != 1}
    raw, target = Counter(), Counter()
    for k, text in docs:
        for some in grams(text, buckets):
            raw.update(some)
            if k in fits & good & clean:
                target.update(some)
    share = sum(target.values()) / sum(raw.values())
    ratio = np.array([np.float32(math.log((target[i] + 1) / (raw[i] * share + 1))) for i in range(buckets)], np.float32)
    x = {i: np.array(features(t, ratio)) for i, (_, t) in enumerate(docs) if grams(t, buckets)[0]}
    held = [i for i in x if docs[i][0] in set(sample) - fits]
    z = np.array([x[i] for i in held])
    centre, scale = z.mean(0), z.std(0) + 1e-9
    z = (z - centre) / scale
    is_good = np.array([docs[i][0] in good for i in held])
    models = [logistic(z, [int(g) for g in is_good]), logistic(z[is_good], [int(docs[i][0] in clean) for i in held if docs[i][0] in good])]
    weights = {}
    for i in x:
        p = 1.0
        for w in models:
            if w is not None:
                p *= 1 / (1 + math.exp(-min(30, max(-30, float(np.append((x[i] - centre) / scale, 1) @ w)))))
        weight = math.log(p) - math.log(max(1 - p, 1e-13))
        u = (spark_hash(long(docs[i][0]), b"gumbel", number) % (1 << 52) + 0.5) / (1 << 52)
        weights[i] = (weight, weight - math.log(-math.log(u)))
    k = round(sum(1 / (1 + math.exp(-w)) for w, _ in weights.values()))
    least = sorted((key for _, key in weights.values()), reverse=True)[k - 1]
    return ratio, weights, k, {i for i, (_, key) in weights.items() if key >= least}
