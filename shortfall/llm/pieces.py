"""SentencePiece BPE encoding and decoding by vectorised merge rounds (operator 12).

A text is a dummy space and its code points, spaces written as U+2581. No piece holds U+2581 after another
character, so a text is cut into words before each first U+2581 of a run, and words are encoded apart. The distinct words
of a block of texts lie in flat numpy arrays of symbols, and in each round:

* every pair of neighbours gets the rank of the piece it would make (scores descending; equal scores share a rank);
* each word takes its least rank and merges its pairs of that rank, from the left and without overlap, at once;
  should a merge make a new pair that comes before the rest of them, the word stops there until the next round, as
  merging one pair after another would;
* merged symbols are compacted, and words without a pair to merge leave.

A word that has a pair left after ``MANY_ROUNDS`` rounds (long texts without spaces: each round stops at the first new pair
that comes earlier) goes on from there merge by merge with a queue, so its time stays in proportion to its length.
What is left after the last round are the pieces; a symbol that is no piece becomes its bytes. Decoding looks up each
id's bytes, writes U+2581 as a space and takes the dummy space away.

Models: BPE with byte fallback, identity normalisation, a dummy prefix, kept white space and no user-defined pieces (the
loader checks it). Defined results: NULL is empty text and has no ids; rows are independent, so repeated rows and
NULL ids come through; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.llm.text import blocks, buffers
from shortfall.llm.tokens import taken

SPACE = "▁"
BLOCK_BYTES = 4 << 20
#: Bound of a worker's memory of encoded words, in bytes with what Python adds to them.
KEPT_BYTES = 48 << 20
NONE = np.int64(1 << 40)
MANY_ROUNDS = 48


class Model:
    """Arrays of a model: piece bytes, and the pairs that make pieces as a sorted table."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if lib.is_byte(i)}
        self.special = np.array([lib.is_control(i) or lib.is_unknown(i) for i in range(n)])
        self.is_byte = np.array([lib.is_byte(i) for i in range(n)])
        self.unknown = lib.unk_id()
        plain = [i for i in range(n) if not self.special[i] and not self.is_byte[i]]
        if len(self.byte_id) != 256 or lib.encode(f"a  b  {SPACE}") != lib.encode(f"a  b   ") or lib.decode(lib.encode(" ①ﬁ ")) != " ①ﬁ " \
                or any(SPACE in self.pieces[i].lstrip(SPACE) for i in plain):
            raise ValueError("not a byte-fallback BPE model with identity normalisation and a dummy prefix")
        scores = sorted({lib.get_score(i) for i in plain}, reverse=True)
        rank_of = {s: k for k, s in enumerate(scores)}
        self.ids = {self.pieces[i]: i for i in plain}
        self.rank = np.full(n, NONE)
        for i in plain:
            self.rank[i] = rank_of[lib.get_score(i)]
        self.id_of_char = {p: i for p, i in self.ids.items() if len(p) == 1}
        # symbols are piece ids, or n + code point for characters that are no pieces
        flat = array("q")
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                if p[:k] in self.ids and p[k:] in self.ids:
                    flat.extend((self.ids[p[:k]], self.ids[p[k:]], i))
        left, right, made = np.array(flat, np.int64).reshape(-1, 3).T
        order = np.argsort(left << np.int64(32) | right)
        self.pair_key, self.pair_made = (left << np.int64(32) | right)[order], made[order]
        self._pairs: dict[tuple[int, int], tuple[int, int]] = {}
        self.first_char = np.full(0x110000, -1, np.int32)
        for c, i in self.id_of_char.items():
            self.first_char[ord(c)] = i
        self.n = n
        raw = [bytes([int(p[3:5], 16)]) if self.is_byte[i] else b"" if self.special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.raw = raw
        self.bytes = pa.array(raw, pa.large_binary())

    @property
    def pairs(self) -> dict[tuple[int, int], tuple[int, int]]:
        """(rank, piece) of each pair, made when it is first asked for."""
        if not self._pairs:
            left, right = self.pair_key >> 32, self.pair_key & 0xFFFFFFFF
            self._pairs = dict(zip(zip(left.tolist(), right.tolist()), zip(self.rank[self.pair_made].tolist(), self.pair_made.tolist())))
        return self._pairs

    def made_by(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that each pair of symbols makes, or -1."""
        key = left << np.int64(32) | right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_made[at], -1)

    def ranks(self, made: np.ndarray) -> np.ndarray:
        return np.where(made >= 0, self.rank[made], NONE)


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def merge_words(model: Model, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, offsets) of words after all merge rounds; ``first`` has each word's first symbol, and the end."""
    count = len(first) - 1
    word = np.repeat(np.arange(count), np.diff(first))
    place = np.arange(len(symbols))                                # where a symbol stood at first: it orders the result
    done_symbols, done_place, done_word = [], [], []
    made = np.full(len(symbols), -1, np.int64)                     # piece that a symbol and its right neighbour make
    inside = np.flatnonzero(word[1:] == word[:-1]) if len(symbols) else place
    made[inside] = model.made_by(symbols[inside], symbols[inside + 1])
    rounds = 0
    while len(symbols):
        heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        if rounds == MANY_ROUNDS:
            left = np.concatenate([_merge_in_turn(model, symbols[a:b].tolist()) + np.array([a, 0]) for a, b in zip(heads.tolist(), np.r_[heads[1:], len(symbols)].tolist())])
            at = left[:, 0]
            done_symbols.append(left[:, 1]), done_place.append(place[at]), done_word.append(word[at])
            break
        rounds += 1
        rank = model.ranks(made)
        least = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.r_[heads, len(symbols)]))
        over = least == NONE                                       # words without a pair
        if over.any():
            done_symbols.append(symbols[over]), done_place.append(place[over]), done_word.append(word[over])
            live = ~over
            symbols, place, word, made, rank, least = (x[live] for x in (symbols, place, word, made, rank, least))
            if not len(symbols):
                break
        at = np.flatnonzero(rank == least)
        run = np.flatnonzero(np.r_[True, np.diff(at) != 1])        # overlapping pairs: every second one of a run
        behind = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
        at = at[behind % 2 == 0]
        piece = made[at]
        # pairs that the merge makes with what stands left (merged already, if it was to be) and right of it
        left_at = np.maximum(at - 1, 0)
        before = symbols[left_at]
        close = np.flatnonzero(np.diff(at) == 2) + 1
        before[close], left_at[close] = piece[close - 1], at[close - 1]
        has_left = (at > 0) & (word[left_at] == word[at])
        after_at = np.minimum(at + 2, len(symbols) - 1)
        has_right = (at + 2 < len(symbols)) & (word[after_at] == word[at])
        made_left, made_right = np.full(len(at), -1, np.int64), np.full(len(at), -1, np.int64)
        made_left[has_left] = model.made_by(before[has_left], piece[has_left])
        made_right[has_right] = model.made_by(piece[has_right], symbols[after_at[has_right]])
        early = np.minimum(model.ranks(made_left), model.ranks(made_right)) <= least[at]
        if early.any():                                            # merge up to the first such pair of a word
            of = word[at]
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            passed = np.cumsum(early) - early
            stay = passed - np.repeat(passed[starts], np.diff(np.r_[starts, len(at)])) == 0
            at, piece, left_at, has_left, made_left, made_right = (x[stay] for x in (at, piece, left_at, has_left, made_left, made_right))
        symbols[at], made[at] = piece, made_right
        made[left_at[has_left]] = made_left[has_left]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, place, word, made = symbols[keep], place[keep], word[keep], made[keep]
    if not done_symbols:
        return symbols, np.zeros(count + 1, np.int64)
    symbols, place, word = (np.concatenate(x) for x in (done_symbols, done_place, done_word))
    order = np.argsort(place, kind="stable")
    return symbols[order], np.r_[0, np.cumsum(np.bincount(word, minlength=count))].astype(np.int64)


def _merge_in_turn(model: Model, symbols: list[int]) -> np.ndarray:
    """(place, symbol) of what is left when the first best pair is merged again and again."""
    n = len(symbols)
    after, before = list(range(1, n)) + [-1], [-1, *range(n - 1)]
    made = model.made_by(np.array(symbols[:-1], np.int64), np.array(symbols[1:], np.int64))
    at = np.flatnonzero(made >= 0)
    queue = [(r, k, p, symbols[k], symbols[k + 1]) for r, k, p in zip(model.rank[made[at]].tolist(), at.tolist(), made[at].tolist())]
    heapq.heapify(queue)

    def offer(k: int) -> None:
        pair = model.pairs.get((symbols[k], symbols[after[k]]))
        if pair is not None:
            heapq.heappush(queue, (*pair[:1], k, pair[1], symbols[k], symbols[after[k]]))

    while queue:
        _, k, piece, a, b = heapq.heappop(queue)
        right = after[k]
        if symbols[k] != a or right < 0 or symbols[right] != b:
            continue                                               # one of the two has been merged since
        symbols[k], symbols[right], after[k] = piece, -1, after[right]
        if after[k] >= 0:
            before[after[k]] = k
            offer(k)
        if before[k] >= 0:
            offer(before[k])
    left = [k for k, s in enumerate(symbols) if s >= 0]
    return np.array([(k, symbols[k]) for k in left], np.int64).reshape(-1, 2)


def _as_ids(model: Model, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of symbols; characters that are no pieces become the ids of their bytes."""
    odd = np.flatnonzero(symbols >= model.n)
    if not len(odd):
        return symbols, first
    spelt = [[model.byte_id[b] for b in chr(c - model.n).encode("utf-8", "surrogatepass")] for c in symbols[odd].tolist()]
    size = np.ones(len(symbols), np.int64)
    size[odd] = [len(x) for x in spelt]
    at = np.r_[0, np.cumsum(size)]
    out = np.empty(at[-1], np.int64)
    out[at[:-1][size == 1]] = symbols[size == 1]
    for k, x in zip(odd.tolist(), spelt):
        out[at[k]:at[k] + len(x)] = x
    return out, at[first]


def encode_words(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of words, U+2581 for spaces."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    first = np.r_[0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]
    known = model.first_char[points]
    return _as_ids(model, *merge_words(model, np.where(known >= 0, known, points + model.n), first))


_kept: dict[str, tuple[dict[str, bytes], list[int]]] = {}


def _words_kept(path: str, words: list[str], most: int) -> list[bytes]:
    """Ids (int32) of each word; a worker keeps those of its first words, up to ``most`` bytes."""
    kept, size = _kept.setdefault(path, ({}, [0]))
    found = [kept.get(w) for w in words]
    missing = [i for i, ids in enumerate(found) if ids is None]
    if missing:
        ids, at = encode_words(load(path), [words[i] for i in missing])
        data, ends = ids.astype(np.int32).tobytes(), (at * 4).tolist()
        for k, i in enumerate(missing):
            found[i] = data[ends[k]:ends[k + 1]]
            if size[0] < most:
                kept[words[i]] = found[i]
                size[0] += 200 + len(words[i]) + len(found[i])
    return found


def _cut(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of words, and the end: texts, and spaces (or U+2581) that follow another character."""
    padded = np.r_[raw, np.zeros(2, np.uint8)]
    space = raw == 0x20
    mark = (raw == 0xE2) & (padded[1:-1] == 0x96) & (padded[2:] == 0x81)
    opens = space | mark
    after = np.zeros(len(raw) + 1, bool)                       # the byte behind a space
    after[1:][space] = True
    at = np.flatnonzero(mark)
    after[at + 3] = True
    cut = np.zeros(len(raw) + 1, bool)
    cut[:-1] = opens & ~after[:-1]
    cut[offsets] = True
    return np.flatnonzero(cut)


def encode(column: pa.Array, path: str, kept_bytes: int = KEPT_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids as int32, offsets into them per row) for runs of rows of about 4 MB."""
    for first, end, raw, offsets in blocks(*buffers(column), BLOCK_BYTES):
        n = end - first
        if not len(raw):
            yield first, np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
            continue
        bounds = _cut(raw, offsets)
        chunks = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw)))
        # a text's first word also has the dummy space
        opening = np.zeros(len(chunks), bool)
        filled = offsets[:-1][np.diff(offsets) > 0]
        opening[np.searchsorted(bounds, filled)] = True
        coded = chunks.dictionary_encode()
        codes, distinct = coded.indices.to_numpy().astype(np.int64), [w.replace(" ", SPACE) for w in coded.dictionary.to_pylist()]
        heads = np.unique(codes[opening])
        codes[opening] = len(distinct) + np.searchsorted(heads, codes[opening])
        found = _words_kept(path, distinct + [SPACE + distinct[i] for i in heads], kept_bytes)
        ids, ends = taken(found, codes)
        yield first, ids.view(np.int32), ends[np.searchsorted(bounds, offsets)] // 4


def decode(ids: np.ndarray, offsets: np.ndarray, path: str) -> list[str]:
    """Texts of runs of ids: the first piece loses its dummy space, bytes that are no UTF-8 become U+FFFD each."""
    model = load(path)
    raw, ends = taken(model.bytes, ids)
    ends = ends[offsets]
    special = np.r_[0, np.cumsum(model.special[ids])][offsets]
    plain = ~(model.special | model.is_byte)
    data, out = raw.tobytes(), []
    for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
        part = slice(offsets[i], offsets[i + 1])
        drop = bool(b > a and data[a:a + 1] == b" " and plain[ids[offsets[i]]])
        whole = data[a + drop:b]
        if special[i + 1] > special[i]:
            out.append(_decode_slowly(model, ids[part].tolist()))
            continue
        try:
            out.append(whole.decode())
        except UnicodeDecodeError:
            out.append(_decode_slowly(model, ids[part].tolist()))
    return out


def _decode_slowly(model: Model, ids: list[int]) -> str:
    """Ids with control or unknown ones, or with bytes that are no UTF-8."""
    out, held, opened = [], bytearray(), False

    def flush() -> None:
        while held:
            for n in (1, 2, 3, 4):
                try:
                    out.append(bytes(held[:n]).decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                n = 1
                out.append("�")
            del held[:n]

    for i in ids:
        if model.is_byte[i]:
            held += bytes([int(model.pieces[i][3:5], 16)])
            continue
        flush()
        if i == model.unknown:
            out.append(" ⁇ ")
        elif not model.special[i]:
            piece = model.pieces[i]
            if not opened and not "".join(out) and piece.startswith(SPACE):
                piece, opened = piece[1:], True
            out.append(piece.replace(SPACE, " "))
    flush()
    return "".join(out)


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids, at in encode(batch.column(1), model_path):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(at) - 1), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            column = column.fill_null([]) if column.null_count else column
            at = column.offsets.to_numpy().astype(np.int64)
            texts = decode(column.flatten().to_numpy().astype(np.int64), at - at[0], model_path) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text, encoded and decoded again in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids, at in encode(batch.column(1), model_path):
                n = len(at) - 1
                ends = at.tolist()
                listed = [hashlib.sha256(",".join(map(str, ids[a:b].tolist())).encode()).hexdigest() for a, b in zip(ends, ends[1:])]
                texts = [hashlib.sha256(t.encode()).hexdigest() for t in decode(ids.astype(np.int64), at, model_path)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(np.diff(at)), pa.array(listed, pa.string()), pa.array(texts, pa.string())],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
