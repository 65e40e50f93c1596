"""Byte-level BPE encoding and decoding by replaying merges over a word corpus.

The matches of the pre-tokenizer pattern are named once per batch, so every
distinct word is encoded once.  All new words lie behind one another in flat
arrays; an inverted index leads from the rank of a token pair to the positions
where the pair stands.  Merges are applied in rank order, each at all its
positions at once, and only the pairs with the touched neighbours are looked
up again.

A merge can make a pair of a lower rank than its own in vocabularies whose
ranks are not nested; such words are encoded again one by one with a heap over
(rank, position), which is the order that applies within one word.

Defined cases: a null or empty text has no tokens and decodes to no bytes; rows
are independent, so repeated rows give repeated results; texts are handled
whole at any length; extra columns pass through.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from itertools import count, islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns

SHIFT = 20  # bits of a token id in a pair's key
NONE = np.int64(1 << 40)  # rank of a pair that does not merge
LONG = 1 << 22  # characters from which a text is matched piece by piece
MOST_WORDS = 200_000  # distinct words held by a task before it starts anew
PIECE = 100_000  # words replayed together


def load_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank of a vocabulary file with lines ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merges:
    """Lookup tables of a vocabulary: every split of a token into two tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys[a << SHIFT | b] = rank
        self.pair = keys
        self.keys = np.array(sorted(keys), np.int64)
        self.values = np.array([keys[k] for k in self.keys.tolist()], np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs (a, b); ``NONE`` where they do not merge or lie over a word's end (-1)."""
        key = a << SHIFT | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.values[at], NONE)


def encode_word(word: bytes, m: Merges) -> list[int]:
    """One word, always merging the leftmost pair of the lowest rank."""
    tok = m.byte[np.frombuffer(word, np.uint8)].tolist()
    n = len(tok)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := m.pair.get(tok[i] << SHIFT | tok[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        j = nxt[i]
        if tok[i] < 0 or j >= n or m.pair.get(tok[i] << SHIFT | tok[j]) != r:
            continue
        tok[i], tok[j], nxt[i] = r, -1, nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        for a, b in ((prv[i], i), (i, nxt[i])):
            if a >= 0 and b < n and (k := m.pair.get(tok[a] << SHIFT | tok[b])) is not None:
                heapq.heappush(heap, (k, a))
    return [t for t in tok if t >= 0]


def replay(words: list[bytes], m: Merges) -> list[bytes]:
    """The token ids (little-endian unsigned 32-bit) of each word."""
    done: dict[int, bytes] = {}
    todo = []
    for i, w in enumerate(words):
        r = m.ranks.get(w)  # a word that is a token stays whole
        if r is not None:
            done[i] = r.to_bytes(4, "little")
        elif w:
            todo.append(i)
    if todo:
        length = np.array([len(words[i]) for i in todo])
        ends = np.cumsum(length)
        n = int(ends[-1])
        tok = np.append(m.byte[np.frombuffer(b"".join(words[i] for i in todo), np.uint8)], -1)
        nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
        nxt[ends - 1] = n  # position n stands for the end of any word
        prv[np.r_[0, ends[:-1]]] = n
        rank = m.lookup(tok, np.append(tok, -1)[nxt])
        rank[n] = NONE
        odd = _merge_all(tok, nxt, prv, rank, m)
        alive = tok[:n] >= 0
        packed = tok[:n][alive].astype("<u4").tobytes()
        upto = np.cumsum(np.add.reduceat(alive, np.r_[0, ends[:-1]], dtype=np.int64)) * 4
        begin = 0
        for i, end in zip(todo, upto.tolist()):
            done[i] = packed[begin:end]
            begin = end
        for i in {todo[k] for k in np.searchsorted(ends, np.array(sorted(odd), np.int64), side="right").tolist()}:
            done[i] = np.array(encode_word(words[i], m), "<u4").tobytes()
    return [done.get(i, b"") for i in range(len(words))]


def _merge_all(tok, nxt, prv, rank, m: Merges) -> set[int]:
    """Apply all merges in place; positions in words where the rank order broke."""
    n = len(tok) - 1
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []
    odd: set[int] = set()

    def enter(at: np.ndarray, now: int) -> None:
        at = at[rank[at] < NONE]
        if not len(at):
            return
        r = rank[at]
        if (r < now).any():
            odd.update(at[r < now].tolist())
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        cut = np.flatnonzero(r[1:] != r[:-1]) + 1
        for k, part in zip(r[np.r_[0, cut]].tolist(), np.split(at, cut)):
            if k in index:
                index[k].append(part)
            else:
                index[k] = [part]
                heapq.heappush(queue, k)

    enter(np.arange(n), -1)
    while queue:
        r = heapq.heappop(queue)
        found = index.pop(r)
        p = np.unique(np.concatenate(found)) if len(found) > 1 else np.sort(found[0])
        p = p[rank[p] == r]
        if not len(p):
            continue
        # where positions follow one another, every second one merges, from the left
        if len(p) > 1 and (chain := nxt[p[:-1]] == p[1:]).any():
            head = np.r_[True, ~chain]
            place = np.arange(len(p))
            p = p[(place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0]
        q = nxt[p]
        after = nxt[q]
        # where merges touch, the left one alone might have made a pair of a lower rank
        close = np.flatnonzero(after[:-1] == p[1:])
        if len(close):
            odd.update(p[close[m.lookup(np.full(len(close), r), tok[after[close]]) < r]].tolist())
        tok[p], tok[q], rank[q], nxt[p] = r, -1, NONE, after
        prv[after] = p  # of position n too, which is never read
        before = prv[p]
        rank[p] = m.lookup(tok[p], tok[after])
        has = before < n
        left = before[has]
        rank[left] = m.lookup(tok[left], tok[p[has]])
        enter(np.unique(np.concatenate([p, left])), r)
    return odd


def encoder(ranks: dict[bytes, int], pattern: str):
    """A function from texts to packed ids, which keeps the words it has seen."""
    m = Merges(ranks)
    match = regex.compile(pattern)
    names: defaultdict[str, int] = defaultdict(count().__next__)
    codes: list[bytes] = []

    def words(t):
        if len(t) < LONG:
            return np.array(list(map(names.__getitem__, match.findall(t))), np.int32)
        return np.fromiter((names[x.group()] for x in match.finditer(t)), np.int32)

    def f(texts):
        nonlocal names, codes
        if len(names) > MOST_WORDS:
            names, codes = defaultdict(count().__next__), []
        found = [words(t) if t else None for t in texts]
        new = list(islice(names, len(codes), None))
        for i in range(0, len(new), PIECE):
            codes += replay([w.encode("utf-8", "surrogatepass") for w in new[i:i + PIECE]], m)
        return [b"" if x is None else b"".join([codes[i] for i in x.tolist()]) for x in found]

    return f


def decoder(ranks: dict[bytes, int]):
    """A function from packed ids to the bytes they stand for."""
    token = [b""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        token[r] = t
    return lambda packed: [b"".join([token[i] for i in np.frombuffer(x or b"", "<u4").tolist()]) for x in packed]


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", out: str = "ids",
           drop: list[str] = ()) -> DataFrame:
    """``df`` with the binary column ``out``: token ids as little-endian unsigned 32-bit integers."""

    def start():
        f = encoder(ranks, pattern)
        return lambda texts: [f(texts)]

    return add_columns(df, [text], f"`{out}` binary", start, drop)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded",
           drop: list[str] = ()) -> DataFrame:
    """``df`` with the bytes that the token ids of column ``ids`` stand for."""

    def start():
        f = decoder(ranks)
        return lambda packed: [f(packed)]

    return add_columns(df, [ids], f"`{out}` binary", start, drop)


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
               drop: list[str] = ()) -> DataFrame:
    """``df`` with ``ids`` and ``decoded``, both made in one pass."""

    def start():
        there, back = encoder(ranks, pattern), decoder(ranks)

        def f(texts):
            ids = there(texts)
            return ids, back(ids)

        return f

    return add_columns(df, [text], "ids binary, decoded binary", start, drop)


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text."""
    both = round_trip(docs.select("doc_id", F.col("text").alias("__text")), ranks, pattern, "__text", ["__text"])
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
