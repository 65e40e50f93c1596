import hashlib
import random

import numpy as np
import public_tokenizers as P
import tiktoken
from frames import docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trafficlens.llm import bpe_replay as BP
from trafficlens.llm.common import read

RANKS = BP.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
MERGES = BP.Merges(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def same(rows):
    for r in rows:
        ids = packed(LIBRARY.encode_ordinary(r.text or ""))
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest()), r.doc_id
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_whole_table(spark):
    d = read(spark, "/root/testdata/sf0.01", "documents")
    got = BP.digests(d, RANKS, P.PATTERN)
    assert got.count() == d.count()
    same(got.join(d.select("doc_id", "text"), "doc_id").collect())


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a" * 30_000), (4, " " * 5000 + "x"), (5, "\n\t \r"), (6, "ab" * 9000), (6, "ab" * 9000), (None, "é😀ﬀ中文"),
            (7, "long text " * 100_000), (8, "it's we'LL 12345 <|endoftext|>")]
    df = docs(spark, rows, clashing=True)
    both = BP.round_trip(df.select("doc_id", "text", "ids"), RANKS, P.PATTERN)
    digest = both.select("doc_id", "text", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                         F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")).collect()
    assert len(digest) == len(rows)
    same(digest)
    two = BP.decode(BP.encode(df, RANKS, P.PATTERN), RANKS).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in two)
    assert BP.digests(docs(spark, []), RANKS, P.PATTERN).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abAB é'1 \n", min_size=1, max_size=40), max_size=8))
def test_words_like_the_library(words):
    got = BP.replay([w.encode() for w in words], MERGES)
    whole = [packed([RANKS[w.encode()]]) if w.encode() in RANKS else packed(BP.encode_word(w.encode(), MERGES)) for w in words]
    assert got == whole


def test_vocabularies_whose_ranks_are_not_nested():
    for seed in range(60):
        rng = random.Random(seed)
        tokens = {bytes([b]) for b in range(256)}
        grown = [b"a", b"b", b"c"]
        for _ in range(25):
            t = rng.choice(grown) + rng.choice(grown)
            if len(t) < 9:
                grown.append(t)
        order = sorted(set(grown) - tokens)
        rng.shuffle(order)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(order)}
        m = BP.Merges(ranks)
        lib = tiktoken.Encoding("x", pat_str=r"[a-c]+", mergeable_ranks=ranks, special_tokens={})
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(40)]
        assert BP.replay([w.encode() for w in words], m) == [packed(lib.encode_ordinary(w)) for w in words]
