"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its 5-word shingles (as 64-bit hashes).  Two sets are
linked when their Jaccard similarity is at least ``SIMILAR`` / 100.  Sets are
put into bands of similar size, where the similarity bounds the number ``k`` of
elements in which two linked sets can differ.  The feature domain is divided
into ``n1 * n2`` partitions; for each first-level part every subset of
``n2 - k2`` of its ``n2`` second-level parts gives one signature, the hash of
the elements that fall into the subset.  Two linked sets differ in at most
``k2`` second-level parts of some first-level parts, so they share a signature.
(n1, n2, k2) are chosen per band as the fewest signatures of at least ``FILL``
elements on average; from ``LARGE`` elements on, plain first-level parts
(k2 = 0) do.

A signature without elements says little and would be shared widely, as is one
whose elements all come from a passage that many texts have in common.  So there
are ``e`` first-level parts more than needed, and two linked sets have 1 + e parts
or more in which they share a signature.

* Empty signatures: a set that has them in at most ``e`` parts withholds them.  A
  set with more gives the signatures of the next of ``SEEDS`` independent
  hashings as well, and the empty ones only after the last.  Of two linked
  sets, the one that stops first has a shared signature with elements, and
  the other has signatures of that hashing too.
* Signatures of more than ``HOT`` sets, known once all are counted: a set with at
  most ``e`` parts of a hashing that are empty or hot withholds its hot
  signatures of that hashing, as it shares a further one with any set linked to it.

Both keep the guarantee exactly.

Sets that share a signature are chained in a sorted order, not paired off.
Chained pairs that pass an exact lower bound on their difference (sizes and
parity sketches) are verified on the exact sets.  What shares a signature that
is not withheld and is still in different components is then paired under the
same bound, and verified as well.  So every link is found or implied by others,
and a large group of near copies, or of texts around a common passage, costs in
proportion to its size.

Equal sets are one node: copies never meet each other.  (Nodes are 64-bit
fingerprints of sets.)

Defined cases: a null or empty text, or one without words, has the empty set
and is linked with nothing; fewer than 5 words are one shingle; rows are told
apart by their place in the files, so rows with a null id are compared like
others, as are several texts of one id; a component of null ids only has a null
id; repeated rows fall into one class; extra columns are not read.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations
from math import ceil, comb, exp, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, discard, mix, small_side, trimmed, with_file_rows, write_table
from .components import connected

WORDS, SIMILAR = 5, 80
LARGE = 150  # elements from which on first-level parts alone are used
RATIO, SMALL_RATIO = 1.6, 1.25  # of the largest to the smallest size in a band, from LARGE on and below
FILL = 2.5  # elements of a signature on average
COMMON = 0.25  # share of a small set that e makes allowance for as common to many
SEEDS = 6  # hashings that a set of many empty signatures tries
HOT = 48  # sets of a signature that is withheld where possible
SKETCH_PER_WORD = 32  # elements for each 64-bit word of the parity sketch, at most


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of the whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII spaces only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    size = min(n, WORDS)
    h = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        h = mix(h ^ w[j:n - size + 1 + j], j + 1)
    return np.unique(h)


def most_different(total: int) -> int:
    """Largest symmetric difference of two linked sets whose sizes add up to ``total`` or less."""
    return max((s - 2 * -(-SIMILAR * s // (100 + SIMILAR)) for s in range(max(2, total - 20), total + 1)), default=0)


@cache
def parts_of(low: int, k: int) -> tuple[int, int, int, int]:
    """(n1, n2, k2, e) for sets of ``low`` elements or more that differ in up to ``k``."""
    if k == 0:
        return 1, 1, 0, 0
    if low >= LARGE:
        n = k + 1
        for _ in range(8):  # spare parts for those that stay empty
            empty = n * exp(-low / n)
            n = k + 1 + ceil(empty + 4 * sqrt(empty) + 1)
        return n, 1, 0, n - (k + 1)

    def at_most(m: int, n: int, q: float) -> float:
        return sum(comb(n, i) * q ** i * (1 - q) ** (n - i) for i in range(min(m, n) + 1))

    for fill in (FILL, 2, 1, 0):
        found = []
        for k2 in range(min(k, 5) + 1):
            for n2 in range(k2 + 1, 11 if k2 else 2):
                for e in range(20):
                    n1 = k // (k2 + 1) + 1 + e
                    if low * (n2 - k2) < fill * n1 * n2:
                        break
                    bad = at_most(k2, n2, 1 - exp(-low * (1 - COMMON) / (n1 * n2)))  # a part with an empty or common signature
                    again = 1 - at_most(e, n1, bad)
                    if again <= 0.3:
                        found.append((n1 * comb(n2, k2) / (1 - again), n1, n2, k2, e))
        if found:
            return min(found)[1:]
    return k + 1, 1, 0, 0  # too few elements for any allowance


class Band:
    """Signature scheme for pairs whose smaller set has ``low`` to ``high`` elements."""

    def __init__(self, low: int, high: int):
        self.low, self.high, self.reach = low, high, 100 * high // SIMILAR
        self.k = max(0, most_different(high + self.reach))
        self.n1, self.n2, self.k2, self.spare = parts_of(low, self.k)  # spare: e
        cells = self.n1 * self.n2
        self.edges = np.array([-(-(j << 64) // cells) for j in range(1, cells)], np.uint64)
        self.subsets = list(combinations(range(self.n2), self.n2 - self.k2))
        count = self.n1 * len(self.subsets)
        self.salt = mix(np.arange(count, dtype=np.uint64) * np.uint64(2) + np.uint64(1), low)

    def of_hashing(self, h: np.ndarray, upto: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Signatures, one row per first-level part, and which of them are empty."""
        cut = np.concatenate([[0], np.searchsorted(h, self.edges), [len(h)]])
        size = np.diff(cut).reshape(self.n1, self.n2)
        held = np.diff(upto[cut]).reshape(self.n1, self.n2)
        if len(self.subsets) > 1:
            held = np.stack([held[:, s].sum(1, dtype=np.uint64) for s in self.subsets], 1)
            size = np.stack([size[:, s].sum(1) for s in self.subsets], 1)
        return mix(held ^ self.salt.reshape(held.shape), 64 * self.low + seed), size == 0


class Hashings:
    """A set under independent hashings: sorted elements and the running sums of their mixed values."""

    def __init__(self, h: np.ndarray):
        self.h, self.made = h, {}

    def __getitem__(self, seed: int) -> tuple[np.ndarray, np.ndarray]:
        if seed not in self.made:
            h = np.sort(mix(self.h, 100 + seed)) if seed else self.h
            self.made[seed] = h, np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h, 11), dtype=np.uint64)])
        return self.made[seed]


class Bands:
    """Bands on demand, by the size of a set."""

    def __init__(self):
        self.made = [Band(1, 1)]

    def of(self, size: int) -> list[Band]:
        while self.made[-1].high < size:
            low = self.made[-1].high + 1
            self.made.append(Band(low, max(low, int(low * (RATIO if low >= LARGE else SMALL_RATIO)))))
        return [b for b in self.made if b.low <= size <= b.reach]

    def hashings(self, h: np.ndarray):
        """(spare parts, signatures, empty ones, whether these are emitted) of each band and hashing of a set."""
        made = Hashings(h)
        for band in self.of(len(h)):
            for seed in range(SEEDS):
                found, empty = band.of_hashing(*made[seed], seed)
                more = int(empty.any(1).sum()) > band.spare
                yield band.spare, found, empty, more and seed == SEEDS - 1
                if not more:
                    break

    def signatures(self, h: np.ndarray) -> list[np.ndarray]:
        """All signatures of a set of sorted elements."""
        return [found.ravel() if last else found[~empty] for _, found, empty, last in self.hashings(h)]

    def not_withheld(self, h: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """The signatures among ``hot`` that the set must keep."""
        out = []
        for spare, found, empty, _ in self.hashings(h):
            shared = np.isin(found, hot)
            if int((shared | empty).any(1).sum()) > spare:
                out.append(found[shared])
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def fingerprint(h: np.ndarray) -> np.uint64:
    return mix(np.array([mix(h, 11).sum(dtype=np.uint64)]), len(h))[0]


def sketch(h: np.ndarray) -> np.ndarray:
    """Parities of the elements in cells: two sketches differ in no more cells than the sets in elements.

    The number of cells is a power of two of 2 to 4 times the size, so a longer
    sketch folds onto a shorter one.
    """
    words = 1 << max(0, int(np.ceil(np.log2(max(1, len(h)) / SKETCH_PER_WORD))))
    odd = np.bincount((mix(h, 23) >> np.uint64(32)).astype(np.int64) & (64 * words - 1), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sets(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The columns ``keep`` and ``n_shingles, node, sketch`` per row (node and sketch null for the empty set)."""
    fields = [f for f in docs.select(*keep).schema]

    def run(batches):
        for b in batches:
            n, node, sk = [], [], []
            for t in b.column("text").to_pylist():
                h = shingles(t)
                n.append(len(h))
                node.append(int(fingerprint(h).view(np.int64)) if len(h) else None)
                sk.append(sketch(h).tolist() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sk, pa.list_(pa.int64()))],
                names=[*keep, "n_shingles", "node", "sketch"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(trimmed(run), f"{ddl}, n_shingles bigint, node bigint, sketch array<bigint>")


def signatures(docs: DataFrame) -> DataFrame:
    """``sig, node`` of every distinct set."""

    def run(batches):
        bands, seen = Bands(), set()
        for b in batches:
            sigs, nodes, counts = [], [], []
            for t in b.column("text").to_pylist():
                h = shingles(t)
                node = fingerprint(h) if len(h) else None
                if node is None or node in seen:  # copies in the same task send one set
                    continue
                seen.add(node)
                found = bands.signatures(h)
                sigs += found
                nodes.append(node)
                counts.append(sum(map(len, found)))
            if sigs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.repeat(np.array(nodes, np.uint64), counts).view(np.int64))],
                    names=["sig", "node"])

    return docs.select("text").mapInArrow(trimmed(run), "sig bigint, node bigint")


def verify(pairs: DataFrame, docs: DataFrame, reps: DataFrame, key: str) -> DataFrame:
    """The pairs (a, b) of nodes that are linked, by their exact sets.

    ``reps`` has one row (``key``) of ``docs`` for every node.
    """
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = write_table(reps.join(wanted, "node", "left_semi").select("node", key), "join-wanted")
    n = wanted.count()

    def run(batches):
        for b in batches:
            nodes, found = [], []
            for node, text in zip(b.column("node").to_pylist(), b.column("text").to_pylist()):
                h = shingles(text)
                if len(h) and int(fingerprint(h).view(np.int64)) == node:  # a key that repeats brings other texts too
                    nodes.append(node)
                    found.append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["node", "items"])

    rows = docs.select(key, "text").join(small_side(wanted, n, 40), key)
    items = write_table(rows.select("node", "text").mapInArrow(trimmed(run), "node bigint, items array<bigint>"), "join-sets")
    left = items.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = items.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    linked = pairs.select("a", "b").join(left, "a").join(right, "b").where(
        100 * both >= SIMILAR * (F.size("x") + F.size("y") - both))
    linked = write_table(linked.select("a", "b"), "join-links")
    discard(wanted, items)
    return linked


def may_link(n: str, m: str, x: str, y: str):
    """Whether sizes and sketches allow a link: linked sets differ in a bounded number of elements."""
    total = F.col(n) + F.col(m)
    most = total - 2 * F.ceil(total * SIMILAR / (100 + SIMILAR))
    short = F.least(F.size(x), F.size(y))
    xor = lambda a, b: a.bitwiseXOR(b)
    fold = lambda c: F.when(F.size(c) == short, F.col(c)).otherwise(
        F.zip_with(F.slice(c, F.lit(1), short), F.slice(c, short + 1, short), xor))
    apart = F.aggregate(F.zip_with(fold(x), fold(y), xor), F.lit(0), lambda acc, v: acc + F.bit_count(v))
    near = 100 * F.least(n, m) >= SIMILAR * F.greatest(n, m)
    return F.when(near, apart <= most).otherwise(F.lit(False))


def not_withheld(shared: DataFrame, docs: DataFrame, reps: DataFrame, key: str) -> DataFrame:
    """The rows of ``shared`` (``sig, node, root``: hot signatures) that their sets must keep."""
    # a set has a bounded number of signatures
    lists = write_table(shared.groupBy("node").agg(F.collect_list("sig").alias("hot")).join(reps, "node"), "join-hot")
    n, held = lists.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("hot")), F.lit(0))).first()
    # texts stay where they are while the lists, or at least their keys, can be broadcast
    rows = docs.select(key, "text")
    if n * 80 + 8 * held > BROADCAST_BYTES:
        rows = rows.join(small_side(lists.select(key), n, 40), key, "left_semi")
    rows = rows.join(small_side(lists, n, 80 + 8 * held // max(1, n)), key)

    def run(batches):
        bands = Bands()
        for b in batches:
            sigs, nodes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for node, text, hot in zip(b.column("node").to_pylist(), b.column("text").to_pylist(), b.column("hot")):
                h = shingles(text)
                if len(h) and int(fingerprint(h).view(np.int64)) == node:
                    sigs.append(bands.not_withheld(h, hot.values.to_numpy().view(np.uint64)))
                    nodes.append(np.full(len(sigs[-1]), node))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(nodes))], names=["sig", "node"])

    kept = rows.select("node", "text", "hot").mapInArrow(trimmed(run), "sig bigint, node bigint").distinct()
    out = write_table(shared.join(kept, ["sig", "node"], "left_semi"), "join-kept")
    discard(lists)
    return out


def classes(docs: DataFrame, key: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``keep``, ``n_shingles``, ``class_node`` and ``component_id`` per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` of the component and
    ``class_node`` a key of it (null for the empty set).  ``key`` names a column
    that tells rows apart and is never null; without it, that is each row's place
    in the files (column ``__row`` of the result).
    """
    if key is None:
        docs, key = with_file_rows(docs.select(*dict.fromkeys(["doc_id", "text", *keep])), "__row"), "__row"
    columns = tuple(dict.fromkeys([key, "doc_id", *keep]))
    info = write_table(sets(docs, columns), "join-sets-of-rows")
    nodes = write_table(info.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min(key).alias("__key"), F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"),
        F.first("sketch").alias("sketch")), "join-nodes")
    sketches = nodes.select("node", "n", "sketch")  # grows with the words of the texts: joined by a shuffle at any size
    reps = nodes.select("node", F.col("__key").alias(key))
    side = lambda k, c: sketches.select(F.col("node").alias(c), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"sketch{k}"))

    order = Window.partitionBy("sig").orderBy("node")
    chain = (signatures(docs).withColumns({"a": F.lag("node").over(order), "low": F.first("node").over(order)})
             .withColumnRenamed("node", "b").where("a <> b"))
    chain = write_table(chain.select("sig", "a", "b", (F.col("a") == F.col("low")).alias("first")), "join-chain")
    near = (chain.select("a", "b").distinct().join(side(1, "a"), "a").join(side(2, "b"), "b")
            .where(may_link("n1", "n2", "sketch1", "sketch2")).select("a", "b"))
    near = write_table(near, "join-near")
    links = verify(near, docs, reps, key)
    parts = write_table(connected(links), "join-parts")

    # Signatures of three sets or more whose members are not all in one component.  Sets that are alike
    # share many of them, so signatures with the same smallest member become one group: a pair is formed
    # in a few groups, not in every signature that it shares.
    many = chain.groupBy("sig").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("sig")
    held = chain.join(many, "sig", "left_semi")
    held = held.select("sig", F.explode(F.when(F.col("first"), F.array("a", "b")).otherwise(F.array("b"))).alias("node"))
    n_parts = parts.count()
    held = held.join(small_side(parts, n_parts, 48), "node", "left").withColumn("root", F.coalesce("root", "node"))
    held = write_table(held, "join-held")
    apart = held.groupBy("sig").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("sets")).where("r0 <> r1")
    apart = write_table(apart.select("sig", "sets"), "join-apart")
    shared = write_table(held.join(apart.where(F.col("sets") > HOT).select("sig"), "sig", "left_semi"), "join-shared")
    kept = not_withheld(shared, docs, reps, key)
    still = (held.join(apart.where(F.col("sets") <= HOT).select("sig"), "sig", "left_semi")).unionByName(kept)
    split = (still.groupBy("sig").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.min("node").alias("group"))
             .where("r0 <> r1").select("sig", "group"))
    open_ = still.join(split, "sig").select("group", "node", "root").distinct()
    open_ = write_table(open_.join(sketches, "node"), "join-open")
    discard(apart, shared, kept)
    x = open_.select("group", *[F.col(c).alias(f"{c}1") for c in ("node", "root", "n", "sketch")])
    y = open_.select(F.col("group").alias("group2"), *[F.col(c).alias(f"{c}2") for c in ("node", "root", "n", "sketch")])
    rest = (x.join(y, (F.col("group") == F.col("group2")) & (F.col("node1") < F.col("node2")) & (F.col("root1") != F.col("root2"))
                   & may_link("n1", "n2", "sketch1", "sketch2"))
            .select(F.col("node1").alias("a"), F.col("node2").alias("b")).distinct().join(near, ["a", "b"], "left_anti"))
    rest = write_table(rest, "join-rest")
    more = verify(rest, docs, reps, key)
    old, parts = parts, write_table(
        connected(parts.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)), "join-parts")
    discard(chain, near, links, held, open_, rest, more, old)
    lowest = (parts.join(nodes.select("node", "first_id"), "node").groupBy("root").agg(F.min("first_id").alias("low")))
    node_class = write_table(
        nodes.select("node", "first_id").join(parts, "node", "left").join(lowest, "root", "left")
        .select("node", F.coalesce("root", "node").alias("class_node"), F.coalesce("low", "first_id").alias("component_id")), "join-classes")
    discard(nodes, parts)
    out = info.join(node_class, "node", "left")
    return out.select(*columns, "n_shingles", "class_node",
                      F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


# all pairs with a common shingle, for tables of moderate size
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS a
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(a[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, a, unnest(range(1, greatest(len(a) - 4, 1) + 1)) AS i FROM w WHERE len(a) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""
