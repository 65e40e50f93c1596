"""Exact dedup against a history of distinct digests in a minimal perfect hash.

Texts are equal when they are identical without the characters space and
U+0009 - U+000D; the SHA-256 of what is left is a text's digest.  The history
holds every distinct digest of earlier deliveries once.  It is cut into shards
by the leading bytes of the digest, and each shard is one row of a written
table: the level bit sets of a minimal perfect hash function, and in its order
the slots, each with the full digest, the number of rows seen, and the winner's
length, id and locator (file and row).  The function sends any digest to some
slot; the digest stored there is compared byte by byte, so a new digest is
either a member (a repeat of that slot) or proven not to be one.  Members are
added to their slot; nonmembers are grouped among themselves.

A shard's function: level ``l`` hashes the digests left over to ``GAMMA`` bits
each; those alone on their bit stay there, the others go to the next level.  A
digest's slot is the number of set bits before its own.

Of equal texts the row with the most code points stays, then the smallest id
(a null id after all others), then the first place in the files, so exactly one
row is kept also among repeated rows.  A null text counts as empty; all texts
without other characters are equal.  An empty history or an empty delivery is
allowed; extra columns are not read.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import discard, mix, stage_path, trim, with_file_rows, write_table

BLANKS = " \t\n\x0b\x0c\r"
GAMMA = 2.0
SHARD = 50_000  # distinct digests of a shard, about
GROUP_BYTES = 160  # of a group's row in a broadcast
HOT_GROUPS = 50_000  # groups that are broadcast for their size, at most


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, place, n_chars, digest`` per row; columns other than ``doc_id`` and ``text`` are not read."""
    text = F.coalesce("text", F.lit(""))
    rows = with_file_rows(docs.select("doc_id", "text"), "place")
    return rows.select("doc_id", "place", F.char_length(text).cast("bigint").alias("n_chars"),
                       F.unhex(F.sha2(F.translate(text, BLANKS, "").cast("binary"), 256)).alias("digest"))


def groups(rows: DataFrame) -> DataFrame:
    """``digest, n_rows, best`` per distinct digest; the least ``best`` is the row that stays."""
    best = F.struct((-F.col("n_chars")).alias("less_chars"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n_rows"), F.min(best).alias("best"))


def level_bits(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit of each digest (four 64-bit words) in a level of ``size`` bits."""
    h = np.zeros(len(words), np.uint64)
    for j in range(4):
        h = mix(h ^ words[:, j], 4 * level + j + 1)
    return (h % np.uint64(size)).astype(np.int64)


def perfect_hash(words: np.ndarray) -> tuple[list[int], bytes]:
    """Level sizes and packed bits of a minimal perfect hash function of distinct digests."""
    sizes, bits, left = [], [], words
    while len(left):
        size = ceil(GAMMA * len(left) / 8) * 8
        at = level_bits(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    return sizes, np.packbits(np.concatenate(bits)).tobytes() if bits else b""


def slots_of(words: np.ndarray, sizes: list[int], packed: bytes) -> np.ndarray:
    """Slot of each digest; -1 where no level has its bit (then it is no member)."""
    bits = np.unpackbits(np.frombuffer(packed, np.uint8))
    before = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
    out = np.full(len(words), -1, np.int64)
    start, left = 0, np.arange(len(words))
    for level, size in enumerate(sizes):
        at = start + level_bits(words[left], level, size)
        hit = bits[at] == 1
        out[left[hit]] = before[at[hit]]
        left, start = left[~hit], start + size
    return out


def digest_words(column) -> np.ndarray:
    """A column of 32-byte digests as an array of four words each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 4)


def shard_of(digest, shards: int):
    return F.conv(F.hex(F.substring(digest, 1, 7)), 16, 10).cast("bigint") % shards


class History:
    """A written table with one row per shard: ``shard, sizes, bits, slots``."""

    def __init__(self, table: DataFrame, shards: int, n: int):
        self.table, self.shards, self.n = table, shards, n

    @classmethod
    def build(cls, distinct: DataFrame, path: str | None = None) -> "History":
        """From ``groups`` (a table that reads the same each time); ``path`` defaults to a fresh folder."""
        spark, n = distinct.sparkSession, distinct.count()
        shards = max(1, ceil(n / SHARD))
        kind = dict(distinct.dtypes)["best"]
        schema = f"shard bigint, sizes array<bigint>, bits binary, slots array<struct<digest:binary,n_rows:bigint,best:{kind}>>"

        def build(table: pa.Table) -> pa.Table:
            words = digest_words(table.column("digest"))
            sizes, bits = perfect_hash(words)
            order = np.argsort(slots_of(words, sizes, bits))
            held = table.take(pa.array(order)).combine_chunks()
            slots = pa.StructArray.from_arrays([held.column(c).combine_chunks() for c in ("digest", "n_rows", "best")],
                                               names=["digest", "n_rows", "best"])
            row = [table.column("shard").slice(0, 1).combine_chunks(), pa.array([sizes], pa.list_(pa.int64())),
                   pa.array([bits], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(slots)], pa.int32()), slots)]
            trim()
            return pa.Table.from_arrays(row, names=["shard", "sizes", "bits", "slots"])

        distinct = distinct.withColumn("best", F.col("best").cast(kind))  # its fields nullable, as in the schema
        made = distinct.withColumn("shard", shard_of("digest", shards)).groupBy("shard").applyInArrow(build, schema)
        path = path or stage_path(spark, "history")
        made.withColumn("shards", F.lit(shards)).write.parquet(path)
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "History":
        table = spark.read.parquet(path)
        table.stage = path
        shards, n = table.agg(F.max("shards"), F.sum(F.size("slots"))).first()
        return cls(table, shards or 1, n or 0)

    def slots(self) -> DataFrame:
        """``slot, digest, n_rows, best``: every distinct digest of the history."""
        return (self.table.select("shard", F.posexplode("slots").alias("at", "s"))
                .select((F.col("shard") * F.lit(1 << 32) + F.col("at")).alias("slot"), "s.*"))

    def lookup(self, distinct: DataFrame, n: int) -> DataFrame:
        """``groups`` of a delivery (``n`` of them) with ``slot``: null for those that are no members.

        Each shard meets its digests in as many tasks as keep these near ``SHARD`` each.
        """
        parts = max(1, ceil(n / self.shards / SHARD))
        kind = dict(distinct.dtypes)["best"]

        def find(probe: pa.Table, shard: pa.Table) -> pa.Table:
            slot = pa.nulls(probe.num_rows, pa.int64())
            if probe.num_rows and shard.num_rows:
                words = digest_words(probe.column("digest"))
                at = slots_of(words, shard.column("sizes")[0].as_py(), shard.column("bits")[0].as_py())
                held = digest_words(shard.column("slots").combine_chunks().flatten().field("digest"))
                member = (at >= 0) & (held[np.maximum(at, 0)] == words).all(1)
                slot = pa.array((shard.column("shard")[0].as_py() << 32) + at, pa.int64(), mask=~member)
            trim()
            return pa.Table.from_arrays([probe.column("digest").combine_chunks(), probe.column("n_rows").combine_chunks(),
                                         probe.column("best").combine_chunks(), slot], names=["digest", "n_rows", "best", "slot"])

        part = F.when(F.lit(parts) > 1, F.conv(F.hex(F.substring("digest", 9, 7)), 16, 10).cast("bigint") % parts).otherwise(F.lit(0))
        probe = distinct.withColumn("best", F.col("best").cast(kind)).withColumn("shard", shard_of("digest", self.shards)).withColumn("part", part.cast("bigint"))
        held = (self.table.select("shard", "sizes", "bits", "slots")
                .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint")))))
        schema = f"digest binary, n_rows bigint, best {kind}, slot bigint"
        return probe.groupBy("shard", "part").cogroup(held.groupBy("shard", "part")).applyInArrow(find, schema)


def merged(history: History, found: DataFrame) -> DataFrame:
    """``groups`` over the history and a looked-up delivery: members join their slot, nonmembers stay apart."""
    new = found.where(F.col("slot").isNotNull()).select("slot", F.col("n_rows").alias("more"), F.col("best").alias("other"))
    old = (history.slots().join(new, "slot", "left")
           .select("digest", (F.col("n_rows") + F.coalesce("more", F.lit(0))).alias("n_rows"),
                   F.when(F.col("other") < F.col("best"), F.col("other")).otherwise(F.col("best")).alias("best")))
    return old.unionByName(found.where(F.col("slot").isNull()).select("digest", "n_rows", "best"))


def decide(rows: DataFrame, total: DataFrame) -> DataFrame:
    """``rows`` with ``keep_id, group_size, kept``.

    Only groups of several rows are joined back.  If they are too many for a
    broadcast, the largest ones (at most ``HOT_GROUPS``) are broadcast and the
    rest, each a small part of the rows, go through a shuffle join.
    """
    many = write_table(total.where("n_rows > 1").select("digest", "n_rows", F.struct("best.doc_id", "best.place").alias("win")), "dedup-many")
    n_groups, n_rows = many.count(), rows.count()

    def apply(part: DataFrame, side: DataFrame, how: str) -> DataFrame:
        j = part.join(side, "digest", how)
        alone = F.col("n_rows").isNull()
        return j.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("win.doc_id")).alias("keep_id"),
                        F.coalesce("n_rows", F.lit(1).cast("bigint")).alias("group_size"),
                        (alone | (F.col("win.place") == F.col("place"))).alias("kept"), "digest")

    if n_groups * GROUP_BYTES <= common.BROADCAST_BYTES:
        return apply(rows, F.broadcast(many), "left")
    hot = n_rows // HOT_GROUPS  # fewer than HOT_GROUPS groups have more rows than that
    top, rest = F.broadcast(many.where(F.col("n_rows") > hot)), many.where(F.col("n_rows") <= hot)
    return apply(rows, top, "inner").unionByName(apply(rows.join(top, "digest", "left_anti"), rest, "left"))


def dedup(docs: DataFrame, seen) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` per row of ``docs``.

    ``seen`` is a condition on ``doc_id``: rows for which it holds are the
    earlier deliveries that the history is built from, the others the new one
    that is looked up in it.
    """
    seen = F.coalesce(seen, F.lit(False))
    rows = write_table(digests(docs), "dedup-rows")
    old = write_table(groups(rows.where(seen)), "dedup-old")
    history = History.build(old)
    new = write_table(groups(rows.where(~seen)), "dedup-new")
    found = write_table(history.lookup(new, new.count()), "dedup-found")
    out = decide(rows, merged(history, found))
    discard(old, new)
    return out


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS h
  FROM documents),
w AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST) AS r,
             count(*) OVER (PARTITION BY h) AS c,
             first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST) AS k
      FROM d)
SELECT doc_id, k AS keep_id, c AS group_size, r = 1 AS kept, h AS text_sha256 FROM w
"""
