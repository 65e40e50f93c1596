"""Language-model scoring with a Katz bigram model.

Counts are Good-Turing discounted up to ``K``; a history's left-over mass goes
to unseen words in proportion to the unigram model, by a backoff weight that
makes each history's probabilities add up to one exactly; the unigram model
gives its own left-over mass to the class of unknown words.  A token's score is
its bigram probability if the bigram was seen, else the history's backoff weight
times the unigram probability (weight 1 after an unknown history).

Words travel as 64-bit hashes, in chunks of whole Arrow columns rather than as
rows: a task turns texts into chunks with a dictionary of their own; the
unigram table, in partitions by word hash, answers every chunk with the counts
of its words; the distinct bigrams of each chunk, with the texts they occur
in, go to the partition of their history, where they are counted and looked
up together.  Histories too frequent for one partition are dealt over several by
their next word, and their statistics added up afterwards.  Only sums and
counts of counts come to the driver.

This form scores the corpus that it counts, in one pass, and keeps no model;
:mod:`.katz_tables` stores the same model, of any order, for other texts.

Defined cases: a null or empty text is the single token ``end``; with no training
text every token is unknown with probability 1 (score 0); a null id counts as
''; rows are scored one by one, so repeated rows give repeated results; extra
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, id_remainder, mix, trim, trimmed, write_table

K = 5  # counts up to here are discounted
CHUNK = 1 << 21  # tokens in a chunk
PIECE = 1 << 20  # tokens of one text handled together
PER_BUCKET = 1 << 21  # training and scored tokens for each partition of the tables
END = np.uint64(xxhash.xxh64_intdigest(b" end"))  # no word holds a space
PARTS = ("kind int, g bigint, row bigint, n bigint, x double, n1 bigint, n2 bigint, n3 bigint, n4 bigint, n5 bigint, "
         "m bigint, s double, packed binary")
COLUMNS = [c.split()[0] for c in PARTS.split(", ")]
DOC, SEEN, HISTORY, UNSEEN, UNDISCOUNTED, TYPES, TABLE = range(7)


def pack(a: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes."""
    a = np.ascontiguousarray(a, np.uint64)
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    planes = a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    """The packed integers, as 32-bit ones where they fit."""
    width, raw = data[0], np.frombuffer(zstandard.decompress(data[1:]), np.uint8)
    size = 4 if width < 4 else 8
    out = np.zeros((len(raw) // width, size), np.uint8)
    out[:, :width] = raw.reshape(width, -1).T
    return out.view(f"<i{size}").ravel()


def pack_all(arrays: list[np.ndarray]) -> bytes:
    found = [pack(a) for a in arrays]
    return b"".join([len(x).to_bytes(8, "little") + x for x in found])


def unpack_all(data: bytes) -> list[np.ndarray]:
    out, i = [], 0
    while i < len(data):
        n = int.from_bytes(data[i:i + 8], "little")
        out.append(unpack(data[i + 8:i + 8 + n]))
        i += 8 + n
    return out


def discounts(types: list[int], k: int = K) -> list[float]:
    """Katz's discount ratios of the counts 1 to ``K`` from the numbers of types with count 1, 2, ...

    The largest ``k`` for which all ratios lie between 0 and 1 decides; higher
    counts lose as much as the last of these.  Where there is none, absolute
    discounting by n1 / (n1 + 2 n2).  Every ratio is below 1.
    """
    n = [0, *types]
    for top in range(k, 0, -1):
        if not all(n[r] for r in range(1, top + 2)):
            continue
        a = (top + 1) * n[top + 1] / n[1]
        found = [((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a) if a != 1 else 0 for r in range(1, top + 1)]
        if all(0 < d < 1 for d in found):
            return found + [1 - (1 - found[-1]) * top / r for r in range(top + 1, k + 1)]
    d = min(0.9, max(0.1, n[1] / (n[1] + 2 * n[2]))) if n[1] else 0.5
    return [1 - d / r for r in range(1, k + 1)]


def unigram_log10(total: int, types: list[int]):
    """count -> log10 probability, for arrays of counts (0: the class of unknown words)."""
    d = np.array([0.0, *discounts(types), 1.0])
    mass = sum(d[r] * r * types[r - 1] for r in range(1, K + 1)) + total - sum(r * types[r - 1] for r in range(1, K + 1))
    if not total:
        return lambda c: np.zeros(len(c))
    scale = 1.0
    if not any(types[:K]):  # nothing is discounted: one more token makes room
        scale, left = total / (total + 1), 1 / (total + 1)
    else:
        left = 1 - mass / total

    def f(c):
        known = d[np.minimum(c, K + 1)] * c / total * scale
        return np.log10(np.where(c > 0, known, left))

    return f


def tokenised(docs: DataFrame, held_out_of: int) -> DataFrame:
    """Chunks: ``chunk``, the distinct ``words`` by hash with their training ``counts``, and the packed ``tokens``."""

    def run(batches):
        part = TaskContext.get().partitionId()
        hashes, pieces, row, size, chunk = [], [], part << 33, 0, part << 20

        def flush():
            words, ids, often = np.unique(np.concatenate(hashes + [np.array([p[2] for p in pieces if p[2] is not None], np.uint64)]),
                                          return_inverse=True, return_counts=True)
            rank = np.empty(len(words), np.int64)
            rank[np.argsort(-often, kind="stable")] = np.arange(len(words))  # small numbers for frequent words
            length = np.array([len(h) for h in hashes])
            train = np.array([p[1] for p in pieces])
            counts = np.bincount(ids[:length.sum()], np.repeat(train, length), len(words)).astype(np.int64)
            before = np.full(len(pieces), len(words))  # what stands before a piece: a word, or the beginning
            before[[i for i, p in enumerate(pieces) if p[2] is not None]] = rank[ids[length.sum():]]
            tokens = pack_all([rank, rank[ids[:length.sum()]], length, train, before, np.array([p[0] for p in pieces]) - (part << 33)])
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([part << 33], pa.int64()), pa.array([words.tobytes()], pa.binary()),
                 pa.array([pack(counts)], pa.binary()), pa.array([[p[3] for p in pieces]], pa.list_(pa.int64())),
                 pa.array([tokens], pa.binary()), pa.array([int(length.sum())], pa.int64()),
                 pa.array([sum(1 for p in pieces if p[1] and p[2] is None)], pa.int64())],
                names=["chunk", "base", "words", "counts", "doc_ids", "tokens", "n", "n_train"])

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                found = (text or "").encode("utf-8", "surrogatepass").lower().split()
                h = np.append(np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found)), END)
                for i in range(0, len(h), PIECE):
                    hashes.append(h[i:i + PIECE])
                    pieces.append((row, id_remainder(doc_id, held_out_of) != 0, h[i - 1] if i else None, doc_id))
                    size += len(hashes[-1])
                    if size >= CHUNK:
                        yield flush()
                        hashes, pieces, size, chunk = [], [], 0, chunk + 1
                row += 1
        if pieces:
            yield flush()

    return write_table(docs.select("doc_id", "text").mapInArrow(
        trimmed(run), "chunk bigint, base bigint, words binary, counts binary, doc_ids array<bigint>, tokens binary, n bigint, n_train bigint"),
        "katz-chunks")


def unigrams(chunks: DataFrame, buckets: int) -> DataFrame:
    """The unigram table by partition (``chunk`` null: hashes, counts, statistics) and the answers to each chunk."""

    def ask(batches):
        for b in batches:
            for chunk, words, counts in zip(b.column("chunk").to_pylist(), b.column("words").to_pylist(), b.column("counts").to_pylist()):
                h, c = np.frombuffer(words, np.uint64), unpack(counts)
                at = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                cut = np.searchsorted(at, np.arange(buckets + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(buckets, dtype=np.int32)), pa.array([chunk] * buckets, pa.int64()),
                     pa.array([h[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary()),
                     pa.array([pack(c[i:j]) for i, j in zip(cut, cut[1:])], pa.binary())],
                    names=["bucket", "chunk", "words", "counts"])

    def answer(t: pa.Table) -> pa.Table:
        bucket = t["bucket"][0].as_py()
        h = [np.frombuffer(x, np.uint64) for x in t["words"].to_pylist()]
        words, place = np.unique(np.concatenate(h), return_inverse=True)
        total = np.bincount(place, np.concatenate([unpack(x) for x in t["counts"].to_pylist()]), len(words)).astype(np.int64)
        cut = np.cumsum([0] + [len(x) for x in h])
        few = np.bincount(np.minimum(total, K + 2), minlength=K + 3)
        stats = [len(words), int((total > 0).sum()), int(total.sum()), *few[1:K + 2].tolist()]
        parts = [place[i:j] for i, j in zip(cut, cut[1:])]
        return pa.table({"bucket": pa.array([bucket] * (len(h) + 1), pa.int32()),
                         "chunk": pa.array(t["chunk"].to_pylist() + [None], pa.int64()),
                         "counts": pa.array([pack(total[p]) for p in parts] + [pack(total)], pa.binary()),
                         "place": pa.array([pack(p) for p in parts] + [words.tobytes()], pa.binary()),
                         "stats": pa.array([None] * len(h) + [stats], pa.list_(pa.int64()))})

    asked = chunks.select("chunk", "words", "counts").mapInArrow(trimmed(ask), "bucket int, chunk bigint, words binary, counts binary")
    return write_table(asked.groupBy("bucket").applyInArrow(
        answer, "bucket int, chunk bigint, counts binary, place binary, stats array<bigint>"), "katz-unigrams")


def rows_of(kind: int, size: int, /, **columns) -> pa.Table:
    out = {}
    for c, f in zip(COLUMNS, PARTS.split(", ")):
        t = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary()}[f.split()[1]]
        v = np.full(size, kind) if c == "kind" else columns.get(c)
        out[c] = pa.nulls(size, t) if v is None else pa.array(v, t)
    return pa.table(out)


def bigrams(chunks: DataFrame, answers: DataFrame, sizes: list[tuple[int, int]], buckets: int, total: int, known: int,
            types: list[int], n_train: int, n_all: int) -> DataFrame:
    """Parts of the scores and of the model (kinds of rows above), from the partitions by history (written)."""
    offset = np.zeros(buckets + 1, np.int64)
    for bucket, n in sizes:
        offset[bucket + 1] = n
    offset = np.cumsum(offset)
    log_p1 = unigram_log10(total, types)
    most = max(1, n_all // (4 * buckets))  # occurrences of a history in one place

    def send(batches):
        for b in batches:
            for i in range(b.num_rows):
                trim()  # after the chunk before
                r = b.slice(i, 1).to_pylist()[0]
                c_h, g_h = [], []
                for a in sorted(r["answers"], key=lambda a: a["bucket"]):
                    c_h.append(unpack(a["counts"]))
                    g_h.append(unpack(a["place"]).astype(np.int64) + offset[a["bucket"]])
                rank, ids, length, train, before, row = unpack_all(r["tokens"])
                count, gid = np.empty(len(rank) + 1, np.int64), np.empty(len(rank) + 1, np.int64)
                count[rank], gid[rank] = np.concatenate(c_h), np.concatenate(g_h)
                del r["answers"], r["tokens"], c_h, g_h
                count[-1], gid[-1] = n_train, offset[-1]  # the beginning of a text
                first = np.cumsum(np.r_[0, length[:-1]])
                seen = count[ids]
                base = np.add.reduceat(np.log10((seen + 0.1) / (total + 0.1 * (known + 1))), first)
                yield block(buckets + r["chunk"] % buckets, r["base"], pack_all([row, length, np.add.reduceat(seen > 0, first, dtype=int)]),
                            base.tobytes(), r["doc_ids"])
                last = np.empty_like(ids)
                last[1:] = ids[:-1]
                last[first] = before
                pair, which = np.unique(last.astype(np.int64) * (len(rank) + 1) + ids, return_inverse=True)
                piece = np.repeat(np.arange(len(length), dtype=np.int32), length)[np.argsort(which, kind="stable")]
                times = np.bincount(which)
                learnt = np.bincount(which, np.repeat(train, length)).astype(np.int64)
                del which, last, ids, seen
                h, w = pair // (len(rank) + 1), pair % (len(rank) + 1)
                salts = -(-count[h] // most) + (count[h] == 0)
                salt = (mix(gid[w].astype(np.uint64)) % salts.astype(np.uint64)).astype(np.int64)
                to = (mix(mix(gid[h].astype(np.uint64)) + salt.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((gid[w], gid[h], to))
                start = np.cumsum(np.r_[0, times])
                cut = np.searchsorted(to[order], np.arange(buckets + 1))
                for k in range(buckets):
                    o = order[cut[k]:cut[k + 1]]
                    if not len(o):
                        continue
                    where = np.repeat(start[o], times[o]) + np.arange(times[o].sum()) - np.repeat(np.cumsum(np.r_[0, times[o][:-1]]), times[o])
                    g = gid[h[o]]
                    new = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
                    yield block(k, r["base"], pack_all([
                        np.diff(np.r_[0, g[new]]), count[h[o[new]]], np.diff(np.r_[new, len(g)]), gid[w[o]], learnt[o], count[w[o]],
                        times[o], piece[where], row]), None, None)

    def block(bucket, base, packed, raw, ids):
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([base], pa.int64()), pa.array([packed], pa.binary()), pa.array([raw], pa.binary()),
             pa.array([ids], pa.list_(pa.int64()))], names=["bucket", "base", "packed", "raw", "doc_ids"])

    def look_up(t: pa.Table) -> pa.Table:
        trim()  # after the group before
        out = []
        if t["bucket"][0].as_py() >= buckets:  # what a chunk knows about its texts
            for r in t.to_pylist():
                row, n, n_known = unpack_all(r["packed"])
                out.append(rows_of(DOC, len(row), g=pa.array(r["doc_ids"], pa.int64()), row=row.astype(np.int64) + r["base"], n=n, n1=n_known, s=np.frombuffer(r["raw"])))
            return pa.concat_tables(out)
        parts = [unpack_all(x) for x in t["packed"].to_pylist()]
        hist = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.int64) for p in parts]))
        w = np.concatenate([p[3] for p in parts])
        wide = int(w.max()) + 1
        of = np.concatenate([np.repeat(np.searchsorted(hist, np.cumsum(p[0], dtype=np.int64)), p[2]) for p in parts])
        key, first, which = np.unique(of * wide + w, return_index=True, return_inverse=True)
        h, w = of[first], w[first]
        del of
        which = which.astype(np.int32)
        c = np.bincount(which, np.concatenate([p[4] for p in parts]), len(key)).astype(np.int64)
        c1 = np.concatenate([np.repeat(p[1], p[2]) for p in parts])[first].astype(np.int64)
        lp = log_p1(np.concatenate([p[5] for p in parts])[first])
        size = [len(p[3]) for p in parts]
        for p in parts:  # only what tells the texts is needed from here on
            p[:6] = [None] * 6
        some = c > 0
        n_r = [np.bincount(h[c == r], minlength=len(hist)) for r in range(1, K + 1)]
        rest = np.bincount(h[c > K], c[c > K], len(hist)).astype(np.int64)
        held = np.bincount(h[some], 10.0 ** lp[some], len(hist))
        whole = np.zeros(len(hist), np.int64)
        whole[h] = c1
        salted = whole > most
        plain = (sum(n_r) == 0) & (whole > 0)  # no count of the history is discounted here
        few = np.bincount(np.minimum(c, K + 2), minlength=K + 3)
        out.append(rows_of(TYPES, 1, **{f"n{r}": [few[r]] for r in range(1, K + 1)}, m=[few[K + 1]]))
        out.append(rows_of(TABLE, 1, packed=[pack_all([hist[h[some]], w[some], c[some]])]))
        x = np.zeros(len(key))
        x[some] = np.log10(c[some] / (c1[some] + (plain & ~salted)[h[some]]))
        x[~some] = lp[~some]
        needed = np.zeros(len(hist), bool)
        needed[h[~some]] = True
        at = np.flatnonzero((needed | salted) & (whole > 0))
        out.append(rows_of(HISTORY, len(at), g=hist[at], n=whole[at], m=rest[at], s=held[at], **{f"n{r + 1}": n_r[r][at] for r in range(K)}))
        done = 0
        for p, base, m in zip(parts, t["base"].to_pylist(), size):
            k = np.repeat(which[done:done + m], p[6])
            done += m
            piece, row = p[7], p[8].astype(np.int64) + base
            direct = some[k] | (c1[k] == 0)
            n = len(row)
            there = np.flatnonzero(np.bincount(piece[direct], minlength=n))
            by = {f"n{r}": np.bincount(piece[direct & (c[k] == r)], minlength=n)[there] for r in range(1, K + 1)}
            out.append(rows_of(SEEN, len(there), row=row[there], x=np.bincount(piece[direct], x[k[direct]], n)[there], **by))
            for kind, chosen in ((UNSEEN, ~direct), (UNDISCOUNTED, some[k] & (plain & salted)[h[k]])):
                pairs, inv, times = np.unique(h[k[chosen]] * n + piece[chosen], return_inverse=True, return_counts=True)
                out.append(rows_of(kind, len(pairs), g=hist[pairs // n], row=row[pairs % n], n=times,
                                   x=np.bincount(inv, x[k[chosen]], len(pairs)) if kind == UNSEEN else np.zeros(len(pairs))))
        return pa.concat_tables(out)

    told = (answers.where("chunk IS NOT NULL").groupBy("chunk")
            .agg(F.collect_list(F.struct("bucket", "counts", "place")).alias("answers")))
    sent = chunks.select("chunk", "base", "doc_ids", "tokens").join(told, "chunk").mapInArrow(
        trimmed(send), "bucket int, base bigint, packed binary, raw binary, doc_ids array<bigint>")
    return write_table(sent.groupBy("bucket").applyInArrow(look_up, PARTS), "katz-parts")


def score(docs: DataFrame, held_out_of: int = 10) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Rows whose id has remainder 0 modulo ``held_out_of`` are not learnt from.
    """
    chunks = tokenised(docs, held_out_of)
    n_all, n_train = chunks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_train"), F.lit(0))).first()
    buckets = max(8, -(-n_all // PER_BUCKET))
    answers = unigrams(chunks, buckets)
    stats = answers.where("stats IS NOT NULL").select("bucket", "stats").collect()  # one row per partition
    _, known, total, *types = np.sum([r["stats"] for r in stats], 0).tolist() if stats else [0] * (K + 4)
    parts = bigrams(chunks, answers, [(r["bucket"], r["stats"][0]) for r in stats], buckets, total, known, types, n_train, n_all)
    discard(chunks, answers)
    counts = parts.where(F.col("kind") == TYPES).agg(*[F.sum(f"n{r}") for r in range(1, K + 1)], F.sum("m")).first()
    d = discounts([int(v or 0) for v in counts])
    kept = sum(F.col(f"n{r}") * (r * d[r - 1]) for r in range(1, K + 1)) + F.col("m")
    none = sum(F.col(f"n{r}") for r in range(1, K + 1)) == 0
    weights = (parts.where(F.col("kind") == HISTORY).groupBy("g")
               .agg(F.max("n").alias("c"), F.sum("m").alias("m"), F.sum("s").alias("s"), *[F.sum(f"n{r}").alias(f"n{r}") for r in range(1, K + 1)])
               .select("g", "c", none.alias("none"),
                       F.log10(F.when(none, 1 / (F.col("c") + 1)).otherwise(1 - kept / F.col("c")) / (1 - F.col("s"))).alias("weight")))
    later = parts.where(F.col("kind").isin(UNSEEN, UNDISCOUNTED)).select("kind", "g", "row", "n", "x").join(weights, "g")
    later = later.select("row", F.when(F.col("kind") == UNSEEN, F.col("n") * F.col("weight") + F.col("x"))
                         .when(F.col("none"), F.col("n") * F.log10(F.col("c") / (F.col("c") + 1))).otherwise(0.0).alias("x"))
    seen = parts.where(F.col("kind") == SEEN).select(
        "row", (F.col("x") + sum(F.col(f"n{r}") * float(np.log10(d[r - 1])) for r in range(1, K + 1))).alias("x"))
    blank = [F.lit(None).cast("bigint").alias(c) for c in ("doc_id", "n", "n1")] + [F.lit(None).cast("double").alias("s")]
    about = parts.where(F.col("kind") == DOC).select("row", F.lit(None).cast("double").alias("x"), F.col("g").alias("doc_id"), "n", "n1", "s")
    every = about.unionByName(seen.unionByName(later).select("row", "x", *blank))
    return (every.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), F.sum("n1").alias("n_known"),
                                     F.sum("s").alias("base_score"), F.sum("x").alias("score"))
            .select("doc_id", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score"))
