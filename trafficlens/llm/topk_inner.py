"""Exact top-k inner products of a query set, pruned by vector length and SVD.

Vectors are turned into integers.  The table is cut into ranges of descending
length, the first with ``FIRST`` rows and each further one ``GROWTH`` times as
large.  They are searched one after the other, and every query carries its k-th
best score so far: a range is sent only those queries for which |query| times
the length of its longest row still reaches that score, so most queries stop
early where lengths differ, and the last ranges are met by few.

Within a range, rows and queries are dealt into blocks by a hash of their id,
and each pair of blocks is one task's work: it goes through its rows by
descending length, rotates both sides by the singular vectors of the table, and
sums the products over leading directions first.  What a row can still add is
bounded by Cauchy-Schwarz over the remaining directions; rows whose bound stays
below a query's k-th best score are dropped.  Survivors are scored in exact
integer arithmetic; the best of all blocks are merged into the carried table.

Defined cases: null ids, null vectors and vectors with null or non-finite
components take no part; shorter vectors count as padded with zeros; among rows
with the id of a query the smallest vector is the query and none is its
candidate; ties go to the smaller id; no rows or no queries give an empty
result; extra columns are not read.  Scores are exact within 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, write_table

ROWS, QUERIES = 16_384, 2_048  # per block
FIRST, GROWTH = 65_536, 8  # rows of the first range; of each further one to the one before
STEP = 2_048  # rows looked at together
STAGES = (0.25, 0.5, 1.0)  # shares of the directions summed before each pruning


def quantised(df: DataFrame, scale: float = 64.0, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vec`` = floor(scale * x) of the rows that take part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (df.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & fine)
            .select(F.col(id_col).cast("bigint").alias("vec_id"),
                    F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint")).alias("vec")))


def matrix(column, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, dim) if len(column) else np.empty((0, dim), np.int64)


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of the table, strongest first, from its dim x dim Gram matrix."""

    def gram(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            x = matrix(pa.chunked_array([b.column("vec")]), dim).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_pydict({"i": np.repeat(np.arange(dim, dtype=np.int32), dim),
                                          "j": np.tile(np.arange(dim, dtype=np.int32), dim), "v": total.ravel()})

    found = vectors.select("vec").mapInArrow(gram, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((dim, dim))
    for r in found.collect():  # dim * dim numbers
        out[r["i"], r["j"]] = r["v"]
    return np.linalg.eigh(out)[1][:, ::-1]


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise integer inner products of equally many rows."""
    return np.einsum("ij,ij->i", a, b)


def best_of_block(q_id, q, p_id, p, turn: np.ndarray, k: int, least: np.ndarray | None = None):
    """(query index, vec_id, score) of the k best rows for each query, of those that reach ``least``."""
    dim = q.shape[1]
    turned_q, turned_p = q @ turn, p @ turn
    len_q, len_p = np.linalg.norm(turned_q, axis=1), np.linalg.norm(turned_p, axis=1)
    order = np.lexsort((p_id, -len_p))
    p_id, p, turned_p, len_p = p_id[order], p[order], turned_p[order], len_p[order]
    cuts = sorted({max(1, int(dim * s)) for s in STAGES})
    least = np.full(len(q), -np.inf) if least is None else least.copy()  # the k-th best score so far
    best = (np.empty(0, int), np.empty(0, np.int64), np.empty(0, np.int64))
    for at in range(0, len(p), STEP):
        rows = slice(at, at + STEP)
        live = np.flatnonzero(len_q * len_p[at] * (1 + 1e-9) + 1e-6 >= least)
        if not len(live):
            break  # all later rows are shorter
        slack = 1e-9 * np.outer(len_q[live], len_p[rows]) + 1e-6
        partial, keep, done = 0.0, None, 0
        for cut in cuts:
            partial = partial + turned_q[live, done:cut] @ turned_p[rows, done:cut].T
            rest_q = np.linalg.norm(turned_q[live, cut:], axis=1)
            rest_p = np.linalg.norm(turned_p[rows, cut:], axis=1)
            ok = partial + np.outer(rest_q, rest_p) + slack >= least[live][:, None]
            keep, done = ok if keep is None else keep & ok, cut
            live_left = keep.any(1)
            if not live_left.all():
                live, partial, keep, slack = live[live_left], partial[live_left], keep[live_left], slack[live_left]
            if not len(live):
                break
        if not len(live):
            continue
        keep &= q_id[live][:, None] != p_id[rows][None, :]
        # the k-th largest of the rotated sums bounds the k-th best from below
        if keep.shape[1] > k:
            sums = np.where(keep, partial, -np.inf)
            kth = np.partition(sums, -k, axis=1)[:, -k]
            keep &= partial + 2 * slack >= kth[:, None]
        i, j = np.nonzero(keep)
        scores = np.concatenate([exact(q[live[i[s:s + (1 << 18)]]], p[at + j[s:s + (1 << 18)]])
                                 for s in range(0, len(i), 1 << 18)] or [np.empty(0, np.int64)])
        who = np.concatenate([best[0], live[i]])
        ids = np.concatenate([best[1], p_id[at + j]])
        scores = np.concatenate([best[2], scores])
        order = np.lexsort((ids, -scores, who))
        who, ids, scores = who[order], ids[order], scores[order]
        first = np.r_[True, who[1:] != who[:-1]] if len(who) else np.empty(0, bool)
        start = np.flatnonzero(first)
        place = np.arange(len(who)) - np.repeat(start, np.diff(np.r_[start, len(who)]))
        best = (who[place < k], ids[place < k], scores[place < k])
        full = place == k - 1
        least[who[full]] = np.maximum(least[who[full]], scores[full])
    return best


def ranges(rows: DataFrame, n: int) -> list[tuple[float, float]]:
    """(shortest, longest) squared length of each range, longest range first; they cover all lengths."""
    upto, size = [], FIRST
    while sum(upto, 0) + size < n:
        upto.append(size)
        size *= GROWTH
    shares = [float(1 - x / n) for x in np.cumsum(upto)]
    cut = rows.agg(F.percentile_approx("length", F.array(*map(F.lit, shares)), 10_000)).first()[0] if shares else []
    edges = [float("inf"), *dict.fromkeys(cut), -1.0]  # equal lengths stay together
    return [(low, high) for high, low in zip(edges, edges[1:])]


def search(vectors: DataFrame, is_query, k: int = 20, report: list | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows of ``vectors`` (from :func:`quantised`).

    ``report`` receives (rows, queries sent, queries) of every range.
    """
    vectors = vectors.withColumn("length", F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x))
    rows = write_table(vectors, "topk-vectors")
    n, n_q, dim = rows.agg(F.count(F.lit(1)), F.count_if(is_query), F.max(F.size("vec"))).first()
    dim = max(1, dim or 1)
    rows = rows.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dim) - F.size("vec"))))
    turn = rotation(rows, dim)
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    deal = lambda m: F.pmod(F.xxhash64("vec_id"), F.lit(m)).cast("int")
    queries = write_table(rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("vec", "length")).alias("q")).select("vec_id", "q.*"),
                          "topk-queries")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        q_id, p_id = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        least = left["least"].to_numpy().astype(float)
        who, ids, scores = best_of_block(q_id, matrix(left["vec"], dim), p_id, matrix(right["vec"], dim), turn, k, least)
        return pa.table({"query_id": q_id[who], "vec_id": ids, "score": scores})

    best = None
    for low, high in ranges(rows, n):
        part = rows.where((F.col("length") > low) & (F.col("length") <= high))
        m, longest = part.agg(F.count(F.lit(1)), F.max("length")).first()
        if not m:
            continue
        sent = queries.withColumn("least", F.lit(float("-inf")))
        if best is not None:
            least = best.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("held"), F.min("score").alias("kth"))
            sent = queries.join(least.where(F.col("held") == k).select("vec_id", "kth"), "vec_id", "left")
            sent = sent.withColumn("least", F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf")))).drop("kth")
            sent = sent.where(F.sqrt("length") * float(np.sqrt(longest)) * (1 + 1e-9) + 1e-6 >= F.col("least"))
        sent = write_table(sent, "topk-sent")
        n_sent = sent.count()
        if report is not None:
            report.append((m, n_sent, n_q))
        if n_sent:
            stripes, groups = max(1, -(-m // ROWS)), max(1, -(-n_sent // QUERIES))
            left = sent.withColumns({"group": deal(groups), "stripe": every(stripes)})
            right = part.withColumns({"stripe": deal(stripes), "group": every(groups)})
            found = (left.select("vec_id", "vec", "least", "stripe", "group").groupBy("stripe", "group")
                     .cogroup(right.select("vec_id", "vec", "stripe", "group").groupBy("stripe", "group"))
                     .applyInArrow(cell, "query_id bigint, vec_id bigint, score bigint"))
            found = found if best is None else found.unionByName(best.select("query_id", "vec_id", "score"))
            old, best = best, write_table(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "topk-best")
            if old is not None:
                discard(old)
        discard(sent)
    if best is None:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return best.select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, p.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.vec) + 1), lambda i: q.vec[i] * p.vec[i])) AS BIGINT) AS score
  FROM v q JOIN v p ON q.vec_id <> p.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
