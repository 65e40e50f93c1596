"""Removal of repeated runs of lines, found in a suffix array of line ids.

A document is the sequence of its lines that hold a word; runs never cross
documents.  A run of consecutive lines with at least ``min_words`` words in all
that also occurs earlier (in the order of doc_id, then row, then line) is a
later copy: each line inside such a run is deleted, first occurrences stay.
(Rows of one id stand in the order of their row keys.)

The suffix array is built by prefix doubling: rank 1 is the place of the line id
among the ids that repeat, rank 2h of a position the place of the pair (rank h
here, rank h at h lines on).  Positions of one rank share h lines: an interval
of the array whose longest common prefix is h or more.  Runs that occur once
lose their rank at once, so each round only carries repeated runs, and doubling
ends when none repeats or a run of ``min_words`` lines is covered by two of h lines.  The interval of all
suffixes that share a run of any length between h and 2h is the one with equal
ranks h at its first and at its last h lines.  The shortest runs with enough
words that start at each line, and those that end at each line, cover every
maximal repeated run completely; of each interval the smallest position is the
first occurrence and all others are deleted.

DataFrame functions only.  Grouping is by rank with partial aggregation; windows
span the repeated lines of one document.

Defined cases: a null text stays null, an empty text stays empty, lines without
a word are never deleted and do not part a run; repeated rows are copies of the
first; null ids come first; an empty table stays empty; extra columns pass
through, and those with the names of result columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, WORD, discard, small_side, with_file_rows, write_table

MIN_WORDS = 50
ROW = "__row"


def worded_lines(docs: DataFrame) -> DataFrame:
    """``__row, doc_id, pos, lineno, w, h1, h2``: the lines with a word, numbered from 0, by 128-bit id."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(
        i.alias("lineno"), F.regexp_count(x, F.lit(WORD)).alias("w"),
        F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x, F.lit(2)).alias("h2")))
    return (docs.select(ROW, "doc_id", F.posexplode(F.filter(lines, lambda s: s["w"] > 0)).alias("pos", "s"))
            .select(ROW, "doc_id", "pos", "s.*"))


def ranked(keys: DataFrame, by: list[str], name: str) -> DataFrame:
    """The rows of ``keys`` that occur twice or more, with their place in sorted order (written)."""
    twice = keys.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    return write_table(twice.orderBy(*by).withColumn("rank", F.monotonically_increasing_id()), name)


def doubled_ranks(lines: DataFrame, min_words: int) -> tuple[DataFrame, list[int]]:
    """Repeated lines with their segment, word sums, and rank columns ``r1, r2, r4, ...``; the lengths."""
    ids = ranked(lines, ["h1", "h2"], "lines-r1")
    at = lines.join(small_side(ids.withColumnRenamed("rank", "r1"), ids.count(), 40), ["h1", "h2"]).drop("h1", "h2")
    # a segment is a stretch of repeated lines with no other between them
    in_row = Window.partitionBy(ROW).orderBy("pos")
    at = at.withColumn("seg", F.col("pos") - F.row_number().over(in_row))
    upto = F.sum("w").over(Window.partitionBy(ROW, "seg").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    written = at = write_table(at.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("w")), "lines-at")
    in_seg = Window.partitionBy(ROW, "seg").orderBy("pos")
    lengths = [1]
    while 2 * lengths[-1] <= min_words:
        h = lengths[-1]
        at = at.withColumns({"a": F.col(f"r{h}"), "b": F.lead(f"r{h}", h).over(in_seg)})
        ids = ranked(at.where("a IS NOT NULL AND b IS NOT NULL"), ["a", "b"], f"lines-r{2 * h}")
        n = ids.count()
        if not n:
            at = at.drop("a", "b")
            break
        at = at.join(small_side(ids.withColumnRenamed("rank", f"r{2 * h}"), n, 40), ["a", "b"], "left").drop("a", "b")
        old, at = written, write_table(at, "lines-at")
        discard(old)
        written = at
        lengths.append(2 * h)
    return at, lengths


def shortest_runs(at: DataFrame, min_words: int) -> DataFrame:
    """``__row, doc_id, start, len`` of the shortest runs with enough words from and up to each line."""
    ahead = Window.partitionBy(ROW, "seg").orderBy("before").rangeBetween(0, min_words - 1)
    behind = Window.partitionBy(ROW, "seg").orderBy("upto").rangeBetween(-(min_words - 1), 0)
    both = at.select(
        ROW, "doc_id", "pos", "before", "upto", F.max("pos").over(ahead).alias("last"), F.max("upto").over(ahead).alias("last_upto"),
        F.min("pos").over(behind).alias("first"), F.min("before").over(behind).alias("first_before"))
    onward = both.where(F.col("last_upto") - F.col("before") >= min_words).select(
        ROW, "doc_id", F.col("pos").alias("start"), (F.col("last") - F.col("pos") + 1).alias("len"))
    back = both.where(F.col("upto") - F.col("first_before") >= min_words).select(
        ROW, "doc_id", F.col("first").alias("start"), (F.col("pos") - F.col("first") + 1).alias("len"))
    return onward.unionByName(back).distinct()


def later_copies(at: DataFrame, lengths: list[int], runs: DataFrame) -> DataFrame:
    """``__row, start, len`` of the runs that also occur earlier."""
    runs = runs.where(F.col("len") < 2 * lengths[-1])
    level, rank = F.lit(1), F.col("r1")
    for h in lengths[1:]:
        level = F.when(F.col("len") >= h, h).otherwise(level)
        rank = F.when(F.col("len") >= h, F.col(f"r{h}")).otherwise(rank)
    ranks = at.select(ROW, F.col("pos").alias("__p"), *[f"r{h}" for h in lengths])
    names = [f"r{h}" for h in lengths]
    runs = runs.withColumn("second", F.col("start") + F.col("len") - level)
    keyed = (runs.withColumn("__p", F.col("start")).join(ranks, [ROW, "__p"]).withColumn("k1", rank).drop("__p", *names)
             .withColumn("__p", F.col("second")).join(ranks, [ROW, "__p"]).withColumn("k2", rank).drop("__p", "second", *names)
             .where("k1 IS NOT NULL AND k2 IS NOT NULL").withColumn("place", F.struct("doc_id", ROW, "start")))
    keyed = write_table(keyed, "lines-runs")
    first = keyed.groupBy("len", "k1", "k2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = write_table(first, "lines-first")
    return (keyed.join(small_side(first, first.count(), 80), ["len", "k1", "k2"]).where(F.col("place") > F.col("first"))
            .groupBy(ROW, "start").agg(F.max("len").alias("len")))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` freed of later copies, ``n_lines`` (with a word) and ``n_deleted``."""
    docs = docs.drop(ROW, "gone", "n_lines", "n_deleted")
    frozen = with_file_rows(docs, ROW)
    lines = write_table(worded_lines(frozen), "lines")
    at, lengths = doubled_ranks(lines, min_words)
    late = later_copies(at, lengths, shortest_runs(at, min_words))
    reach = F.max(F.col("pos") + F.coalesce("len", F.lit(0))).over(
        Window.partitionBy(ROW, "seg").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    gone = (at.select(ROW, "seg", "pos", "lineno").join(late.withColumnRenamed("start", "pos"), [ROW, "pos"], "left")
            .withColumn("reach", reach).where("reach > pos"))
    gone = write_table(gone.groupBy(ROW).agg(F.collect_list("lineno").alias("gone")), "lines-gone")
    discard(lines)
    n, held = gone.agg(F.count(F.lit(1)), F.sum(F.size("gone"))).first()
    side = gone if 64 * n + 8 * (held or 0) > BROADCAST_BYTES else F.broadcast(gone)
    split = F.split("text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone"))
    out = frozen.join(side, ROW, "left").withColumns({
        "n_deleted": F.coalesce(F.size("gone"), F.lit(0)).cast("bigint"),
        "n_lines": F.coalesce(F.size(F.filter(split, lambda x: x.rlike(WORD))), F.lit(0)).cast("bigint")})
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n"))
    return out.withColumn("text", text).select(*docs.columns, "n_lines", "n_deleted")


ORACLE_SQL = r"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS lineno
  FROM documents WHERE text IS NOT NULL),
l AS (
  SELECT doc_id, lineno, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w,
         row_number() OVER (PARTITION BY doc_id ORDER BY lineno) AS pos
  FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
c AS (SELECT *, CAST(sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS upto FROM l),
f AS (
  SELECT doc_id, pos, upto - w AS before, upto, line,
         md5(string_agg(line, chr(10)) OVER a) AS ahead, max(upto) OVER a AS a_upto, max(pos) OVER a AS a_last,
         md5(string_agg(line, chr(10)) OVER b) AS behind, min(upto - w) OVER b AS b_before, min(pos) OVER b AS b_first
  FROM c WINDOW a AS (PARTITION BY doc_id ORDER BY upto - w RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING),
                b AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
r AS (
  SELECT doc_id, pos AS first, a_last AS last, ahead AS k FROM f WHERE a_upto - before >= 50
  UNION
  SELECT doc_id, b_first, pos, behind FROM f WHERE upto - b_before >= 50),
e AS (SELECT *, min(struct_pack(d := doc_id, p := first)) OVER (PARTITION BY k) AS lowest FROM r),
x AS (SELECT DISTINCT doc_id, first, last FROM e WHERE struct_pack(d := doc_id, p := first) > lowest),
g AS (SELECT DISTINCT l.doc_id, l.lineno FROM l JOIN x ON l.doc_id = x.doc_id AND l.pos BETWEEN x.first AND x.last),
k AS (
  SELECT raw.doc_id, string_agg(line, chr(10) ORDER BY raw.lineno) FILTER (g.lineno IS NULL) AS text,
         count(g.lineno) AS n_deleted, count(*) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]')) AS n_lines
  FROM raw LEFT JOIN g ON raw.doc_id = g.doc_id AND raw.lineno = g.lineno GROUP BY raw.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_deleted, 0)::BIGINT AS n_deleted
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""
