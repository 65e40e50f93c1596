"""Mixing sources to target weights by capped water-filling.

Every source gets a share of all words by its weight, but no more than
``max_epochs`` times its own size; the excess of clamped sources goes to the
others by weight, until none is above its cap.  A source's target is met with
whole repetitions of all its documents and one fractional repetition: documents
in the order of a seeded hash until the words run out, the last one in part.
So each source takes its target rounded to whole words.

DataFrame functions only.  The order of a source is cut by the hash into
``BINS`` bins whose sizes are summed first; only the rows of the one bin in
which the words run out are ordered row by row, so no task ever holds a source.

Defined cases: a null text has size 0; a null source is a source of its own;
null ids hash as ''; rows alike in hash, id and size are interchangeable, and
an empty table gives an empty result; extra columns pass through, and those
with the names of result columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, discard, small_side, write_table

BINS = 1 << 16


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def sized(docs: DataFrame, seed: str = "") -> DataFrame:
    """``docs`` with ``size``, the seeded hash ``draw`` of the id and its bin."""
    draw = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return (docs.withColumns({"size": word_count(), "draw": draw})
            .withColumn("bin", F.conv(F.substring("draw", 1, 4), 16, 10).cast("int")))


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """Weights in turn over the distinct sources by code point, null last (one row per source)."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    return sources.select("source").distinct().select("source", turn.alias("weight"))


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``.

    Each round clamps the sources above their cap at the present level; only
    the sums over the sources come to the driver.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = None, -1
    while True:
        over = F.lit(False) if level is None else cap <= F.lit(level[0]) * F.col("weight") / F.lit(level[1])
        n, used, weight = sources.agg(
            F.count_if(over), F.sum(F.when(over, cap).otherwise(0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if n == clamped or not weight:
            break
        clamped, level = n, (float(total - used), float(weight))
    share = F.lit(0.0) if level is None else F.lit(level[0]) * F.col("weight") / F.lit(level[1])
    return sources.withColumn("target", F.least(cap.cast("double"), share))


def plan(rows: DataFrame, weights: DataFrame, max_epochs: int) -> tuple[DataFrame, int]:
    """One row per source: target, whole repetitions, and where its fractional one ends; their number."""
    bins = write_table(rows.groupBy("source", "bin").agg(F.sum("size").alias("words")), "mix-bins")
    totals = bins.groupBy("source").agg(F.sum("words").alias("source_size"))
    weighted = totals.join(weights.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    weighted = write_table(weighted, "mix-sources")
    sources = water_fill(weighted, max_epochs)
    sources = sources.withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"))
    sources = sources.withColumn("part", F.greatest(
        F.lit(0), F.floor(F.col("target") + 0.5).cast("bigint") - F.col("whole") * F.col("source_size")))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ends = (bins.withColumn("before", upto - F.col("words"))
            .join(sources.select(F.col("source").alias("__s"), "part"), F.col("source").eqNullSafe(F.col("__s")))
            .where((F.col("before") <= F.col("part")) & (F.col("part") < F.col("before") + F.col("words")))
            .select(F.col("source").alias("__s"), F.col("bin").alias("end_bin"), "before"))
    done = write_table(
        sources.join(ends, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
        .withColumn("end_bin", F.coalesce("end_bin", F.lit(BINS))), "mix-plan")
    discard(bins, weighted)
    return done, done.count()


def mix(rows: DataFrame, weights: DataFrame, max_epochs: int = 3) -> DataFrame:
    """``rows`` (from :func:`sized`) with ``source_size, target, whole, extra, taken``.

    ``whole`` repetitions take a document entirely, ``extra`` counts the words
    of the fractional one, ``taken = whole * size + extra``.
    """
    rows = rows.drop("source_size", "weight", "target", "whole", "part", "end_bin", "before", "extra", "taken", "__s")
    sources, n = plan(rows, weights, max_epochs)
    sources = small_side(sources.withColumnRenamed("source", "__s"), n, 128)
    joined = rows.join(sources, F.col("source").eqNullSafe(F.col("__s")))
    rest = joined.where(F.col("bin") != F.col("end_bin")).withColumn(
        "extra", F.when(F.col("bin") < F.col("end_bin"), F.col("size")).otherwise(F.lit(0)).cast("bigint"))
    order = Window.partitionBy("source").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    left = F.col("part") - F.col("before") - (F.sum("size").over(order) - F.col("size"))
    last = joined.where(F.col("bin") == F.col("end_bin")).withColumn(
        "extra", F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("bigint"))
    return (rest.unionByName(last).withColumn("taken", F.col("whole") * F.col("size") + F.col("extra"))
            .drop("__s", "part", "end_bin", "before"))


def repeat(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each row as often as taken, a document taken in part cut after its last word taken."""
    whole = F.col("whole") + F.when((F.col("extra") > 0) & (F.col("extra") == F.col("size")), 1).otherwise(0)
    copies = mixed.where(whole > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), whole.cast("int")))).select(*columns)
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), 0), F.lit(1), F.col("extra").cast("int"))
    cut = (mixed.where((F.col("extra") > 0) & (F.col("extra") < F.col("size")))
           .withColumn("text", F.concat_ws(" ", words)).withColumn("n_chars", F.length("text").cast("bigint")))
    return copies.unionByName(cut.select(*columns))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS cap,
         CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight
  FROM d GROUP BY source),
-- sources by cap per weight: the level at which all before are clamped and none after
f AS (
  SELECT *, (sum(source_size) OVER () - (sum(cap) OVER w - cap))::DOUBLE AS rest,
         sum(weight) OVER () - (sum(weight) OVER w - weight) AS rest_weight
  FROM s WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT rest, rest_weight FROM f WHERE cap / weight > rest / rest_weight ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT s.source, source_size, least(CAST(cap AS DOUBLE), coalesce(rest * weight / rest_weight, CAST(cap AS DOUBLE))) AS target
  FROM s LEFT JOIN l ON true),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
         CAST(floor(p.target + 0.5) AS BIGINT) - p.whole * p.source_size
           - (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size) AS left_words
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, left_words)) AS BIGINT) AS taken FROM r
"""
