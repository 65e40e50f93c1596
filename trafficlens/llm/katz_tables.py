"""Katz backoff of any order in stored tables, evaluated level by level.

:func:`train` writes a model below a folder, to be loaded later for other texts:

* ``ngrams`` (partitioned by ``k``): ``h, w, c, p`` - for every n-gram of ``k`` words
  its history (hash of the ``k - 1`` words before), its word, its count and its
  discounted probability;
* ``histories`` (partitioned by ``k``): ``h, c, weight`` - log10 of the backoff weight
  with which the next shorter history takes over for words not seen after ``h``;
* ``summary``: one row per order with the number of n-grams of each low count.

Counts up to ``K`` are Good-Turing discounted per order.  A history's left-over
mass is divided by the lower-order mass of the words not seen after it, so its
probabilities add up to one exactly; a history without a discounted count gets
one more token in its denominator.  The unigram table gives its left-over mass
to the class of unknown words.

:func:`score` looks a token up by its longest history; where the n-gram is not
stored, the weight of the history (1 if that is unknown too) is added and the
next shorter history is asked, down to the unigram.  Each level is one join of
only the tokens that are still open.

:mod:`.katz_lm` computes the same model of order 2 in one pass over packed
chunks, within the disk of one corpus-wide run; here every window is a row.

Defined cases: a null or empty text is the single token ``end``; a text's first
words have beginning marks before them; without training texts every token has
probability 1; repeated rows count and score one by one; extra columns are not
read.  Words and histories are 64-bit hashes.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import with_file_rows, write_table
from .katz_lm import K, discounts

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def token_windows(docs: DataFrame, order: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per token: ``w0`` (the token) and ``w1``, ``w2``, ... (the words before it, beginning marks at the start)."""
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, UPPER.lower())
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    mark = lambda name: F.array(F.xxhash64(F.lit(name)))  # noqa: E731  # a word holds no space
    d = docs.select(*keep, F.concat(F.transform(words, lambda x: F.xxhash64(x)), mark(" end")).alias("__a"))
    before = [F.slice(F.concat(*[mark(" begin")] * j, F.col("__a")), F.lit(1), F.size("__a")).alias(f"w{j}") for j in range(1, order)]
    zipped = F.arrays_zip(F.col("__a").alias("w0"), *before)
    return d.select(*keep, F.inline(zipped)).toDF(*keep, *[f"w{j}" for j in range(order)])


def history(k: int):
    """Hash of the ``k`` words before a token."""
    return F.xxhash64(*[F.col(f"w{j}") for j in range(1, k + 1)]) if k else F.lit(0).cast("bigint")


def _ratios(summary: list, k: int) -> list[float]:
    row = next((r for r in summary if r["k"] == k), None)
    return discounts([int(row[f"n{r}"]) for r in range(1, K + 2)]) if row else [1.0] * K


def _discounted(c, ratios: list[float]):
    out = F.lit(1.0)
    for r, d in enumerate(ratios, 1):
        out = F.when(c == r, F.lit(float(d))).otherwise(out)
    return out * c


def train(docs: DataFrame, path: str, order: int = 3) -> None:
    """Count the texts of ``docs`` and write the model below ``path``."""
    spark = docs.sparkSession
    tokens = token_windows(docs, order)
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), history(k - 1).alias("h"), history(max(0, k - 2)).alias("shorter"))
                                 for k in range(1, order + 1)]))
    counts = (tokens.select("w0", levels.alias("l")).groupBy("l.k", "l.h", "l.shorter", F.col("w0").alias("w"))
              .agg(F.count(F.lit(1)).alias("c")))
    counts = write_table(counts, "katz-counts")
    few = [F.count_if(F.col("c") == r).alias(f"n{r}") for r in range(1, K + 2)]
    summary = counts.groupBy("k").agg(*few, F.sum("c").alias("total")).collect()  # one row per order
    spark.createDataFrame([(r["k"], *[r[f"n{i}"] for i in range(1, K + 2)], r["total"], order) for r in summary],
                          "k int, " + ", ".join(f"n{i} bigint" for i in range(1, K + 2)) + ", total bigint, model_order int").coalesce(1) \
        .write.mode("overwrite").parquet(os.path.join(path, "summary"))
    lower = None
    for k in range(1, order + 1):
        own = counts.where(F.col("k") == k).withColumn("kept", _discounted(F.col("c"), _ratios(summary, k)))
        sums = own.groupBy("h").agg(F.sum("c").alias("n"), F.sum("kept").alias("held"), F.min("c").alias("least"))
        # no discounted count: one more token makes room
        plain = F.col("least") > K
        whole = F.col("n") + F.when(plain, 1).otherwise(0)
        left = F.when(plain, 1 / whole).otherwise(1 - F.col("held") / whole)
        sums = sums.select("h", F.col("n").alias("c"), whole.alias("whole"), left.alias("left"))
        rows = own.join(sums.select("h", "whole"), "h").withColumn("p", F.col("kept") / F.col("whole"))
        if lower is None:
            hist = sums.select("h", "c", F.log10("left").alias("weight"))  # of the class of unknown words
        else:
            # the lower-order mass of the words seen after each history; every lower n-gram is stored
            below = rows.select("h", "w", F.col("shorter").alias("sh")).join(
                lower.select(F.col("h").alias("sh"), "w", F.col("p").alias("q")), ["sh", "w"])
            mass = below.groupBy("h").agg(F.sum("q").alias("mass"))
            hist = sums.join(mass, "h").select("h", "c", F.log10(F.col("left") / (1 - F.col("mass"))).alias("weight"))
        rows.select("h", "w", "c", "p").write.mode("overwrite").parquet(os.path.join(path, "ngrams", f"k={k}"))
        hist.write.mode("overwrite").parquet(os.path.join(path, "histories", f"k={k}"))
        lower = spark.read.parquet(os.path.join(path, "ngrams", f"k={k}"))


def score(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, n_known, score`` of every row of ``docs`` by a stored model."""
    spark: SparkSession = docs.sparkSession
    order = spark.read.parquet(os.path.join(path, "summary")).agg(F.max("model_order")).first()[0]
    table = lambda name, k: spark.read.parquet(os.path.join(path, name, f"k={k}"))
    rows = with_file_rows(docs.select("doc_id", "text"), "__row")
    if order is None:  # nothing was learnt
        n = token_windows(rows, 1, ("doc_id", "__row")).groupBy("__row", "doc_id").agg(F.count(F.lit(1)).alias("n_tokens"))
        return n.select("doc_id", "n_tokens", F.lit(0).cast("bigint").alias("n_known"), F.lit(0.0).alias("score"))
    open_ = token_windows(rows, order, ("doc_id", "__row")).groupBy("doc_id", "__row", *[f"w{j}" for j in range(order)]).agg(
        F.count(F.lit(1)).alias("n")).withColumn("x", F.lit(0.0))
    done = None
    for k in range(order, 0, -1):
        found = open_.withColumn("h", history(k - 1)).withColumnRenamed("w0", "w").join(table("ngrams", k).select("h", "w", "p"), ["h", "w"], "left")
        found = write_table(found.withColumnRenamed("w", "w0"), "katz-level")
        hit = found.where(F.col("p").isNotNull()).select("doc_id", "__row", "n", (F.col("x") + F.log10("p")).alias("x"), F.lit(1).alias("known"))
        miss = found.where(F.col("p").isNull()).drop("p").join(table("histories", k).select("h", "weight"), "h", "left")
        open_ = miss.withColumn("x", F.col("x") + F.coalesce("weight", F.lit(0.0))).drop("weight", "h")
        done = hit if done is None else done.unionByName(hit)
    # what is open at the end are unknown words: their class has the weight of the unigram level
    done = done.unionByName(open_.select("doc_id", "__row", "n", "x", F.lit(0).alias("known")))
    return (done.groupBy("__row", "doc_id").agg(F.sum("n").alias("n_tokens"), F.sum(F.col("n") * F.col("known")).alias("n_known"),
                                                F.sum(F.col("n") * F.col("x")).alias("score"))
            .select("doc_id", "n_tokens", F.col("n_known").cast("bigint").alias("n_known"), "score"))
