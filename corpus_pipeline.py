"""Corpus preparation pipeline: language ID, line dedup, near-duplicate removal, mixing, tokens.

Each stage works on what its predecessor kept.  ``run`` writes the result of a
stage as Parquet into the shared folder and reads it again for the next one.

Rejections: language ID drops texts without a letter and texts in which no
language has ``MIN_SHARE``; line dedup drops a document when none of its
lines with a word is left; of near duplicates the smallest (doc_id, row) of a
component stays, and empty texts are no duplicates of anything.  Mixing repeats
whole documents; the one document per source in which the words run out is cut
after its last word taken.  A null or extra column passes through
``COLUMNS`` unread; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.llm import bpe_replay as BP
from trafficlens.llm import language_mixture as LM
from trafficlens.llm import line_runs as LR
from trafficlens.llm import partenum_join as PJ
from trafficlens.llm import source_mixing as SM
from trafficlens.llm.common import WORD, discard, read, small_side, with_file_rows, write_table
from trafficlens.llm.queries import tokenizer
from trafficlens.session import prepare_workers

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_SHARE = 0.5  # of the leading language for a document to stay
MAX_EPOCHS = 3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1, trained on all labelled rows."""
    prepare_workers(spark)
    langs, model = LM.train(docs, F.lit(True))
    found = LM.identify(docs, langs, model, keep=tuple(COLUMNS))
    return found.where((F.col("lang_pred") != LM.UNDETERMINED) & (F.col("score") >= MIN_SHARE)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9; the character count follows the new text."""
    out = LR.dedup(docs.select(*COLUMNS))
    return (out.where((F.col("n_deleted") == 0) | F.col("text").rlike(WORD))
            .withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("bigint"))
            .select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4; one document of each component stays."""
    prepare_workers(spark)
    frozen = with_file_rows(docs.select(*COLUMNS), "row")
    classes = write_table(PJ.classes(frozen, key="row").where(F.col("class_node").isNotNull()), "near-classes")
    place = F.struct("doc_id", "row")
    first = classes.groupBy("class_node").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = write_table(first.select("class_node", "first"), "near-first")
    extra = write_table(classes.join(small_side(first, first.count(), 64), "class_node")
                        .where(place > F.col("first")).select("row"), "near-extra")
    discard(classes, first)
    return frozen.join(small_side(extra, extra.count(), 24), "row", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6 with the weights 1, 2, 3 in turn over the sources."""
    rows = SM.sized(docs.select(*COLUMNS))
    mixed = SM.mix(rows, SM.cyclic_weights(docs), max_epochs=MAX_EPOCHS)
    return SM.repeat(mixed, COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: token counts and digests of every row of the mix."""
    prepare_workers(spark)
    ranks, pattern = tokenizer()
    return BP.digests(docs, ranks, pattern)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", tokens),
]

# EM and the tokenizer are beyond SQL; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
