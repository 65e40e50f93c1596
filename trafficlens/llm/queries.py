"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_replay as BP
from . import collocations as CO
from . import history_dedup as HD
from . import katz_lm as KZ
from . import language_mixture as LM
from . import line_runs as LR
from . import partenum_join as PJ
from . import quality_bytes_cnn as QC
from . import quality_divergence as QD
from . import source_mixing as SM
from . import topk_inner as TK
from . import turn_repair as TR
from . import warc as WA
from .common import crc_remainder, read, write_table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_remainder("doc_id", 3) == 1
    langs, model = LM.train(docs, ~held_out)
    return LM.identify(docs, langs, model).withColumn("held_out", held_out)


def op2_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return QD.judge(docs, QD.references(docs))


def op3_quality_bytes_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = crc_remainder("doc_id", 5) == 0
    net = QC.train(docs.where(~held_out), labels.where(~held_out))
    return QC.score(docs, net).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PJ.classes(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_topk_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = TK.quantised(read(spark, sf_dir, "embeddings"), scale=64.0)
    return TK.search(vectors, F.col("vec_id") % 20 == 0, k=20)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = write_table(SM.sized(docs).select("doc_id", "source", "size", "draw", "bin"), "mix-sizes")
    return SM.mix(rows, SM.cyclic_weights(rows), max_epochs=3).select("doc_id", "size", "source_size", "target", "taken")


def op7_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return KZ.score(docs, held_out_of=10).withColumn("held_out", crc_remainder("doc_id", 10) == 0)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WA.round_trip(read(spark, sf_dir, "pages"), least_bytes=0)


def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return LR.dedup(docs).select("doc_id", "text", "n_lines", "n_deleted")


def tokenizer() -> tuple[dict[bytes, int], str]:
    import public_tokenizers
    return BP.load_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN


def op10_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer()
    return BP.digests(read(spark, sf_dir, "documents"), ranks, pattern)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CO.collocations(read(spark, sf_dir, "documents"))


def op12_history_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = crc_remainder("doc_id", 2) == 0  # stands for the earlier deliveries
    return HD.dedup(read(spark, sf_dir, "documents"), seen).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    return TR.repair(TR.damage(conversations), ids=conversations)


QUERIES = {
    "op1_language_mixture": op1_language_mixture,
    "op2_quality_divergence": op2_quality_divergence,
    "op3_quality_bytes_cnn": op3_quality_bytes_cnn,
    "op4_partenum_join": op4_partenum_join,
    "op5_topk_inner": op5_topk_inner,
    "op6_source_mixing": op6_source_mixing,
    "op7_katz_lm": op7_katz_lm,
    "op8_warc": op8_warc,
    "op9_line_runs": op9_line_runs,
    "op10_bpe_replay": op10_bpe_replay,
    "op11_collocations": op11_collocations,
    "op12_history_dedup": op12_history_dedup,
    "op13_turn_repair": op13_turn_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op4_partenum_join": PJ.ORACLE_SQL,
    "op5_topk_inner": TK.ORACLE_SQL,
    "op6_source_mixing": SM.ORACLE_SQL,
    "op8_warc": WA.ORACLE_SQL,
    "op9_line_runs": LR.ORACLE_SQL,
    "op11_collocations": CO.ORACLE_SQL,
    "op12_history_dedup": HD.ORACLE_SQL,
}
