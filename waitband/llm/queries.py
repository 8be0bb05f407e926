"""The registered queries of the operators: each reads its whole table,
applies its operator with production parameters and returns one row per row
(or per packed row) of the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import table
from . import decontaminate, encoding, lines, neardup, packing, runs, secrets, sharding, simhash, spans, toxicity, warc, whitening
from .bpe import tokenizer_path
from .oracle import ORACLE  # noqa: F401


def op1_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.kd_shards(table(spark, sf_dir, "documents"), shards=24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.quality(table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Fitted on the documents that ``labels`` covers, a bounded sample of them."""
    return toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity_model(spark, docs, sf_dir))


def op5_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "first")


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.default_path())


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path)


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.dedup(docs)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op13_repair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_kd_sharding": op1_kd_sharding,
    "op2_bpe": op2_bpe,
    "op3_line_quality": op3_line_quality,
    "op4_toxicity": op4_toxicity,
    "op5_bagminhash": op5_bagminhash,
    "op6_winnowing": op6_winnowing,
    "op7_secrets": op7_secrets,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_sentence_spans": op10_sentence_spans,
    "op11_whitening": op11_whitening,
    "op12_simhash": op12_simhash,
    "op13_repair_runs": op13_repair_runs,
}
