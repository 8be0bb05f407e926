"""The training-data pipeline over ``documents``: toxic documents go, one
document of each near-duplicate class stays, documents that hold benchmark
passages go, secrets are masked, and what is left is encoded.

Each stage takes the documents that the one before it kept and returns their
columns (the last one ids and digests), so a stage can be run again from the
table its predecessor wrote.

Null and empty texts are not toxic, are no near copies, hold nothing and are
encoded to no ids; they stay.  Very long texts are worked on whole.  Rows that
are repeated with equal id and text are one near-duplicate class, of which one
stays; a null doc_id stays null.  Further columns, whatever their names, are
carried to the last stage but one.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitband.llm import decontaminate, encoding, neardup, secrets, toxicity
from waitband.llm.bpe import tokenizer_path
from waitband.llm.common import materialise
from waitband.llm.queries import toxicity_model
from waitband.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity_model(spark, docs, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoding.digests(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("bpe", encode),
]

#: Trained weights, signatures and BPE have no SQL form; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
