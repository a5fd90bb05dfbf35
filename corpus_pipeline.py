"""A training corpus from ``documents``, in five stages; each is written as Parquet and reread by the next.

1. language: documents in a language that the labelled rows teach; others go.
2. near_dup: one document of each near-duplicate class.
3. secrets: secrets in the texts are replaced by a mark; every document stays.
4. mixing: sources repeated or thinned to their targets.
5. encoding: every document's SentencePiece ids, and whether they decode to its text.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import language, mixing, neardup, pieces, secrets
from tramline.llm.queries import TOKENIZERS
from tramline.session import checkpoint_dir, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(docs.select("doc_id", "text", "lang"))
    return language.speakable(docs.select(COLUMNS), model)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs.select(COLUMNS), either=True)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    formats = secrets.learn(docs.select("doc_id", "text"))
    found = secrets.scan(docs.select(COLUMNS), formats)
    clean = found.withColumn("text", secrets.redacted(F.col("text"), F.col("found"))).drop("found")
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("bigint")).select(COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.materialised(mixing.mix(docs.select(COLUMNS))).select(COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, model: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> DataFrame:
    read = pieces.read_back(docs.select(COLUMNS), model)
    return read.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_ids"), F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


STAGES = [
    ("language_id", language_stage),
    ("minhash_near_dup", near_dup_stage),
    ("secret_scans", secrets_stage),
    ("source_mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

#: Language identification and what follows from it has no SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; stage outputs lie in a folder of this run in the shared checkpoint folder."""
    folder = os.path.join(checkpoint_dir(spark), f"corpus-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        written = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(written)
        docs = spark.read.parquet(written)
    return docs
