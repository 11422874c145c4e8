"""The corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. All but the last keep the columns of ``documents``: rejected rows go, and texts are redacted in place (``n_chars`` follows the text).

1. ``quality``: rows that fail the base rules or the fences of their language and source go.
2. ``exact_dedup``: of equal texts the row with the least id stays.
3. ``near_dedup``: of texts linked by five-word shingles at a similarity of 0.8 the row with the least id stays.
4. ``pii``: personal data and secrets are replaced by their kind in brackets.
5. ``packing``: sequences of powers of two up to 1024 tokens.

An empty table passes through every stage; a null or empty text fails the first.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import exact_dedup, near_dedup, packing, pii, quality_rules
from colloquy.session import ensure_checkpoint_dir

VOCABULARY = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = pii.redact(docs)
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return redacted


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path(VOCABULARY))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("pii", redaction), ("packing", pack)]

# Signatures, boosted trees and token ids are beyond SQL; a test compares every stage with brute force on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is a table in the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
