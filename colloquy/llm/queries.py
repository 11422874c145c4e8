"""The registered queries of the training-data operators: each applied to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import (
    bpe, exact_dedup, license_rules, near_dedup, packing, pii, prefix_trie, quality_classifier, quality_rules, sentence_pieces, spelling, substring_dedup,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
# The rules of the URL query.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_substring_dedup(spark, d):
    return substring_dedup.remove_repeats(_table(spark, d, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


@query
def op2_exact_dedup(spark, d):
    return exact_dedup.find_copies(_table(spark, d, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query
def op3_quality_rules(spark, d):
    judged = quality_rules.judge(_table(spark, d, "documents").select("doc_id", "text", "lang", "source"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op4_quality_classifier(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    labels = _table(spark, d, "labels").where(~quality_classifier.held_out("doc_id"))
    return quality_classifier.score(docs, quality_classifier.train(docs, labels)).select(
        "doc_id", quality_classifier.held_out("doc_id").alias("held_out"), "score", "predicted"
    )


@query
def op5_pii(spark, d):
    found = pii.find(_table(spark, d, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("email"), count("ip"), count("card"), count("phone"),
        F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"),
    )


@query
def op6_license_rules(spark, d):
    return license_rules.summary(license_rules.scan(_table(spark, d, "documents"))).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query
def op7_bpe(spark, d):
    return bpe.encode(_table(spark, d, "documents"), public_tokenizers.path(VOCABULARY), decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


@query
def op8_near_dedup(spark, d):
    return near_dedup.components(_table(spark, d, "documents"), k=3, percent=85)


@query
def op9_url_filter(spark, d):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(_table(spark, d, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


@query
def op10_packing(spark, d):
    return packing.pack(_table(spark, d, "documents"), public_tokenizers.path(VOCABULARY)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op11_spelling_variants(spark, d):
    return spelling.spelling_variants(_table(spark, d, "documents"), typo_every=31)


@query
def op12_sentence_pieces(spark, d):
    return sentence_pieces.encode(_table(spark, d, "documents"), public_tokenizers.path(PIECES), decoded=True).select(
        "doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).alias("n_bytes"),
    )


@query
def op13_prefix_trie(spark, d):
    turns = prefix_trie.numbered_turns(_table(spark, d, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.paths(turns, family=20))
