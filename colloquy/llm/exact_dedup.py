"""Exact dedup with a heavy-hitter split.

Texts are compared by the SHA-256 of the text with each run of white space replaced by one space. A narrow table of ids and digests is made
in one pass over the text (a checkpoint); everything else works on it.

**Heavy digests.** Each task keeps a Misra-Gries summary of at most ``COUNTERS`` digests. Summed, a digest's counters fall short of its frequency
by at most N / (COUNTERS + 1), so every digest with at least N / ``HEAVY`` rows has a sum of at least N / HEAVY - N / (COUNTERS + 1); as all
sums together are at most N, fewer than 1 / (1 / HEAVY - 1 / (COUNTERS + 1)) digests (342 by default) reach it. These candidates are verified by
an exact count, and their winners are broadcast: rows with a heavy digest are decided on the map side, without a shuffle.

**Other digests** are grouped by an ordinary shuffle and joined back.

**Cases.** Null text counts as empty; empty texts are equal. Of equal texts the row with the smallest id stays, a null id being larger than any other;
of rows that repeat that id, one stays. An empty table gives an empty result. Other columns are not read by :func:`find_copies` and are kept as
they are by :func:`drop_copies`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.arrays import batch_of, map_batches
from colloquy.session import durable

COUNTERS, HEAVY = 1024, 256
SPACES = r"[\x20\x09-\x0D]+"


def digest_of(text: str) -> Column:
    """SHA-256 (hexadecimal) of the text with runs of white space as one space."""
    return F.sha2(F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), SPACES, " ").cast("binary"), 256)


def _summary(counters: int):
    """Misra-Gries over a partition, batch by batch: beyond ``counters`` digests the next largest count is taken off all."""

    def apply(batches):
        kept: dict[bytes, int] = {}
        for batch in batches:
            found = batch.column(0).value_counts()
            for digest, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                kept[digest] = kept.get(digest, 0) + n
            if len(kept) > counters:
                counts = np.fromiter(kept.values(), dtype=np.int64, count=len(kept))
                off = int(np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1])
                kept = {d: n - off for d, n in kept.items() if n > off}
        if kept:
            yield batch_of(["digest", "n"], [pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.int64())])

    return apply


def heavy_candidates(digests: DataFrame, n_rows: int, counters: int = COUNTERS, heavy: int = HEAVY) -> DataFrame:
    """The digests (column ``digest``) that may have at least ``n_rows / heavy`` rows; a bounded number, see above."""
    least = n_rows / heavy - n_rows / (counters + 1)
    return (
        map_batches(digests.select("digest"), _summary(counters), "digest binary, n bigint")
        .groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("digest")
    )


def find_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS, heavy: int = HEAVY
) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, digest (binary SHA-256). Runs a job for the table of digests when called."""
    if heavy > counters:
        raise ValueError("heavy must be at most counters")
    rows = durable(
        docs.select(F.col(id_col).alias("doc_id"), F.unhex(digest_of(text_col)).alias("digest"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    rows = rows.withColumn("rank", F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row"))
    candidates = heavy_candidates(rows, rows.count(), counters, heavy)
    sums = [F.min("rank").alias("first"), F.count("*").alias("group_size")]
    winners = rows.join(F.broadcast(candidates), "digest").groupBy("digest").agg(*sums)
    split = rows.join(F.broadcast(winners), "digest", "left")
    light = split.where("group_size is null").drop("first", "group_size")
    decided = split.where("group_size is not null").unionByName(
        light.join(light.groupBy("digest").agg(*sums), "digest")
    )
    return decided.select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "digest"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = find_copies(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.unhex(digest_of(text_col)).alias("digest"))
    out = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest")), "left_semi")
    # Rows that repeat an id and its text are interchangeable: one of them stays.
    return out.dropDuplicates(["id", "digest"]).select("row.*")
