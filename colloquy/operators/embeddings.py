"""Greedy token-embedding match of candidate and reference texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Token positions per block; a block is at most this many vectors.
BLOCK = 1024

def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _matrix(vectors: pa.Scalar) -> np.ndarray:
    rows = vectors.values
    return rows.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(rows), -1)


def _best_in_blocks(batches):
    """For each pair of blocks the highest cosine of every vector of one within the other: (pair, side, block, at, cosine)."""
    for batch in batches:
        pair, c, r, c_vectors, r_vectors = batch.columns
        for i in range(batch.num_rows):
            cosines = _unit(_matrix(c_vectors[i])) @ _unit(_matrix(r_vectors[i])).T
            n, m = cosines.shape
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pair[i], n + m), pa.array(["c"] * n + ["r"] * m), pa.array([c[i].as_py()] * n + [r[i].as_py()] * m, pa.int64()),
                pa.array(np.concatenate([np.arange(n), np.arange(m)])), pa.array(np.concatenate([cosines.max(axis=1), cosines.max(axis=0)])),
            ], names=["pair", "side", "block", "at", "cosine"])


def _blocks(tokens: DataFrame, pair: str, position: str, vector: str, block: int, side: str) -> DataFrame:
    return tokens.where(F.col(vector).isNotNull()).groupBy(pair, F.floor(F.col(position) / block).alias(side)).agg(
        F.sort_array(F.collect_list(F.struct(F.col(position), F.col(vector).alias("v")))).alias("__v")
    ).select(pair, side, F.col("__v.v").alias(f"{side}_vectors"))


def greedy_match(
    cand: DataFrame, ref: DataFrame, pair: str = "pair_id", position: str = "position",
    vector: str = "embedding", block: int = BLOCK,
) -> DataFrame:
    """``pair, precision, recall, f1`` per text pair from given token vectors.

    Precision is the mean, over candidate tokens, of the highest cosine with a reference
    token; recall swaps the sides. Vectors are grouped into blocks of token positions, and
    a block pair is one matrix product that returns only the best value per token. The
    grid of block ids is built from the narrow ids, and the vectors are then joined by
    (pair, block): an ordinary text is one cell, a huge one is spread over many tasks. A
    pair with tokens on one side only scores 0.
    """
    c = _blocks(cand, pair, position, vector, block, "c")
    r = _blocks(ref, pair, position, vector, block, "r")
    c_ids, r_ids = (
        t.select(pair, F.floor(F.col(position) / block).alias(s)).distinct() for t, s in ((cand, "c"), (ref, "r"))
    )
    cells = c_ids.join(r_ids, pair).join(c, [pair, "c"]).join(r, [pair, "r"])
    kind = cells.schema[pair].dataType.simpleString()
    best = cells.select(F.col(pair).alias("pair"), "c", "r", "c_vectors", "r_vectors").mapInArrow(
        _best_in_blocks, f"pair {kind}, side string, block bigint, at bigint, cosine double"
    )
    # The highest of the blocks' highest: maxima merge, so both sides come out of one pass.
    top = best.groupBy("pair", "side", "block", "at").agg(F.max("cosine").alias("cosine"))
    scores = top.groupBy(F.col("pair").alias(pair)).agg(
        F.avg(F.when(F.col("side") == "c", F.col("cosine"))).alias("precision"), F.avg(F.when(F.col("side") == "r", F.col("cosine"))).alias("recall")
    )
    pairs = c_ids.select(pair).union(r_ids.select(pair)).distinct()
    both = F.col("precision") + F.col("recall")
    return pairs.join(scores, pair, "left").select(
        pair,
        F.coalesce("precision", F.lit(0.0)).alias("precision"),
        F.coalesce("recall", F.lit(0.0)).alias("recall"),
        F.when(F.coalesce(both, F.lit(0.0)) != 0, 2 * F.col("precision") * F.col("recall") / both)
        .otherwise(0.0)
        .alias("f1"),
    )


def greedy_match_means(scores: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The means over pairs, named as in a metrics record; one row, or one per group."""
    return scores.groupBy(*(by or [])).agg(
        F.avg("precision").alias("bertscore_precision"),
        F.avg("recall").alias("bertscore_recall"),
        F.avg("f1").alias("bertscore_f1"),
    )
