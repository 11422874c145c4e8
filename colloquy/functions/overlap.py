"""Clipped n-gram overlap of two token arrays in one row, without a shuffle.

The tokens come from Spark's own functions; an Arrow function counts the grams that two
arrays share. It works on many rows at once: a token is its number in the batch's
dictionary, a gram of n tokens the rank of its first n - 1 and its last one, so that equal
numbers are equal grams, with nothing hashed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows are counted together up to this many tokens; a longer row alone.
CHUNK_TOKENS = 1 << 15


def _chunk_ends(sizes: np.ndarray) -> list[int]:
    """Where runs of rows with about ``CHUNK_TOKENS`` tokens end."""
    ends, total = [], 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > CHUNK_TOKENS:
            ends.append(i)
            total = 0
        total += size
    return [*ends, len(sizes)]


def _shared(left: pa.ListArray, right: pa.ListArray, n_left: np.ndarray, n_right: np.ndarray, longest: int) -> list[np.ndarray]:
    """For each order up to ``longest`` the grams that each row's two sides share, clipped."""
    rows = len(n_left)
    tokens = pa.concat_arrays([left.flatten(), right.flatten()])
    codes = tokens.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(codes.max(initial=0)) + 1
    # Which text a token stands in: the left ones first, then the right ones.
    text = np.repeat(np.arange(2 * rows), np.concatenate([n_left, n_right]))
    at = np.arange(len(codes))
    rank = text % max(rows, 1)
    out = []
    for n in range(1, longest + 1):
        if n > 1:
            # A gram in both texts begins with a gram in both texts; it must not run into the next text.
            go = at + (n - 1) < len(codes)
            go[go] = text[at[go] + (n - 1)] == text[at[go]]
            at, rank = at[go], rank[go]
        _, first, rank = np.unique(rank * width + codes[at + (n - 1)], return_index=True, return_inverse=True)
        row = text[at[first]] % max(rows, 1)
        on_left = text[at] < rows
        both = np.minimum(np.bincount(rank[on_left], minlength=len(first)), np.bincount(rank[~on_left], minlength=len(first)))
        out.append(np.bincount(row, weights=both, minlength=rows).astype(np.int64))
        going = both[rank] > 0
        at, rank = at[going], rank[going]
    return out


def _counter(orders: list[int]):
    fields = ["left_len", "right_len", *[f"match{n}" for n in orders]]

    @F.arrow_udf(T.StructType([T.StructField(f, T.IntegerType()) for f in fields]))
    def counted(left: pa.Array, right: pa.Array) -> pa.Array:
        n_left, n_right = (x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (left, right))
        matches: list[list[np.ndarray]] = [[] for _ in orders]
        start = 0
        for end in _chunk_ends(n_left + n_right):
            some = _shared(left.slice(start, end - start), right.slice(start, end - start), n_left[start:end], n_right[start:end], max(orders))
            for found, n in zip(matches, orders):
                found.append(some[n - 1])
            start = end
        columns = [n_left, n_right, *[np.concatenate(found) for found in matches]]
        return pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in columns], fields)

    return counted


def with_overlaps(
    df: DataFrame, left: str, right: str, orders: list[int], prefix: str
) -> DataFrame:
    """Replace two token arrays by their lengths and their common grams.

    Gives ``{prefix}left_len``, ``{prefix}right_len`` and, for each order,
    ``{prefix}match{n}``: the grams the two have in common, clipped.
    """
    names = ["left_len", "right_len", *[f"match{n}" for n in orders]]
    keep = [c for c in df.columns if c not in (left, right)]
    out = df.select(*keep, _counter(list(orders))(left, right).alias(f"__{prefix}counts"))
    return out.select(*keep, *[F.col(f"__{prefix}counts")[name].alias(f"{prefix}{name}") for name in names])
