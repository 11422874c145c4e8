"""Word hashes of many texts at once, as numpy arrays.

A word is a maximal run of characters other than space, tab, line feed, vertical tab, form feed and carriage return. All of
these are single bytes in UTF-8 and never part of another character, so words are cut on the bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 1 << 20
# Bytes whose hashes are summed together; only so many are held as 64-bit numbers.
BLOCK_BYTES = 1 << 16
BATCH_BYTES = 16 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# Odd bases have an inverse modulo 2**64, so a hash can be moved to any position.
BASE_BYTES = 0xD6E8FEB86659FD93
BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_powers: dict[int, np.ndarray] = {}


def bounded_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes, so that a run of long texts fits into a Python worker; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    text = spark.conf.get(key)
    if not text.isdigit() or int(text) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``df.mapInArrow`` with batches bounded in bytes."""
    bounded_batches(df.sparkSession)
    return df.mapInArrow(function, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64; kept for the usual chunk size only."""
    have = _powers.get(base)
    if have is not None and len(have) >= n:
        return have[:n]
    out = np.empty(max(n, 1 << 16), dtype=np.uint64)
    out[0] = 1
    filled = 1
    while filled < len(out):
        step = np.uint64(pow(base, filled, 1 << 64))
        more = min(filled, len(out) - filled)
        out[filled:filled + more] = out[:more] * step
        filled += more
    if len(out) <= CHUNK_BYTES + (1 << 16):
        _powers[base] = out
    return out[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of ``values[i] * base**i``; element 0 is 0."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def ranges(prefixes: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The polynomial hash of each range, the same wherever the range stands."""
    return (prefixes[end] - prefixes[start]) * powers(inverse(base), len(prefixes))[start]


def byte_ranges(b: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The polynomial hash of each range of bytes (ascending, not empty), as :func:`ranges` has it for prefix sums, block by block."""
    at_start, at_end = np.empty(len(start), dtype=np.uint64), np.empty(len(start), dtype=np.uint64)
    back = inverse(base)
    shift = np.empty(len(start), dtype=np.uint64)
    local, local_back = powers(base, BLOCK_BYTES), powers(back, BLOCK_BYTES)
    total, scale, scale_back = 0, 1, 1
    for a in range(0, len(b), BLOCK_BYTES):
        sums = b[a:a + BLOCK_BYTES].astype(np.uint64)
        sums += np.uint64(1)
        sums *= local[:len(sums)]
        np.cumsum(sums, out=sums)
        sums *= np.uint64(scale)
        sums += np.uint64(total)
        lo, hi = np.searchsorted(start, [a, a + len(sums)])
        inside = start[lo:hi] - a
        at_start[lo:hi] = np.where(inside > 0, sums[inside - 1], np.uint64(total))
        shift[lo:hi] = local_back[inside] * np.uint64(scale_back)
        lo, hi = np.searchsorted(end, [a + 1, a + len(sums) + 1])
        at_end[lo:hi] = sums[end[lo:hi] - a - 1]
        total = int(sums[-1])
        scale, scale_back = scale * pow(base, BLOCK_BYTES, 1 << 64) % (1 << 64), scale_back * pow(back, BLOCK_BYTES, 1 << 64) % (1 << 64)
    at_end -= at_start
    at_end *= shift
    return at_end


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of a batch as (first row, texts in UTF-8) of about ``limit`` bytes; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(text))
    first, size, group = 0, 0, []
    for i, value in enumerate(column.cast(pa.large_binary())):
        value = value.as_py() or b""
        if group and size + len(value) > limit:
            yield first, group
            first, size, group = i, 0, []
        group.append(value)
        size += len(value) + 1
    if group:
        yield first, group


class Words:
    """The words of some texts: ``start`` and ``end`` in ``buffer``, ``doc`` (which text), ``hash`` (64 bits)."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.buffer = np.frombuffer(b" ".join(texts), dtype=np.uint8)
        b = self.buffer
        if lower:
            b = np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)
        inside = np.zeros(len(b) + 2, dtype=bool)
        inside[1:-1] = ~((b == 32) | ((b >= 9) & (b <= 13)))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[0::2], edges[1::2]
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.first_byte = np.concatenate([[0], np.cumsum(lengths + 1)])
        # first_word[i] .. first_word[i + 1] are the words of text i
        self.first_word = np.searchsorted(self.start, self.first_byte)
        self.n_words = np.diff(self.first_word)
        self.doc = np.repeat(np.arange(len(texts)), self.n_words)
        self.hash = mix(byte_ranges(b, BASE_BYTES, self.start, self.end) + _GOLDEN * (self.end - self.start).astype(np.uint64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours; ``len(x) - width + 1`` values."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def as_long(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as Spark's signed ones, bit for bit."""
    return np.ascontiguousarray(x).view(np.int64)


def batch_of(names: Iterable[str], columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=list(names))
