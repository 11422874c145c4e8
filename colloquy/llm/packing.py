"""Packing by power-of-two decomposition.

A document's tokens (its ids and one ``END`` id) are cut from the front into pieces of ``longest`` tokens and then into the powers of two
of the rest, largest first. Each piece is a sequence of its own: no sequence crosses documents and, its length being a power of two, none needs
padding. Batches are formed from the bucket of one length (``bucket``), which a writer may partition by.

The plan is one pass over the text without a shuffle. ``sequence_id`` is the number of the task and of the row in it
(``monotonically_increasing_id``): a lost task that is run again on the same file split gives the same numbers, and no two rows share one.
Cut the lineage (write and reread) before packing rows that come out of a shuffle.

**Cases.** A null or empty text is the ``END`` id alone: one piece of length 1. Rows that repeat an id are packed each for itself. A null id stays
null. A very long text gives many pieces of ``longest``. An empty table gives no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.arrays import batch_of, chunks, map_batches
from colloquy.llm.bpe import PATTERN, Vocabulary, broadcast_vocabulary, encoder_of

LONGEST = 1024
END = 0


# The library's expression engine needs stack for each character of a run of white space; longer texts take the other encoder.
LIBRARY_CHARS = 200_000
_libraries: dict[int, tuple] = {}


def _tokens_of(broadcast):
    """A function from texts to arrays of ids: a library's encoder, and the one of :mod:`bpe` for very long texts.

    The library ranks merges by the id of what they make, so it serves only vocabularies whose ids rise with the merges.
    """
    key = hash(broadcast.value)
    if key not in _libraries:
        vocabulary = Vocabulary(broadcast.value)
        library = None
        if (np.diff(vocabulary.merged) > 0).all():
            ranks = {b: i for i, b in enumerate(vocabulary.bytes_of) if b and i not in vocabulary.special.values()}
            library = tiktoken.Encoding("library", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=vocabulary.special)
        _libraries.clear()
        _libraries[key] = library

    def encode(text: str) -> np.ndarray:
        library = _libraries[key]
        if library is None or len(text) > LIBRARY_CHARS:
            return np.frombuffer(encoder_of(broadcast).encode(text), dtype="<u4")
        return library.encode_to_numpy(text, allowed_special="all")

    return encode


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """``n`` as a sum of ``longest`` and lower powers of two, in falling order."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, end: int = END
) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, ids (binary), sequence_id, offset, bucket. ``longest`` is a power of two."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    vocabulary = broadcast_vocabulary(docs, path)
    last = np.array([end], dtype="<u4").tobytes()

    def apply(batches):
        encode = _tokens_of(vocabulary)
        for batch in batches:
            for first, texts in chunks(batch, "text"):
                row, start, length, total, ids = [], [], [], [], []
                for i, text in enumerate(texts):
                    tokens = encode(text.decode("utf-8", "replace")).astype("<u4").tobytes() + last
                    n, at = len(tokens) // 4, 0
                    for size in lengths(n, longest):
                        row.append(first + i)
                        start.append(at)
                        length.append(size)
                        total.append(n)
                        ids.append(tokens[4 * at:4 * (at + size)])
                        at += size
                yield batch_of(
                    ["doc_id", "start", "length", "doc_tokens", "ids"],
                    [
                        batch.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                        pa.array(total, pa.int64()), pa.array(ids, pa.large_binary()),
                    ],
                )

    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = map_batches(docs, apply, f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, ids binary")
    return pieces.select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), F.col("length").alias("bucket")
    )


def write_buckets(pieces: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder per length, so that a reader of one batch shape opens only that."""
    pieces.write.mode(mode).partitionBy("bucket").parquet(path)
