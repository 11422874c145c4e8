"""Removal of passages that stand in an earlier document, by relative Lempel-Ziv parsing.

**Reference blocks.** Every text is cut at content-defined places: of each window of ``window`` words the least hash among its
``gram``-word grams is the window's *anchor*, and a maximal run of windows with one anchor is a *block* (on average about 20
windows). Equal passages are cut alike wherever they stand, so no block has to be compared at other offsets. The reference of a
document is every block of every document with a smaller id, and each distinct block belongs to the smallest id that holds it.

**Parsing.** A document is factored against all of them through the index of blocks: a block that an earlier document holds is
copied whole, and neighbouring copies join to one factor. Where a copy ends, the factor may go on for some words into a block that
differs: blocks that share their anchor with another block are factored word by word, each window looked up among the windows of
those blocks only. A window of ``window`` words that an earlier document holds has the same anchor there, so one of the two ways
finds it; windows across a factor boundary are therefore found as well. Factors of at least ``window`` words are duplicate spans.

**Scale.** Anchors are aggregated before the shuffle; only blocks whose anchor stands in two documents (about a fifth of them) go
on, and only blocks at the ends of shared passages are opened. Every group is reduced to a minimum by partial aggregation and
joined back, so a passage that a third of all documents hold never meets in one task; AQE splits the skewed joins. Texts are
dealt out by ``doc_id`` once, for the words to be removed. Hashes of windows have 128 bits.

**Cases.** Null or empty text: no words, nothing removed. Fewer than ``window`` words: nothing removed. Repeats inside one document
stay. A null id is never earlier or later than another: nothing is removed from it or because of it. Rows with one id and the
same text get the same result each; rows with one id and different texts are judged each for itself, and never because of each
other. An empty table gives an empty result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.arrays import (
    BASES, Words, as_long, batch_of, chunks, map_batches, mix, prefix, ranges, sliding_min,
)
from colloquy.session import durable

WINDOW, GRAM = 50, 16
_SPAN = "struct<start:bigint,windows:bigint,source:bigint,check:bigint>"


def _sums(words: Words) -> list[np.ndarray]:
    return [prefix(words.hash, base) for base in BASES]


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(0)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), column.is_valid().to_numpy(zero_copy_only=False)


def _blocks(words: Words, sums: list[np.ndarray], window: int, gram: int):
    """Anchor, first word and end (exclusive, in windows) of every block."""
    n = len(words.hash)
    if n < window:
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(np.uint64), empty, empty
    at = np.arange(n - gram + 1)
    least = sliding_min(mix(ranges(sums[0], BASES[0], at, at + gram)), window - gram + 1)
    first, last = words.doc[: n - window + 1], words.doc[window - 1:]
    inside = first == last
    cut = np.ones(len(least) + 1, dtype=bool)
    cut[1:-1] = (least[1:] != least[:-1]) | (first[1:] != first[:-1]) | (inside[1:] != inside[:-1])
    edges = np.flatnonzero(cut)
    start, end = edges[:-1], edges[1:]
    kept = inside[start]
    return least[start[kept]], start[kept], end[kept]


def anchors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The blocks of each document: (anchor, digest in two halves, doc_id, start, windows)."""

    def cut(batches):
        for batch in batches:
            ids, valid = _ids(batch)
            for first, texts in chunks(batch, "text"):
                words = Words(texts)
                sums = _sums(words)
                anchor, start, end = _blocks(words, sums, window, gram)
                row = first + words.doc[start] if len(start) else start
                kept = valid[row]
                anchor, start, end, row = anchor[kept], start[kept], end[kept], row[kept]
                one, two = (as_long(ranges(s, b, start, end + window - 1)) for s, b in zip(sums, BASES))
                yield batch_of(
                    ["anchor", "one", "two", "doc_id", "start", "windows"],
                    [as_long(anchor), one, two, ids[row], start - words.first_word[row - first], end - start],
                )

    return map_batches(
        docs, cut, "anchor bigint, one bigint, two bigint, doc_id bigint, start bigint, windows bigint"
    )


def _opened(docs: DataFrame, window: int) -> DataFrame:
    """The windows of the blocks listed in ``open``: (one, two, doc_id, start)."""

    def open_up(batches):
        for batch in batches:
            ids, _ = _ids(batch)
            lists = batch.column(batch.schema.get_field_index("open"))
            for first, texts in chunks(batch, "text"):
                words = Words(texts)
                sums = _sums(words)
                starts, rows = [], []
                for i in range(len(texts)):
                    base, n = words.first_word[i], words.n_words[i]
                    spans = {(s["start"], s["windows"], s["check"]) for s in lists[first + i].as_py()}
                    for start, windows, check in spans:
                        a, b = base + start, base + start + windows + window - 1
                        if start + windows + window - 1 <= n and as_long(ranges(sums[0], BASES[0], np.array([a]), np.array([b])))[0] == check:
                            starts.append(np.arange(a, a + windows))
                            rows.append(np.full(windows, i))
                if starts:
                    at, row = np.concatenate(starts), np.concatenate(rows)
                    one, two = (as_long(ranges(s, b, at, at + window)) for s, b in zip(sums, BASES))
                    yield batch_of(["one", "two", "doc_id", "start"], [one, two, ids[first + row], at - words.first_word[row]])

    return map_batches(docs, open_up, "one bigint, two bigint, doc_id bigint, start bigint")


def _parse(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Factors from window hits (first window, windows, source), greedily: a factor goes on while the next hit touches it."""
    factors: list[list[int]] = []
    for start, windows, source in sorted(spans):
        if factors and start <= factors[-1][1] and source == factors[-1][2]:
            factors[-1][1] = max(factors[-1][1], start + windows)
        else:
            factors.append([start, start + windows, source])
    return [(a, b, s) for a, b, s in factors]


def _removed(window: int):
    def apply(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("spans"))
            out = {k: [] for k in ("n_words", "n_removed", "factors", "kept_text")}
            for first, texts in chunks(batch, "text"):
                words = Words(texts)
                sums = _sums(words)
                for i in range(len(texts)):
                    base, n = int(words.first_word[i]), int(words.n_words[i])
                    found = []
                    for s in lists[first + i].as_py() or []:
                        a, b = base + s["start"], base + s["start"] + s["windows"] + window - 1
                        if b <= base + n and as_long(ranges(sums[0], BASES[0], np.array([a]), np.array([b])))[0] == s["check"]:
                            found.append((s["start"], s["windows"], s["source"]))
                    factors = [(a, b + window - 1, s) for a, b, s in _parse(found)]
                    gone = np.zeros(n, dtype=bool)
                    for a, b, _ in factors:
                        gone[a:b] = True
                    at = np.flatnonzero(~gone) + base
                    text = memoryview(words.buffer)
                    out["n_words"].append(n)
                    out["n_removed"].append(n - len(at))
                    out["factors"].append([{"start": a, "length": b - a, "source": s} for a, b, s in factors])
                    out["kept_text"].append(
                        b" ".join(text[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist())).decode("utf-8", "replace")
                    )
            kinds = [
                pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("source", pa.int64())])),
                pa.large_string(),
            ]
            yield batch_of(["doc_id", *out], [batch.column(0), *(pa.array(v, t) for v, t in zip(out.values(), kinds))])

    return apply


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, factors (start, length, source: the earlier document), kept_text.

    ``gram`` must be at most ``window``. Runs one job when called, for the table of shared blocks (a checkpoint).
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = anchors(docs, window, gram)
    # The key of the join is not the key of the aggregate, so both sides are exchanges that AQE can split.
    shared = (
        cut.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
        .select(F.xxhash64("anchor").alias("place"))
    )
    blocks = durable(
        cut.withColumn("place", F.xxhash64("anchor")).join(shared, "place", "left_semi").drop("place")
    )
    first = blocks.groupBy("anchor", "one", "two").agg(F.min("doc_id").alias("source"))
    held = blocks.withColumn("place", F.xxhash64("one", "two")).join(
        first.select(F.xxhash64("one", "two").alias("place"), F.col("anchor").alias("a"), F.col("one").alias("o"), F.col("two").alias("t"), "source"),
        "place",
    ).where("anchor = a and one = o and two = t")
    copies = held.where("source < doc_id").select(
        "doc_id", F.expr("named_struct('start', start, 'windows', windows, 'source', source, 'check', one)").cast(_SPAN).alias("span")
    )
    kinds = (
        first.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select(F.xxhash64("anchor").alias("place"))
    )
    to_open = (
        held.where("source = doc_id").withColumn("place", F.xxhash64("anchor")).join(kinds, "place", "left_semi")
        .groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows", F.col("one").alias("check"))).alias("open"))
    )
    opened = _opened(docs.join(to_open, "doc_id").select("doc_id", "text", "open"), window)
    least = opened.groupBy("one", "two").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last")).where("source < last")
    hits = (
        opened.withColumn("place", F.xxhash64("one", "two"))
        .join(least.select(F.xxhash64("one", "two").alias("place"), F.col("one").alias("o"), F.col("two").alias("t"), "source"), "place")
        .where("one = o and two = t and source < doc_id")
        .select("doc_id", F.expr("named_struct('start', start, 'windows', 1L, 'source', source, 'check', one)").cast(_SPAN).alias("span"))
    )
    spans = copies.unionByName(hits).groupBy("doc_id").agg(F.collect_list("span").alias("spans"))
    ready = docs.join(spans, "doc_id", "left").select("doc_id", "text", "spans")
    return map_batches(
        ready, _removed(window),
        "doc_id bigint, n_words bigint, n_removed bigint, "
        "factors array<struct<start:bigint,length:bigint,source:bigint>>, kept_text string",
    )
