"""Spelling variants: for every word its neighbours at one edit, the common word it is a form of, and the root of that chain.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with only A-Z lower-cased. Two words are near if one inserted, deleted or replaced
character turns one into the other. A word's form is its near word of largest count (ties: least in code-point order) if that count is
at least ``ratio`` times its own; its root is the end of the chain of forms.

**Method.** The vocabulary is indexed by bits: for each (position, letter) a bitset tells which words of a block have that letter there.
A query runs over its own letters and keeps two sets for 64 words at a time, those that agree so far (``zero``) and those with one error
(``one``); the bitset of position i + shift extends ``one``, where shift is the difference in length. Words with one error share their
first or their last (L - 1) // 2 letters, L being the indexed word's length, so a query meets only the words of those two keys; a pair
that shares both is taken by its first letters. Every word of the vocabulary is indexed and is a query.

**Scale.** Occurrences are counted inside a task before they are shuffled; what follows reads the vocabulary (word and count), kept in the
checkpoint folder. A key of more than ``BLOCK`` words is cut into blocks by a hash of the word, its queries going to each; a task holds one block of
words and a bounded number of queries. Only counts and the best neighbour leave a task, never pairs.

**Cases.** Null and empty texts have no words. A null id counts as the empty string in the rule of ``typo_every``. Repeated rows count again.
An empty table, or one without words, gives an empty result. Columns other than the id and the text are not read. A word may be of any length.
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.arrays import batch_of, chunks, map_batches
from colloquy.session import durable

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
# Texts are read in chunks of about so many bytes; a task's counts are passed on when it has so many words.
CHUNK_BYTES = 1 << 20
HELD_WORDS = 200_000
# Words of one key in a block; rows, and bytes of them, that a task looks at together; pairs of a query and 64 words at a time.
BLOCK = 8192
ROWS_AT_ONCE = 1 << 15
BYTES_AT_ONCE = 4 << 20
LANES = 1 << 18


def _runs(texts: list[bytes], least: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased buffer, and start, end, length in characters and text number of each run of at least ``least`` characters."""
    b = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    upper = (b >= 65) & (b <= 90)
    b = np.where(upper, b + np.uint8(32), b)
    high = np.zeros(len(b), dtype=bool)  # the second byte of U+00C0 .. U+00FF
    high[1:] = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0xBF)
    first = (b >= 97) & (b <= 122)
    first[:-1] |= high[1:]
    inside = np.zeros(len(b) + 2, dtype=bool)
    inside[1:-1] = first | high
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    sums = np.zeros(len(b) + 1, dtype=np.int32)
    np.cumsum(first, out=sums[1:])
    length = sums[end] - sums[start]
    long = length >= least
    start, end, length = start[long], end[long], length[long]
    firsts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    return b.tobytes(), start, end, length, np.searchsorted(firsts, start, side="right") - 1


def word_counts(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, typo_every: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``word, n`` of the words of at least ``min_length`` characters that occur at least ``min_count`` times.

    With ``typo_every``, an occurrence whose crc32 h of ``<id>:<word>`` is a multiple of it loses its character h % length first.
    """

    def apply(batches):
        held: Counter = Counter()
        for batch in batches:
            ids = [(i or "").encode() + b":" for i in batch.column(0).to_pylist()]
            for at, texts in chunks(batch, "text", CHUNK_BYTES):
                data, start, end, length, text = _runs(texts, min_length)
                words = [data[s:e] for s, e in zip(start.tolist(), end.tolist())]
                if typo_every:
                    seeds = [crc32(i) for i in ids[at:at + len(texts)]]
                    hashes = np.fromiter(map(crc32, words, [seeds[t] for t in text.tolist()]), dtype=np.uint32, count=len(words))
                    hit = np.flatnonzero(hashes % np.uint32(typo_every) == 0)
                    for k, h, size in zip(hit.tolist(), hashes[hit].tolist(), length[hit].tolist()):
                        word, gone = words[k].decode(), h % size
                        words[k] = (word[:gone] + word[gone + 1:]).encode() if size > min_length else b""
                held.update(words)
                if len(held) >= HELD_WORDS:
                    yield _counted(held)
                    held = Counter()
        yield _counted(held)

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = map_batches(rows, apply, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _counted(held: Counter) -> pa.RecordBatch:
    held.pop(b"", None)
    return batch_of(["word", "n"], [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())])


def _matrix(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), -1)


def _bitsets(letters: np.ndarray) -> np.ndarray:
    """For each letter (256) the words that have it in a column of the index: 64 words to a number, word j at bit j % 64 of number j // 64."""
    n = len(letters)
    out = np.zeros((256, (n + 63) // 64), dtype=np.uint64)
    at = np.arange(n)
    np.bitwise_or.at(out, (letters, at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
    return out


def _spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers of the bitset that each query's words low .. high - 1 lie in: (query, number, mask of its bits)."""
    first, last = low // 64, (high - 1) // 64
    count = np.where(high > low, last - first + 1, 0)
    query = np.repeat(np.arange(len(low)), count)
    number = np.arange(len(query)) - np.repeat(np.cumsum(count) - count, count) + first[query]
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    from_bit = np.clip(low[query] - number * 64, 0, 63).astype(np.uint64)
    to_bit = np.clip(high[query] - number * 64, 1, 64).astype(np.uint64)
    return query, number, (full << from_bit) & (full >> (np.uint64(64) - to_bit))


def one_error(index: list[bytes], queries: list[bytes], low: np.ndarray, high: np.ndarray, skip_prefix: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, word of the index) that are one edit apart.

    All words of the index have one length, all queries one that differs by at most 1. Query i looks at the words low[i] .. high[i] - 1.
    Words that share the first ``skip_prefix`` letters with the query are left out.
    """
    size, length = len(queries[0]), len(index[0])
    shift = length - size
    words, asked = _matrix(index), _matrix(queries)
    query, number, mask = _spans(low, high)
    found_query, found_word = [], []
    for a in range(0, len(query), LANES):
        q, w = query[a:a + LANES], number[a:a + LANES]
        zero, one = mask[a:a + LANES].copy(), np.zeros(len(q), dtype=np.uint64)
        allowed = zero.copy()
        sets: dict[int, np.ndarray] = {}

        def having(place: int, letter: np.ndarray):
            if not 0 <= place < length:
                return np.uint64(0)
            if place not in sets:
                sets[place] = _bitsets(words[:, place])
            return sets[place][letter, w]

        for i in range(size):
            sets.pop(i - 2, None)
            letter = asked[q, i]
            same = having(i, letter)
            if shift == 0:
                one = (one & same) | (zero & ~same)
            elif shift > 0:  # an extra letter of the word stands before this one
                one = (one | zero) & having(i + 1, letter)
            else:  # this letter is the extra one, or one stood before
                one = (one & having(i - 1, letter)) | zero
            zero = zero & same
            if i + 1 == skip_prefix:
                allowed &= ~zero
        if shift > 0:  # the extra letter is the last
            one = one | zero
        one &= allowed
        some = np.flatnonzero(one)
        lane, bit = np.nonzero(np.unpackbits(one[some].view(np.uint8).reshape(len(some), 8), axis=1, bitorder="little"))
        found_query.append(q[some][lane])
        found_word.append(w[some][lane] * 64 + bit)
    if not found_query:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_query), np.concatenate(found_word)


class _Rows:
    """Rows of one (side, length) in key order; ``take`` looks for the neighbours of all queries among them."""

    def __init__(self, kind: tuple[str, int]):
        self.kind = kind
        self.groups: list[str] = []  # of each row
        self.words: list[bytes] = []
        self.counts: list[int] = []
        self.indexed: list[bool] = []
        self.asks: list[bool] = []  # a word of the index that is kept for further queries asks only once
        self.bytes = 0

    def add(self, group: str, word: bytes, n: int, indexed: bool) -> None:
        self.groups.append(group)
        self.words.append(word)
        self.counts.append(n)
        self.indexed.append(indexed)
        self.asks.append(True)
        self.bytes += len(word)

    def take(self) -> pa.RecordBatch | None:
        side, length = self.kind
        starts: dict[str, list[int]] = {}
        at = [i for i, x in enumerate(self.indexed) if x]
        for place, i in enumerate(at):
            starts.setdefault(self.groups[i], [place, place])[1] = place + 1
        if not at:
            return None
        index, counts = [self.words[i] for i in at], np.array([self.counts[i] for i in at], dtype=np.int64)
        order = np.empty(len(index), dtype=np.int64)
        order[sorted(range(len(index)), key=index.__getitem__)] = np.arange(len(index))
        by_size: dict[int, list[int]] = {}
        for i, group in enumerate(self.groups):
            if self.asks[i] and group in starts:
                by_size.setdefault(len(self.words[i]), []).append(i)
        out: list[list] = [[], [], [], []]
        for rows in by_size.values():
            ends = np.array([starts[self.groups[i]] for i in rows], dtype=np.int64)
            query, word = one_error(index, [self.words[i] for i in rows], ends[:, 0], ends[:, 1], (length - 1) // 2 if side == "s" else 0)
            if not len(query):
                continue
            best = np.lexsort((order[word], -counts[word], query))
            query, word = query[best], word[best]
            first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
            out[0] += [self.words[rows[q]].decode("latin-1") for q in query[first].tolist()]
            out[1] += np.diff(np.r_[first, len(query)]).tolist()
            out[2] += [index[w].decode("latin-1") for w in word[first].tolist()]
            out[3] += counts[word[first]].tolist()
        if not out[0]:
            return None
        return batch_of(["word", "found", "near", "near_n"], [pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int64(), pa.string(), pa.int64()))])

    def keep_last(self) -> None:
        """Forget all but the indexed words of the last group, whose queries may go on."""
        last = self.groups[-1]
        stay = [i for i, g in enumerate(self.groups) if g == last and self.indexed[i]]
        self.groups, self.words = [last] * len(stay), [self.words[i] for i in stay]
        self.counts, self.indexed, self.asks = [self.counts[i] for i in stay], [True] * len(stay), [False] * len(stay)
        self.bytes = 0


def _search(batches):
    rows: _Rows | None = None
    for batch in batches:
        side, length, group, word, n, query = (c.to_pylist() for c in batch.columns)
        for i in range(len(side)):
            full = rows is not None and (len(rows.words) >= ROWS_AT_ONCE or rows.bytes >= BYTES_AT_ONCE)
            if rows is not None and (rows.kind != (side[i], length[i]) or full and (group[i] != rows.groups[-1] or query[i])):
                if (found := rows.take()) is not None:
                    yield found
                if rows.kind == (side[i], length[i]):
                    rows.keep_last()
                else:
                    rows = None
            if rows is None:
                rows = _Rows((side[i], length[i]))
            rows.add(group[i], word[i].encode("latin-1"), n[i], not query[i])
    if rows is not None and (found := rows.take()) is not None:
        yield found


def _keys(vocabulary: DataFrame) -> DataFrame:
    """A row for each key under which a word stands in the index (``query`` 0) or is looked up (1)."""
    size = F.length("word")
    kinds = []
    for step in (0, -1, 1):
        length = size + F.lit(step)
        half = F.floor((length - 1) / 2).cast("int")
        for side in ("p", "s"):
            part = F.substring(F.col("word"), F.lit(1), half) if side == "p" else F.substring(F.col("word"), size - half + 1, half)
            kinds.append(F.struct(F.lit(side).alias("side"), length.alias("length"), part.alias("part"), F.lit(abs(step)).alias("query")))
    keyed = vocabulary.select("word", "n", F.explode(F.array(*kinds)).alias("k")).select("word", "n", "k.*")
    return keyed.withColumn("group", F.concat_ws(":", "side", F.col("length").cast("string"), "part")).drop("part")


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n_near, near, near_n`` for the words of ``vocabulary`` (``word, n``) that have a near word; near is the most frequent one."""
    keyed = _keys(vocabulary)
    crowded = keyed.where("query = 0").groupBy("group").agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > block)
    crowded = crowded.select("group", F.ceil(F.col("words") / block).cast("int").alias("blocks"))
    dealt = keyed.join(crowded, "group", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("at", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select(
        "side", "length", F.concat_ws("#", "group", F.col("at").cast("string")).alias("group"), "word", "n",
        F.when(F.col("at") == F.col("own"), F.col("query")).otherwise(F.lit(1)).alias("query"),
    )
    dealt = dealt.repartition("group").sortWithinPartitions("side", "length", "group", "query")
    found = map_batches(dealt, _search, "word string, found bigint, near string, near_n bigint")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    return found.groupBy("word").agg(F.sum("found").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")
    )


def variants(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``vocabulary`` (``word, n``), which is read several times."""
    near = near_words(vocabulary)
    # one shuffle brings a word and what was found for it together
    both = vocabulary.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("string").alias("near"), F.lit(None).cast("bigint").alias("near_n"))
    both = both.unionByName(near.withColumn("n", F.lit(None).cast("bigint")))
    known = both.groupBy("word").agg(*[F.max(c).alias(c) for c in ("n", "n_near", "near", "near_n")])
    enough = F.col("near_n") >= F.col("n") * ratio
    known = durable(known.select("word", "n", "n_near", F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n")))
    # A form is at least ``ratio`` times as frequent, so chains are short; each round doubles the steps taken.
    hops = known.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = hops.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        longer = durable(longer)
        hops = longer.drop("moved")
        if longer.where("moved").isEmpty():
            break
    roots = known.join(hops, "word", "left")
    return roots.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, typo_every: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """:func:`variants` of the words of the documents; the vocabulary is kept in the checkpoint folder."""
    return variants(durable(word_counts(docs, min_length, min_count, typo_every, id_col, text_col)), ratio)
