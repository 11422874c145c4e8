"""A quality classifier over supervised subword embeddings.

A document is the average of the learned vectors of its words, word pairs and character n-grams; a linear layer and a softmax give the class. Words and
n-grams share ``BUCKETS`` hashed rows, so the model has a fixed size whatever the vocabulary.

**Learning** takes a bounded sample: the ``SAMPLE`` labelled rows with the least hash of their id (fewer if there are fewer). Their texts are turned into
bucket counts by the executors, each a sparse vector of at most ``BUCKETS`` entries, and only those come to the driver, where numpy runs stochastic
gradient descent: one row an id, and in the order of the hashes as many as have ``ENTRIES`` entries together (8 bytes each). Classes are weighted to equal total weight and the scores moved back to the class shares of the sample afterwards.

**Scoring** is one pass over the text without a shuffle. Averaging and the last layer are linear, so they fold into one number per bucket; a text's score is
the logistic function of the average of its buckets' numbers. The folded model (``BUCKETS`` numbers) is broadcast.

**Cases.** Null, empty or blank text has no features: its score is that of a zero vector. Rows without a label, or with one that is not 0 or 1, are
not learned from; of several labels for one id the least counts, and of several texts the one with the least features. Without any labelled row every score is 0.5. Repeated rows score alike; an empty table
gives an empty result. Very long texts are counted whole, in blocks. Only the id and the text are read, the id for nothing but the sample.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.arrays import BASE_BYTES, Words, batch_of, chunks, map_batches, mix, prefix, ranges
from colloquy.session import durable

BUCKETS = 1 << 15
SIZES = (2, 3, 4)
DIMENSIONS = 16
SAMPLE = 4_000
ENTRIES = 24_000_000
EPOCHS, RATE, SEED = 12, 0.5, 7


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word, every pair of neighbours, and every n-gram (in bytes) of a word with a mark at each end.

    A pair is hashed by the difference of its words, so that a word said twice is one feature for all words.
    """
    words = Words(texts)
    n_words = len(words.start)
    inside = np.flatnonzero(words.doc[1:] == words.doc[:-1])
    pairs = words.hash[inside + 1] - words.hash[inside]
    docs, buckets = [words.doc, words.doc[inside]], [mix(words.hash) % np.uint64(BUCKETS), mix(pairs) % np.uint64(BUCKETS)]
    size = words.end - words.start + 2
    end = np.cumsum(size)
    marked = np.full(int(end[-1]) if n_words else 0, 32, dtype=np.uint64)
    inner = np.arange(len(marked)) - np.repeat(end - size, size)
    mid = (inner > 0) & (inner < np.repeat(size, size) - 1)
    marked[mid] = words.buffer[(np.repeat(words.start, size) + inner - 1)[mid]]
    doc = np.repeat(words.doc, size)
    left = np.repeat(size, size) - inner
    sums = prefix(marked + np.uint64(1), BASE_BYTES)
    for n in SIZES:
        at = np.flatnonzero(left >= n)
        docs.append(doc[at])
        buckets.append(mix(ranges(sums, BASE_BYTES, at, at + n) + np.uint64(n)) % np.uint64(BUCKETS))
    return np.concatenate(docs), np.concatenate(buckets).astype(np.int64)


def _blocks(texts: list[bytes], limit: int = 1 << 20):
    """Groups of (text number, part of a text) of about ``limit`` bytes; a longer text is cut at white space."""
    group, size = [], 0
    for i, text in enumerate(texts):
        while len(text) > limit:
            cut = max(text.rfind(space, 0, limit) for space in (b" ", b"\n", b"\t"))
            if cut <= 0:
                break
            yield [(i, text[:cut])]
            text = text[cut:]
        group.append((i, text))
        size += len(text)
        if size > limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def totals(texts: list[bytes], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the sum of its buckets' numbers, and how many there are."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for group in _blocks(texts):
        doc, bucket = features([t for _, t in group])
        rows = np.array([i for i, _ in group])
        np.add.at(total, rows, np.bincount(doc, weights=numbers[bucket], minlength=len(group)))
        np.add.at(count, rows, np.bincount(doc, minlength=len(group)))
    return total, count


def _counted(batches):
    for batch in batches:
        for first, texts in chunks(batch, "text"):
            ids, counts = [], []
            for text in texts:
                sums = np.zeros(BUCKETS, dtype=np.int64)
                for group in _blocks([text]):
                    sums += np.bincount(features([t for _, t in group])[1], minlength=BUCKETS)
                at = np.flatnonzero(sums)
                ids.append(at.astype(np.int32))
                counts.append(sums[at].astype(np.float32))
            yield batch_of(
                ["id", "label", "buckets", "counts"],
                [batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))],
            )


def learn(examples: list[tuple[int, np.ndarray, np.ndarray]], dimensions: int = DIMENSIONS, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, float]:
    """(number per bucket, offset) from (label, buckets, counts) by stochastic gradient descent; zeros without both labels."""
    labels = np.array([e[0] for e in examples], dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        if not len(labels):
            return np.zeros(BUCKETS), 0.0
        return np.zeros(BUCKETS), 4.0 if labels[0] else -4.0
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dimensions, 1 / dimensions, (BUCKETS, dimensions))
    layer = np.zeros((dimensions, 2))
    share = np.bincount(labels, minlength=2) / len(labels)
    weight = 0.5 / share
    steps, step = epochs * len(examples), 0
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            now = rate * (1 - step / steps)
            step += 1
            label, buckets, counts = examples[k]
            if not len(buckets):
                continue
            part = counts / counts.sum()
            mean = part @ vectors[buckets]
            logits = mean @ layer
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[label] -= 1
            error *= now * weight[label]
            back = layer @ error
            layer -= np.outer(mean, error)
            # Each bucket moves by its share; scaled up, as the shares of a long text are tiny.
            vectors[buckets] -= np.outer(np.minimum(part * len(part), 4.0), back)
    return vectors @ (layer[:, 1] - layer[:, 0]), float(np.log(share[1] / share[0]))


def sample_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label: str, sample: int) -> DataFrame:
    """(id, label, text) of the labelled rows with the least hashes of their ids: at most ``sample`` ids, so their table may be broadcast."""
    marked = (
        labels.where(F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.min(label).cast("int").alias("label"))
        .where("_id is not null").orderBy(F.xxhash64("_id"), "_id").limit(sample)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(marked), "_id").select(F.col("_id").alias("id"), "label", "text")


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", sample: int = SAMPLE
) -> tuple[np.ndarray, float]:
    """A model from at most ``sample`` labelled rows of ``labels`` (id, label). Runs a job; the counts of the sample come to the driver."""
    kind = docs.schema[id_col].dataType.simpleString()
    counted = map_batches(
        sample_of(docs, labels, id_col, text_col, label, sample), _counted, f"id {kind}, label int, buckets array<int>, counts array<float>"
    ).groupBy("id").agg(F.min(F.struct("label", "buckets", "counts")).alias("f")).select("id", "f.*")
    # At most ``sample`` rows of three numbers: how many entries there are up to each row.
    upto = F.sum("size").over(Window.orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = durable(counted)
    fitting = counted.select("id", F.size("buckets").cast("bigint").alias("size")).withColumn("upto", upto).where(F.col("upto") <= ENTRIES)
    rows = counted.join(F.broadcast(fitting.select("id")), "id", "left_semi").toArrow()
    buckets, counts = rows.column("buckets").combine_chunks(), rows.column("counts").combine_chunks()
    edges = buckets.offsets.to_numpy()
    flat, weights = buckets.values.to_numpy(), counts.values.to_numpy().astype(np.float64)
    examples = [
        (y, flat[a:b], weights[a:b]) for y, a, b in zip(rows.column("label").to_pylist(), edges[:-1].tolist(), edges[1:].tolist())
    ]
    # The order of the rows depends on the cluster; that of the learning must not.
    examples.sort(key=lambda e: (e[0], len(e[1]), e[1].tobytes(), e[2].tobytes()))
    return learn(examples)


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, score (0 to 1) and predicted (1 from 0.5 on)."""
    numbers = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches):
        weights, offset = numbers.value
        for batch in batches:
            for first, texts in chunks(batch, "text"):
                total, count = totals(texts, weights)
                logit = np.clip(total / np.maximum(count, 1) + offset, -30, 30)
                value = 1 / (1 + np.exp(-logit))
                yield batch_of(["doc_id", "score", "predicted"], [
                    batch.column(0).slice(first, len(texts)), value, pa.array((value >= 0.5).astype(np.int32), pa.int32())
                ])

    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, apply, f"doc_id {kind}, score double, predicted int").withColumnRenamed("doc_id", id_col)


def held_out(id_col: str) -> Column:
    """Rows that are never learned from: the CRC-32 of the id as text leaves 1 when divided by 3. A null id is one of the others."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
