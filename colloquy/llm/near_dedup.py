"""Near-duplicate detection by min-max hashing, with every link confirmed on full shingle sets.

**Signatures.** Each permutation gives two values, the least and the greatest hash of a set, so a signature of 2m values costs m hash evaluations per
shingle. Bands of ``ROWS`` values are hashed to keys; their number follows from the similarity so that a pair at the limit shares no band with a
probability of at most ``MISS``. Equal sets are one class from the start; only a class's document with the least id goes on.

**Links.** Classes that share a band key are candidates, but pairs within a key are not listed. Each key's class with the least id is its *centre*, and
every other class is compared with it. Nearly all links of a group are found so: the number of comparisons is at most the number of band keys. Components are
then formed, and what is left are classes that no link joins to their centre's component. Each of them is compared with the other members of the centre's keys,
block by block: members are dealt out in blocks of about ``BLOCK_SHINGLES`` shingles and at most about ``BLOCK_ROWS`` rows, and only these classes are repeated for each block. Within a block the triangle inequality of the Jaccard distance
(distances to the centre are known) and the component rule out most pairs before sets are intersected. No candidate pair is left undecided.

**Scale.** Signatures are made in one pass over the text and kept, narrow, in a checkpoint. Texts are shuffled only for the classes that have a candidate. The
members of a centre are dealt out to ``ceil(members / GROUP)`` salted groups with the centre's text in each, read as a stream, so a group of copies that
holds a third of all rows is neither one task nor one list. Components come from repeated large-star and small-star steps (joins and minima), with a checkpoint each.

**Cases.** A document with fewer than ``k`` words has one shingle, all its words. Null, empty or blank text has no shingle, is linked with nothing and
stays. Rows without an id are linked with nothing. With one id on different texts, each text is judged by its own: links join classes of texts, not ids. Of a component
one row stays, the least by id, then by the digest of its text; of rows that repeat both, one. An empty table gives an empty result. Columns other than the id and the text are not read by :func:`components`; :func:`drop_near_copies` keeps them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.arrays import BASES, Words, as_long, batch_of, chunks, map_batches, mix, prefix, ranges
from colloquy.llm.idmap import mark_ids
from colloquy.session import durable

SHINGLE, PERCENT = 5, 80
ROWS, MISS = 6, 2e-5
GROUP = 256
BLOCK_SHINGLES, BLOCK_ROWS = 300_000, 256
SEED = 20


def band_chance(percent: int, rows: int = ROWS) -> float:
    """The least chance that two different sets of at least this similarity agree in a band.

    The least and the greatest value of a permutation are drawn without putting back: for a union of n shingles and an intersection of m both agree
    with m(m - 1) / (n(n - 1)), which is lowest at small n and nears (m / n)**2 from below; beyond n = 1000 it is above that of the same share at n = 100.
    """
    pairs = [(n, -(-percent * n // 100)) for n in range(2, 1001)]
    both = min(m * (m - 1) / (n * (n - 1)) for n, m in pairs if m < n)
    return both ** math.ceil(rows / 2)


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands so that two sets of this similarity share none with a probability of at most ``miss``; even, for whole permutations."""
    chance = band_chance(percent, rows)
    if chance == 0:
        raise ValueError("percent must be over 50: one common shingle of two is never both the least and the greatest")
    n = math.ceil(math.log(miss) / math.log(1 - chance))
    return n + n % 2


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, edges): the sorted distinct shingle hashes of text i are ``hashes[edges[i]:edges[i + 1]]``."""
    words = Words(texts, lower=True)
    sums = prefix(words.hash, BASES[0])
    size = np.minimum(words.n_words, k)
    n_each = np.where(words.n_words > 0, words.n_words - size + 1, 0)
    doc = np.repeat(np.arange(len(texts)), n_each)
    start = np.arange(n_each.sum()) - np.repeat(np.cumsum(n_each) - n_each, n_each) + words.first_word[:-1][doc]
    found = mix(ranges(sums, BASES[0], start, start + size[doc]) + size[doc].astype(np.uint64))
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    doc, found = doc[new], found[new]
    return found, np.searchsorted(doc, np.arange(len(texts) + 1))


def signatures(hashes: np.ndarray, edges: np.ndarray, n_permutations: int, seed: int = SEED) -> np.ndarray:
    """Least and greatest value under each permutation, for the sets that are not empty: (sets, 2 * n_permutations)."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(1, 1 << 63, n_permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    masks = rng.integers(1, 1 << 63, n_permutations, dtype=np.uint64)
    full = np.flatnonzero(edges[1:] > edges[:-1])
    out = np.empty((len(full), 2 * n_permutations), dtype=np.uint64)
    if len(full):
        starts = edges[:-1][full]
        for p in range(n_permutations):
            values = hashes ^ masks[p]
            values *= factors[p]
            values ^= values >> np.uint64(32)
            values *= factors[p]
            out[:, 2 * p] = np.minimum.reduceat(values, starts)
            out[:, 2 * p + 1] = np.maximum.reduceat(values, starts)
    return out


def _signed(k: int, bands: int, rows: int):
    def apply(batches):
        for batch in batches:
            for first, texts in chunks(batch, "text"):
                hashes, edges = shingle_sets(texts, k)
                n = np.diff(edges)
                full = np.flatnonzero(n)
                values = signatures(hashes, edges, bands * rows // 2)
                keys = np.empty((len(full), bands), dtype=np.uint64)
                for b in range(bands):
                    key = np.full(len(full), b + 1, dtype=np.uint64)
                    for r in range(rows):
                        key = mix(key ^ values[:, b * rows + r])
                    keys[:, b] = key
                sums = [prefix(hashes, base) for base in BASES]
                digest = [mix(ranges(s, base, edges[:-1], edges[1:])) for s, base in zip(sums, BASES)]
                offsets = np.zeros(len(texts) + 1, dtype=np.int32)
                offsets[1:] = np.cumsum(np.where(n > 0, bands, 0))
                yield batch_of(
                    ["doc_id", "digest", "n_shingles", "one", "two", "bands"],
                    [
                        batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)), n.astype(np.int64), as_long(digest[0]), as_long(digest[1]),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(as_long(keys.ravel()))),
                    ],
                )

    return apply


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def _compared(k: int):
    """Rows of one (centre, group) follow each other, the centre's text first: its overlap with every other."""

    def apply(batches):
        current, centre_set = None, None
        for batch in batches:
            centres, groups, nodes = (batch.column(i).to_pylist() for i in range(3))
            out: list[tuple] = []
            for first, texts in chunks(batch, "text"):
                hashes, edges = shingle_sets(texts, k)
                for i in range(len(texts)):
                    row = first + i
                    own = hashes[edges[i]:edges[i + 1]]
                    if (centres[row], groups[row]) != current:
                        current, centre_set = (centres[row], groups[row]), own.copy()
                        if nodes[row] != centres[row]:
                            raise ValueError("a group must begin with its centre")
                        continue
                    both = overlap(own, centre_set)
                    out.append((centres[row], nodes[row], both, len(own) + len(centre_set) - both))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[c] for o in out], pa.int64()) for c in range(4)], names=["centre", "node", "both", "any"]
            )

    return apply


def _leftovers(k: int, percent: int):
    """Rows of one (centre, block pair) follow each other: links between its asking rows and the others.

    Each such group holds at most two blocks. ``distance`` is the Jaccard distance to the centre.
    """
    reach = 1 - percent / 100

    def links(rows: list[tuple], hashes: list[np.ndarray]) -> list[tuple]:
        ids = np.array([r[0] for r in rows])
        component = np.array([r[1] for r in rows])
        distance = np.array([r[2] for r in rows])
        asks = np.array([r[3] for r in rows])
        size = np.array(list(map(len, hashes)))
        # Numbers for the shingles of the group, and the rows that hold each.
        flat = np.concatenate(hashes)
        holder = np.repeat(np.arange(len(rows)), size)
        _, number = np.unique(flat, return_inverse=True)
        order = np.argsort(number, kind="stable")
        holder, edges = holder[order], np.searchsorted(number[order], np.arange(number.max() + 2))
        at = np.concatenate([[0], np.cumsum(size)])
        out = []
        for i in np.flatnonzero(asks):
            may = ~asks & (component != component[i]) & (np.abs(distance - distance[i]) <= reach + 1e-9)
            may &= (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
            if not may.any():
                continue
            own = number[at[i]:at[i + 1]]
            both = np.zeros(len(rows), dtype=np.int64)
            for e in own:
                both[holder[edges[e]:edges[e + 1]]] += 1
            linked = may & (100 * both >= percent * (size + size[i] - both))
            out += [(int(ids[i]), int(ids[j])) for j in np.flatnonzero(linked)]
        return out

    def apply(batches):
        current, rows, sets = None, [], []
        for batch in batches:
            names = {n: batch.column(batch.schema.get_field_index(n)).to_pylist() for n in batch.schema.names if n != "text"}
            out: list[tuple] = []
            for first, texts in chunks(batch, "text"):
                hashes, edges = shingle_sets(texts, k)
                for i in range(len(texts)):
                    row = first + i
                    key = (names["centre"][row], names["ask_block"][row], names["block"][row])
                    if key != current:
                        if rows:
                            out += links(rows, sets)
                        current, rows, sets = key, [], []
                    rows.append((names["node"][row], names["component"][row], names["distance"][row], names["asks"][row]))
                    sets.append(hashes[edges[i]:edges[i + 1]].copy())
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(2)], names=["a", "b"])
        if rows:
            out = links(rows, sets)
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(2)], names=["a", "b"])

    return apply


def connected(links: DataFrame) -> DataFrame:
    """(node, component: the least node it reaches) for every node of ``links`` (a, b) but those least ones."""

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = durable(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    before, now = None, state(edges)
    while now != before:
        # Large star: a node's higher neighbours are tied to its least neighbour, or to itself.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.xxhash64("a").alias("k"), F.least("low", "a").alias("low"), F.col("a").alias("n"))
        large = (
            both.where("b > a").withColumn("k", F.xxhash64("a")).join(least, "k").where("a = n")
            .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        )
        # Small star: a node and its lower neighbours are tied to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        ties = F.array(F.struct(F.col("a").alias("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))
        edges = durable(large.join(low, "a").select(F.explode(ties).alias("e")).select("e.a", "e.b").where("a != b").distinct())
        before, now = now, state(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _with_text(docs: DataFrame, rows: DataFrame, nodes: DataFrame, classes: DataFrame, repeats: bool) -> DataFrame:
    """``rows`` with the text of their node. Texts that cannot be among ``nodes`` are spared the shuffle; ``repeats``: rows may repeat an id and its text."""
    named = classes.select(F.col("node").alias("_node"), "doc_id", "digest").join(nodes.select(F.col("node").alias("_node")).distinct(), "_node", "left_semi")
    texts = mark_ids(docs, named).where("may_be").select("doc_id", "digest", "text")
    texts = texts.dropDuplicates(["doc_id", "digest"]) if repeats else texts
    return rows.join(named, F.col("node") == F.col("_node")).drop("_node").join(texts, ["doc_id", "digest"]).drop("doc_id", "digest")


def _compare(docs: DataFrame, candidates: DataFrame, classes: DataFrame, repeats: bool, k: int) -> DataFrame:
    """(centre, node, both, any) of each candidate pair (centre, node)."""
    sizes = candidates.groupBy("centre").agg(F.ceil(F.count("*") / GROUP).cast("bigint").alias("groups"))
    sizes = sizes.select(F.xxhash64("centre").alias("place"), "groups")
    dealt = (
        candidates.withColumn("place", F.xxhash64("centre")).join(sizes, "place")
        .select("centre", F.expr("pmod(xxhash64(node, 1), groups)").alias("group"), "node")
    )
    rows = dealt.select("*", F.lit(1).alias("role")).unionByName(
        dealt.select("centre", "group").distinct().select("*", F.col("centre").alias("node"), F.lit(0).alias("role"))
    )
    nodes = candidates.select("node").unionByName(candidates.select(F.col("centre").alias("node")))
    with_text = _with_text(docs, rows, nodes, classes, repeats).select("centre", "group", "node", "role", "text")
    sorted_rows = with_text.repartition("centre", "group").sortWithinPartitions("centre", "group", "role", "node")
    return map_batches(sorted_rows, _compared(k), "centre bigint, node bigint, both bigint, any bigint").where("centre != node")


def _leftover_links(docs: DataFrame, compared: DataFrame, found: DataFrame, classes: DataFrame, repeats: bool, k: int, percent: int) -> DataFrame:
    """Links between members of one centre that the links to centres (components ``found``) leave apart."""
    def component(df: DataFrame, col: str) -> DataFrame:
        named = found.select(F.col("node").alias(col), F.col("component").alias(f"{col}_component"))
        return df.join(named, col, "left").withColumn(f"{col}_component", F.coalesce(f"{col}_component", col))

    members = component(component(compared, "centre"), "node").join(classes.select("node", "n_shingles"), "node").select(
        "centre", "node", F.col("node_component").alias("component"), (1 - F.col("both") / F.col("any")).alias("distance"),
        (F.col("node_component") != F.col("centre_component")).alias("asks"), "n_shingles",
    )
    members = durable(members)
    def parts(rows: Column) -> Column:
        shingles = F.ceil(F.sum(F.when(rows, F.col("n_shingles"))) / BLOCK_SHINGLES)
        return F.greatest(shingles, F.ceil(F.count_if(rows) / BLOCK_ROWS)).cast("bigint")

    blocks = members.groupBy("centre").agg(
        parts(F.col("asks")).alias("ask_blocks"), parts(F.lit(True)).alias("blocks"), F.count("*").alias("n"),
    ).where("n > 1 and ask_blocks > 0").select(F.xxhash64("centre").alias("place"), "ask_blocks", "blocks")
    dealt = members.withColumn("place", F.xxhash64("centre")).join(blocks, "place")
    # The asking rows of a block meet every block of members, and each member every block of asking rows.
    asking = dealt.where("asks").withColumn("ask_block", F.expr("pmod(xxhash64(node, 2), ask_blocks)")).withColumn(
        "block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    asked = dealt.withColumn("asks", F.lit(False)).withColumn("block", F.expr("pmod(xxhash64(node, 3), blocks)")).withColumn(
        "ask_block", F.explode(F.expr("sequence(0L, ask_blocks - 1)")))
    names = ["centre", "ask_block", "block", "node", "component", "distance", "asks"]
    rows = asking.select(*names).unionByName(asked.select(*names))
    with_text = _with_text(docs, rows, dealt.select("node"), classes, repeats).select(*names, "text")
    sorted_rows = with_text.repartition("centre", "ask_block", "block").sortWithinPartitions("centre", "ask_block", "block", "node")
    return map_batches(sorted_rows, _leftovers(k, percent), "a bigint, b bigint").distinct()


def _digest(text: str) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(F.col(text).cast("string").cast("binary")))


def _decided(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, rows: int) -> tuple[DataFrame, bool]:
    """Per row: doc_id, digest, n_shingles, component_id, first (it is the row of its component that stays); and whether rows repeat an id and its text."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), _digest(text_col).alias("digest"), F.col(text_col).cast("string").alias("text"))
    bands = bands_for(percent, rows)
    signed = durable(map_batches(
        docs, _signed(k, bands, rows), "doc_id bigint, digest binary, n_shingles bigint, one bigint, two bigint, bands array<bigint>"
    ).withColumn("row", F.monotonically_increasing_id()))
    judged = signed.where("n_shingles > 0 and doc_id is not null")
    repeats = not judged.groupBy("doc_id", "digest").count().where("count > 1").isEmpty()
    # A class's node is a number of its own: an id may stand in several classes.
    classes = durable(judged.groupBy("one", "two").agg(
        F.min(F.struct("doc_id", "digest", "row")).alias("first"), F.any_value("bands").alias("bands"), F.max("n_shingles").alias("n_shingles")
    ).select("one", "two", "first", "first.doc_id", "first.digest", "bands", "n_shingles", F.monotonically_increasing_id().alias("node")))
    keyed = classes.select("first", "node", F.explode("bands").alias("key"))
    centres = keyed.groupBy("key").agg(F.min(F.struct("first.doc_id", "first.digest", "node"))["node"].alias("centre"), F.count("*").alias("n")).where("n > 1")
    candidates = durable(
        keyed.withColumn("place", F.xxhash64("key")).join(centres.select(F.xxhash64("key").alias("place"), "centre"), "place")
        .where("centre != node").select("centre", "node").distinct()
    )
    compared = durable(_compare(docs, candidates, classes, repeats, k))
    linked = compared.where(100 * F.col("both") >= percent * F.col("any")).select(F.col("centre").alias("a"), F.col("node").alias("b"))
    found = connected(linked)
    more = durable(_leftover_links(docs, compared, found, classes, repeats, k, percent))
    found = connected(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    of_class = classes.select("one", "two", "first", "node").join(found.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(
        "one", "two", "first", F.coalesce("component", "node").alias("component"),
    )
    least = of_class.groupBy("component").agg(F.min("first").alias("least")).withColumnRenamed("component", "_component")
    named = of_class.join(least, F.col("component") == F.col("_component")).select(
        F.xxhash64("one", "two").alias("place"), F.col("one").alias("_one"), F.col("two").alias("_two"), "least",
    )
    out = judged.withColumn("place", F.xxhash64("one", "two")).join(named, "place").where("one = _one and two = _two")
    return out.select(
        "doc_id", "digest", "n_shingles", F.col("least.doc_id").alias("component_id"), (F.col("row") == F.col("least.row")).alias("first"),
    ).unionByName(signed.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "digest", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))), repeats


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least id that links reach, its own included), kept (doc_id is component_id, or null).

    Rows that repeat the least id of a component are all marked kept; :func:`drop_near_copies` keeps one of them.

    Texts with a Jaccard similarity of at least ``percent`` / 100 over ``k``-word shingles are linked. Runs jobs when called.
    """
    decided = _decided(docs, id_col, text_col, k, percent, rows)[0]
    return decided.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the row with the least id and text digest, and every row without an id."""
    decided, repeats = _decided(docs, id_col, text_col, k, percent, ROWS)
    place = [F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")]
    kept = decided.where("first and n_shingles > 0 and doc_id is not null").select(*place)
    gone = decided.where("not first").select(*place).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("id"), _digest(text_col).alias("digest"))
    same = (F.col("id") == F.col("gone_id")) & (F.col("digest") == F.col("gone_digest"))
    stay = rows.join(gone, same, "left_anti")
    if repeats:  # Rows that repeat an id and its text: all but one are gone.
        twice = gone.join(kept, ["gone_id", "gone_digest"], "left_semi")
        stay = stay.unionByName(rows.join(twice, same, "left_semi").dropDuplicates(["id", "digest"]))
    return stay.select("row.*")
