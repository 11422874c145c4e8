"""Prefix trie of conversations, with totals of every subtree by centroid decomposition.

Conversations that begin with the same turns share the nodes of those turns. A node is named by its least member and its depth, which is unique:
the conversations of a node are those of its children and those that end there, so the least member of a node owns what follows on its own path.

**Method.** The totals of subtrees come from a decomposition of the parent edges. A component's centroid is the deepest node whose subtree holds
more than half of its weight; taking it away leaves its children's subtrees and the part above, each at most half as heavy. The total of the
centroid's subtree within the component is added to the centroid and to every node on its path up to the component's top. Every pair of an
ancestor and a descendant is parted, or met by a centroid, exactly once, so the sums are whole after a logarithmic number of rounds however deep or wide
the trie is. Components of more than ``LIMIT`` nodes are split by Spark joins (weights are the turns of all members below a node, which the grouping
that finds the nodes yields as well); smaller ones are shuffled whole to a task, which splits many at once with numpy.

**Scale.** Texts become digests in the scan. Turns are put in order by a range partitioning on (conversation, turn, digest), so a conversation may
hold any share of the rows: its position is the place in the partition plus the rows of earlier partitions. A prefix is identified by its depth and
four sums of 32-bit hashes of (digest, position), running sums within spans of ``SPAN`` turns plus the totals of earlier spans; two prefixes of
one depth are taken for equal by chance with a probability of about 2**-128. Members that end at one node are joined in runs of ids and hashed as a stream.
Narrow tables (turns, paths, nodes, and the components of each round) are kept in the checkpoint folder.

**Cases.** Turns go in order of ``turn``, null first; equal turns by a digest of role and text; repeated rows count as turns each. A null role or text counts
as empty. Rows without a conversation id belong to no conversation. An empty table has no nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.arrays import batch_of, map_batches
from colloquy.session import durable

SPAN = 1024
LIMIT = 1024
# Nodes a task splits together, whole components only.
AT_ONCE = 1 << 16
# Conversation ids that agree but for their last RUN_BITS bits are joined to one text; a node's texts are hashed in order.
RUN_BITS = 9
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def numbered_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv, position`` (from 0), ``n_turns, digest, n_words`` of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"),
        F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_words"),
    )
    # The range partitioning reads its input twice; the narrow table is read instead of the texts.
    rows = durable(rows).withColumn("tie", F.monotonically_increasing_id())
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("digest"), F.col("tie")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "digest", "n_words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")
    )
    placed = durable(placed)
    parts = placed.groupBy("conv", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "conv", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy("conv")).alias("n_turns"),
    )
    return placed.join(parts, ["conv", "part"]).select("conv", (F.col("place") + F.col("shift")).alias("position"), "n_turns", "digest", "n_words")


def paths(turns: DataFrame, family: int | None = None, most: int = 4) -> DataFrame:
    """``conv, depth, length, digest, n_words`` for depths 0 (no turn) to length, from :func:`numbered_turns`.

    With ``family``, a conversation c takes the first h turns of conversation ``c - c % family`` (all if there are fewer, none if it is absent) in place of
    its own first h, where h is ``crc32(c) % most``.
    """
    first = turns.where("position = 0")
    if family is None:
        root = first.select("conv", F.lit(0).cast("bigint").alias("depth"), F.col("n_turns").alias("length"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("n_words"))
        return root.unionByName(turns.select("conv", (F.col("position") + 1).alias("depth"), F.col("n_turns").alias("length"), "digest", "n_words"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = first.select("conv", "n_turns", h.alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    opening = turns.where((F.col("conv") % family == 0) & (F.col("position") < most - 1))
    opening = opening.select(F.col("conv").alias("base"), "position", "digest", "n_words", F.col("n_turns").alias("base_turns"))
    sizes = opening.where("position = 0").select("base", "base_turns")
    convs = convs.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_turns", F.lit(0))))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).drop("base_turns")
    root = convs.select("conv", F.lit(0).cast("bigint").alias("depth"), "length", F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("n_words"))
    taken = convs.join(opening, "base").where(F.col("position") < F.col("h"))
    taken = taken.select("conv", (F.col("position") + 1).alias("depth"), "length", "digest", "n_words")
    own = turns.drop("n_turns").join(convs, "conv").where(F.col("position") >= F.col("h"))
    own = own.select("conv", (F.col("position") - F.col("h") + F.col("taken") + 1).alias("depth"), "length", "digest", "n_words")
    return root.unionByName(taken).unionByName(own)


def _prefixes(path: DataFrame) -> DataFrame:
    """``conv, depth, length, n_words, prefix, before``: the key of the first depth turns, and of one fewer."""
    wide = [F.xxhash64(F.lit(seed), "digest", "depth") for seed in (1, 2)]
    low, high = (lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))), (lambda x: F.shiftrightunsigned(x, 32))
    turns = path.where("depth > 0").withColumn("span", F.floor((F.col("depth") - 1) / SPAN))
    hashes = {"h1": low(wide[0]), "h2": high(wide[0]), "h3": low(wide[1]), "h4": high(wide[1])}
    turns = turns.withColumns(hashes)
    long = turns.where(F.col("length") > SPAN).groupBy("conv", "span").agg(*[F.sum(h).alias(h) for h in hashes])
    earlier = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    long = long.select("conv", "span", *[F.coalesce(F.sum(h).over(earlier), F.lit(0)).alias(f"{h}_before") for h in hashes])
    inside = Window.partitionBy("conv", "span").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = turns.withColumns({f"{h}_sum": F.sum(h).over(inside) for h in hashes}).join(long, ["conv", "span"], "left")
    sums = sums.withColumns({f"{h}_sum": F.col(f"{h}_sum") + F.coalesce(f"{h}_before", F.lit(0)) for h in hashes})

    def key(depth: Column, values: list[Column]) -> Column:
        return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[v.cast("string") for v in values]).cast("binary")))

    nothing = [F.lit(0)] * len(hashes)
    root = path.where("depth = 0").select(
        "conv", "depth", "length", "n_words", key(F.lit(0), nothing).alias("prefix"), F.lit(None).cast("binary").alias("before")
    )
    return root.unionByName(sums.select(
        "conv", "depth", "length", "n_words", key(F.col("depth"), [F.col(f"{h}_sum") for h in hashes]).alias("prefix"),
        key(F.col("depth") - 1, [F.col(f"{h}_sum") - F.col(h) for h in hashes]).alias("before"),
    ))


def _split_here(parent: np.ndarray, depth: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Totals of all subtrees of a forest by centroid decomposition; nodes in order of depth, ``parent`` -1 at a top."""
    parent, sums = parent.copy(), np.zeros_like(values)
    alive, top = np.arange(len(parent)), np.zeros(len(parent), dtype=np.int64)
    size, below = np.zeros(len(parent), dtype=np.int64), np.zeros_like(values)
    gone = np.zeros(len(parent), dtype=bool)
    while len(alive):
        levels = np.split(alive, np.flatnonzero(np.diff(depth[alive])) + 1)
        size[alive], below[alive] = 1, values[alive]
        for level in reversed(levels):
            up = level[parent[level] >= 0]
            np.add.at(size, parent[up], size[up])
            np.add.at(below, parent[up], below[up])
        for level in levels:
            up = parent[level]
            top[level] = np.where(up >= 0, top[up], level)
        heavy = alive[size[alive] * 2 > size[top[alive]]]
        deepest = np.full(len(parent), -1, dtype=np.int64)
        np.maximum.at(deepest, top[heavy], heavy)
        centroid = deepest[deepest >= 0]
        at, total = centroid, below[centroid]
        while len(at):  # one path a component, so no node comes twice
            sums[at] += total
            on = parent[at] >= 0
            at, total = parent[at[on]], total[on]
        gone[centroid] = True
        alive = alive[~gone[alive]]
        cut = alive[(parent[alive] >= 0) & gone[parent[alive]]]
        parent[cut] = -1
    return sums


def _split_batches(batches):
    """Rows (top_owner, top_depth, owner, depth, parent, values ...), the rows of a component together and in order of depth."""
    held: list[np.ndarray] = []
    rows = 0

    def done(block: np.ndarray) -> pa.RecordBatch:
        block = block[np.argsort(block[:, 3], kind="stable")]
        at = {key: i for i, key in enumerate(map(tuple, block[:, 2:4].tolist()))}
        up = np.array([at.get((p, d - 1), -1) for p, d in block[:, [4, 3]].tolist()], dtype=np.int64)
        same = (block[up, 0] == block[:, 0]) & (block[up, 1] == block[:, 1])
        sums = _split_here(np.where((up >= 0) & same, up, -1), block[:, 3], block[:, 5:])
        return batch_of(["owner", "depth", "n_leaves", "saved"], [block[:, 2], block[:, 3], sums[:, 0], sums[:, 1]])

    for batch in batches:
        held.append(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.int64).reshape(batch.num_rows, -1))
        rows += batch.num_rows
        if rows < AT_ONCE:
            continue
        block = np.concatenate(held)
        # the last component may go on in the next batch
        last = np.flatnonzero((block[1:, 0] != block[:-1, 0]) | (block[1:, 1] != block[:-1, 1]))
        if len(last):
            yield done(block[:last[-1] + 1])
            block = block[last[-1] + 1:]
        held, rows = [block], len(block)
    if rows:
        yield done(np.concatenate(held))


COMPONENT = ["top_owner", "top_depth"]
SUMS = ["n_leaves", "saved"]


def subtree_sums(nodes: DataFrame, walk: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``owner, depth, n_leaves, saved``: parts whose sums over (owner, depth) are the totals of each node's subtree.

    ``nodes`` has ``owner, depth, parent`` (owner of the parent), ``weight`` (of the subtree) and the values ``n_leaves, saved``; ``walk`` tells for
    each ``conv`` and ``depth`` the ``at`` (owner) of its node and ``at_parent``.
    """
    root = nodes.where("depth = 0").agg(F.max("owner")).scalar()
    state = nodes.select("*", root.alias("top_owner"), F.lit(0).cast("bigint").alias("top_depth"))
    out: list[DataFrame] = []
    ready: list[DataFrame] = []
    walk_kept = None
    while True:
        sizes = durable(state.groupBy(*COMPONENT).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("whole")))
        large = sizes.where(F.col("n") > limit)
        if large.isEmpty():
            ready.append(state)
            break
        if walk_kept is None:
            walk_kept = durable(walk)
        ready.append(state.join(large, COMPONENT, "left_anti"))
        state = state.join(large.drop("n"), COMPONENT)
        heavy = state.where(F.col("weight") * 2 > F.col("whole"))
        centroid = heavy.groupBy(*COMPONENT).agg(F.max(F.struct("depth", "owner", "weight")).alias("c"))
        centroid = durable(centroid.select(*COMPONENT, F.col("c.depth").alias("c_depth"), F.col("c.owner").alias("c_owner"), F.col("c.weight").alias("c_weight")))
        # The nodes from the component's top down to the centroid's parent lie on the path of the centroid's owner.
        above = centroid.join(walk_kept, F.col("conv") == F.col("c_owner")).where((F.col("depth") >= F.col("top_depth")) & (F.col("depth") < F.col("c_depth")))
        above = above.select(*COMPONENT, F.col("at").alias("owner"), "depth", "c_weight")
        # A node below the centroid has the centroid on its owner's path; the next node on it is the top of its new component.
        step = walk_kept.select(F.col("conv").alias("owner"), F.col("depth").alias("new_depth"), F.col("at").alias("new_owner"), F.col("at_parent").alias("new_parent"))
        seen = state.join(centroid.drop("c_weight"), COMPONENT).withColumn("new_depth", F.when(F.col("depth") > F.col("c_depth"), F.col("c_depth") + 1))
        seen = seen.join(step, ["owner", "new_depth"], "left")
        is_centroid = (F.col("depth") == F.col("c_depth")) & (F.col("owner") == F.col("c_owner"))
        beneath = F.coalesce(F.col("new_parent") == F.col("c_owner"), F.lit(False))
        seen = seen.join(above.withColumnRenamed("c_weight", "less"), [*COMPONENT, "owner", "depth"], "left")
        seen = durable(seen.select("*", is_centroid.alias("is_centroid"), beneath.alias("beneath")))
        totals = seen.where(F.col("is_centroid") | F.col("beneath")).groupBy(*COMPONENT).agg(*[F.sum(v).alias(v) for v in SUMS])
        reached = above.drop("c_weight").unionByName(centroid.select(*COMPONENT, F.col("c_owner").alias("owner"), F.col("c_depth").alias("depth")))
        out.append(durable(reached.join(totals, COMPONENT).select("owner", "depth", *SUMS)))
        state = seen.where(~F.col("is_centroid")).select(
            "owner", "depth", "parent", (F.col("weight") - F.coalesce("less", F.lit(0))).alias("weight"), *SUMS,
            F.when(F.col("beneath"), F.col("new_owner")).otherwise(F.col("top_owner")).alias("top_owner"),
            F.when(F.col("beneath"), F.col("new_depth")).otherwise(F.col("top_depth")).alias("top_depth"),
        )
    columns = [*COMPONENT, "owner", "depth", "parent", *SUMS]
    pieces = ready[0].select(*columns)
    for more in ready[1:]:
        pieces = pieces.unionByName(more.select(*columns))
    pieces = pieces.withColumn("parent", F.coalesce("parent", F.lit(-1))).repartition(*COMPONENT).sortWithinPartitions(*COMPONENT, "depth")
    sums = map_batches(pieces, _split_batches, "owner bigint, depth bigint, n_leaves bigint, saved bigint")
    for more in out:
        sums = sums.unionByName(more)
    return sums


def _ends(rows: DataFrame) -> DataFrame:
    """``prefix, ends_sha256``: the digest of the ids that end at a prefix, ascending and joined by commas."""
    runs = rows.where("depth = length").groupBy("prefix", F.shiftright("conv", RUN_BITS).alias("run"))
    runs = runs.agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    runs = runs.repartition("prefix").sortWithinPartitions("prefix", "run")

    def apply(batches):
        now, digest = None, None
        for batch in batches:
            keys, shas = [], []
            for prefix, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if prefix != now:
                    if now is not None:
                        keys.append(now)
                        shas.append(digest.hexdigest())
                    now, digest = prefix, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield batch_of(["prefix", "ends_sha256"], [pa.array(keys, pa.binary()), pa.array(shas, pa.string())])
        if now is not None:
            yield batch_of(["prefix", "ends_sha256"], [pa.array([now], pa.binary()), pa.array([digest.hexdigest()], pa.string())])

    return map_batches(runs.select("prefix", "ids"), apply, "prefix binary, ends_sha256 string")


def prefix_trie(path: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie of :func:`paths`.

    ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes of the subtree),
    ``saved_tokens`` (over the subtree, the words of a node's turn times its members but one), ``ends_sha256``.
    """
    rows = durable(_prefixes(path))
    found = rows.groupBy("prefix").agg(
        F.min("conv").alias("owner"), F.min("depth").alias("depth"), F.min("before").alias("before"), F.count(F.lit(1)).alias("n_convs"),
        F.max("n_words").alias("n_words"), F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.max("length").alias("longest"),
    )
    found = durable(found)
    parents = found.select(F.col("prefix").alias("before"), F.col("owner").alias("parent"))
    nodes = durable(found.join(parents, "before", "left").join(_ends(rows), "prefix", "left").select(
        "owner", "depth", "parent", "n_convs", "weight", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        (F.col("longest") == F.col("depth")).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"),
    ))
    owners = found.select("prefix", F.col("owner").alias("at"))
    walk = rows.join(owners, "prefix").join(parents, "before", "left").select("conv", "depth", "at", F.col("parent").alias("at_parent"))
    sums = subtree_sums(nodes.drop("n_convs", "ends_sha256"), walk, limit)
    zero, none = F.lit(0).cast("bigint"), F.lit(None)
    described = nodes.select("owner", "depth", "parent", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved"), "ends_sha256")
    summed = sums.select("owner", "depth", none.cast("bigint").alias("parent"), none.cast("bigint").alias("n_convs"), zero.alias("n_children"), "n_leaves", "saved", none.cast("string").alias("ends_sha256"))
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    children = children.select("owner", "depth", none.cast("bigint").alias("parent"), none.cast("bigint").alias("n_convs"), "n_children", zero.alias("n_leaves"), zero.alias("saved"), none.cast("string").alias("ends_sha256"))
    return described.unionByName(summed).unionByName(children).groupBy("owner", "depth").agg(
        F.max("parent").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.max("ends_sha256").alias("ends_sha256"),
    ).withColumnRenamed("owner", "conv_id")
