"""Joins that stay even when a few keys dominate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds more than this share of the rows; so there are fewer than
# 1 / HOT_SHARE hot keys, which bounds the broadcast below whatever the data looks like.
HOT_SHARE = 0.001
# Below this many rows one key is no burden for a task; a hot key gets a salt for each.
HOT_ROWS = 200_000


# Keys that the sketch follows; it may be short of a key's count by 3.5 / TRACKED of the rows, well below HOT_SHARE.
TRACKED = 16_384


def hot_salts(facts: DataFrame, keys: list[str], share: float = HOT_SHARE, rows: int = HOT_ROWS) -> dict[str, Column]:
    """For each key column a map from its hot keys (as text) to their number of salts, one per ``rows`` of them: scalars, read when a result is.

    A key is hot if it holds more than ``share`` of the rows that have a key, and more than ``rows``. A mergeable heavy-hitter sketch names at most
    ``2 / share`` candidates per column in one pass over the keys, with counts that are never short and at most ``3.5 / TRACKED`` of the rows over:
    salts deal rows out and change no result, so no second pass counts them exactly.
    """
    most = int(2 / share)
    texts = facts.select(*[F.col(k).cast("string").alias(f"__{i}") for i, k in enumerate(keys)])
    counted = texts.agg(*[c for i in range(len(keys)) for c in (
        F.expr(f"approx_top_k(__{i}, {most}, {max(TRACKED, most)})").alias(f"__{i}"), F.count(f"__{i}").alias(f"__n{i}")
    )])

    def salts(i: int) -> Column:
        hot = F.filter(f"__{i}", lambda x: x["item"].isNotNull() & (x["count"] > F.greatest(F.col(f"__n{i}") * F.lit(share), F.lit(rows))))
        return F.map_from_entries(F.transform(hot, lambda x: F.struct(x["item"], F.ceil(x["count"] / F.lit(max(rows, 1))).cast("bigint"))))

    maps = counted.select(F.struct(*[salts(i).alias(f"__{i}") for i in range(len(keys))])).scalar()
    return {k: maps[f"__{i}"] for i, k in enumerate(keys)}


def lookup_join(
    facts: DataFrame,
    state: DataFrame,
    key: str,
    row_id: str,
    into: str,
    share: float = HOT_SHARE,
    rows: int = HOT_ROWS,
    salts: Column | None = None,
) -> DataFrame:
    """Left join of a table of facts to a table with one row per key.

    The matching state row is added as struct ``into`` (null if there is none); of several
    state rows for one key the least counts, so no fact is ever doubled. Facts of a hot key
    are spread by a hash of their id over one salt per ``rows`` of them, and the state row of
    that key is repeated once per salt. Facts without a key are spread by that hash.
    ``salts`` is the map of :func:`hot_salts`, where several lookups share one.
    """
    salts = hot_salts(facts, [key], share, rows)[key] if salts is None else salts
    own = F.try_element_at(salts, F.col(key).cast("string"))
    spread = F.xxhash64(row_id)
    left = facts.withColumn(
        "__salt", F.when(F.col(key).isNull(), spread).otherwise(F.coalesce(F.pmod(spread, own), F.lit(0))),
    )
    others = [c for c in state.columns if c != key]
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(own - 1, F.lit(0).cast("bigint")))
    # Grouped by the columns of the join, whose shuffle and order then serve both.
    salted = state.withColumn("__salt", F.explode(copies))
    unique = salted.groupBy(key, "__salt").agg(F.min(F.struct(*(others or [key]))).alias("__state"))
    right = unique.select(key, "__salt", F.struct(*[key if c == key else F.col("__state")[c].alias(c) for c in state.columns]).alias(into))
    return left.join(right, [key, "__salt"], "left").select(*facts.columns, into)


# Bits of a key map: 2**17 numbers of 64 bits at most, so the map is broadcast whatever the data.
MAP_BITS = 1 << 23


def mark_keys(df: DataFrame, keys: DataFrame, key: str, into: str) -> DataFrame:
    """``df`` and whether its ``key`` may be among those of ``keys`` (one column of that name, null being a key).

    The map has a bit for each hash of a key. A key that is among them is always marked; where the map is full, every key is,
    and nothing but the saving is lost.
    """
    # Never null, as the optimizer can see: it would add tests for null to the joins and move them below what makes ``keys``.
    place = F.coalesce(F.pmod(F.xxhash64(key), F.lit(MAP_BITS)), F.lit(0))
    word = F.expr("coalesce(__place div 64, 0L)").alias("__word")
    bit = F.expr("shiftleft(1L, cast(__place % 64 as int))")
    words = keys.select(place.alias("__place")).select(word, bit.alias("__bit"))
    words = words.groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    placed = df.withColumn("__place", place).withColumn("__word", word).join(F.broadcast(words), "__word", "left")
    return placed.select(*df.columns, F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False)).alias(into))
