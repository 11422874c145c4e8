"""A map of ids in a fixed number of bits, for sparing texts a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23


def mark_ids(docs: DataFrame, ids: DataFrame, column: str = "may_be") -> DataFrame:
    """``docs`` (with ``doc_id``) and whether the id may be among those of ``ids``: whether its hash has its bit in the map.

    The map is a table of at most 2**17 rows (64 bits each), so it is broadcast whatever the data. An id that is among them is always marked; where the
    map is full, every id is, and nothing but the saving is lost.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    bit = F.expr("shiftleft(1L, cast(_place % 64 as int))")
    words = (
        ids.where("doc_id is not null").select(place.alias("_place")).select(F.expr("_place div 64").alias("_word"), bit.alias("_bit"))
        .groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    )
    marked = docs.withColumn("_place", place).withColumn("_word", F.expr("_place div 64")).join(F.broadcast(words), "_word", "left")
    return marked.select(*docs.columns, F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False)).alias(column))
