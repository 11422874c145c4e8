"""Row filters, text cleaning, exact dedup and the audit of what was removed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed
from colloquy.functions.text import fill, normalize_ws, quality_flag, seeded_key
from colloquy.operators.joins import mark_keys


@dataclass(frozen=True)
class CleanConfig:
    """Settings of the cleaning pipeline.

    Lengths are tested on the raw text; with ``recheck_length`` they are tested again after
    white space is normalised. ``flags=None`` leaves out the quality-flag column.
    """

    min_chars: dict[str, int] = field(
        default_factory=lambda: {
            "response": fixed.MIN_RESPONSE_CHARS,
            "instruction": fixed.MIN_INSTRUCTION_CHARS,
        }
    )
    flags: str | None = fixed.QUALITY_FLAGS
    flag_column: str = "flags"
    keys: tuple[str, str] = ("instruction", "response")
    order: str = "example_id"
    recheck_length: bool = False


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def _long_enough(min_chars: dict[str, int]) -> Column:
    tests = [F.length(c) >= n for c, n in min_chars.items()]
    return reduce(lambda a, b: a & b, tests)


def min_length(df: DataFrame, min_chars: dict[str, int]) -> DataFrame:
    return df.where(_long_enough(min_chars))


def normalize_text(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: normalize_ws(c) for c in cols})


def with_quality_flag(df: DataFrame, col: str = "flags", flags: str = fixed.QUALITY_FLAGS) -> DataFrame:
    return df.withColumn("has_quality_flag", quality_flag(col, flags))


def key_digest(keys: list[str]) -> Column:
    """SHA-256 of several texts, each with its length in front so that moving a boundary changes it; null is a value.

    Never null, and the optimizer can see that: a join on a nullable digest makes it test every row for a null below the scan, at the price
    of several more digests a row, and differently on either side of the join, so that neither uses what the other has made."""
    parts = []
    for k in keys:
        text = F.col(k).cast("string")
        parts += [F.coalesce(F.length(text).cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit(""))]
    return F.coalesce(F.sha2(F.concat(*parts).cast("binary"), 256), F.lit(""))


def _first_of_each(
    df: DataFrame, keys: list[str], order: str, prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """``prepare(df)`` without the rows that another of the same key and a lower ``order`` makes redundant.

    ``prepare`` may drop rows and rewrite columns, but not ``order``. Digests and orders, a narrow table, tell which orders may have to go (or are repeated); a map
    of them, a bit each, is broadcast. Other rows pass through where they lie; only those are dealt out by digest and looked up.
    """
    narrow = prepare(df).select(key_digest(keys).alias("__digest"), F.col(order).alias("__order"))
    groups = narrow.groupBy("__digest", "__order").agg(F.count(F.lit(1)).alias("__times"))
    lowest = groups.groupBy("__digest").agg(F.min("__order").alias("__lowest"), F.sum("__times").alias("__rows")).where("__rows > 1")
    several = groups.join(lowest, "__digest").where("not (__order <=> __lowest) or __times > 1")
    several = several.select("__digest", "__order", F.col("__order").eqNullSafe(F.col("__lowest")).alias("__stays"))
    marked = mark_keys(df.withColumn("__order", F.col(order)), several.select("__order"), "__order", "__may").drop("__order")
    apart = prepare(marked.where(~F.col("__may")).drop("__may"))
    looked_up = prepare(marked.where("__may").drop("__may")).withColumns({"__digest": key_digest(keys), "__order": F.col(order)})
    found = looked_up.join(
        several.select(F.col("__digest").alias("__d"), F.col("__order").alias("__o"), "__stays"),
        (F.col("__digest") == F.col("__d")) & F.col("__order").eqNullSafe(F.col("__o")), "left",
    )
    single = found.where("__stays is null")
    # Rows that repeat key and order are interchangeable: one of them stays.
    repeated = found.where("__stays").dropDuplicates(["__digest", "__order"])
    columns = apart.columns
    return apart.unionByName(single.select(*columns)).unionByName(repeated.select(*columns))


def dedup_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keep the row with the lowest ``order`` of each distinct key; one of them if several have it."""
    return _first_of_each(df, keys, order)


def clean_stateless(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """Everything but dedup: filters and projections only, so it also runs on a stream."""
    keys = list(config.keys)
    out = normalize_text(min_length(drop_missing(df, keys), config.min_chars), keys)
    if config.recheck_length:
        out = min_length(out, config.min_chars)
    if config.flags is not None:
        out = with_quality_flag(out, config.flag_column, config.flags)
    return out


def clean(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """Drop incomplete and short rows, tidy white space, flag quality, drop duplicates.

    Texts are tidied for the table of digests and, those rows that stay or are looked up, once for the result.
    """
    return _first_of_each(df, list(config.keys), config.order, lambda rows: clean_stateless(rows, config))


def clean_audit(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """Rows left after each stage, from one aggregate over the raw table.

    The number of distinct pairs is counted on digests with the length of the first text in
    front, so that moving a boundary cannot make two pairs look alike and only short keys
    are shuffled.
    """
    keys = list(config.keys)
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    long = F.coalesce(_long_enough(config.min_chars), F.lit(False))
    first, second = (normalize_ws(k) for k in keys)
    kept = present & long
    if config.recheck_length:
        again = reduce(
            lambda a, b: a & b,
            [F.length(normalize_ws(c)) >= n for c, n in config.min_chars.items()],
        )
        kept = kept & again
    flagged = (
        quality_flag(config.flag_column, config.flags) if config.flags is not None else F.lit(False)
    )
    pair = F.sha2(
        F.concat(F.length(first).cast("string"), F.lit(":"), first, second).cast("binary"), 256
    )
    staged = df.select(
        present.alias("present"), kept.alias("kept"), flagged.alias("flagged"),
        F.when(kept, pair).alias("pair"),
    )
    counted = staged.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if("present").alias("after_missing"),
        F.count_if("kept").alias("after_length"),
        F.count_if(F.col("kept") & F.col("flagged")).alias("flagged"),
        F.count_distinct("pair").alias("after_dedup"),
    )
    removed = F.col("rows_in") - F.col("after_dedup")
    return counted.select(
        "*",
        removed.alias("removed"),
        F.when(F.col("rows_in") > 0, removed * 100.0 / F.col("rows_in")).alias("removed_pct"),
    )


def pick_example(
    df: DataFrame, intent: str | None = None, seed: int = 42, order: str = "example_id"
) -> DataFrame:
    """One seeded random row of an intent (``None`` = all) with a label; empty if none."""
    pool = df if intent is None else df.where(F.col("intent") == intent)
    label = fill(fixed.EXAMPLE_LABEL, intent=F.col("intent"), category=F.col("category"))
    return pool.orderBy(seeded_key(order, seed), order).limit(1).withColumn("label", label)
