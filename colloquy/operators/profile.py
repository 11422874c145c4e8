"""Profiling aggregates: counts, nulls, value shares, flags, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: ``column, n_null``. One pass, then a reshape of one row."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "n_null")


def value_counts(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    """``value, n, share_pct`` of the non-null values, most frequent first.

    Ties are ordered by value. The total is a scalar subquery, so no row is joined.
    """
    present = df.where(F.col(col).isNotNull())
    total = present.agg(F.count(F.lit(1))).scalar()
    counts = present.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.orderBy(F.desc("n"), "value")
    if k is not None:
        ranked = ranked.limit(k)
    return ranked.select("value", "n", (F.col("n") * 100.0 / total).alias("share_pct"))


def char_counts(df: DataFrame, col: str) -> DataFrame:
    """``flag, n``: how often each character occurs, white space left out."""
    chars = df.select(F.explode(F.split(F.col(col), "")).alias("flag"))
    return (
        chars.where(F.regexp_replace("flag", r"(?U)[\s\x1c-\x1f]", "") != "")
        .groupBy("flag")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def dimension_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct non-null values, sorted."""
    return df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram of the character lengths of ``col``.

    ``bin, low, high, n`` with empty bins included and the last bin closed; a single bin
    if all lengths are equal. The data is reduced to one row per length first, so the
    range is read from that small table.
    """
    lengths = (
        df.where(F.col(col).isNotNull())
        .groupBy(F.length(col).cast("bigint").alias("len"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    low = lengths.agg(F.min("len")).scalar()
    high = lengths.agg(F.max("len")).scalar()
    placed = lengths.select("len", "n", low.alias("lo"), high.alias("hi")).withColumn(
        "bin",
        F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
            F.least(F.expr(f"((len - lo) * {bins}) div (hi - lo)"), F.lit(bins - 1))
        ),
    )
    filled = placed.groupBy("bin").agg(F.sum("n").alias("n"))
    edges = df.sparkSession.range(bins).select(
        F.col("id").alias("bin"), low.alias("lo"), high.alias("hi")
    )
    edges = edges.where(F.col("lo").isNotNull() & ((F.col("hi") > F.col("lo")) | (F.col("bin") == 0)))
    width = F.when(F.col("hi") == F.col("lo"), 0.0).otherwise(
        (F.col("hi") - F.col("lo")).cast("double") / bins
    )
    return edges.join(filled, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def profile(
    df: DataFrame,
    dimensions: tuple[str, ...] = ("intent", "category"),
    texts: tuple[str, ...] = ("instruction", "response"),
    flags: str | None = "flags",
    approximate: bool = False,
) -> DataFrame:
    """One record: rows, columns, distinct values, nulls, flag counts, mean text lengths.

    ``constant_columns`` names the dimensions and flag column with at most one value: such
    a column carries no information.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    watched = [*dimensions, *([flags] if flags else [])]
    record = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        *[distinct(F.col(c)).alias(f"n_{c}") for c in dimensions],
        F.struct(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).alias("null_counts"),
        *[F.avg(F.length(c)).alias(f"avg_{c}_len") for c in texts],
        F.array_compact(
            F.array(*[F.when(distinct(F.col(c)) <= 1, F.lit(c)) for c in watched])
        ).alias("constant_columns"),
    )
    if not flags:
        return record
    # One row per character in use, so the map stays small however large the table is.
    spread = char_counts(df, flags).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("flag", "n"))))
    )
    return record.withColumn("flag_distribution", spread.scalar())


def profile_basic(
    df: DataFrame,
    dimensions: tuple[str, ...] = ("intent", "category"),
    texts: tuple[str, ...] = ("instruction", "response"),
) -> DataFrame:
    """The flat part of :func:`profile`: rows, columns, distinct values, mean lengths."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        *[F.count_distinct(F.col(c)).alias(f"n_{c}") for c in dimensions],
        *[F.avg(F.length(c)).alias(f"avg_{c}_len") for c in texts],
    )
