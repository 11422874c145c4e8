"""Stratified splits and seeded samples; the same rows for the same seed, always."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions.text import seeded_fraction, seeded_key
from colloquy.operators.ranking import cut_keys

# One row per stratum is broadcast up to this many strata, which is checked while the split runs.
MAX_STRATA = 200_000


def _seats(counts: DataFrame, strata: str, n: str, total: Column, into: str) -> DataFrame:
    """Share ``total`` seats over strata in proportion to ``n``, largest remainder first, ties by stratum name.

    ``counts`` has one row per stratum; the window over all of them sees no other rows.
    """
    every = Window.partitionBy(F.lit(0))
    shared = counts.withColumn("__all", F.sum(n).over(every)).withColumn("__total", total).withColumn(
        "__product", F.col(n).cast("decimal(19,0)") * F.col("__total").cast("decimal(19,0)")
    ).select(
        "*", F.expr("cast(floor(__product / __all) as bigint)").alias("__base"), F.expr("__product % __all").alias("__rest"),
    )
    spare = F.col("__total") - F.sum("__base").over(every)
    rank = F.row_number().over(every.orderBy(F.desc("__rest"), F.col(strata)))
    return shared.select("*", spare.alias("__spare"), rank.alias("__rank")).select(
        *counts.columns, (F.col("__base") + (F.col("__rank") <= F.col("__spare")).cast("bigint")).alias(into),
    )


def split_quotas(df: DataFrame, strata: str, held_out: float = 0.2, test_share: float = 0.5) -> DataFrame:
    """``strata, n, n_held_out, n_test`` per stratum.

    The held-out part has ceil(held_out * N) rows and the test part ceil(test_share * held
    out); both are shared by largest remainder. One pass over the stratum column.
    """
    every = Window.partitionBy(F.lit(0))

    def share(of: str, fraction: float) -> Column:
        return F.ceil(F.sum(of).over(every).cast("double") * F.lit(fraction)).cast("bigint")

    counts = df.groupBy(strata).agg(F.count(F.lit(1)).alias("n"))
    first = _seats(counts, strata, "n", share("n", held_out), "n_held_out")
    return _seats(first, strata, "n_held_out", share("n_held_out", test_share), "n_test")


def _seeded(order: str, seed: int) -> tuple[Column, list[Column]]:
    """A number that rises with the seeded key, and the whole sort key."""
    return seeded_fraction(order, seed), [seeded_key(order, seed), F.col(order)]


def stratified_split(
    df: DataFrame,
    strata: str = "intent",
    seed: int = 42,
    held_out: float = 0.2,
    test_share: float = 0.5,
    order: str = "example_id",
    method: str = "exact",
    many_strata: bool = False,
) -> DataFrame:
    """Add ``split``: train, validation or test, in proportion within every stratum.

    ``exact`` meets the quotas of :func:`split_quotas` to the row (rows that repeat an id stay together): the seeded keys of the last test and the last held-out
    row of each stratum are selected on (stratum, key) alone, and every row is compared with its stratum's two keys where it lies. Those are broadcast, one row a stratum,
    at most ``MAX_STRATA``; with ``many_strata`` they are joined however many there are. ``hash_threshold`` needs no shuffle at all and gives approximate sizes.
    """
    if method == "hash_threshold":
        at = seeded_fraction(order, seed)
        return df.withColumn(
            "split",
            F.when(at >= held_out, "train")
            .when(at >= held_out * test_share, "validation")
            .otherwise("test"),
        )
    if method != "exact":
        raise ValueError(f"unknown split method: {method}")
    quotas = split_quotas(df, strata, held_out, test_share).drop("n")
    fraction, key = _seeded(order, seed)
    cuts = cut_keys(df, [strata], fraction, key, {"__test": F.col("n_test"), "__held_out": F.col("n_held_out")}, carry=quotas)
    cuts = cuts.select(F.struct(strata).alias("__stratum"), "__test", "__held_out")
    if not many_strata:
        few = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))) <= MAX_STRATA
        checked = cuts.withColumn("__few", few).where(F.assert_true("__few", "too many strata to broadcast; pass many_strata=True").isNull())
        cuts = F.broadcast(checked.drop("__few"))
    own = F.struct(*[k.alias(f"__k{i}") for i, k in enumerate(key)])
    split = (
        F.when(own <= F.col("__test"), "test")
        .when(own <= F.col("__held_out"), "validation")
        .otherwise("train")
    )
    return df.withColumn("__stratum", F.struct(strata)).join(cuts, "__stratum", "left").select(*df.columns, split.alias("split"))


def _first_keys(df: DataFrame, n: int, seed: int, order: str) -> Column:
    """Whether a row is among the ``n`` with the least seeded keys of ``df``; true for any other table's row with such an id."""
    fraction, key = _seeded(order, seed)
    cut = cut_keys(df.select(order), [], fraction, key, {"cut": F.lit(n)}).select("cut").scalar()
    return F.coalesce(F.struct(*[k.alias(f"__k{i}") for i, k in enumerate(key)]) <= cut, F.lit(False))


def sample_n(df: DataFrame, n: int, seed: int = 42, order: str = "example_id") -> DataFrame:
    """``n`` seeded random rows, or all rows if there are no more than that; rows that repeat an id stay together.

    The key of the last row is selected on the ids alone; the rows are only compared with it.
    """
    return df.where(_first_keys(df, n, seed, order))


def sample_aligned(
    a: DataFrame, b: DataFrame, n: int, seed: int = 42, order: str = "example_id",
    suffixes: tuple[str, str] = ("base", "ft"), shared: tuple[str, ...] = (),
) -> DataFrame:
    """The same seeded sample of two tables, joined on the row id.

    ``shared`` columns are taken from ``a``; other columns of both get a suffix. The key of the last row sampled from ``a`` bounds both
    tables, so each gives about ``n`` rows to the join.
    """
    sampled = _first_keys(a, n, seed, order)
    left = a.where(sampled).select(
        order, *shared,
        *[F.col(c).alias(f"{c}_{suffixes[0]}") for c in a.columns if c != order and c not in shared],
    )
    right = b.where(sampled).select(
        order,
        *[F.col(c).alias(f"{c}_{suffixes[1]}") for c in b.columns if c != order and c not in shared],
    )
    return right.join(left, order).select(*left.columns, *[c for c in right.columns if c != order])


def sample_per_group(
    df: DataFrame, key: str, k: int = 2, seed: int = 42, order: str = "example_id"
) -> DataFrame:
    """Up to ``k`` seeded random rows per group.

    The limit on the row number is applied before the shuffle too, so a task sends at most
    ``k`` rows of a group and a large group costs nothing extra.
    """
    inside = Window.partitionBy(key).orderBy(seeded_key(order, seed), order)
    ranked = df.withColumn("__rank", F.row_number().over(inside))
    return ranked.where(F.col("__rank") <= k).drop("__rank")


def head_n(df: DataFrame, n: int, order: str = "example_id") -> DataFrame:
    return df.orderBy(order).limit(n)
