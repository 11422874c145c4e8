"""Ranks and order statistics that never sort one large group in one task.

A plain ``row_number`` over a group sorts the whole group in a single task, so one group
holding a third of the rows would hold up the job. Here a group is cut into buckets that
follow the sort order; the buckets are counted, and a row's rank is the number of rows in
earlier buckets plus its rank inside its own bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _group(by: list[str]) -> Column:
    """The group of a row as one value; unlike a bare column it is equal for equal nulls."""
    return F.struct(*by) if by else F.lit(0)


def join_groups(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same name, two nulls being equal."""
    other = right.select(
        F.struct(*by).alias("__group"), *[c for c in right.columns if c not in by]
    )
    return left.withColumn("__group", F.struct(*by)).join(other, "__group", how).drop("__group")


def bucket_offsets(df: DataFrame, bucket: str, rows: Column | None = None) -> DataFrame:
    """Rows per (__group, bucket) and how many rows of the group lie in earlier buckets.

    The window runs over bucket counts, one row per bucket, never over the data.
    """
    size = F.count(F.lit(1)) if rows is None else F.sum(rows)
    counts = df.groupBy("__group", bucket).agg(size.cast("bigint").alias("__rows"))
    earlier = Window.partitionBy("__group").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))


def rank_in_buckets(
    df: DataFrame,
    by: list[str],
    bucket: str,
    order: list[Column | str],
    into: str,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Add the 1-based rank of each row of a ``by`` group as column ``into``.

    ``bucket`` must follow ``order``: a row in a lower bucket sorts before one in a higher
    bucket. ``carry`` may hold one row per ``by`` group; its other columns come along. The
    join and the window share the same keys, hence one shuffle of the data.
    """
    grouped = df.withColumn("__group", _group(by))
    offsets = bucket_offsets(grouped, bucket).drop("__rows")
    if carry is not None:
        extra = [c for c in carry.columns if c not in by]
        offsets = offsets.join(carry.select(_group(by).alias("__group"), *extra), "__group")
    joined = grouped.join(offsets, ["__group", bucket])
    inside = Window.partitionBy("__group", bucket).orderBy(*order)
    ranked = joined.withColumn(into, F.col("__before") + F.row_number().over(inside))
    return ranked.drop("__before", "__group")


def _cuts_below(value: Column, cuts: Column, most: int) -> Column:
    """How many of the ascending ``cuts`` (at most ``most``) lie below the value, by halving."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(most, 1).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        F.coalesce(F.get(cuts, low + step - 1) < value, F.lit(False)), low + step
    ).otherwise(low))


def range_bucket(df: DataFrame, order: str, into: str, buckets: int | None = None) -> DataFrame:
    """Cut a numeric column at its own quantiles into about equal buckets.

    The cuts come from a mergeable sketch of that one column, read as a scalar when the result is; their number is the number of shuffle
    partitions, whatever the size of the data. Nothing runs here.
    """
    wanted = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.col(order).cast("double")
    if wanted < 2:
        return df.withColumn(into, F.lit(0))
    steps = [i / wanted for i in range(1, wanted)]
    cuts = df.agg(F.percentile_approx(number, steps, 10 * wanted)).scalar()
    return df.withColumn("__cuts", cuts).withColumn(into, _cuts_below(number, F.col("__cuts"), wanted)).drop("__cuts")


def with_position(
    df: DataFrame, order: str = "example_id", into: str = "position", buckets: int | None = None
) -> DataFrame:
    """Add the dense position 0..n-1 of each row in the order of a unique numeric column."""
    cut = range_bucket(df, order, "__bucket", buckets)
    ranked = rank_in_buckets(cut, [], "__bucket", [F.col(order)], into)
    return ranked.withColumn(into, F.col(into).cast("bigint") - 1).drop("__bucket")


# A sketch cuts a group into cells of equally many rows, to within 1 / ACCURACY of the rows.
CELLS, ACCURACY = 1000, 10_000
# So many rows or fewer are taken as they are; a cell of more has several rows, which the sketch's error needs.
SMALL = 4096


def _sketch(value: Column) -> Column:
    """The values between the cells, CELLS + 1 of them; null without values."""
    return F.percentile_approx(value, [i / CELLS for i in range(CELLS + 1)], ACCURACY)


def _bracket(low: Column, high: Column, rows: Column, cuts: Column) -> tuple[Column, Column]:
    """Two values that enclose those at the zero-based positions ``low`` to ``high``, a cell wider at both ends than the sketch says."""
    whole = F.greatest(rows, F.lit(1))
    first, last = (F.floor(low * CELLS / whole) - 1).cast("int"), (F.floor(high * CELLS / whole) + 2).cast("int")
    small = rows <= SMALL
    return (
        F.when(small | (first < 0), F.lit(float("-inf"))).otherwise(F.get(cuts, first)),
        F.when(small | (last > CELLS), F.lit(float("inf"))).otherwise(F.get(cuts, last)),
    )


def _enclosed(values: DataFrame, wide: DataFrame, n_places: int, rest: tuple[str, ...] = ()) -> DataFrame:
    """Per ``__group`` the columns of ``wide``, the few rows around each wanted place, and how many lie below those.

    ``values`` has ``__group, __value`` and the columns ``rest`` that order rows of one value. ``wide`` has for each place i ``__low{i}`` and ``__high{i}``
    (zero-based positions), ``__from{i}`` and ``__to{i}`` (values that enclose them). The rows below a place's values are counted and those inside are
    sketched; then the rows below that narrower bracket are counted and the others collected, equal ones together (``__items``: key, times).
    """
    each = range(n_places)
    kept = [c for c in wide.columns if c != "__group"]
    carried = [F.any_value(c).alias(c) for c in kept]
    below = [F.col("__value") < F.col(f"__from{i}") for i in each]
    inside = [F.col("__value").between(F.col(f"__from{i}"), F.col(f"__to{i}")) for i in each]
    within = values.select("__group", "__value").join(wide, "__group").groupBy("__group").agg(
        *carried, *[F.count_if(below[i]).alias(f"__below{i}") for i in each], *[F.count_if(inside[i]).alias(f"__rows{i}") for i in each],
        *[_sketch(F.when(inside[i], F.col("__value"))).alias(f"__cuts{i}") for i in each],
    )
    narrow = {}
    for i in each:
        low, high = (F.col(f"__{end}{i}") - F.col(f"__below{i}") for end in ("low", "high"))
        a, b = _bracket(low, high, F.col(f"__rows{i}"), F.col(f"__cuts{i}"))
        narrow |= {f"__from{i}": F.greatest(a, f"__from{i}"), f"__to{i}": F.least(b, f"__to{i}")}
    within = within.withColumns(narrow).select("__group", *kept)
    some = F.coalesce(reduce(lambda a, b: a | b, inside, F.lit(False)), F.lit(False))
    under = reduce(lambda a, b: a + b, [F.when(below[i], 1 << i).otherwise(0) for i in each], F.lit(0))
    key = F.when(some, F.struct("__value", *rest))
    counted = values.join(within, "__group").groupBy("__group", key.alias("__key"), F.when(~some, under).alias("__under")).agg(
        F.count(F.lit(1)).alias("__times"), *carried
    )
    before = [F.coalesce(F.col("__key.__value") < F.col(f"__from{i}"), F.col("__under").bitwiseAND(F.lit(1 << i)) != 0, F.lit(False)) for i in each]
    return counted.groupBy("__group").agg(
        *carried, F.sort_array(F.collect_list(F.when(F.col("__key").isNotNull(), F.struct("__key", "__times")))).alias("__items"),
        *[F.sum(F.when(before[i], F.col("__times")).otherwise(0)).alias(f"__below{i}") for i in each],
    )


def _walked(i: int, kind: str) -> Column:
    """The keys at both positions of place i, from one walk over the items."""
    nothing = F.lit(None).cast(kind)

    def step(s: Column, x: Column) -> Column:
        seen = s["seen"] + x["__times"]
        ends = [F.when(s[end].isNull() & (seen > F.col(f"__{end}{i}")), x["__key"]).otherwise(s[end]).alias(end) for end in ("low", "high")]
        return F.struct(seen.alias("seen"), *ends)

    start = F.struct(F.col(f"__below{i}").alias("seen"), nothing.alias("low"), nothing.alias("high"))
    return F.aggregate(F.filter("__items", lambda x: x["__key"]["__value"] >= F.col(f"__from{i}")), start, step)


def _with_brackets(wide: DataFrame, n_places: int) -> DataFrame:
    """The values that enclose each place, from the sketch ``__cuts`` of all ``n`` values."""
    ends = {}
    for i in range(n_places):
        ends[f"__from{i}"], ends[f"__to{i}"] = _bracket(F.col(f"__low{i}"), F.col(f"__high{i}"), F.col("n"), F.col("__cuts"))
    return wide.select("*", *[c.alias(k) for k, c in ends.items()]).drop("__cuts")


def order_statistics(
    df: DataFrame, value: str, by: list[str], at: dict[str, Column], also: list[Column] | None = None, also_from: DataFrame | None = None
) -> DataFrame:
    """Exact order statistics of a numeric column, per group.

    Null and NaN do not count. ``at`` maps an output name to a zero-based position written in terms of the column ``n`` (the number of
    values). A fractional position interpolates linearly between its neighbours. ``also`` are further aggregates over the same groups, taken in the
    first pass, of ``also_from`` (with the same groups and values) if that is given; with them a group without values has a row too, and without a
    group an empty table has one.

    Three passes, each an aggregate that combines before the shuffle: a mergeable quantile sketch brackets each position, :func:`_enclosed` narrows the
    brackets and collects what is left. Two sketches leave about 1 in 100,000 of a group's rows, whatever band its values lie in.
    """
    names, also = list(at), also or []
    number = F.col(value).cast("double")
    number = F.when(~F.isnan(number), number)
    values = df.select(_group(by).alias("__group"), number.alias("__value"))
    source = (df if also_from is None else also_from).select("*", _group(by).alias("__group"), number.alias("__value"))
    sketched = (source.groupBy("__group") if by else source).agg(F.count("__value").alias("n"), _sketch(F.col("__value")).alias("__cuts"), *also)
    if not by:
        # A row without a value, so that an empty table has its one group.
        sketched = sketched.withColumn("__group", F.lit(0))
        values = values.unionByName(df.sparkSession.range(1).select(F.lit(0).alias("__group"), F.lit(None).cast("double").alias("__value")))
    more = [c for c in sketched.columns if c not in ("__group", "n", "__cuts")]
    places = {}
    for i, k in enumerate(names):
        places |= {f"__low{i}": F.when(F.col("n") > 0, F.floor(at[k]).cast("bigint")), f"__high{i}": F.when(F.col("n") > 0, F.ceil(at[k]).cast("bigint")),
                   f"__share{i}": at[k] - F.floor(at[k])}
    wide = sketched.select("__group", "n", "__cuts", *more, *[c.alias(k) for k, c in places.items()])
    found = _enclosed(values, _with_brackets(wide, len(names)), len(names))
    out = found.select("*", *[_walked(i, "struct<__value:double>").alias(f"__at{i}") for i in range(len(names))])
    if not also:
        out = out.where("n > 0")
    low, high = ({i: F.col(f"__at{i}.{end}.__value") for i in range(len(names))} for end in ("low", "high"))
    return out.select(
        *[F.col("__group")[c].alias(c) for c in by], "n", *more,
        *[(low[i] + (high[i] - low[i]) * F.col(f"__share{i}")).alias(k) for i, k in enumerate(names)],
    )


def cut_keys(df: DataFrame, by: list[str], fraction: Column, key: list[Column], ranks: dict[str, Column], carry: DataFrame | None = None) -> DataFrame:
    """Per group the sort key of the row at each wanted rank: rows up to the cut are the first ones, so no row need be ranked or moved.

    ``key`` is the sort key and ``fraction`` a number that rises with its first column. ``ranks`` maps an output name to a 1-based rank written in terms of ``n``
    (the group's rows) and of the columns of ``carry``, one row per group; beyond the last row it is the last, for rank 0 the cut is null. Only group, fraction and
    key are shuffled, as in :func:`order_statistics`.
    """
    names, parts = list(ranks), [f"__k{i}" for i in range(len(key))]
    values = df.select(_group(by).alias("__group"), fraction.alias("__value"), *[k.alias(p) for k, p in zip(key, parts)])
    wide = values.groupBy("__group").agg(F.count(F.lit(1)).alias("n"), _sketch(F.col("__value")).alias("__cuts"))
    more: list[str] = []
    if carry is not None:
        more = [c for c in carry.columns if c not in by]
        wide = wide.join(carry.select(_group(by).alias("__group"), *more), "__group")
    places = {}
    for i, k in enumerate(names):
        place = F.least(ranks[k].cast("bigint"), F.col("n")) - 1
        places |= {f"__low{i}": F.greatest(place, F.lit(0)), f"__high{i}": F.greatest(place, F.lit(0)), f"__none{i}": place < 0}
    wide = wide.select("__group", "n", "__cuts", *more, *[c.alias(k) for k, c in places.items()])
    found = _enclosed(values, _with_brackets(wide, len(names)), len(names), tuple(parts))
    kind = found.schema["__items"].dataType.elementType["__key"].dataType.simpleString()
    at = {k: _walked(i, kind)["low"] for i, k in enumerate(names)}
    return found.select(
        *[F.col("__group")[c].alias(c) for c in by],
        *[F.when(~F.col(f"__none{i}"), F.struct(*[at[k][p].alias(p) for p in parts])).alias(k) for i, k in enumerate(names)],
    )


def linear_position(q: float) -> Column:
    """Position of a quantile with linear interpolation."""
    return (F.col("n") - 1) * F.lit(float(q))


def rank_position(q: float) -> Column:
    """Position of a quantile taken from the sorted values without interpolation."""
    return F.floor(F.col("n") * F.lit(float(q)))
