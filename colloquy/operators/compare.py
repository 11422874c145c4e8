"""Model comparisons: delta tables, leaderboards, example sheets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed
from colloquy.operators.ranking import join_groups
from colloquy.operators.split import sample_per_group


def _long(record: DataFrame, metrics: list[str], by: list[str], value: str) -> DataFrame:
    """A metrics record as rows; a metric the record lacks is left out."""
    have = [m for m in metrics if m in record.columns]
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(value)) for m in have]
    return record.select(*by, F.inline(F.array(*rows)))


def _verdict(delta: Column, lower_is_better: Column) -> Column:
    gain = F.when(lower_is_better, -delta).otherwise(delta)
    return F.when(gain > 0, "better").when(gain < 0, "worse").otherwise("same")


def compare(
    base: DataFrame, candidate: DataFrame, by: list[str] | None = None,
    metrics: list[str] = fixed.COMPARED_METRICS,
) -> DataFrame:
    """``metric, base, candidate, delta, pct, verdict`` of two metrics records.

    A metric that is null or NaN on either side is skipped. The change is 0 % where the base is 0.
    For lengths and latencies lower is better.
    """
    by = by or []
    both = join_groups(
        _long(base, metrics, by, "base"), _long(candidate, metrics, by, "candidate"), [*by, "metric"]
    ).where(F.nanvl("base", F.lit(None)).isNotNull() & F.nanvl("candidate", F.lit(None)).isNotNull())
    delta = F.col("candidate") - F.col("base")
    return both.select(
        *by, "metric", "base", "candidate", delta.alias("delta"),
        F.when(F.col("base") != 0, delta / F.col("base") * 100).otherwise(0.0).alias("pct"),
        _verdict(delta, F.col("metric").isin(fixed.LOWER_IS_BETTER)).alias("verdict"),
    )


def combine_records(base: DataFrame, candidate: DataFrame, names: tuple[str, str] = ("base", "finetuned")) -> DataFrame:
    """One row with the two one-row records as structs."""
    rows = base.select(F.struct(*base.columns).alias("__a"), F.lit(None).alias("__b"))
    more = candidate.select(F.lit(None).alias("__a"), F.struct(*candidate.columns).alias("__b"))
    return rows.union(more).agg(
        F.first("__a", ignorenulls=True).alias(names[0]), F.first("__b", ignorenulls=True).alias(names[1])
    )


def stack_records(*records: DataFrame) -> DataFrame:
    """Records of several models as rows; a column one of them lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), records)


def leaderboard(
    metrics: DataFrame, judge: DataFrame | None = None,
    columns: tuple[str, ...] = ("perplexity", "rougeL", "bleu", "bertscore_f1", "avg_latency_ms"),
    judge_columns: tuple[str, ...] = ("avg_composite", "win_rate"),
    display: bool = False, attributes: DataFrame | None = None,
) -> DataFrame:
    """One row per model label. A value that is missing is null, or ``N/A`` for display.

    ``attributes`` (see :func:`run_attributes`) adds what the runs were made with, for the labels on the board.
    """
    absent = F.lit(None).cast("double")
    board = metrics.select(
        "label", *[(F.col(c).cast("double") if c in metrics.columns else absent).alias(c) for c in columns]
    )
    names = list(columns)
    if judge is not None:
        scores = judge.select("label", *[F.col(c).cast("double").alias(c) for c in judge_columns])
        board = board.join(scores, "label", "full_outer")
        names += judge_columns
    if attributes is not None:
        more = [c for c in attributes.columns if c != "label"]
        board = board.join(attributes, "label", "left").select(*board.columns, *more)
        names += more
    if display:
        board = board.select("label", *[F.coalesce(F.col(c).cast("string"), F.lit("N/A")).alias(c) for c in names])
    return board


def run_attributes(configs: DataFrame, paths: dict[str, str], config: str = "config") -> DataFrame:
    """``label`` and a column for each path into its run's nested configuration.

    ``configs`` has ``label`` and a JSON text, read as a semi-structured value, so runs may differ in what they set. ``paths`` maps a column to a path and a type,
    as in ``{"rank": "$.lora.r bigint"}``; what a configuration lacks, or has in another type, is null, and so is a text that is not JSON.
    """
    parsed = configs.select("label", F.try_parse_json(config).alias("__config"))
    return parsed.select("label", *[F.try_variant_get("__config", *path.split(" ", 1)).alias(name) for name, path in paths.items()])


def leaderboard_by_metric(board: DataFrame, labels: list[str]) -> DataFrame:
    """The leaderboard turned round: one row per number on it, one column per listed label."""
    numbers = ("double", "float", "bigint", "int")
    names = [c for c, kind in board.dtypes if c != "label" and (kind in numbers or kind.startswith("decimal"))]
    long = board.select("label", *[F.col(c).cast("double").alias(c) for c in names]).unpivot(["label"], names, "metric", "value")
    return long.groupBy("metric").pivot("label", labels).agg(F.first("value", ignorenulls=True))


def compare_judge(base: DataFrame, candidate: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``metric, base, candidate, delta, verdict`` of two judge aggregates; with ``by``, of each candidate row with the one base row.

    A missing average counts as 0, and no change counts as worse.
    """
    metrics, by = fixed.JUDGE_METRICS, by or []
    both = _long(candidate, metrics, by, "candidate").join(
        _long(base, metrics, [], "base"), "metric", "left" if by else "full_outer"
    )
    filled = both.select(
        *by, "metric", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("base", "candidate")]
    )
    delta = F.col("candidate") - F.col("base")
    return filled.select(
        *by, "metric", "base", "candidate", delta.alias("delta"),
        F.when(delta > 0, "better").otherwise("worse").alias("verdict"),
    )


def example_sheet(base: DataFrame, candidate: DataFrame, k: int = 2, seed: int = 42) -> DataFrame:
    """Up to ``k`` examples per intent with both predictions, all as strings.

    The sample is drawn from the base table first, so only sampled rows join. ``intent``
    null or not, every group takes part.
    """
    picked = sample_per_group(base, "intent", k, seed)
    other = candidate.select("example_id", F.col("prediction").alias("__ft"))
    return picked.join(other, "example_id", "left").select(
        *[F.col(c).cast("string").alias(n) for c, n in (
            ("instruction", "instruction"), ("prediction", "base_prediction"), ("__ft", "ft_prediction"),
            ("response", "response"), ("intent", "intent"), ("category", "category"),
        )]
    )
