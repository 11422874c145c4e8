"""Text, latency and likelihood metrics of predictions against references.

Every text metric is computed inside its own row and then averaged: the only shuffle is
the one of the final aggregate, a few numbers per task and slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.lcs import rouge_l_f1, rouge_lsum_f1
from colloquy.functions.overlap import with_overlaps
from colloquy.functions.text import bleu_tokens, rouge_tokens, word_count
from colloquy.operators.ranking import join_groups, linear_position, order_statistics, rank_position

BLEU_ORDERS = [1, 2, 3, 4]


def _grams(size: Column, n: int) -> Column:
    return F.greatest(size - (n - 1), F.lit(0))


def _f1(matches: Column, n_pred: Column, n_ref: Column) -> Column:
    # 2PR/(P+R) with P = m/p and R = m/r is 2m/(p+r).
    return F.when(matches > 0, 2.0 * matches / (n_pred + n_ref)).otherwise(0.0)


def with_rouge_n(df: DataFrame, pred: str, ref: str, orders: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Add ``rouge{n}``: the F1 of shared n-grams of each row."""
    tokens = df.withColumns({"__pred": rouge_tokens(pred), "__ref": rouge_tokens(ref)})
    counted = with_overlaps(tokens, "__pred", "__ref", list(orders), "__rouge_")
    n_pred, n_ref = F.col("__rouge_left_len"), F.col("__rouge_right_len")
    return counted.select(
        *df.columns,
        *[
            _f1(F.col(f"__rouge_match{n}"), _grams(n_pred, n), _grams(n_ref, n)).alias(f"rouge{n}")
            for n in orders
        ],
    )


def with_rouge_lcs(df: DataFrame, pred: str, ref: str) -> DataFrame:
    """Add ``rougeL`` and ``rougeLsum``. Without a line break the two are the same."""
    texts = {
        "__pred": F.lower(F.coalesce(F.col(pred), F.lit(""))),
        "__ref": F.lower(F.coalesce(F.col(ref), F.lit(""))),
    }
    return (
        df.withColumns(texts)
        .withColumns({
            "rougeL": rouge_l_f1("__pred", "__ref"),
            "rougeLsum": rouge_lsum_f1("__pred", "__ref"),
        })
        .drop("__pred", "__ref")
    )


def with_bleu_counts(df: DataFrame, pred: str, ref: str) -> DataFrame:
    """Add the row's share of the corpus counts: matches and totals per order, lengths."""
    tokens = df.withColumns({"__pred": bleu_tokens(pred), "__ref": bleu_tokens(ref)})
    counted = with_overlaps(tokens, "__pred", "__ref", BLEU_ORDERS, "bleu_")
    return counted.withColumnsRenamed({"bleu_left_len": "bleu_pred_len", "bleu_right_len": "bleu_ref_len"})


def _bleu_sums() -> list[Column]:
    sums = []
    for n in BLEU_ORDERS:
        sums.append(F.sum(f"bleu_match{n}").alias(f"bleu_match{n}"))
        sums.append(F.sum(_grams(F.col("bleu_pred_len"), n)).alias(f"bleu_total{n}"))
    sums.append(F.sum("bleu_pred_len").alias("bleu_pred_len"))
    sums.append(F.sum("bleu_ref_len").alias("bleu_ref_len"))
    return sums


def _bleu_score() -> Column:
    """Geometric mean of the precisions times the brevity penalty; 0 if any is 0."""
    pred, ref = F.col("bleu_pred_len").cast("double"), F.col("bleu_ref_len").cast("double")
    every = F.lit(True)
    logs = F.lit(0.0)
    for n in BLEU_ORDERS:
        every = every & (F.col(f"bleu_match{n}") > 0)
        logs = logs + F.log(F.col(f"bleu_match{n}") / F.col(f"bleu_total{n}"))
    penalty = F.when(pred > ref, 1.0).otherwise(F.exp(1.0 - ref / pred))
    return (
        F.when(pred.isNull(), None)
        .when(every, F.exp(logs / len(BLEU_ORDERS)) * penalty)
        .otherwise(0.0)
    )


def bleu(df: DataFrame, pred: str, ref: str, by: list[str] | None = None) -> DataFrame:
    """Corpus BLEU-4 without smoothing, one row (or one per slice); null for no rows."""
    by = by or []
    sums = with_bleu_counts(df.select(*by, pred, ref), pred, ref).groupBy(*by).agg(*_bleu_sums())
    return sums.select(*by, _bleu_score().alias("bleu"))


def rouge_n(df: DataFrame, pred: str, ref: str, n: int, by: list[str] | None = None) -> DataFrame:
    """Mean n-gram F1."""
    by = by or []
    rows = with_rouge_n(df.select(*by, pred, ref), pred, ref, (n,))
    return rows.groupBy(*by).agg(F.avg(f"rouge{n}").alias(f"rouge{n}"))


def rouge_l(df: DataFrame, pred: str, ref: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    return with_rouge_lcs(df.select(*by, pred, ref), pred, ref).groupBy(*by).agg(
        F.avg("rougeL").alias("rougeL")
    )


def rouge_lsum(df: DataFrame, pred: str, ref: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    return with_rouge_lcs(df.select(*by, pred, ref), pred, ref).groupBy(*by).agg(
        F.avg("rougeLsum").alias("rougeLsum")
    )


def _length_aggregates(pred: str, ref: str) -> list[Column]:
    return [F.avg(word_count(pred)).alias("avg_pred_length"), F.avg(word_count(ref)).alias("avg_ref_length")]


def _length_ratio() -> Column:
    return F.col("avg_pred_length") / F.greatest(F.col("avg_ref_length"), F.lit(1.0))


def length_stats(df: DataFrame, pred: str, ref: str, by: list[str] | None = None) -> DataFrame:
    """Mean words of predictions and references and the ratio of the two means."""
    by = by or []
    means = df.groupBy(*by).agg(*_length_aggregates(pred, ref))
    return means.select("*", _length_ratio().alias("length_ratio"))


def without_nan(df: DataFrame, *cols: str) -> DataFrame:
    """NaN read as null in these columns, so that means and extremes skip it."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.nanvl(c, F.lit(None).cast(kinds[c])) for c in cols if kinds[c] in ("double", "float")})


def latency_stats(
    df: DataFrame, col: str = "latency_ms", by: list[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Mean and 95th percentile (linear); nulls if the table has no such column.

    The exact percentile is selected in parallel; ``approximate`` uses a sketch instead.
    """
    by = by or []
    if col in df.columns:
        df = without_nan(df, col)
    if col not in df.columns:
        absent = F.lit(None).cast("double")
        return df.groupBy(*by).agg(
            F.max(absent).alias("avg_latency_ms"), F.max(absent).alias("p95_latency_ms")
        )
    if approximate:
        return df.groupBy(*by).agg(
            F.avg(col).alias("avg_latency_ms"), F.percentile_approx(col, 0.95).alias("p95_latency_ms")
        )
    return order_statistics(df, col, by, {"p95_latency_ms": linear_position(0.95)}, also=[F.avg(col).alias("avg_latency_ms")]).drop("n")


def attach(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Add the columns of ``right`` to ``left``, both with one row per ``by`` group.

    Without a group both sides are one-row aggregates, so the row is read as a scalar.
    """
    new = [c for c in right.columns if c not in by]
    if not by:
        one = right.agg(F.max(F.struct(*new))).scalar()
        return left.withColumn("__one", one).select(*left.columns, *[F.col("__one")[c].alias(c) for c in new])
    return join_groups(left, right, by, "left")


def latency_summary(
    df: DataFrame, latency: str = "latency_ms", tokens: str = "response_tokens",
    by: list[str] | None = None, weighted: bool = False,
) -> DataFrame:
    """Mean, median, 95th percentile by rank, extremes, token rate, mean tokens, rows.

    The token rate is the mean of per-row rates; ``weighted`` gives total tokens over total
    time instead.
    """
    by = by or []
    df = without_nan(df, latency, tokens)
    # A latency of 0 has no rate; such a row is left out of the mean of rates.
    seconds = F.nullif(F.col(latency), F.lit(0.0)) / 1000.0
    if weighted:
        rate = F.sum(tokens) / F.nullif(F.sum(latency) / 1000.0, F.lit(0.0))
    else:
        rate = F.avg(F.col(tokens) / seconds)
    plain = [
        F.count(F.lit(1)).alias("n_prompts"),
        F.avg(latency).alias("avg_latency_ms"),
        F.min(latency).alias("min_latency_ms"),
        F.max(latency).alias("max_latency_ms"),
        rate.alias("avg_tokens_per_sec"),
        F.avg(tokens).alias("avg_response_tokens"),
    ]
    ranks = {"median_latency_ms": linear_position(0.5), "p95_latency_ms": rank_position(0.95)}
    return order_statistics(df, latency, by, ranks, also=plain).drop("n")


def latency_details(df: DataFrame, latency: str = "latency_ms", tokens: str = "response_tokens",
                    keep: tuple[str, ...] = ("prompt", "response")) -> DataFrame:
    """Per-prompt rows with the latency rounded for a report."""
    return without_nan(df, latency).select(*keep, F.round(latency, 1).alias("latency_ms"), F.col(tokens).alias("response_tokens"))


def perplexity(
    df: DataFrame, loss: str, by: list[str] | None = None, weight: str | None = None
) -> DataFrame:
    """exp of the mean loss; ``weight`` (say, tokens per text) makes it a weighted mean. NaN counts as null."""
    by = by or []
    df = without_nan(df, loss)
    mean = F.avg(loss) if weight is None else F.sum(F.col(loss) * F.col(weight)) / F.sum(F.when(F.col(loss).isNotNull(), F.col(weight)))
    return df.groupBy(*by).agg(F.exp(mean).alias("perplexity"))


def metrics_for(
    df: DataFrame,
    label: str,
    model_path: str,
    by: list[str] | None = None,
    pred: str = "prediction",
    ref: str = "response",
    latency: str = "latency_ms",
) -> DataFrame:
    """The metrics record of one model: one row, or one per slice.

    All text metrics come from one pass over the rows and one aggregate.
    """
    by = by or []
    has_latency = latency in df.columns
    rows = df.select(*by, pred, ref, *([latency] if has_latency else []))
    rows = with_bleu_counts(with_rouge_n(with_rouge_lcs(rows, pred, ref), pred, ref), pred, ref)
    means = [
        F.count(F.lit(1)).alias("n_samples"),
        *_bleu_sums(),
        *[F.avg(c).alias(c) for c in ("rouge1", "rouge2", "rougeL", "rougeLsum")],
        *_length_aggregates(pred, ref),
    ]
    if has_latency:
        means.append(F.avg(latency).alias("avg_latency_ms"))
        means = order_statistics(df, latency, by, {"p95_latency_ms": linear_position(0.95)}, also=means, also_from=rows).drop("n")
    else:
        absent = F.lit(None).cast("double")
        means = rows.groupBy(*by).agg(*means).withColumns({"avg_latency_ms": absent, "p95_latency_ms": absent})
    return means.select(
        *by,
        F.lit(label).alias("label"),
        F.lit(model_path).alias("model_path"),
        "n_samples",
        _bleu_score().alias("bleu"),
        "rouge1", "rouge2", "rougeL", "rougeLsum",
        "avg_pred_length", "avg_ref_length", _length_ratio().alias("length_ratio"),
        "avg_latency_ms", "p95_latency_ms",
    )


def with_model_scores(
    record: DataFrame, perplexity: DataFrame | None = None, match: DataFrame | None = None, by: list[str] | None = None
) -> DataFrame:
    """A metrics record with the scores that need a model's output: the perplexity of its losses
    (:func:`perplexity`) and the means of a greedy token match, as far as they are given."""
    for scores in (perplexity, match):
        if scores is not None:
            record = attach(record, scores, by or [])
    return record


# Decimals of each metric in a report.
REPORT_DIGITS = {
    "bleu": 4, "rouge1": 4, "rouge2": 4, "rougeL": 4, "rougeLsum": 4,
    "avg_pred_length": 1, "avg_ref_length": 1, "length_ratio": 3,
    "avg_latency_ms": 1, "p95_latency_ms": 1, "perplexity": 2,
    "bertscore_precision": 4, "bertscore_recall": 4, "bertscore_f1": 4,
    "avg_helpfulness": 3, "avg_accuracy": 3, "avg_professionalism": 3, "avg_composite": 3,
}


def rounded(record: DataFrame) -> DataFrame:
    """A metrics record rounded for display; computation keeps full precision."""
    return record.withColumns({
        c: F.round(c, d) for c, d in REPORT_DIGITS.items() if c in record.columns
    })
