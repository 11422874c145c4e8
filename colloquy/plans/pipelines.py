"""The three end-to-end jobs: prepare data, score predictions, judge predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed
from colloquy.operators.apply import with_replies
from colloquy.operators.clean import CleanConfig, clean
from colloquy.operators.compare import combine_records, compare
from colloquy.operators.format import to_messages
from colloquy.operators.judge import align_predictions, judge_details, judge_report, preference_prompt, rating_prompt
from colloquy.operators.metrics import metrics_for
from colloquy.operators.split import sample_n, stratified_split
from colloquy.sources.tables import read_split, read_table, write_record, write_splits, write_table


def prepare(
    raw: DataFrame, path: str, config: CleanConfig = CleanConfig(), seed: int = 42,
    system_prompt: str = fixed.SYSTEM_PROMPT,
) -> DataFrame:
    """Clean, split and format raw dialogues into ``path/dataset``, and the test rows into
    ``path/test_set``. Returns the rows per split.

    The cleaned table is written first, so the split reads it instead of cleaning again.
    """
    spark = raw.sparkSession
    write_table(clean(raw, config), f"{path}/cleaned")
    cleaned = read_table(spark, f"{path}/cleaned")
    write_splits(to_messages(stratified_split(cleaned, "intent", seed), system_prompt), f"{path}/dataset")
    write_table(read_split(spark, f"{path}/dataset", "test").drop("messages"), f"{path}/test_set")
    return read_table(spark, f"{path}/dataset").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def score(
    base: DataFrame, candidate: DataFrame, base_label: str, candidate_label: str,
    path: str | None = None,
) -> DataFrame:
    """Delta table of two prediction tables; records and comparison are written to ``path``."""
    left = metrics_for(base, base_label, base_label)
    right = metrics_for(candidate, candidate_label, candidate_label)
    if path is not None:
        spark = base.sparkSession
        write_table(left, f"{path}/base_record")
        write_table(right, f"{path}/finetuned_record")
        left = read_table(spark, f"{path}/base_record")
        right = read_table(spark, f"{path}/finetuned_record")
        write_record(left, f"{path}/base_metrics")
        write_record(right, f"{path}/finetuned_metrics")
        write_record(combine_records(left, right), f"{path}/comparison")
    return compare(left, right)


def judge(
    base: DataFrame, candidate: DataFrame, ask: Callable[[str], str], path: str, judge_model: str,
    n_samples: int = 50, seed: int = 42,
) -> DataFrame:
    """Ask for ratings and preferences on an aligned sample and report them.

    Replies are written before they are parsed: a remote judge must not be asked twice.
    """
    spark = base.sparkSession
    write_table(sample_n(base, n_samples, seed), f"{path}/judge_sample")
    sample = read_table(spark, f"{path}/judge_sample")
    aligned = preference_prompt(align_predictions(sample, candidate)).withColumns({
        "base_prompt": rating_prompt("instruction", "base_prediction"),
        "ft_prompt": rating_prompt("instruction", "ft_prediction"),
    })
    asked = aligned.select("example_id", "base_prompt", "ft_prompt", F.col("prompt").alias("pref_prompt"))
    for name in ("base", "ft", "pref"):
        asked = with_replies(asked, ask, f"{name}_prompt", f"{name}_reply", f"{name}_error")
    write_table(asked, f"{path}/judge_replies")
    replies = read_table(spark, f"{path}/judge_replies")
    write_table(judge_details(sample, candidate, replies), f"{path}/judge_details")
    report = judge_report(read_table(spark, f"{path}/judge_details"), judge_model)
    write_record(report, f"{path}/judge_results")
    return report
