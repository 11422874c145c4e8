"""Judge prompts, reply parsing, score aggregation and error logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed
from colloquy.functions.text import fill, json_object
from colloquy.operators.ranking import with_position

SCORES = ["helpfulness", "accuracy", "professionalism"]
_RATING = ", ".join(f"{s} double" for s in SCORES) + ", reasoning string, _corrupt_record string"
_PREFERENCE = "winner string, reasoning string, _corrupt_record string"


def rating_prompt(instruction: Column | str, response: Column | str) -> Column:
    a, b = (F.col(c) if isinstance(c, str) else c for c in (instruction, response))
    return fill(fixed.RATING_PROMPT, instruction=a, response=b)


def align_predictions(base: DataFrame, candidate: DataFrame) -> DataFrame:
    """Both predictions of each example with its dense position, by ``example_id``."""
    left = base.select(
        "example_id", "instruction", "intent", "category", F.col("prediction").alias("base_prediction")
    )
    right = candidate.select("example_id", F.col("prediction").alias("ft_prediction"))
    return with_position(left, "example_id").join(right, "example_id")


def preference_prompt(aligned: DataFrame) -> DataFrame:
    """Add ``prompt`` and ``swapped``: on odd positions the candidate is response A."""
    swapped = F.col("position") % 2 == 1
    a = F.when(swapped, F.col("ft_prediction")).otherwise(F.col("base_prediction"))
    b = F.when(swapped, F.col("base_prediction")).otherwise(F.col("ft_prediction"))
    return aligned.withColumns({
        "swapped": swapped,
        "prompt": fill(fixed.PREFERENCE_PROMPT, instruction=F.col("instruction"), response_a=a, response_b=b),
    })


def _parse(reply: Column | str, schema: str) -> tuple[Column, Column]:
    """The reply read as a JSON object, and whether it is one at all."""
    text = F.col(reply) if isinstance(reply, str) else reply
    options = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = F.from_json(text, schema, options)
    fields = [f.split()[0] for f in schema.split(", ") if not f.startswith("_corrupt")]
    nothing = reduce(lambda a, b: a & b, [parsed[f].isNull() for f in fields])
    whole = json_object(text).isNotNull()
    return parsed, whole & ~(nothing & parsed["_corrupt_record"].isNotNull())


def parse_rating(reply: Column | str) -> Column:
    """Struct of three scores and the reasoning; nulls and ``error`` for a broken reply.

    A quoted score is not a number and gives null.
    """
    parsed, readable = _parse(reply, _RATING)
    return F.struct(
        *[F.when(readable, parsed[s]).alias(s) for s in SCORES],
        F.when(readable, parsed["reasoning"]).otherwise("error").alias("reasoning"),
    )


def parse_preference(reply: Column | str) -> Column:
    """Struct of winner and reasoning; null and ``error`` for a broken reply."""
    parsed, readable = _parse(reply, _PREFERENCE)
    return F.struct(
        F.when(readable, parsed["winner"]).alias("winner"),
        F.when(readable, parsed["reasoning"]).otherwise("error").alias("reasoning"),
    )


def aggregate_scores(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Averages over rows with all three scores, and how many rows had them.

    A group without a valid row is left out. The composite is the mean of row means.
    """
    by = by or []
    valid = reduce(lambda a, b: a & b, [F.col(s).isNotNull() for s in SCORES])
    mean = (F.col(SCORES[0]) + F.col(SCORES[1]) + F.col(SCORES[2])) / 3
    out = df.groupBy(*by).agg(
        *[F.avg(F.when(valid, F.col(s))).alias(f"avg_{s}") for s in SCORES],
        F.avg(F.when(valid, mean)).alias("avg_composite"),
        F.count_if(valid).alias("n_valid"),
        F.count_if(~valid).alias("n_failed"),
    )
    return out.where(F.col("n_valid") > 0)


def with_preference(df: DataFrame, failed: str = "as_b") -> DataFrame:
    """Add ``preference`` (base or finetuned) from ``winner`` and ``position``.

    On even positions A is the base, on odd ones the candidate. Anything but A counts for
    B, failed verdicts too; ``failed="exclude"`` makes those null instead.
    """
    even = F.col("position") % 2 == 0
    a_wins = F.coalesce(F.col("winner") == "A", F.lit(False))
    side = F.when(a_wins == even, "base").otherwise("finetuned")
    if failed == "exclude":
        side = F.when(F.col("winner").isNotNull(), side)
    elif failed != "as_b":
        raise ValueError(f"unknown rule for failed verdicts: {failed}")
    return df.withColumn("preference", side)


def win_rate(df: DataFrame, by: list[str] | None = None, failed: str = "as_b") -> DataFrame:
    """Share of verdicts for each model; the two add up to 1."""
    by = by or []
    won = (F.col("preference") == "finetuned").cast("double")
    rates = with_preference(df, failed).groupBy(*by).agg(
        F.avg(won).alias("win_rate_finetuned"),
        F.count("preference").alias("n_preferences"),
        F.count_if(F.col("winner").isNull()).alias("n_pref_failed"),
    )
    return rates.select(
        *by, "win_rate_finetuned", (1 - F.col("win_rate_finetuned")).alias("win_rate_base"),
        "n_preferences", "n_pref_failed",
    )


def judge_details(base: DataFrame, candidate: DataFrame, replies: DataFrame, failed: str = "as_b") -> DataFrame:
    """One row per judged example with both predictions, all scores and the preference.

    ``replies``: ``example_id, base_reply, ft_reply, pref_reply`` as raw texts.
    """
    joined = align_predictions(base, candidate).join(replies, "example_id")
    parsed = joined.withColumns({
        "__base": parse_rating("base_reply"), "__ft": parse_rating("ft_reply"),
        "winner": parse_preference("pref_reply")["winner"],
    })
    return with_preference(parsed, failed).select(
        "example_id", "position", "instruction", "intent", "category", "base_prediction", "ft_prediction",
        *[F.col(f"__{m}.{s}").alias(f"{m}_{s}") for m in ("base", "ft") for s in SCORES],
        "winner", "preference",
    )


def judge_report(details: DataFrame, judge_model: str, failed: str = "as_b") -> DataFrame:
    """The result record: judge, sample size, both score aggregates, both win rates.

    Both sides are aggregated in the same pass.
    """
    def side(m: str) -> list[Column]:
        valid = reduce(lambda a, b: a & b, [F.col(f"{m}_{s}").isNotNull() for s in SCORES])
        row_mean = (F.col(f"{m}_{SCORES[0]}") + F.col(f"{m}_{SCORES[1]}") + F.col(f"{m}_{SCORES[2]}")) / 3
        return [
            *[F.avg(F.when(valid, F.col(f"{m}_{s}"))).alias(f"{m}_avg_{s}") for s in SCORES],
            F.avg(F.when(valid, row_mean)).alias(f"{m}_avg_composite"),
            F.count_if(valid).alias(f"{m}_n_valid"),
            F.count_if(~valid).alias(f"{m}_n_failed"),
        ]

    names = [f"avg_{s}" for s in SCORES] + ["avg_composite", "n_valid", "n_failed"]
    won = with_preference(details, failed)
    sums = won.agg(
        F.count(F.lit(1)).alias("n_samples"), *side("base"), *side("ft"),
        F.avg((F.col("preference") == "finetuned").cast("double")).alias("__rate"),
        F.count_if(F.col("winner").isNull()).alias("n_pref_failed"),
    )

    def record(m: str) -> Column:
        whole = F.struct(*[F.col(f"{m}_{n}").alias(n) for n in names])
        return F.when(F.col(f"{m}_n_valid") > 0, whole)

    return sums.select(
        F.lit(judge_model).alias("judge_model"), "n_samples",
        record("base").alias("base_model"), record("ft").alias("finetuned_model"),
        F.col("__rate").alias("preference_win_rate_finetuned"),
        (1 - F.col("__rate")).alias("preference_win_rate_base"),
        "n_pref_failed",
    )


def retry_seconds(message: Column | str) -> Column:
    """The wait named in a rate-limit message plus a buffer; null if none is named."""
    text = F.col(message) if isinstance(message, str) else message

    def part(group: int) -> Column:
        digits = F.regexp_replace(F.regexp_extract(text, fixed.RETRY_AFTER, group), "s$", "")
        return F.when(digits != "", digits.cast("double")).otherwise(0.0)

    wait = part(1) * 3600 + part(2) * 60 + part(3) + fixed.RETRY_BUFFER_SECONDS
    return F.when(text.rlike(fixed.RETRY_AFTER), wait)


def _any_of(text: Column, marks: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(m) for m in marks])


def classify_errors(df: DataFrame, col: str) -> DataFrame:
    """Add ``kind`` (daily_limit, rate_limit, other; null for no error), ``wait_seconds``."""
    text = F.col(col)
    limited = text.contains(fixed.RATE_LIMIT_MARKS[0]) | F.lower(text).contains(fixed.RATE_LIMIT_MARKS[1])
    daily = _any_of(text, fixed.DAILY_LIMIT_MARKS)
    kind = (
        F.when(text.isNull(), None).when(limited & daily, "daily_limit")
        .when(limited, "rate_limit").otherwise("other")
    )
    return df.withColumns({"kind": kind, "wait_seconds": retry_seconds(text)})


def error_counts(errors: DataFrame) -> DataFrame:
    """Errors and waiting time by kind."""
    return errors.where(F.col("kind").isNotNull()).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_errors"),
        F.count("wait_seconds").alias("n_with_wait"),
        F.sum("wait_seconds").alias("total_wait_seconds"),
    )
