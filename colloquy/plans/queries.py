"""The registered queries: each operator applied to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators import (
    apply, clean, compare, embeddings, format, judge, metrics, profile, ranking, split, support, turns,
)
from colloquy.plans import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Digits kept where floating-point results are compared across engines.
DIGITS = 6


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def near(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), DIGITS) for c in cols})


def _long(c: str) -> F.Column:
    return F.col(c).cast("bigint").alias(c)


def _record_columns(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return near(df, *doubles)


# ---------------------------------------------------------------- sources and profiling

@query
def scan_table(spark, d):
    return views.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")


@query
def profile_basic(spark, d):
    return near(profile.profile_basic(views.dialogues(spark, d)), "avg_instruction_len", "avg_response_len")


@query
def profile_record(spark, d):
    out = profile.profile(views.dialogues(spark, d))
    return near(
        out.select(
            "n_rows", _long("n_columns"), "n_intent", "n_category", "avg_instruction_len", "avg_response_len",
            F.col("null_counts.flags").alias("null_flags"),
            F.array_join("constant_columns", ",").alias("constant_columns"),
            F.array_join(
                F.transform(F.map_entries("flag_distribution"),
                            lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ","
            ).alias("flag_distribution"),
        ),
        "avg_instruction_len", "avg_response_len",
    )


@query
def null_counts(spark, d):
    return profile.null_counts(views.dialogues(spark, d))


@query
def value_counts_topk(spark, d):
    return near(profile.value_counts(views.dialogues(spark, d), "intent", 10), "share_pct")


@query
def value_counts_all(spark, d):
    return near(profile.value_counts(views.dialogues(spark, d), "category"), "share_pct")


@query
def flag_chars(spark, d):
    return profile.char_counts(views.dialogues(spark, d), "flags")


@query
def length_histogram(spark, d):
    return near(profile.histogram(views.dialogues(spark, d), "response", 50), "low", "high")


@query
def dimension_values(spark, d):
    return profile.dimension_values(views.dialogues(spark, d), "intent")


# ---------------------------------------------------------------- cleaning

@query
def drop_missing(spark, d):
    return clean.drop_missing(views.dialogues(spark, d), ["flags"]).select("example_id", "flags")


@query
def min_length(spark, d):
    out = clean.min_length(views.dialogues(spark, d), {"response": 20, "instruction": 5})
    return out.select("example_id", _length("response"))


def _length(c: str) -> F.Column:
    return F.length(c).cast("bigint").alias(f"{c}_chars")


@query
def normalize_ws(spark, d):
    return clean.normalize_text(views.pairs(spark, d), ["instruction", "response"]).select(
        "example_id", "instruction", "response"
    )


@query
def quality_flag(spark, d):
    return clean.with_quality_flag(views.dialogues(spark, d)).select("example_id", "flags", "has_quality_flag")


@query
def dedup_first(spark, d):
    out = clean.dedup_first(views.dialogues(spark, d), ["instruction", "response"], "example_id")
    return out.select("example_id", "intent", "category", "flags")


@query
def with_position(spark, d):
    return ranking.with_position(views.pairs(spark, d), "example_id").select("example_id", "position")


@query
def clean_audit(spark, d):
    return near(clean.clean_audit(views.dialogues(spark, d)), "removed_pct")


@query
def clean_pipeline(spark, d):
    return clean.clean(views.dialogues(spark, d)).select(
        "example_id", "instruction", "response", "has_quality_flag", "intent"
    )


@query
def clean_without_flags(spark, d):
    config = clean.CleanConfig(flags=None, recheck_length=True)
    return clean.clean(views.pairs(spark, d), config).select("example_id", "instruction", "response")


@query
def select_columns(spark, d):
    return views.pred_base(spark, d).select("instruction", "response", "intent", "category")


@query
def pick_example(spark, d):
    return clean.pick_example(views.pairs(spark, d), "intent_3").select("example_id", "instruction", "label")


# ---------------------------------------------------------------- turns and formats

@query
def pairs_from_turns(spark, d):
    return turns.pairs_from_turns(views.table(spark, d, "conversations"))


@query
def assemble_history(spark, d):
    out = turns.assemble_history(
        views.table(spark, d, "conversations"), turns.agent_system_text(), views.tool_results(spark, d)
    )
    return out.select(
        "conv_id", F.size("messages").cast("bigint").alias("n_messages"),
        F.array_join(
            F.transform("messages", lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|"
        ).alias("messages"),
    )


@query
def history_turns(spark, d):
    rows = turns.history_rows(
        views.table(spark, d, "conversations"), turns.agent_system_text(), views.tool_results(spark, d)
    )
    return rows.select("conv_id", _long("turn"), "role", "content")


@query
def render_transcript(spark, d):
    out = turns.assemble_history(views.table(spark, d, "conversations"), "Be brief.")
    return out.select("conv_id", format.render_transcript("messages").alias("transcript"))


@query
def to_messages(spark, d):
    out = format.to_messages(views.pairs(spark, d))
    return out.select(
        "example_id", "intent", "category",
        *[F.col("messages")[i]["role"].alias(f"role_{i}") for i in range(3)],
        *[F.col("messages")[i]["content"].alias(f"content_{i}") for i in range(3)],
    )


@query
def render_chat(spark, d):
    out = format.to_messages(views.pairs(spark, d))
    return out.select("example_id", format.render_chat("messages").alias("text"))


@query
def render_prompt(spark, d):
    return views.pairs(spark, d).select(
        "example_id",
        *[format.render_prompt("instruction", s).alias(s) for s in ("plain", "labelled", "chat")],
    )


@query
def render_pair(spark, d):
    return views.pairs(spark, d).select("example_id", format.render_pair("instruction", "response").alias("text"))


# ---------------------------------------------------------------- splits and samples

@query
def stratified_split(spark, d):
    return split.stratified_split(views.dialogues(spark, d), "intent", 42).select("example_id", "intent", "split")


@query
def split_quotas(spark, d):
    return split.split_quotas(views.dialogues(spark, d), "intent")


@query
def split_by_hash(spark, d):
    out = split.stratified_split(views.dialogues(spark, d), "intent", 42, method="hash_threshold")
    return out.select("example_id", "split")


@query
def sample_n(spark, d):
    return split.sample_n(views.pred_base(spark, d), 100, 42).select("example_id", "prediction")


@query
def sample_n_ranked(spark, d):
    events = views.table(spark, d, "events")
    return split.sample_n(events, 10_001, 7, "event_id").select("event_id", "event_type")


@query
def sample_aligned(spark, d):
    cols = ["example_id", "instruction", "prediction"]
    return split.sample_aligned(
        views.pred_base(spark, d).select(*cols), views.pred_ft(spark, d).select(*cols), 50, 42,
        shared=("instruction",),
    )


@query
def sample_per_group(spark, d):
    return split.sample_per_group(views.dialogues(spark, d), "intent", 2, 42).select("example_id", "intent")


@query
def head_n(spark, d):
    return split.head_n(views.pairs(spark, d), 50).select("example_id", "instruction")


# ---------------------------------------------------------------- metrics

@query
def rouge_1(spark, d):
    return near(metrics.rouge_n(views.pred_ft(spark, d), "prediction", "response", 1), "rouge1")


@query
def rouge_2(spark, d):
    return near(metrics.rouge_n(views.pred_ft(spark, d), "prediction", "response", 2), "rouge2")


@query
def rouge_rows(spark, d):
    rows = metrics.with_rouge_n(views.pred_base(spark, d), "prediction", "response")
    return near(rows.select("example_id", "rouge1", "rouge2"), "rouge1", "rouge2")


@query
def rouge_l(spark, d):
    return near(metrics.rouge_l(views.pred_base(spark, d), "prediction", "response"), "rougeL")


@query
def rouge_lsum(spark, d):
    return near(metrics.rouge_lsum(views.pred_base(spark, d), "prediction", "response"), "rougeLsum")


@query
def bleu(spark, d):
    return near(metrics.bleu(views.pred_ft(spark, d), "prediction", "response"), "bleu")


@query
def bleu_by_intent(spark, d):
    return near(metrics.bleu(views.pred_ft(spark, d), "prediction", "response", ["intent"]), "bleu")


@query
def bleu_documents(spark, d):
    return near(metrics.bleu(views.doc_predictions(spark, d), "prediction", "response", ["category"]), "bleu")


@query
def length_stats(spark, d):
    out = metrics.length_stats(views.pred_base(spark, d), "prediction", "response", ["category"])
    return near(out, "avg_pred_length", "avg_ref_length", "length_ratio")


@query
def latency_stats(spark, d):
    return near(metrics.latency_stats(views.latency(spark, d)), "avg_latency_ms", "p95_latency_ms")


@query
def latency_stats_by_label(spark, d):
    out = metrics.latency_stats(views.latency(spark, d), by=["label"])
    return near(out, "avg_latency_ms", "p95_latency_ms")


@query
def latency_summary(spark, d):
    return _record_columns(metrics.latency_summary(views.latency(spark, d), by=["label"]))


@query
def latency_details(spark, d):
    return metrics.latency_details(views.latency(spark, d), keep=("event_id", "prompt", "response"))


@query
def perplexity(spark, d):
    losses = views.latency(spark, d).withColumn("loss", F.col("latency_ms") / 100)
    return near(metrics.perplexity(losses, "loss", ["label"]), "perplexity")


@query
def perplexity_weighted(spark, d):
    losses = views.latency(spark, d).withColumn("loss", F.col("latency_ms") / 100)
    return near(metrics.perplexity(losses, "loss", ["label"], "response_tokens"), "perplexity")


@query
def greedy_match(spark, d):
    cand, ref = views.token_vectors(spark, d)
    return near(embeddings.greedy_match(cand, ref), "precision", "recall", "f1")


@query
def greedy_match_means(spark, d):
    cand, ref = views.token_vectors(spark, d)
    return _record_columns(embeddings.greedy_match_means(embeddings.greedy_match(cand, ref)))


@query
def metrics_for(spark, d):
    return _record_columns(metrics.metrics_for(views.pred_base(spark, d), "base", "models/base"))


@query
def metrics_rounded(spark, d):
    record = _simple_record(views.pred_base(spark, d), "base")
    return metrics.rounded(record)


@query
def metrics_extended(spark, d):
    """A whole record with perplexity and the greedy-match means beside the text metrics."""
    losses = views.latency(spark, d).withColumn("loss", F.col("latency_ms") / 100)
    cand, ref = views.token_vectors(spark, d)
    return _record_columns(metrics.with_model_scores(
        metrics.metrics_for(views.pred_base(spark, d), "base", "models/base"), metrics.perplexity(losses, "loss"),
        embeddings.greedy_match_means(embeddings.greedy_match(cand, ref)),
    ))


@query
def metrics_by_slice(spark, d):
    return _record_columns(metrics.metrics_for(views.pred_base(spark, d), "base", "models/base", ["category"]))


@query
def metrics_documents(spark, d):
    """Long texts: the record of documents scored against their own first halves."""
    return _record_columns(metrics.metrics_for(views.doc_predictions(spark, d), "half", "models/half", ["category"]))


# ---------------------------------------------------------------- comparisons

def _simple_record(df: DataFrame, label: str) -> DataFrame:
    """The parts of a record that need no LCS."""
    lengths = metrics.length_stats(df, "prediction", "response")
    times = metrics.latency_stats(df)
    record = metrics.attach(metrics.attach(metrics.bleu(df, "prediction", "response"), lengths, []), times, [])
    return record.withColumn("label", F.lit(label))


@query
def compare_models(spark, d):
    out = compare.compare(
        _simple_record(views.pred_base(spark, d), "base"), _simple_record(views.pred_ft(spark, d), "tuned")
    )
    return near(out, "base", "candidate", "delta", "pct")


@query
def compare_full(spark, d):
    """The flagship: both models scored on every metric and compared."""
    base = metrics.metrics_for(views.pred_base(spark, d), "base", "models/base")
    tuned = metrics.metrics_for(views.pred_ft(spark, d), "tuned", "models/tuned")
    return near(compare.compare(base, tuned), "base", "candidate", "delta", "pct")


@query
def combine_records(spark, d):
    out = compare.combine_records(
        _simple_record(views.pred_base(spark, d), "base"), _simple_record(views.pred_ft(spark, d), "tuned")
    )
    return out.select(
        F.col("base.label").alias("base_label"), F.round("base.bleu", DIGITS).alias("base_bleu"),
        F.col("finetuned.label").alias("finetuned_label"),
        F.round("finetuned.length_ratio", DIGITS).alias("finetuned_length_ratio"),
    )


# What the board shows of a run's configuration.
ATTRIBUTES = {"base_model": "$.model.base string", "rank": "$.lora.r bigint", "first_module": "$.lora.target_modules[0] string", "learning_rate": "$.training.learning_rate double"}


def _board(spark, d) -> DataFrame:
    """Every label is a run: a fifth of the pairs, its losses, its token vectors, its judged replies and its configuration."""
    rows = views.pred_base(spark, d).withColumn("run", views.label_of(F.col("example_id")))
    records = metrics.metrics_for(rows, "run", "models/run", ["run"]).drop("label").withColumnRenamed("run", "label")
    losses = views.latency(spark, d).withColumn("loss", F.col("latency_ms") / 100)
    cand, ref = views.token_vectors(spark, d)
    match = embeddings.greedy_match(cand, ref).withColumn("label", views.label_of(F.col("pair_id")))
    records = metrics.with_model_scores(
        records, metrics.perplexity(losses, "loss", ["label"]), embeddings.greedy_match_means(match, ["label"]), ["label"]
    )
    scored = _judged(spark, d, ["label"]).select("label", "avg_composite")
    attributes = compare.run_attributes(views.run_configs(spark, d), ATTRIBUTES)
    return compare.leaderboard(records, scored, judge_columns=("avg_composite",), attributes=attributes)


def _judged(spark, d, by) -> DataFrame:
    parsed = views.replies(spark, d).select("label", judge.parse_rating("rating_reply").alias("r"))
    return judge.aggregate_scores(parsed.select("label", "r.*"), by)


@query
def leaderboard(spark, d):
    return _record_columns(_board(spark, d))


@query
def leaderboard_by_metric(spark, d):
    return near(compare.leaderboard_by_metric(_board(spark, d), views.LABELS), *views.LABELS)


@query
def compare_judge(spark, d):
    scored = _judged(spark, d, ["label"])
    out = compare.compare_judge(scored.where("label = 'click'"), scored.where("label != 'click'"), ["label"])
    return near(out, "base", "candidate", "delta")


@query
def example_sheet(spark, d):
    return compare.example_sheet(views.pred_base(spark, d), views.pred_ft(spark, d))


# ---------------------------------------------------------------- judge

@query
def rating_prompt(spark, d):
    return views.pred_base(spark, d).select(
        "example_id", judge.rating_prompt("instruction", "prediction").alias("prompt")
    )


@query
def preference_prompt(spark, d):
    aligned = judge.align_predictions(views.pred_base(spark, d), views.pred_ft(spark, d))
    return judge.preference_prompt(aligned).select("example_id", "position", "swapped", "prompt")


@query
def parse_rating(spark, d):
    return views.replies(spark, d).select("example_id", judge.parse_rating("rating_reply").alias("r")).select(
        "example_id", "r.*"
    )


@query
def parse_preference(spark, d):
    return views.replies(spark, d).select("example_id", judge.parse_preference("pref_reply").alias("p")).select(
        "example_id", "p.*"
    )


@query
def aggregate_scores(spark, d):
    return _record_columns(_judged(spark, d, ["label"]))


@query
def win_rate(spark, d):
    verdicts = views.replies(spark, d).select(
        "label", F.col("example_id").alias("position"), judge.parse_preference("pref_reply")["winner"].alias("winner")
    )
    return _record_columns(judge.win_rate(verdicts, ["label"]))


@query
def win_rate_strict(spark, d):
    verdicts = views.replies(spark, d).select(
        F.col("example_id").alias("position"), judge.parse_preference("pref_reply")["winner"].alias("winner")
    )
    return _record_columns(judge.win_rate(verdicts, failed="exclude"))


def _details(spark, d) -> DataFrame:
    return judge.judge_details(
        views.pred_base(spark, d), views.pred_ft(spark, d), views.pair_replies(spark, d)
    )


@query
def judge_details(spark, d):
    return _details(spark, d).drop("instruction", "base_prediction", "ft_prediction")


@query
def judge_report(spark, d):
    out = judge.judge_report(_details(spark, d), "recorded")
    return _record_columns(out.select(
        "judge_model", "n_samples",
        F.col("base_model.avg_composite").alias("base_composite"),
        F.col("finetuned_model.avg_composite").alias("ft_composite"),
        F.col("finetuned_model.avg_helpfulness").alias("ft_helpfulness"),
        F.col("base_model.n_failed").alias("base_n_failed"),
        "preference_win_rate_finetuned", "preference_win_rate_base", "n_pref_failed",
    ))


@query
def classify_errors(spark, d):
    return judge.classify_errors(views.judge_errors(spark, d), "message").select("example_id", "kind", "wait_seconds")


@query
def error_counts(spark, d):
    return judge.error_counts(judge.classify_errors(views.judge_errors(spark, d), "message"))


# ---------------------------------------------------------------- support

@query
def tool_calls(spark, d):
    calls = support.with_tool_call(views.agent_texts(spark, d))
    return calls.select(
        "request_id", "tool",
        F.array_join(F.transform(F.array_sort(F.map_entries("args")),
                                 lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("args"),
    )


@query
def tool_usage(spark, d):
    return support.tool_usage(support.with_tool_call(views.agent_texts(spark, d)))


@query
def tool_call_validity(spark, d):
    calls = support.with_tool_call(views.agent_texts(spark, d))
    return support.check_tool_calls(calls).select("request_id", "tool", "code", "error")


@query
def call_requests(spark, d):
    calls = support.with_tool_call(views.agent_texts(spark, d))
    out = support.requests_from_calls(calls)
    return out.select("*", F.col("amount").cast("double").alias("asked")).drop("amount")


@query
def call_outcomes(spark, d):
    calls = support.with_tool_call(views.agent_texts(spark, d))
    return support.call_outcomes(calls, views.order_state(spark, d), views.account_state(spark, d), views.AS_OF)


@query
def invalid_tool_calls(spark, d):
    calls = support.with_tool_call(views.agent_texts(spark, d))
    return support.invalid_tool_calls(calls).select("request_id", "tool", "code")


def _requests(spark, d, *cols: str) -> DataFrame:
    return views.requests(spark, d).select("request_id", *cols)


@query
def order_lookup(spark, d):
    out = support.order_lookup(_requests(spark, d, "order_id"), views.order_state(spark, d))
    return out.withColumn("items", F.concat(F.col("items")[0]["name"], F.lit("x"), F.col("items")[0]["quantity"].cast("string")))


@query
def address_change(spark, d):
    return support.address_change(_requests(spark, d, "order_id", "new_address"), views.order_state(spark, d))


@query
def cancel_order(spark, d):
    return support.cancel_order(_requests(spark, d, "order_id"), views.order_state(spark, d), views.AS_OF)


@query
def return_eligibility(spark, d):
    return support.return_eligibility(_requests(spark, d, "order_id"), views.order_state(spark, d), views.AS_OF)


@query
def account_lookup(spark, d):
    return support.account_lookup(_requests(spark, d, "email"), views.account_state(spark, d))


@query
def account_unlock(spark, d):
    return support.account_unlock(_requests(spark, d, "email"), views.account_state(spark, d), views.AS_OF)


@query
def plan_change(spark, d):
    return support.plan_change(_requests(spark, d, "email", "new_plan"), views.account_state(spark, d))


@query
def cancel_subscription(spark, d):
    return support.cancel_subscription(_requests(spark, d, "email"), views.account_state(spark, d), views.AS_OF)


@query
def refund_routing(spark, d):
    return support.refund_routing(
        _requests(spark, d, "email", "order_id", "amount"), views.account_state(spark, d), views.AS_OF
    )


def _decided(spark, d) -> DataFrame:
    return support.adjudicate(
        views.requests(spark, d), views.order_state(spark, d), views.account_state(spark, d), views.AS_OF
    )


@query
def adjudicate(spark, d):
    return _decided(spark, d).select("request_id", "action", "success", "code", "refund_amount")


@query
def adjudication_summary(spark, d):
    return support.adjudication_summary(_decided(spark, d)).withColumn(
        "refund_amount", F.col("refund_amount").cast("double")
    )


# ---------------------------------------------------------------- user functions

def echo_model(texts: list[str]) -> list[str]:
    """A stand-in model: the text backwards."""
    return [t[::-1] for t in texts]


def stub_judge(prompt: str) -> str:
    """A stand-in judge that fails on some prompts."""
    if len(prompt) % 5 == 0:
        raise RuntimeError("Error 429: try again in 2s")
    return '{"helpfulness": 4, "accuracy": 3.5, "professionalism": %d, "reasoning": "ok"}' % (len(prompt) % 5 + 1)


@query
def with_predictions(spark, d):
    out = apply.with_predictions(
        views.pairs(spark, d).select("example_id", "instruction"), echo_model, batch_rows=64
    )
    return out.select("example_id", "prediction", (F.col("latency_ms") >= 0).alias("timed"))


@query
def with_replies(spark, d):
    prompts = views.pairs(spark, d).select("example_id", F.col("instruction").alias("prompt"))
    out = judge.classify_errors(apply.with_replies(prompts, stub_judge), "error")
    return out.select(
        "example_id", judge.parse_rating("reply")["professionalism"].alias("professionalism"), "kind", "wait_seconds"
    )
