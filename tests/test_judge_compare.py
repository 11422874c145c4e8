import pytest
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed
from colloquy.operators import compare, judge

SCORES = "helpfulness double, accuracy double, professionalism double"


def aggregate(spark, rows):
    return [r.asDict() for r in judge.aggregate_scores(spark.createDataFrame(rows, SCORES)).collect()]


def test_aggregate(spark):
    (out,) = aggregate(spark, [(4.0, 5.0, 3.0), (2.0, 3.0, 5.0)])
    assert (out["avg_helpfulness"], out["avg_accuracy"], out["avg_professionalism"]) == (3.0, 4.0, 4.0)
    assert out["avg_composite"] == pytest.approx(11 / 3)
    (out,) = aggregate(spark, [(5.0, 5.0, 5.0), (None, None, None), (3.0, None, 4.0)])
    assert (out["n_valid"], out["n_failed"], out["avg_helpfulness"]) == (1, 2, 5.0)
    assert aggregate(spark, []) == [] == aggregate(spark, [(None, None, None)])


@pytest.mark.parametrize("reply,scores,reasoning", [
    ('{"helpfulness": 4, "accuracy": 5, "professionalism": 3, "reasoning": "ok"}', (4.0, 5.0, 3.0), "ok"),
    (' {"helpfulness": 4.0, "accuracy": 3.5, "professionalism": 3}\n', (4.0, 3.5, 3.0), None),
    ('{"helpfulness": "5", "accuracy": 4, "professionalism": 4, "reasoning": "q"}', (None, 4.0, 4.0), "q"),
    ('{"accuracy": 4, "reasoning": "half"}', (None, 4.0, None), "half"),
    ("I would say 4", (None, None, None), "error"),
    ('{"helpfulness": 4, ', (None, None, None), "error"),
    ("{'helpfulness': 4}", (None, None, None), "error"),
    ("[1]", (None, None, None), "error"),
    ("", (None, None, None), "error"),
    (None, (None, None, None), "error"),
])
def test_parse_rating(spark, reply, scores, reasoning):
    r = spark.createDataFrame([(reply,)], "t string").select(judge.parse_rating("t").alias("r")).first()["r"]
    assert (r["helpfulness"], r["accuracy"], r["professionalism"]) == scores and r["reasoning"] == reasoning


def test_parse_preference(spark):
    df = spark.createDataFrame([('{"winner": "A", "reasoning": "x"}',), ("none",)], "t string")
    assert [tuple(r[0]) for r in df.select(judge.parse_preference("t")).collect()] == [("A", "x"), (None, "error")]


def test_preference_by_position_and_failure(spark):
    rows = [(0, "A", "base"), (0, "B", "finetuned"), (1, "A", "finetuned"), (1, "B", "base"),
            (0, None, "finetuned"), (1, None, "base")]
    df = spark.createDataFrame(rows, "position long, winner string, want string")
    assert all(r["preference"] == r["want"] for r in judge.with_preference(df).collect())
    rates = judge.win_rate(df).first()
    assert (rates["win_rate_finetuned"], rates["win_rate_base"], rates["n_pref_failed"]) == (0.5, 0.5, 2)
    only = judge.win_rate(df.where("position = 0"), failed="exclude").first()
    assert (only["win_rate_finetuned"], only["n_preferences"], only["n_pref_failed"]) == (0.5, 2, 1)
    with pytest.raises(ValueError):
        judge.with_preference(df, "other")


def predictions(spark, tag):
    rows = [(i * 3, f"q{i} 5%", f"r{i}", "i", "c", f"{tag}{i}") for i in range(4)]
    return spark.createDataFrame(
        rows, "example_id long, instruction string, response string, intent string, category string, prediction string"
    )


def test_prompts_swap_on_odd_positions(spark):
    aligned = judge.align_predictions(predictions(spark, "b"), predictions(spark, "f"))
    rows = judge.preference_prompt(aligned).orderBy("position").collect()
    assert [r["position"] for r in rows] == [0, 1, 2, 3]
    assert "Response A:\nb0\n" in rows[0]["prompt"] and "Response A:\nf1\n" in rows[1]["prompt"]
    assert rows[0]["prompt"].endswith('{"winner": "A" or "B", "reasoning": "brief explanation"}')
    text = aligned.select(judge.rating_prompt("instruction", "ft_prediction")).orderBy("example_id").first()[0]
    assert "Customer question: q0 5%\n" in text and "Response to evaluate:\nf0\n" in text
    assert '{"helpfulness": X, "accuracy": X,' in text


def test_report_without_valid_scores(spark):
    replies = spark.createDataFrame(
        [(i * 3, "bad", '{"helpfulness": 5, "accuracy": 5, "professionalism": 2}', "bad") for i in range(4)],
        "example_id long, base_reply string, ft_reply string, pref_reply string",
    )
    details = judge.judge_details(predictions(spark, "b"), predictions(spark, "f"), replies)
    report = judge.judge_report(details, "j").first()
    assert report["base_model"] is None and report["finetuned_model"]["avg_composite"] == 4.0
    assert (report["n_samples"], report["preference_win_rate_finetuned"], report["n_pref_failed"]) == (4, 0.5, 4)


@pytest.mark.parametrize("message,kind,wait", [
    ("Error 429: try again in 6m14.976s", "rate_limit", 6 * 60 + 14.976 + 5),
    ("429 try again in 1h2m3s", "rate_limit", 3600 + 120 + 3 + 5),
    ("429 try again in a while", "rate_limit", 5.0),
    ("429 slow down", "rate_limit", None),
    ("Rate_Limit: tokens per day", "daily_limit", None),
    ("429 TPD, try again in 7s", "daily_limit", 12.0),
    ("tokens per day", "other", None),
    ("timeout", "other", None),
    (None, None, None),
])
def test_errors(spark, message, kind, wait):
    row = judge.classify_errors(spark.createDataFrame([(message,)], "m string"), "m").first()
    assert row["kind"] == kind
    assert row["wait_seconds"] == (None if wait is None else pytest.approx(wait))


def record(spark, **values):
    return spark.range(1).select(*[F.lit(v).cast("double").alias(k) for k, v in values.items()])


def test_compare_directions_and_nulls(spark):
    base = record(spark, bleu=0.1, rouge1=0.0, rouge2=0.5, avg_pred_length=10.0, avg_latency_ms=None)
    cand = record(spark, bleu=0.2, rouge1=0.3, rouge2=0.5, avg_pred_length=12.0, avg_latency_ms=5.0)
    rows = {r["metric"]: r for r in compare.compare(base, cand).collect()}
    assert set(rows) == {"bleu", "rouge1", "rouge2", "avg_pred_length"}
    assert rows["bleu"]["pct"] == pytest.approx(100.0) and rows["bleu"]["verdict"] == "better"
    assert rows["rouge1"]["pct"] == 0.0 and rows["rouge1"]["verdict"] == "better"
    assert rows["rouge2"]["verdict"] == "same" and rows["avg_pred_length"]["verdict"] == "worse"


def test_compare_by_slice(spark):
    base = record(spark, bleu=0.1).withColumn("intent", F.lit(None).cast("string"))
    cand = record(spark, bleu=0.3).withColumn("intent", F.lit(None).cast("string"))
    assert compare.compare(base, cand, by=["intent"]).first()["delta"] == pytest.approx(0.2)


def test_compare_judge_missing_is_zero_and_same_is_worse(spark):
    base = record(spark, avg_helpfulness=4.0, avg_accuracy=3.0, avg_professionalism=5.0, avg_composite=4.0)
    rows = {r["metric"]: r for r in compare.compare_judge(base, base).collect()}
    assert {r["verdict"] for r in rows.values()} == {"worse"}
    empty = compare.compare_judge(base.where("false"), base).collect()
    assert {r["metric"]: r["delta"] for r in empty}["avg_accuracy"] == 3.0


def test_combine_and_leaderboard(spark):
    a = record(spark, bleu=0.1, rougeL=0.2).withColumn("label", F.lit("a"))
    b = record(spark, bleu=0.3, perplexity=3.8).withColumn("label", F.lit("b"))
    both = compare.combine_records(a, b).first()
    assert both["base"]["label"] == "a" and both["finetuned"]["perplexity"] == 3.8
    scores = spark.createDataFrame([("b", 4.5, 0.4), ("c", 4.0, 0.6)], "label string, avg_composite double, win_rate double")
    board = compare.leaderboard(compare.stack_records(a, b), scores, display=True)
    rows = {r["label"]: r for r in board.collect()}
    assert rows["a"]["perplexity"] == "N/A" == rows["a"]["win_rate"] and rows["b"]["perplexity"] == "3.8"
    assert rows["c"]["bleu"] == "N/A"
    plain = compare.leaderboard(compare.stack_records(a, b), scores)
    turned = {r["metric"]: r for r in compare.leaderboard_by_metric(plain, ["a", "b", "c"]).collect()}
    assert turned["bleu"]["b"] == 0.3 and turned["win_rate"]["a"] is None


def test_example_sheet(spark):
    base = predictions(spark, "b").withColumn("intent", F.when(F.col("example_id") > 0, "i"))
    rows = compare.example_sheet(base, predictions(spark, "f")).collect()
    assert len(rows) == 3 and all(r["ft_prediction"][1:] == r["base_prediction"][1:] for r in rows)


def test_reply_with_more_than_one_object_is_broken(spark):
    good = '{"helpfulness": 4, "accuracy": 5, "professionalism": 3, "reasoning": "ok"}'
    table = spark.createDataFrame([(0, good), (1, good + ' {"z":1}'), (2, good + "]"), (3, " " + good + "\n")], "id int, reply string")
    rows = table.select("id", judge.parse_rating("reply").alias("r")).orderBy("id").collect()
    assert [r["r"]["helpfulness"] for r in rows] == [4.0, None, None, 4.0]


def test_nan_is_skipped(spark):
    base = spark.createDataFrame([(float("nan"), 1.0)], "bleu double, rouge1 double")
    tuned = spark.createDataFrame([(0.5, 2.0)], "bleu double, rouge1 double")
    assert [r["metric"] for r in compare.compare(base, tuned).collect()] == ["rouge1"]


def test_run_attributes_of_nested_configurations(spark):
    configs = spark.createDataFrame([
        ("a", '{"lora": {"r": 16, "modules": ["q", "v"]}, "lr": 2e-4}'), ("b", '{"lora": {}, "lr": "high"}'), ("c", "not json"), ("d", None)], "label string, config string")
    paths = {"rank": "$.lora.r bigint", "second": "$.lora.modules[1] string", "rate": "$.lr double"}
    rows = {r["label"]: (r["rank"], r["second"], r["rate"]) for r in compare.run_attributes(configs, paths).collect()}
    assert rows == {"a": (16, "v", 0.0002), "b": (None, None, None), "c": (None, None, None), "d": (None, None, None)}
    board = compare.leaderboard(record(spark, bleu=0.1).withColumn("label", F.lit("a")), attributes=compare.run_attributes(configs, paths))
    assert board.first()["rank"] == 16
    turned = {r["metric"]: r["a"] for r in compare.leaderboard_by_metric(board, ["a"]).collect()}
    assert turned["rank"] == 16.0 and "second" not in turned


def test_each_candidate_with_the_base(spark):
    scores = spark.createDataFrame([("a", 4.0, 4.0, 4.0, 4.0), ("b", 5.0, 3.0, 4.0, 4.0), ("c", None, 1.0, 1.0, 1.0)], "label string, " + ", ".join(f"{m} double" for m in fixed.JUDGE_METRICS))
    rows = compare.compare_judge(scores.where("label = 'a'"), scores.where("label != 'a'"), ["label"]).collect()
    got = {(r["label"], r["metric"]): (r["base"], r["candidate"], r["verdict"]) for r in rows}
    assert len(got) == 8 and got["b", "avg_helpfulness"] == (4.0, 5.0, "better") and got["c", "avg_helpfulness"] == (4.0, 0.0, "worse")


def test_nothing_runs_while_positions_are_planned(spark):
    context = spark.sparkContext
    context.setJobGroup("planning", "no job may run")
    try:
        aligned = judge.align_predictions(predictions(spark, "b"), predictions(spark, "f"))
        jobs = context.statusTracker().getJobIdsForGroup("planning")
    finally:
        context._jsc.clearJobGroup()
    assert list(jobs) == [] and aligned.count() == predictions(spark, "b").count()
