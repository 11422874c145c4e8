import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from colloquy.operators import apply, judge, support
from colloquy.operators.clean import clean_stateless
from colloquy.plans import pipelines
from colloquy.session import ensure_checkpoint_dir
from colloquy.sources import tables
from colloquy.streaming import stateless


@pytest.fixture(scope="module")
def dialogues(spark):
    return spark.range(300).select(
        F.col("id").alias("example_id"),
        F.concat(F.lit("How do I do  thing "), F.col("id").cast("string")).alias("instruction"),
        F.concat(F.lit("You can do it like this, step by step: é "), F.col("id").cast("string")).alias("response"),
        F.concat(F.lit("i"), (F.col("id") % 5).cast("string")).alias("intent"), F.lit("c").alias("category"),
        F.when(F.col("id") % 2 == 0, "BL").otherwise("L").alias("flags"),
    )


def test_missing_table_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        tables.read_table(spark, str(tmp_path / "none"))


def test_splits_are_pruned_on_read(spark, dialogues, tmp_path):
    path = str(tmp_path / "splits")
    tables.write_splits(dialogues.withColumn("split", F.when(F.col("example_id") < 30, "test").otherwise("train")), path)
    test = tables.read_split(spark, path, "test")
    assert test.count() == 30 and "split" not in test.columns
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_spread_only_for_few_files(spark, dialogues, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    tables.write_table(dialogues.coalesce(1), one)
    tables.write_table(dialogues.repartition(12), many)
    assert "REPARTITION" in tables.read_table(spark, one, spread=True)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION" not in tables.read_table(spark, many, spread=True)._jdf.queryExecution().executedPlan().toString()
    assert tables.read_table(spark, one, ["intent"]).columns == ["intent"]


def test_records_keep_nulls_and_non_ascii(spark, tmp_path):
    path = str(tmp_path / "record")
    tables.write_record(spark.createDataFrame([("é 😀", None)], "label string, perplexity double"), path)
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "record").glob("*.json"))
    assert text.strip() == '{"label":"é 😀","perplexity":null}'


def test_first_existing_json_wins(spark, tmp_path):
    (tmp_path / "b.json").write_text('[{"a": 1},\n {"a": 2}]')
    paths = [str(tmp_path / "a.json"), str(tmp_path / "b.json")]
    assert sorted(r["a"] for r in tables.read_json_records(spark, paths, "a int").collect()) == [1, 2]
    assert tables.read_json_records(spark, paths[:1], "a int").count() == 0


def test_predictions_and_replies(dialogues):
    out = apply.with_predictions(dialogues, lambda texts: [t.upper() for t in texts], batch_rows=7)
    row = out.orderBy("example_id").first()
    assert row["prediction"] == "HOW DO I DO  THING 0" and row["latency_ms"] >= 0 and out.count() == 300

    def fails_on_seven(prompt):
        if prompt.endswith("7"):
            raise ValueError("429 try again in 3s")
        return '{"helpfulness": 1, "accuracy": 2, "professionalism": 3}'

    replies = judge.classify_errors(apply.with_replies(dialogues, fails_on_seven, "instruction"), "error")
    assert replies.where("kind = 'rate_limit' and wait_seconds = 8").count() == 30
    assert replies.where("reply is not null and error is null").count() == 270


def test_wrong_number_of_predictions_is_an_error(dialogues):
    with pytest.raises(Exception, match="one prediction per text"):
        apply.with_predictions(dialogues, lambda texts: [], batch_rows=10).count()


def test_stream_gives_the_batch_result(spark, dialogues, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    tables.write_table(dialogues.repartition(3), source)
    stream = spark.readStream.schema(dialogues.schema).parquet(source)
    prepared = stateless.prepare_stream(stream)
    called = support.with_tool_call(prepared, "response").withColumn("r", judge.parse_rating("response"))
    query = stateless.append_to(called, sink, str(tmp_path / "state"), available_now=True)
    query.awaitTermination(120)
    got = spark.read.parquet(sink)
    assert got.count() == clean_stateless(dialogues).count() == 300
    assert got.where("tool is null and r.reasoning = 'error' and has_quality_flag").count() == 150


def test_prepare_job(spark, dialogues, tmp_path):
    sizes = {r["split"]: r["n"] for r in pipelines.prepare(dialogues, str(tmp_path / "job")).collect()}
    assert sizes == {"train": 240, "validation": 30, "test": 30}
    test = tables.read_table(spark, str(tmp_path / "job/test_set"))
    assert test.count() == 30 and test.first()["instruction"].startswith("How do I do thing")


def test_score_and_judge_jobs(spark, dialogues, tmp_path):
    base = dialogues.withColumn("prediction", F.lit("You can do it like that")).withColumn("latency_ms", F.lit(5.0))
    tuned = base.withColumn("prediction", F.col("response"))
    rows = {r["metric"]: r for r in pipelines.score(base, tuned, "base", "tuned", str(tmp_path / "s")).collect()}
    assert rows["bleu"]["candidate"] == pytest.approx(1.0) and rows["rougeL"]["verdict"] == "better"
    assert spark.read.json(str(tmp_path / "s/comparison")).first()["finetuned"]["label"] == "tuned"

    def ask(prompt):
        if "comparing" in prompt:
            return '{"winner": "A", "reasoning": "first"}'
        return '{"helpfulness": 4, "accuracy": 4, "professionalism": 5, "reasoning": "fine"}'

    report = pipelines.judge(base, tuned, ask, str(tmp_path / "j"), "stub", n_samples=20).first()
    assert report["n_samples"] == 20 and report["preference_win_rate_base"] == 0.5
    assert report["base_model"]["n_valid"] == 20


def test_checkpoint_dir_comes_from_the_session(spark):
    assert ensure_checkpoint_dir(spark)
