import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from colloquy.operators import clean, profile

ROWS = [
    (0, "How do I cancel my order?", "You can cancel it from the orders page.", "cancel_order", "ORDER", "B"),
    (1, "Where is my refund?", "Refunds take three to five business days.", "track_refund", "REFUND", "Z"),
    (2, "Hi", "OK", "greet", "OTHER", ""),
    (3, "I need help with my account", "Please tell us what is wrong with it.", "account", "ACCOUNT", "BIK"),
    (4, "Where is my refund?", "Refunds take three to five business days.", "track_refund", "REFUND", "Q"),
    (5, "Change my address please", "Open the profile page and edit the address.", "address", "ACCOUNT", "P"),
    (6, "Can I pay by card instead?", "Yes, every major card is accepted here.", "payment", "PAYMENT", None),
]
SCHEMA = "example_id long, instruction string, response string, intent string, category string, flags string"


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_pipeline_drops_short_and_duplicate_rows(raw):
    out = {r["example_id"]: r for r in clean.clean(raw).collect()}
    assert sorted(out) == [0, 1, 3, 5, 6]
    assert [out[i]["has_quality_flag"] for i in (0, 1, 3, 5, 6)] == [True, False, True, False, False]


def test_result_does_not_depend_on_partitioning(raw):
    a = {tuple(r) for r in clean.clean(raw.repartition(5)).collect()}
    assert a == {tuple(r) for r in clean.clean(raw.coalesce(1).orderBy(F.desc("example_id"))).collect()}


def test_nulls_are_dropped(spark):
    df = spark.createDataFrame(
        [(0, None, "a long enough response here", "i", "c", "B"), (1, "question", None, "i", "c", "B")], SCHEMA
    )
    assert clean.clean(df).count() == 0


@pytest.mark.parametrize("text,expected", [
    ("  Hello   world  ", "Hello world"),
    (" Hello 　world\u0085", "Hello world"),
    ("Hello\x1c\x1f\t\nworld", "Hello world"),
    ("", ""),
    (" \n ", ""),
])
def test_white_space(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert clean.normalize_text(df, ["t"]).first()["t"] == expected == " ".join(text.split())


def test_padded_short_text_survives_unless_rechecked(spark):
    df = spark.createDataFrame([(0, "x    ", "y" + " " * 30, "i", "c", "B")], SCHEMA)
    assert clean.clean(df).first()["instruction"] == "x"
    assert clean.clean(df, clean.CleanConfig(recheck_length=True)).count() == 0
    audit = clean.clean_audit(df, clean.CleanConfig(recheck_length=True)).first()
    assert (audit["after_missing"], audit["after_length"], audit["removed_pct"]) == (1, 0, 100.0)


def test_length_counts_code_points(spark):
    df = spark.createDataFrame([("😀😀😀😀😀", "z" * 20)], "instruction string, response string")
    assert clean.min_length(df, {"response": 20, "instruction": 5}).count() == 1
    assert clean.min_length(df, {"response": 21, "instruction": 5}).count() == 0


def test_audit_matches_stages(raw):
    audit = clean.clean_audit(raw).first().asDict()
    assert audit == {
        "rows_in": 7, "after_missing": 7, "after_length": 6, "flagged": 2, "after_dedup": 5, "removed": 2,
        "removed_pct": pytest.approx(200 / 7),
    }


def test_audit_does_not_confuse_shifted_pairs(spark):
    rows = [(0, "abcdef", "g" * 20, "i", "c", None), (1, "abcde", "f" + "g" * 20, "i", "c", None)]
    assert clean.clean_audit(spark.createDataFrame(rows, SCHEMA)).first()["after_dedup"] == 2


def test_dedup_keeps_first_and_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(3, None, "a"), (1, None, "a"), (2, "x", "a")], "id long, k string, v string")
    assert sorted(r["id"] for r in clean.dedup_first(df, ["k", "v"], "id").collect()) == [1, 2]


def test_pick_example(raw):
    assert clean.pick_example(raw, "nothing").count() == 0
    row = clean.pick_example(raw, "account").first()
    assert row["label"] == "**Intent:** `account`  ·  **Category:** `ACCOUNT`"
    assert clean.pick_example(raw, seed=1).count() == 1


def test_profile_reports_constant_columns(raw):
    record = profile.profile(raw.withColumn("flags", F.lit("BL"))).first()
    assert record["constant_columns"] == ["flags"]
    assert record["flag_distribution"] == {"B": 7, "L": 7}
    assert (record["n_rows"], record["n_intent"]) == (7, 6)


def test_null_counts_and_value_counts(raw):
    assert {r["column"]: r["n_null"] for r in profile.null_counts(raw).collect()}["flags"] == 1
    top = profile.value_counts(raw, "category", 2).collect()
    assert [(r["value"], r["n"]) for r in top] == [("ACCOUNT", 2), ("REFUND", 2)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([("a" * n,) for n in (1, 1, 6, 11)], "t string")
    assert [(r["bin"], r["n"]) for r in profile.histogram(df, "t", 5).orderBy("bin").collect()] == [
        (0, 2), (1, 0), (2, 1), (3, 0), (4, 1)
    ]
    same = spark.createDataFrame([("abc",), ("xyz",)], "t string")
    assert [tuple(r) for r in profile.histogram(same, "t", 5).collect()] == [(0, 3.0, 3.0, 2)]
    assert profile.histogram(df.where("false"), "t", 5).count() == 0


def test_dedup_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(40)]), rng.choice("abc") * rng.choice([1, 2]), rng.choice(["x", "y", None])) for _ in range(300)]
    df = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "example_id long, instruction string, response string, n long").repartition(5)
    got = Counter((r["instruction"], r["response"], r["example_id"]) for r in clean.dedup_first(df, ["instruction", "response"], "example_id").collect())
    least = {}
    for order, a, b in rows:
        if order is not None:
            least[a, b] = min(order, least.get((a, b), order))
    assert got == Counter((a, b, order) for (a, b), order in least.items())


def test_rows_that_cannot_lose_are_not_shuffled(spark, tmp_path):
    spark.range(2000).select(F.col("id").alias("example_id"), F.concat(F.lit("question number "), (F.col("id") % 1990).cast("string")).alias("instruction"),
                             F.repeat(F.lit("a long enough answer "), 20).alias("response")).write.parquet(f"{tmp_path}/t")
    out = clean.dedup_first(spark.read.parquet(f"{tmp_path}/t"), ["instruction", "response"], "example_id")
    assert out.count() == 1990
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # The first branch of the union, the rows that pass through, meets nothing but the broadcast map; the others also the narrow table of losers.
    branches = plan.split("\n:- ")[0], *plan.split("\n:- ")[1:]
    through = branches[1].split("\n+- ")[0]
    assert plan.startswith("Union") and "strategy=broadcast" in through
