import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from colloquy.operators import joins, ranking, split


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows, two thirds of them in one stratum; one stratum is null."""
    return spark.range(3000).select(
        F.col("id").alias("example_id"),
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 30 == 2, None)
        .otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("intent"),
    )


def test_positions_are_dense_and_ordered(skewed):
    gaps = skewed.withColumn("example_id", F.col("example_id") * F.col("example_id") + 7)
    rows = ranking.with_position(gaps.repartition(7), buckets=6).orderBy("example_id").collect()
    assert [r["position"] for r in rows] == list(range(3000))
    assert ranking.with_position(gaps.where("false")).count() == 0
    assert [r["position"] for r in ranking.with_position(gaps.limit(1)).collect()] == [0]


def test_split_is_an_exact_partition(skewed):
    rows = split.stratified_split(skewed.repartition(5)).collect()
    assert sorted(r["example_id"] for r in rows) == list(range(3000))
    sizes = {}
    for r in rows:
        sizes[r["split"]] = sizes.get(r["split"], 0) + 1
    assert sizes == {"train": 2400, "validation": 300, "test": 300}
    quotas = {r["intent"]: r for r in split.split_quotas(skewed, "intent").collect()}
    for intent, q in quotas.items():
        inside = [r for r in rows if r["intent"] == intent]
        assert sum(r["split"] == "test" for r in inside) == q["n_test"]
        assert sum(r["split"] != "train" for r in inside) == q["n_held_out"]
        assert abs(q["n_held_out"] - 0.2 * q["n"]) < 1


def test_split_is_reproducible_and_seeded(skewed):
    def chosen(df, seed):
        return {r["example_id"] for r in split.stratified_split(df, seed=seed).where("split = 'test'").collect()}

    assert chosen(skewed, 1) == chosen(skewed.repartition(9), 1) != chosen(skewed, 2)


def test_one_row_strata(spark):
    df = spark.createDataFrame([(i, f"s{i}") for i in range(10)], "example_id long, intent string")
    counts = split.stratified_split(df).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in counts} == {"train": 8, "validation": 1, "test": 1}


def test_sample_is_the_top_n(skewed, spark):
    for n in (0, 1, 700, 2999, 3000, 5000):
        plain = skewed.orderBy(split.seeded_key("example_id", 42), "example_id").limit(n)
        assert {r["example_id"] for r in split.sample_n(skewed, n).collect()} == {r["example_id"] for r in plain.collect()}, n
    assert split.sample_n(skewed.where("false"), 3).count() == 0
    big = spark.range(40_000).withColumnRenamed("id", "example_id").repartition(5)
    plain = big.orderBy(split.seeded_key("example_id", 1), "example_id").limit(20_011)
    assert {r[0] for r in split.sample_n(big, 20_011, seed=1).collect()} == {r[0] for r in plain.collect()}


def test_split_and_samples_read_the_text_once(spark, tmp_path):
    spark.range(500).select(F.col("id").alias("example_id"), (F.col("id") % 3).cast("string").alias("intent"), F.repeat(F.lit("x"), 9).alias("text")).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    for out in (split.stratified_split(table), split.sample_n(table, 50)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len([x for x in plan.split("\n") if "FileScan" in x and "text" in x.split("]")[0]]) == 1
        assert not [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "text" in x]


def test_too_many_strata_are_named(skewed, monkeypatch):
    monkeypatch.setattr(split, "MAX_STRATA", 3)
    with pytest.raises(Exception, match="too many strata"):
        split.stratified_split(skewed).collect()
    assert split.stratified_split(skewed, many_strata=True).count() == 3000


def test_sample_per_group_limits_before_the_shuffle(skewed):
    out = split.sample_per_group(skewed, "intent", 2)
    assert {r["count"] for r in out.groupBy("intent").count().collect()} == {2}
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_aligned_sample(skewed):
    a = skewed.withColumn("p", F.lit("a"))
    b = skewed.withColumn("p", F.lit("b")).drop("intent")
    rows = split.sample_aligned(a, b, 20, shared=("intent",)).collect()
    assert len(rows) == 20 and {(r["p_base"], r["p_ft"]) for r in rows} == {("a", "b")}


def test_order_statistics_match_numpy(spark):
    rng = np.random.default_rng(3)
    values = {"a": rng.normal(0, 50, 999).round(1), "b": np.repeat(5.0, 40), None: np.array([7.0])}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("a", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    at = {
        "q95": ranking.linear_position(0.95), "med": ranking.linear_position(0.5),
        "r95": ranking.rank_position(0.95), "lo": ranking.linear_position(0.0),
    }
    got = {r["g"]: r for r in ranking.order_statistics(df, "v", ["g"], at).collect()}
    for k, vs in values.items():
        assert got[k]["n"] == len(vs)
        assert got[k]["q95"] == pytest.approx(np.percentile(vs, 95))
        assert got[k]["med"] == pytest.approx(np.median(vs))
        assert got[k]["r95"] == sorted(vs)[int(0.95 * len(vs))]
        assert got[k]["lo"] == vs.min()


def test_rank_position_is_the_maximum_of_twenty(spark):
    df = spark.range(1, 21).select(F.col("id").cast("double").alias("v"))
    assert ranking.order_statistics(df, "v", [], {"p": ranking.rank_position(0.95)}).first()["p"] == 20.0


def test_salted_lookup_equals_plain_join(skewed, spark):
    facts = skewed.withColumnRenamed("intent", "key").withColumnRenamed("example_id", "row_id")
    state = spark.createDataFrame([("hot", 1), ("s0", 2), ("zz", 3)], "key string, value int")
    plain = facts.join(state, "key", "left").select("row_id", "value")
    salted = joins.lookup_join(facts, state, "key", "row_id", "st", rows=10).select("row_id", "st.value")
    assert {tuple(r) for r in salted.collect()} == {tuple(r) for r in plain.collect()}
    assert salted.count() == 3000
    assert facts.limit(1).select(joins.hot_salts(facts, ["key"], rows=500)["key"].alias("m")).first()["m"] == {"hot": 4}


def test_hot_keys_are_named_by_a_sketch_and_counted(spark):
    rows = [("a",)] * 700 + [("b",)] * 300 + [(f"k{i}",) for i in range(2000)] + [(None,)] * 500
    facts = spark.createDataFrame(rows, "key string").select("key", F.lit(7).alias("other")).repartition(6)
    maps = joins.hot_salts(facts, ["key", "other"], share=0.05, rows=100)
    got = facts.limit(1).select(*[maps[k].alias(k) for k in ("key", "other")]).first()
    assert got["key"] == {"a": 7, "b": 3} and got["other"] == {"7": 35}
    empty = facts.where("false")
    state = spark.createDataFrame([("a", 1)], "key string, value int")
    assert joins.lookup_join(empty.select("key", F.lit(1).alias("row_id")), state, "key", "row_id", "st").collect() == []


def test_ranked_window_equals_plain_window(skewed):
    keyed = skewed.withColumn("b", F.floor(F.col("example_id") / 100))
    got = ranking.rank_in_buckets(keyed, ["intent"], "b", ["example_id"], "rk")
    plain = F.row_number().over(Window.partitionBy("intent").orderBy("example_id"))
    assert {(r[0], r[1]) for r in got.select("example_id", "rk").collect()} == {
        (r[0], r[1]) for r in skewed.select("example_id", plain).collect()
    }


@pytest.mark.parametrize("shape", ["narrow band", "heavy ties", "two bands"])
def test_large_groups_are_bracketed_twice(spark, shape):
    rng = np.random.default_rng(3)
    values = rng.permutation(100_000) / 1e9
    if shape == "heavy ties":
        values[:40_000] = 5e-5
        values[40_000:60_000] = 9.5e-5
    elif shape == "two bands":
        values[:95_001] -= 1e6
    rows = [(float(v), i % 2) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "v double, g int").repartition(7)
    at = {f"p{q}": ranking.linear_position(q / 100) for q in (0, 1, 50, 95, 100)} | {"r95": ranking.rank_position(0.95)}
    out = ranking.order_statistics(df, "v", [], at)
    row = out.first()
    for q in (0, 1, 50, 95, 100):
        assert row[f"p{q}"] == pytest.approx(np.quantile(values, q / 100), rel=1e-12), q
    assert row["r95"] == sorted(values)[95_000] and row["n"] == 100_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 3 and "Window" not in plan
    by_group = {r["g"]: r for r in ranking.order_statistics(df, "v", ["g"], at).collect()}
    for g in (0, 1):
        assert by_group[g]["p95"] == pytest.approx(np.quantile([v for v, k in rows if k == g], 0.95), rel=1e-12)


def test_further_aggregates_come_from_the_first_pass(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), ("b", float("nan"))], "g string, v double")
    also = [F.count(F.lit(1)).alias("rows")]
    got = {r["g"]: (r["rows"], r["n"], r["m"]) for r in ranking.order_statistics(df, "v", ["g"], {"m": ranking.linear_position(0.5)}, also).collect()}
    assert got == {"a": (2, 2, 2.0), "b": (2, 0, None)}
    empty = ranking.order_statistics(df.where("false"), "v", [], {"m": ranking.linear_position(0.5)}, also).collect()
    assert [(r["rows"], r["n"], r["m"]) for r in empty] == [(0, 0, None)]
    assert ranking.order_statistics(df.where("false"), "v", ["g"], {"m": ranking.linear_position(0.5)}, also).collect() == []
