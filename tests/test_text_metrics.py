import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed
from colloquy.functions import lcs
from colloquy.functions.text import bleu_tokens, rouge_tokens, word_count
from colloquy.operators import embeddings, metrics

PAIRS = [
    ("The quick brown fox", "The quick brown fox"),
    ("apple orange banana", "dog cat bird"),
    ("I can help with your billing issue.", "I will help you with the billing problem."),
    ("hello", "hello world"),
    ("the the the cat", "the cat the"),
    ("", "something"),
    (None, "something else"),
    ("a b\nc d e", "c d\na b"),
    ("It costs $3.50, not 1,000-2,000!", "It costs $3.50 (not 1,000)."),
]


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(i, p, r) for i, (p, r) in enumerate(PAIRS)]
    return spark.createDataFrame(rows, "example_id long, prediction string, response string").repartition(3)


def plain_tokens(text):
    return re.findall("[a-z0-9]+", (text or "").lower())


def plain_grams(tokens, n):
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def plain_f1(p, q, n):
    a, b = plain_grams(plain_tokens(p), n), plain_grams(plain_tokens(q), n)
    hits = sum((a & b).values())
    return 0.0 if not hits else 2 * hits / (sum(a.values()) + sum(b.values()))


def plain_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = table[i - 1][j - 1] + 1 if x == y else max(table[i - 1][j], table[i][j - 1])
    return table


def test_rouge_n_per_row(pairs):
    for r in metrics.with_rouge_n(pairs, "prediction", "response", (1, 2)).collect():
        for n in (1, 2):
            assert r[f"rouge{n}"] == pytest.approx(plain_f1(r["prediction"], r["response"], n))


def test_rouge_l_and_lsum(pairs):
    rows = {r["example_id"]: r for r in metrics.with_rouge_lcs(pairs, "prediction", "response").collect()}
    assert rows[0]["rougeL"] == rows[0]["rougeLsum"] == 1.0
    assert rows[1]["rougeL"] == 0.0 == rows[5]["rougeL"] == rows[6]["rougeL"]
    assert rows[3]["rougeL"] == pytest.approx(2 / 3)
    # As one text the longest common run is two of five and four tokens ...
    assert rows[7]["rougeL"] == pytest.approx(2 * 2 / (5 + 4))
    # ... line by line all four reference tokens are found.
    assert rows[7]["rougeLsum"] == pytest.approx(2 * 4 / (5 + 4))
    assert rows[2]["rougeL"] == rows[2]["rougeLsum"]


def test_lcs_against_the_full_table():
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        b = [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        table = plain_lcs(a, b)
        assert lcs.lcs_length(a, b) == table[-1][-1] == lcs.lcs_length(b, a)
        want, i, j = set(), len(a), len(b)
        while i and j:
            if a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
                want.add(i)
            elif table[i][j - 1] > table[i - 1][j]:
                j -= 1
            else:
                i -= 1
        assert lcs.lcs_reference_positions(a, b) == want


def test_lcs_of_long_texts_is_quick():
    rng = random.Random(1)
    a = [str(rng.randint(0, 900)) for _ in range(20_000)]
    assert lcs.lcs_length(a, a[::2]) == 10_000


def test_lsum_clips_repeated_tokens():
    # Both reference lines find the single "a" of the candidate; it counts once.
    assert lcs.rouge_lsum_pair("a x", "a\na") == pytest.approx(2 * 1 / (2 + 2))


def plain_lsum(candidate, reference):
    cand = [plain_tokens(x) for x in candidate.split("\n") if x]
    ref = [plain_tokens(x) for x in reference.split("\n") if x]
    have_c, have_r, hits = Counter(sum(cand, [])), Counter(sum(ref, [])), 0
    n_c, n_r = sum(have_c.values()), sum(have_r.values())
    for line in ref:
        union = set()
        for other in cand:
            table, i, j = plain_lcs(line, other), len(line), len(other)
            while i and j:
                if line[i - 1] == other[j - 1]:
                    i, j = i - 1, j - 1
                    union.add(i)
                elif table[i][j - 1] > table[i - 1][j]:
                    j -= 1
                else:
                    i -= 1
        for at in sorted(union):
            if have_c[line[at]] and have_r[line[at]]:
                hits += 1
                have_c[line[at]] -= 1
                have_r[line[at]] -= 1
    return 0.0 if not hits else 2 * hits / (n_c + n_r)


def test_lsum_against_the_full_table():
    rng = random.Random(9)
    for _ in range(300):
        a, b = ("".join(rng.choice("ab c\n ") for _ in range(rng.randint(0, 40))) for _ in range(2))
        assert lcs.rouge_lsum_pair(a, b) == pytest.approx(plain_lsum(a, b))


def plain_bleu(rows):
    match, total, p_len, r_len = [0] * 4, [0] * 4, 0, 0
    for p, q in rows:
        p_len, r_len = p_len + len(p), r_len + len(q)
        for n in range(1, 5):
            a, b = plain_grams(p, n), plain_grams(q, n)
            match[n - 1] += sum((a & b).values())
            total[n - 1] += sum(a.values())
    if not all(match):
        return 0.0
    penalty = 1.0 if p_len > r_len else math.exp(1 - r_len / p_len)
    return penalty * math.exp(sum(math.log(m / t) for m, t in zip(match, total)) / 4)


def test_bleu_is_a_corpus_score(pairs):
    tokens = pairs.select(bleu_tokens("prediction").alias("p"), bleu_tokens("response").alias("q")).collect()
    want = plain_bleu([(r["p"], r["q"]) for r in tokens])
    assert 0 < want < 1
    assert metrics.bleu(pairs, "prediction", "response").first()["bleu"] == pytest.approx(want)


@pytest.mark.parametrize("p,q,low,high", [
    ("the cat sat on the mat", "the cat sat on the mat", 1.0, 1.0),
    ("apple orange", "dog cat", 0.0, 0.0),
    ("I can help you with your order.", "I will assist you with the order.", 0.0, 1.0),
])
def test_bleu_bounds(spark, p, q, low, high):
    df = spark.createDataFrame([(p, q)], "prediction string, response string")
    assert low - 1e-9 <= metrics.bleu(df, "prediction", "response").first()["bleu"] <= high + 1e-9


def test_bleu_of_nothing_is_null(pairs):
    assert metrics.bleu(pairs.where("false"), "prediction", "response").first()["bleu"] is None


@pytest.mark.parametrize("text,tokens", [
    ("Hello, world!", ["Hello", ",", "world", "!"]),
    ("It costs $3.50, not 1,000-2,000.", ["It", "costs", "$", "3.50", ",", "not", "1,000", "-", "2,000", "."]),
    ("a&amp;b &quot;x&quot; pre-\nfix", ["a", "&", "b", '"', "x", '"', "prefix"]),
    ("don't well-known (e.g.)", ["don't", "well-known", "(", "e", ".", "g", ".", ")"]),
])
def test_13a_tokens(spark, text, tokens):
    assert spark.createDataFrame([(text,)], "t string").select(bleu_tokens("t")).first()[0] == tokens


def test_tokens_shorter_than_the_order(spark):
    df = spark.createDataFrame([("one two", "one two")], "prediction string, response string")
    row = metrics.with_bleu_counts(df, "prediction", "response").first()
    assert [row[f"bleu_match{n}"] for n in (1, 2, 3, 4)] == [2, 1, 0, 0]
    assert df.select(rouge_tokens("prediction")).first()[0] == ["one", "two"]


def test_length_stats(spark):
    df = spark.createDataFrame([("hi", "this is a much longer reference"), ("", " \n ")], "p string, r string")
    row = metrics.length_stats(df, "p", "r").first()
    assert (row["avg_pred_length"], row["avg_ref_length"]) == (0.5, 3.0)
    assert row["length_ratio"] == pytest.approx(0.5 / 3)
    assert df.select(word_count("r")).collect()[1][0] == 0


def test_metrics_record_equals_its_parts(pairs):
    timed = pairs.withColumn("latency_ms", F.col("example_id") * 10.0)
    record = metrics.metrics_for(timed, "base", "path").first()
    assert record["n_samples"] == len(PAIRS) and record["label"] == "base"
    assert record["bleu"] == pytest.approx(metrics.bleu(pairs, "prediction", "response").first()["bleu"])
    assert record["rouge1"] == pytest.approx(np.mean([plain_f1(p, q, 1) for p, q in PAIRS]))
    assert record["p95_latency_ms"] == pytest.approx(np.percentile([10.0 * i for i in range(len(PAIRS))], 95))
    untimed = metrics.metrics_for(pairs, "base", "path").first()
    assert untimed["avg_latency_ms"] is None and untimed["p95_latency_ms"] is None
    shown = metrics.rounded(metrics.metrics_for(timed, "base", "path")).first()
    assert len(str(shown["rouge1"]).split(".")[1]) <= 4


def test_metrics_by_slice_keep_a_null_slice(pairs):
    sliced = pairs.withColumn("intent", F.when(F.col("example_id") > 2, "x")).withColumn("latency_ms", F.lit(1.0))
    rows = {r["intent"]: r for r in metrics.metrics_for(sliced, "m", "p", ["intent"]).collect()}
    assert (rows[None]["n_samples"], rows["x"]["n_samples"]) == (3, len(PAIRS) - 3)
    assert rows[None]["p95_latency_ms"] == 1.0


def test_latency_summary(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 2), (3.0, 3), (10.0, 10), (0.0, 5)], "latency_ms double, response_tokens int")
    row = metrics.latency_summary(df).first()
    assert (row["n_prompts"], row["median_latency_ms"], row["p95_latency_ms"]) == (5, 2.0, 10.0)
    assert row["avg_tokens_per_sec"] == pytest.approx(1000.0)
    assert metrics.latency_summary(df, weighted=True).first()["avg_tokens_per_sec"] == pytest.approx(21 / 0.016)


def test_perplexity(spark):
    df = spark.createDataFrame([(1.0, 1), (3.0, 3)], "loss double, tokens int")
    assert metrics.perplexity(df, "loss").first()[0] == pytest.approx(math.exp(2))
    assert metrics.perplexity(df, "loss", weight="tokens").first()[0] == pytest.approx(math.exp(2.5))
    assert metrics.perplexity(df.where("false"), "loss").first()[0] is None


@pytest.mark.parametrize("block", [2, 1000])
def test_greedy_match_against_brute_force(spark, block):
    rng = np.random.default_rng(2)
    sides = {s: {p: rng.normal(size=(n, 4)) for p, n in sizes.items()}
             for s, sizes in (("c", {1: 5, 2: 3, 3: 1}), ("r", {1: 7, 2: 1, 4: 2}))}
    frames = [
        spark.createDataFrame(
            [(p, i, [float(x) for x in v]) for p, vs in sides[s].items() for i, v in enumerate(vs)],
            "pair_id int, position int, embedding array<float>",
        ) for s in ("c", "r")
    ]
    got = {r["pair_id"]: r for r in embeddings.greedy_match(*frames, block=block).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    for p in (1, 2):
        c, r = (sides[s][p] / np.linalg.norm(sides[s][p], axis=1, keepdims=True) for s in ("c", "r"))
        cosines = c @ r.T
        precision, recall = cosines.max(axis=1).mean(), cosines.max(axis=0).mean()
        assert got[p]["precision"] == pytest.approx(precision, abs=1e-6)
        assert got[p]["recall"] == pytest.approx(recall, abs=1e-6)
        assert got[p]["f1"] == pytest.approx(2 * precision * recall / (precision + recall), abs=1e-6)
    assert tuple(got[3])[1:] == tuple(got[4])[1:] == (0.0, 0.0, 0.0)


def _by_rules(text):
    for pattern, new in fixed.BLEU_13A_RULES:
        text = re.sub(pattern, new.replace("$1", r"\1").replace("$2", r"\2"), text)
    return text.split()


def test_13a_tokens_equal_the_rules_on_generated_texts(spark):
    rng = random.Random(13)
    parts = [".", ",", "-", "5", "42", "a", "B", " ", "\n", "-\n", "'", "!", "$", "/", "&amp;", "&lt;", "<skipped>", "é", "中", "\u00a0", "_", "~", "..", "3.14", "1,000", "e.g."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string").select("id", bleu_tokens("t").alias("k")).collect()
    wrong = [(texts[r["id"]], r["k"], _by_rules(texts[r["id"]])) for r in rows if r["k"] != _by_rules(texts[r["id"]])]
    assert not wrong, wrong[:3]


def test_13a_tokens_of_the_documents_equal_the_rules(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", bleu_tokens("text").alias("k"))
    assert all(r["k"] == _by_rules(r["text"] or "") for r in docs.collect())


def test_long_lines_keep_few_states():
    rng = random.Random(2)
    a = [str(rng.randint(0, 40_000)) for _ in range(40_000)]
    b = [t for t in a if rng.random() < 0.7] + [str(rng.randint(0, 40_000)) for _ in range(12_000)]
    tracemalloc.start()
    taken = lcs.lcs_reference_positions(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(taken) == lcs.lcs_length(a, b)
    # All states of the table would be m * n / 8 bytes, about 200 MB.
    assert peak < 25_000_000
