"""Substring, exact and near dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import LOWER, odd_rows, passage, words
from pyspark.sql import functions as F

from colloquy.llm import exact_dedup, near_dedup, substring_dedup
from colloquy.llm.arrays import Words


def _repeats(docs, window):
    first = {}
    for i, text in docs:
        w = words(text)
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, text in docs:
        w, gone = words(text), set()
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s:s + window])] < i:
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


def test_substring_dedup_equals_brute_force(spark):
    rng = random.Random(1)
    shared = [passage(k * 1000, n) for k, n in enumerate((49, 50, 51, 80, 200))]
    docs = []
    for i in range(80):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts.append(rng.choice(shared) if rng.random() < 0.6 else passage(100000 + rng.randint(0, 400), rng.randint(0, 70)))
        text = " ".join(parts).split(" ")
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = "edit"
        docs.append((rng.randint(0, 1000) * 100 + i, rng.choice([" ", "\n"]).join(text)))
    docs += [(docs[0][0], docs[0][1]), (None, docs[1][1]), (5, None), (6, ""), (7, "a " * 500), (8, "a " * 60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = substring_dedup.remove_repeats(frame, window=50).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert Counter(map(tuple, got)) == _repeats(docs, 50)


def test_substring_factors_name_an_earlier_source(spark):
    text = passage(0, 120)
    frame = spark.createDataFrame([(1, text), (2, "x y " + text + " z")], "doc_id long, text string")
    row = substring_dedup.remove_repeats(frame).where("doc_id = 2").first()
    assert [tuple(f) for f in row["factors"]] == [(2, 120, 1)] and row["kept_text"] == "x y z"


def test_one_id_with_two_texts(spark):
    a, b = passage(0, 60), passage(500, 60)
    frame = spark.createDataFrame([(1, a), (2, a), (2, b)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_removed"]) for r in substring_dedup.remove_repeats(frame).collect())
    assert got == [(1, 0), (2, 0), (2, 60)]


def test_exact_dedup_equals_brute_force(spark):
    rng = random.Random(2)
    texts = [f"text {k}" for k in range(30)]
    docs = [(i, rng.choice(["hot text", "hot\t text"]) if rng.random() < 0.4 else rng.choice(texts)) for i in range(600)]
    docs += [(1000, None), (1001, ""), (1002, " ")]
    got = exact_dedup.find_copies(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), counters=8, heavy=4)
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for i, t in docs:
        groups[norm(t)].append(i)
    want = {
        (i, min(groups[norm(t)]), len(groups[norm(t)]), i == min(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in docs
    }
    assert {(*tuple(r)[:4], bytes(r["digest"]).hex()) for r in got.collect()} == want


def test_heavy_digests_are_found_and_bounded(spark):
    frame = spark.range(4000).select(
        F.unhex(F.sha2(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).cast("binary"), 256)).alias("digest")
    ).repartition(7)
    found = exact_dedup.heavy_candidates(frame, 4000, counters=16, heavy=4).collect()
    assert hashlib.sha256(b"hot").digest() in {bytes(r["digest"]) for r in found}
    assert len(found) < 1 / (1 / 4 - 1 / 17)
    with pytest.raises(ValueError):
        exact_dedup.find_copies(frame, counters=4, heavy=8)


def test_exact_dedup_of_repeated_rows_keeps_one(spark):
    frame = spark.createDataFrame([(2, "a b"), (2, "a  b"), (3, "a b"), (None, "a b"), (None, "c"), (None, "c")], "doc_id long, text string")
    assert sorted(r["group_size"] for r in exact_dedup.find_copies(frame).collect()) == [2, 2, 4, 4, 4, 4]
    assert sum(r["kept"] for r in exact_dedup.find_copies(frame).collect()) == 2
    kept = exact_dedup.drop_copies(frame).collect()
    assert len(kept) == 2 and {r["doc_id"] for r in kept} == {2, None}


def _components(docs, k, percent):
    sets, posts, parent = {}, defaultdict(list), {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, text in sorted(docs):
        w = words((text or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
        parent[i] = i
        both = Counter(j for s in sets[i] for j in posts[s])
        for j, n in both.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            posts[s].append(i)
    return {(i, len(sets[i]), root(i), i == root(i)) for i in sets}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_dedup_equals_brute_force(spark, k, percent, monkeypatch):
    monkeypatch.setattr(near_dedup, "GROUP", 7)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 900)
    rng = random.Random(3)
    docs = []
    for family in range(4):
        base = passage(family * 3000, 150).split(" ")
        for _ in range(40):
            text = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
                at = rng.randrange(len(text))
                text[at:at + rng.randint(0, 2)] = [f"e{rng.randint(0, 30)}"] * rng.randint(0, 2)
            docs.append((len(docs) * 7 % 1009, " ".join(text).upper() if rng.random() < 0.2 else " ".join(text)))
    # A chain: neighbours are linked, the ends are not; the least id stands in the middle of no group.
    chain = passage(50000, 150).split(" ")
    for n in range(8):
        docs.append((2000 - n, " ".join(chain)))
        chain[n * 16] = f"c{n}"
    docs += [(3000, None), (3001, ""), (3002, " "), (3003, "a b"), (3004, "A  b"), (3005, "a")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = near_dedup.components(frame, k=k, percent=percent)
    assert set(map(tuple, got.collect())) == _components(docs, k, percent)


def test_group_whose_least_id_is_no_centre_of_it(spark):
    """Variants of one text, 0.8 or so from each other and near the original, whose id is the greatest."""
    rng, docs = random.Random(4), []
    base = passage(0, 200).split(" ")
    for i in range(60):
        text = list(base)
        for at in rng.sample(range(200), 4):
            text[at] = f"v{i}x{at}"
        docs.append((i, " ".join(text)))
    docs.append((99, " ".join(base)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert set(map(tuple, near_dedup.components(frame, k=3, percent=85).collect())) == _components(docs, 3, 85)


def test_one_id_on_different_texts(spark):
    first, second = passage(0, 120), passage(9000, 120)
    near_first, near_second = first + " more", "more " + second
    docs = [
        (1, first), (7, near_first), (7, second), (8, near_second),  # id 7 on a copy and on a text of its own
        (3, passage(20000, 100)), (3, passage(20000, 100) + " more"),  # near copies under one id
        (4, passage(30000, 100)), (4, passage(30000, 100)),  # a repeated row
        (5, passage(40000, 100)), (5, passage(50000, 100)), (6, passage(50000, 100) + " more"), (2, passage(40000, 100) + " more"),
        (None, first), (None, first), (10, None), (10, None),
    ]
    frame = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(docs)], "doc_id long, text string, n int")
    kept = near_dedup.drop_near_copies(frame).collect()
    left = Counter((r["doc_id"], r["text"]) for r in kept)
    assert sum(left[(3, t)] for t in (docs[4][1], docs[5][1])) == 1
    del left[(3, docs[4][1])], left[(3, docs[5][1])]
    assert left == Counter([docs[0], docs[2], docs[6], docs[9], docs[11], *docs[12:]])
    rows = near_dedup.components(frame).collect()
    assert len(rows) == len(docs) and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    assert {r["component_id"] for r in rows} == {1, 7, 3, 4, 2, 5, None, 10}


def test_components_of_links(spark):
    rng = random.Random(5)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)]
    parent = {x: x for e in links for x in e}
    for _ in range(100):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = dict(map(tuple, near_dedup.connected(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {x: p for x, p in parent.items() if x != p}


def test_band_number_keeps_the_miss_bound():
    for percent in (70, 80, 85, 95):
        bands = near_dedup.bands_for(percent)
        assert (1 - (percent / 100) ** near_dedup.ROWS) ** bands <= near_dedup.MISS and bands % 2 == 0


def test_band_number_keeps_the_miss_bound_for_small_sets():
    for percent in (51, 70, 80, 85, 95):
        bands = near_dedup.bands_for(percent)
        for n in range(2, 300):
            for m in range(-(-percent * n // 100), n):
                both = m * (m - 1) / (n * (n - 1))
                assert (1 - both ** (near_dedup.ROWS // 2)) ** bands <= near_dedup.MISS
    with pytest.raises(ValueError):
        near_dedup.bands_for(50)


def test_odd_rows_and_empty_tables(spark):
    odd = odd_rows(spark)
    n = odd.count()
    assert substring_dedup.remove_repeats(odd).count() == n
    assert exact_dedup.find_copies(odd).count() == n
    assert near_dedup.components(odd).count() == n
    for drop in (exact_dedup.drop_copies, near_dedup.drop_near_copies):
        assert drop(odd).columns == odd.columns
        assert drop(odd.limit(0)).count() == 0
    for f in (substring_dedup.remove_repeats, exact_dedup.find_copies, near_dedup.components):
        assert f(odd.limit(0)).count() == 0


def test_columns_of_any_name_are_kept(spark):
    names = ["_id", "_kept", "_gone", "_digest", "row", "id", "digest", "kept_id", "gone_id", "first", "component_id"]
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame([(1, passage(0, 90), *names), (2, passage(0, 90), *names), (3, passage(0, 90) + " more", *names), (None, None, *names)], schema)
    for drop, left in ((exact_dedup.drop_copies, {1, 3, None}), (near_dedup.drop_near_copies, {1, None})):
        rows = drop(docs)
        assert rows.columns == docs.columns and {r["doc_id"] for r in rows.collect()} == left
        assert all(tuple(r)[2:] == tuple(names) for r in rows.collect())


def test_word_hashes_do_not_depend_on_their_place():
    words = [b"a", b"bb", b"x" * 200_000, "é中".encode(), b"tab"]
    rng = random.Random(4)
    first = {}
    for text in (b" ".join(rng.choice(words) for _ in range(n)) for n in (1, 7, 60)):
        found = Words([b"zz  ", text, b"", text])
        for start, end, value in zip(found.start.tolist(), found.end.tolist(), found.hash.tolist()):
            assert first.setdefault(found.buffer[start:end].tobytes(), value) == value
    assert len(set(first.values())) == len(first)
