"""Plans and helpers whose cost must grow with the rows alone."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed
from colloquy.functions import overlap, text
from colloquy.operators import clean


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_makes_digests_once_and_tests_none_for_null(spark):
    rows = spark.range(50).selectExpr("id AS example_id", "concat('Line ', id % 7) AS instruction", "concat('Words  of the text ', id % 9) AS response", "'B' AS flags")
    plan = plan_of(clean.clean(rows))
    assert not re.search(r"isnotnull\((coalesce\()?sha2", plan)
    assert clean.clean(rows).count() == rows.selectExpr("example_id % 7", "example_id % 9").distinct().count()


def test_words_are_split_at_every_white_space_character(spark):
    space = re.compile(f"[{fixed.WHITESPACE_CLASS}]".replace(r"\x{", "\\u{").replace("\\u{85}", "\x85").replace("\\u{a0}", "\xa0")
                       .replace("\\u{", "\\u").replace("}", ""))
    chars = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, f"a{c}{c}b") for c in chars], "c string, t string")
    found = df.select("c", text.word_count("t").alias("n"), text.normalize_ws("t").alias("one")).collect()
    for r in found:
        blank = bool(space.fullmatch(r["c"]))
        assert r["n"] == (2 if blank else 1), hex(ord(r["c"]))
        assert r["one"] == ("a b" if blank else f"a{r['c']}{r['c']}b"), hex(ord(r["c"]))


@pytest.mark.parametrize("chunk", [1, 40, 1 << 18])
def test_shared_grams_against_counters(monkeypatch, chunk):
    import pyarrow as pa

    monkeypatch.setattr(overlap, "CHUNK_TOKENS", chunk)
    rng = random.Random(3)
    pairs = [tuple([rng.choice("ab c".split() + ["d"]) for _ in range(rng.randint(0, 12))] for _ in range(2)) for _ in range(60)]
    left, right = (pa.array([p[k] for p in pairs], pa.list_(pa.string())) for k in (0, 1))
    n_left, n_right = (x.value_lengths().to_numpy().astype(np.int64) for x in (left, right))
    got, start = [], 0
    for end in overlap._chunk_ends(n_left + n_right):
        got.append(np.array(overlap._shared(left.slice(start, end - start), right.slice(start, end - start), n_left[start:end], n_right[start:end], 4)))
        start = end
    for i, found in enumerate(np.concatenate(got, axis=1).T):
        for n in (1, 2, 3, 4):
            a, b = (Counter(tuple(x[k:k + n]) for k in range(len(x) - n + 1)) for x in pairs[i])
            assert found[n - 1] == sum((a & b).values())


def test_overlaps_leave_the_rows_arrays_to_the_arrow_function(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["b", "a"]), (2, [], ["a"]), (3, [], [])], "i long, l array<string>, r array<string>").repartition(3)
    out = overlap.with_overlaps(df, "l", "r", [1, 2], "x_")
    assert "sort_array" not in plan_of(out)
    assert {tuple(r) for r in out.collect()} == {(1, 2, 2, 2, 0), (2, 0, 1, 0, 0), (3, 0, 0, 0, 0)}


def test_bit_rows_of_a_short_line_are_used_as_they_are(monkeypatch):
    from colloquy.functions import lcs

    monkeypatch.setattr(lcs, "_condensed", None)
    assert lcs.rouge_lsum_pair("a x b y c\nd", "b a c b\nz") == pytest.approx(2 * 2 / (6 + 5))


def test_words_of_letters_skip_the_pattern(monkeypatch):
    from pathlib import Path

    import public_tokenizers

    from colloquy.llm import bpe

    encoder = bpe.Encoder(Path(public_tokenizers.path("byte_bpe_50k.json")).read_bytes())
    texts = ["plain words of letters alone", "don't 12 café <|endoftext|> end", "", "a  b"]
    want = []
    for t in texts:
        ids = []
        for part in encoder._split(t):
            ids.append(bpe.packed([part]) if isinstance(part, int) else encoder.vocabulary.merge([part.encode()])[0])
        want.append(b"".join(ids))
    split = []
    monkeypatch.setattr(encoder, "_split", lambda piece, f=encoder._split: split.append(piece) or f(piece))
    assert encoder.encode_many(texts) == want
    assert not {" words", " of", " letters", " alone"} & set(split)
