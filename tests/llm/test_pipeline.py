"""The registered queries and the pipeline on whole small tables."""

import os
import re
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
from helpers import LOWER, words
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from colloquy.llm import pii
from colloquy.llm.oracles import ORACLES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_all_are_registered():
    names = set(entry_points.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_stages_keep_the_columns_and_drop_rows_only(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        now = docs.count()
        assert 0 < now <= before
        before = now
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == ids


def test_stages_take_empty_tables_and_nulls(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, frame, FOLDER).count()


def _same_texts(rows):
    """The row with the least id of each text, white space apart."""
    least = {}
    for doc, text in sorted(rows):
        least.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), doc)
    return set(least.values())


def _near_texts(rows):
    """The least id of each component of five-word shingle sets with a similarity of 0.8."""
    sets = {}
    for doc, text in rows:
        w = words((text or "").translate(LOWER))
        sets[doc] = {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}
    holders, parent = defaultdict(list), {d: d for d in sets}
    for doc, shingles in sets.items():
        for x in shingles:
            holders[x].append(doc)

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for doc, shingles in sets.items():
        for other in {h for x in shingles for h in holders[x]}:
            if 10 * len(shingles & sets[other]) >= 8 * len(shingles | sets[other]):
                a, b = sorted((root(doc), root(other)))
                parent[b] = a
    return {d for d in sets if root(d) == d}


def test_every_stage_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {"input": {r["doc_id"]: r["text"] for r in docs.collect()}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    verdicts = con.execute(f"SELECT doc_id FROM ({ORACLES['op3_quality_rules']}) WHERE kept").fetchall()
    assert rows["quality"] == {d: rows["input"][d] for d, in verdicts}
    assert rows["exact_dedup"] == {d: rows["quality"][d] for d in _same_texts(rows["quality"].items())}
    assert rows["near_dedup"] == {d: rows["exact_dedup"][d] for d in _near_texts(rows["exact_dedup"].items())}
    spans = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(list(rows["near_dedup"].items()), "doc_id long, text string")).collect()}
    for doc, text in rows["near_dedup"].items():
        out, at = "", 0
        for s in spans[doc]:
            if s["start"] >= at:
                out, at = out + text[at:s["start"]] + f"[{s['kind'].upper()}]", s["end"]
            else:
                at = max(at, s["end"])
        assert rows["pii"][doc] == out + text[at:]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    pieces, places = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect():
        ids = [int.from_bytes(r["ids"][i:i + 4], "little") for i in range(0, len(r["ids"]), 4)]
        assert len(ids) == r["length"]
        pieces[r["doc_id"]].append((r["start"], ids))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, text in rows["pii"].items():
        whole = [i for _, ids in sorted(pieces[doc]) for i in ids]
        assert whole == tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    for held in places.values():
        ends = [0] + [sum(n for _, n in sorted(held)[:k + 1]) for k in range(len(held))]
        assert [o for o, _ in sorted(held)] == ends[:-1] and ends[-1] <= 1024


def test_stages_keep_columns_of_any_name(spark):
    names = ["_id", "_kept", "_gone", "_digest", "_spans", "_row", "row", "found", "n_words", "kept"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    text = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, "en", "s", 9, *names), (2, text + " x@y.org", "en", "s", 9, *names)], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and all(tuple(r)[5:] == tuple(names) for r in out.collect())
