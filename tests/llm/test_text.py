"""Quality rules, classifier, personal data, licences, tokens, URLs and packing."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import ODD, WORD, odd_rows, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from colloquy.llm import bpe, license_rules, packing, pii, quality_classifier, quality_rules, url_filter

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


# ---------------------------------------------------------------- quality rules

def _counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark):
    rng = random.Random(1)
    parts = ["a", "b", "\n", " ", "\t", "#", "$x", "ñ", "🙂", "line one\n", "a b c d e f g h ", "\x0b"]
    docs = [(i, "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    docs += [(i + 1000, t) for i, (_, t) in enumerate(ODD)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = quality_rules.word_counts(frame).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {i: _counts(t) for i, t in docs}


def test_sketches_merge_and_keep_their_error(spark):
    rng = random.Random(2)
    rows = [("en", f"s{i % 3}", 100, int(rng.lognormvariate(6, 0.5)), 0, 1, 0, 0) for i in range(3000)]
    counted = spark.createDataFrame(rows, "lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")
    fine = quality_rules.sketches(counted, ["lang", "source"])
    whole = quality_rules.sketches(counted, ["lang"])
    merged = quality_rules.merge(fine, ["lang"])
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    row = quality_rules.quartiles(merged, ["lang"]).where("metric = 'mean_word'").first()
    values = sorted(r[3] / r[2] for r in rows)
    assert row["n"] == 3000
    assert abs(row["low"] / values[749] - 1) < 0.021 and abs(row["high"] / values[2249] - 1) < 0.021


def test_fences_follow_the_source(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    noisy = " ".join(f"word{i}#" for i in range(60))
    junk = " ".join(f"w{i}###" for i in range(60))
    docs = [(i, clean, "en", "plain") for i in range(300)] + [(1000 + i, noisy, "en", "code") for i in range(300)]
    docs += [(5000, junk, "en", "plain"), (5001, noisy, "en", "plain"), (5002, clean, None, None), (5003, None, "en", "plain"), (5004, junk, None, None)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(300)) and all(got[1000 + i] for i in range(300))
    assert not got[5000] and not got[5001] and got[5002] and not got[5003]
    assert got[5004]  # a source of two rows goes by all rows, of which half are as noisy


def _symbols(share, n=60):
    """About ``share`` of the word characters are symbols."""
    marks = round(share * n * 6 / (1 - share))
    return " ".join(f"word{i:02d}" + "#" * (marks // n + (i < marks % n)) for i in range(n))


def test_fences_tighten_and_loosen(spark):
    # Against fixed cutoffs of 0.10 symbols and 12 letters a word: code has more symbols, and prose with 0.09 is junk.
    texts = [(i, _symbols(0), "en", "prose") for i in range(300)] + [(6000 + i, _symbols(0), "en", f"more{i % 3}") for i in range(900)] + [(300, _symbols(0.09), "en", "prose"), (301, " ".join(["verylongword"] * 5 + [f"longword{i}" for i in range(60)]), "en", "prose")]
    texts += [(1000 + i, _symbols(0.11 + 0.0003 * i), "en", "code") for i in range(300)] + [(2000, _symbols(0.5), "en", "code")]
    # A source of which two fifths are junk, and one of nothing else: neither voids its fence.
    texts += [(3000 + i, _symbols(0.4 if i % 5 < 2 else 0), "en", "mixed") for i in range(300)] + [(4000 + i, _symbols(0.45), "en", "junk") for i in range(300)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(300)) and not got[300] and not got[301]
    limits = {r["source"]: r for r in quality_rules.fences(quality_rules.word_counts(spark.createDataFrame(texts, "doc_id long, text string, lang string, source string"))).collect()}
    margin = quality_rules.SPREAD * quality_rules.MARGINS["symbol_share"][1]
    english = limits["prose"]["fence_symbol_share"]
    assert all(r["fence_symbol_share"] <= english + margin + 1e-9 for r in limits.values())
    assert limits["code"]["fence_symbol_share"] > english and not got[2000]
    assert all(got[3000 + i] == (i % 5 >= 2) for i in range(300)) and not any(got[4000 + i] for i in range(300))


def test_quality_keeps_columns(spark):
    odd = odd_rows(spark)
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() == sum(
        n[0] >= 20 and 100 * n[4] <= 30 * n[0] for n in (_counts(t) for _, t in ODD))
    assert quality_rules.judge(odd).count() == odd.count()
    assert quality_rules.keep_good(odd.limit(0)).count() == 0


# ---------------------------------------------------------------- classifier

def test_classifier_on_held_out_rows(spark):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(["river", "house", "walks", "softly", "green"]) for _ in range(40))
    bad = lambda: " ".join(rng.choice(["BUY!!", "NOW$$", "click>>", "WIN!!"]) for _ in range(40))
    rows = [(i, good() if i % 4 else bad(), int(bool(i % 4))) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    held = quality_classifier.held_out("doc_id")
    model = quality_classifier.train(docs, labels.where(~held), sample=200)
    got = {r["doc_id"]: r for r in quality_classifier.score(docs, model).withColumn("held", held).collect()}
    checked = [got[i]["predicted"] == q for i, _, q in rows if got[i]["held"]]
    assert len(checked) > 80 and np.mean(checked) > 0.97
    assert got[900]["score"] == got[901]["score"] and 0 <= got[900]["score"] <= 1
    assert all(got[i]["held"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)


def test_one_row_an_id_is_learned_from(spark, monkeypatch):
    rows = [(i % 20, f"good text number {i}" if i % 2 else f"bad words here {i}") for i in range(200)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_classifier, "learn", lambda examples: seen.append(examples) or (np.zeros(quality_classifier.BUCKETS), 0.0))
    quality_classifier.train(docs, labels)
    assert len(seen[0]) == 20
    monkeypatch.setattr(quality_classifier, "ENTRIES", 200)
    quality_classifier.train(docs, labels)
    assert 0 < len(seen[1]) < 20 and sum(len(b) for _, b, _ in seen[1]) <= 200


def test_long_texts_are_scored_whole():
    rng = np.random.default_rng(0)
    numbers = rng.normal(size=quality_classifier.BUCKETS)
    text = b"alpha beta gamma " * 90_000
    total, count = quality_classifier.totals([text, b"", b"alpha"], numbers)
    doc, bucket = quality_classifier.features([text])
    # Only the word pairs at the few block edges are left out.
    assert abs(count[0] - len(bucket)) <= 2 and abs(total[0] - numbers[bucket].sum()) < 20 and count[1] == 0


def test_classifier_without_labels(spark):
    odd = odd_rows(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality_classifier.score(odd, quality_classifier.train(odd, none)).collect()
    assert len(rows) == len(ODD) and {r["score"] for r in rows} == {0.5}
    assert quality_classifier.score(odd.limit(0), quality_classifier.train(odd, none)).count() == 0


# ---------------------------------------------------------------- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(int(c) for c in reversed(digits))) % 10 == 0


def _base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(p) > 255 for p in m.group().split("."))) or (kind == "phone" and not 10 <= len(digits) <= 15) or (
                    kind == "card" and not (14 <= len(digits) <= 19 and _luhn(digits))):
                continue
            out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(5)
    parts = ["1", "2", "4", "9", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "_", "é", "🙂", "\n", "4111111111111111", "+1 (555) 123-4567", "a@b.co", "1.2.3.4", "000001", "999"]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(2000)]
    docs += [(9001, "a@b.c " * 3000), (9002, "1 " * 30000), (9003, "a" * 100000), (9004, None)]
    got = pii.find(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", pii.listed(F.col("base"))).collect()
    assert dict(map(tuple, got)) == {i: _base(t) for i, t in docs}


def test_method_adds_private_spans_only(spark):
    docs = [
        (1, "please call 555-123-4567 today"), (2, "order 555-123-4567 was shipped"), (3, 'the token = "908038b7daaf91e730d2f64001c52934d43d9336" leaked'),
        (4, "commit 908038b7daaf91e730d2f64001c52934d43d9336 fixed it"), (5, "social security 212-45-6789"), (6, "they arrived at home.Then slept"),
        (7, "a plain and clean sentence of some words"), (8, "transfer to DE89370400440532013000 please"),
    ]
    got = {r[0]: r[1] for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", pii.listed(F.col("spans"))).collect()}
    assert got[1] == "phone_local:12:24" and got[3].startswith("secret:13:") and got[5].startswith("ssn:") and got[8].startswith("iban:")
    assert got[2] == got[4] == got[6] == got[7] == ""


def test_numbers_at_ends_in_brackets_and_in_other_groups(spark):
    private = {
        "phone": [
            ("Call ", "555-123-4567", "."), ("Call us (", "555-123-4567", ")"), ("Call ", "1-800-555-1234", " now"), ("Call ", "555-123-4567", "- at once"),
            ("Tel.", "555-123-4567", ""), ("call ", "0171 2345678", " now"), ("phone ", "01 23 45 67 89", "."), ("call ", "1 (800) 555-1234", "."), ("tel: ", "555-1234", ""),
            ("call ", "(0171) 2345678", "!"), ("phone ", "089 123 45 67", ""),
        ],
        "ipv6": [
            ("from host ", "2001:db8::1", " yesterday"), ("client ", "fe80::1ff:fe23:4567:890a", "."), ("ip ", "::ffff:c0a8:1", ""), ("IPv6:", "2001:db8::1", ""),
            ("ip: ", "2001:db8:0:12:1ff:fe23:4567:890a", ": it"),
        ],
    }
    docs, want = [], {}
    for kind, cases in private.items():
        for before, value, after in cases:
            want[len(docs)] = (kind, len(before), len(before) + len(value))
            docs.append((len(docs), before + value + after))
    clean = [
        "On 2024-01-15 it rained.", "the years 1998-2004 were dry", "a share of 3.14159265 was left", "order 0171 2345678 was sent", "call std::max or dead::beef here",
        "about 12 345 678 grains", "invoice 01 23 45 67 89 is due",
    ]
    docs += [(1000 + i, t) for i, t in enumerate(clean)]
    docs += [(2000, "1-" * 30000), (2001, "12 " * 20000), (2002, "(1" * 30000), (2003, "a:" * 30000), (2004, "::1" * 20000)]
    found = pii.find(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "spans").collect()
    got = {r[0]: [(s["kind"], s["start"], s["end"]) for s in r[1]] for r in found}
    missed = {docs[i][1]: got[i] for i, (kind, a, b) in want.items() if not any(k.startswith(kind) and (x, y) == (a, b) for k, x, y in got[i])}
    assert not missed
    assert {t: got[1000 + i] for i, t in enumerate(clean) if got[1000 + i]} == {}


def test_running_sums(spark):
    rows = [([int(x) for x in np.random.default_rng(n).integers(0, 50, n)],) for n in (0, 1, 2, 7, 100, 501)]
    got = spark.createDataFrame(rows, "v array<bigint>").select("v", pii.running(F.col("v")).alias("s")).collect()
    assert all(r["s"] == np.cumsum(r["v"]).tolist() for r in got)


def test_redaction_keeps_columns_of_any_name(spark):
    names = ["_spans", "found", "row", "_id", "kind", "start"]
    docs = spark.createDataFrame([("mail a@b.co", *names)], "text string, " + ", ".join(f"{n} string" for n in names))
    assert [tuple(r) for r in pii.redact(docs).collect()] == [("mail [EMAIL]", *names)]


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co or +1 (555) 123-4567!", "x"), (2, None, "y"), (3, "clean", "z")], "doc_id long, text string, spans string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert got == {1: "mail [EMAIL] or [PHONE]!", 2: None, 3: "clean"} and pii.redact(docs).columns == docs.columns
    odd = odd_rows(spark)
    assert pii.find(odd).count() == len(ODD) and pii.redact(odd.limit(0)).count() == 0


# ---------------------------------------------------------------- licences

def test_licences(spark):
    docs = [
        (1, "This work is licensed under the GNU General Public License, version 3."), (2, "MIT License mit-license"), (3, "Licensed under CC BY-NC 4.0."),
        (4, "Apache License, Version 2.0 or later. apache license"), (5, "plain words only"), (6, None), (7, "SPDX-License-Identifier: BSD-3-Clause"),
        (8, "limited mit licenses ccby"),
    ]
    rows = {r["doc_id"]: r for r in license_rules.summary(license_rules.scan(spark.createDataFrame(docs, "doc_id long, text string"))).collect()}
    assert (rows[1]["labels"], rows[1]["n_base"], rows[1]["first_word"]) == ("gpl,gpl-3.0", 1, 6)
    assert (rows[2]["n_base"], rows[2]["first_word"], rows[2]["last_word"], rows[2]["labels"]) == (2, 0, 2, "mit")
    assert rows[3]["labels"] == "cc-by,cc-by-nc-4.0" and rows[4]["labels"] == "apache,apache-2.0-or-later"
    assert (rows[5]["labels"], rows[5]["n_words"], rows[5]["first_word"], rows[5]["score"]) == ("", 3, None, 0.0)
    assert (rows[6]["n_words"], rows[6]["labels"]) == (0, "")
    assert rows[7]["labels"] == "bsd-3-clause" and rows[7]["score"] == 1.0 and rows[8]["labels"] == ""


WRITTEN = [
    ("GPLv2", "gpl-2.0"), ("GPLv3 or later", "gpl-3.0-or-later"), ("LGPLv2.1+", "lgpl-2.1-or-later"), ("Apache-2.0", "apache-2.0"), ("MIT licensed", "mit"), ("GPL v2", "gpl-2.0"),
    ("the GNU General Public License v3", "gpl,gpl-3.0"), ("Apache License v2.0", "apache,apache-2.0"), ("version 2 of the GNU GPL", "gpl-2.0"), ("GPL-2.0+", "gpl-2.0-or-later"),
    ("EUPL v1.2", "eupl-1.2"), ("released under the BSD 3-clause licence", "bsd-3-clause"), ("MPL 2.0", "mpl-2.0"), ("under the MIT", "mit"), ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3.0-or-later"),
    ("GNU Lesser General Public Licence version 2.1 or (at your option) any later version", "lgpl-2.1-or-later"), ("Apache 2.0 server", ""), ("we reply, see under the tree; general software of the project was released", ""),
    ("2+3 licensed GPL 2+3", "gpl"), ("Kelvin \u212aK licence", ""), ("GPL 2 or, later, something", "gpl-2.0-or-later"),
]


def test_usual_ways_to_write_a_licence(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(WRITTEN)], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in license_rules.summary(license_rules.scan(docs)).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(WRITTEN)] == WRITTEN


def test_contained_detections_go_and_overlapping_ones_stay(spark):
    rules = [("a", r" (a b c)(?= )", "abc", 9), ("c", r" (c d)(?= )", "cd", 8), ("b", r" (b c)(?= )", "bc", 7), ("b", r" (b)(?= )", "b", 5), ("d", r" (d( e)?)(?= )", "de", 4)]
    rng = random.Random(9)
    texts = ["a b c d e", "b c d", "b a b c", "d e c d"] + [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 25))) for _ in range(200)]
    found = license_rules.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), rules=rules).collect()
    for r in found:
        text, spans, want = f" {texts[r['doc_id']]} ", [], []
        for _, pattern, label, _ in rules:
            now = [(len(text[:m.start(1)].split()), len(m.group(1).split())) for m in re.finditer(pattern, text)]
            want += [(at, n, label) for at, n in now if not any(x <= at and at + n <= x + k for x, k in spans)]
            spans += now
        assert [(f["start"], f["words"], f["label"]) for f in r["found"]] == want, text
    assert [(f["start"], f["label"]) for f in found[0]["found"]] == [(0, "abc"), (2, "cd"), (3, "de")]


def test_base_phrases_equal_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "x", "ñ", "License", "CC"]
    docs = [(i, rng.choice([" ", ", ", "-"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))) for i in range(400)]
    got = license_rules.summary(license_rules.scan(spark.createDataFrame(docs, "doc_id long, text string"))).collect()
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    for r, (_, text) in zip(sorted(got, key=lambda r: r["doc_id"]), docs):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(lower))
        at = [(k, label) for p, label in license_rules.BASE for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        want = (len(w), len(at), min((a for a, _ in at), default=None), max((a for a, _ in at), default=None), ",".join(sorted({x for _, x in at})))
        assert tuple(r)[1:6] == want


def test_rules_are_many_ordered_and_gated():
    rules = license_rules.build_rules()
    assert len(rules) > 300 and [r[3] for r in rules] == sorted((r[3] for r in rules), reverse=True) and all(r[0].strip() for r in rules)
    stems = license_rules.stems_of(rules)
    assert len(stems) < 70 and all(any(s in keyword for s in stems) for keyword, *_ in rules)


# ---------------------------------------------------------------- tokens

def test_encoding_equals_the_library(spark, library):
    rng = random.Random(7)
    parts = [" ", "  ", "\n", "\t", "\x85", "\xa0", "　", "a", "the", "é", "Ñ", "1", "²", "!", "...", "'s", "'ll", "'S", "<|endoftext|>", "<|", "🙂", "́", "中", "\x00", "x" * 400, "ab" * 300, "\r", "_"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(3000)] + [t or "" for _, t in ODD]
    encoder = bpe.Encoder(open(VOCABULARY, "rb").read())
    for text, ids in zip(texts, encoder.encode_many(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert encoder.decode(ids) == library.decode(want, skip_special_tokens=False) == text


def test_remembered_pieces_are_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBER_BYTES", 20_000)
    encoder = bpe.Encoder(open(VOCABULARY, "rb").read())
    rng = random.Random(8)
    for _ in range(5):
        texts = [" ".join("".join(rng.choice("abcé中") for _ in range(rng.choice([2, 5, 200]))) for _ in range(30)) for _ in range(20)]
        assert [np.frombuffer(i, dtype="<u4").tolist() for i in encoder.encode_many(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        for known in (encoder.plain, encoder.after_space):
            assert all(len(p) <= bpe.LONG_PIECE for p in known)
    assert max(encoder.held.values()) <= 20_000 // 2 + 40_000


def test_short_and_long_merges_agree():
    rng, v = random.Random(8), bpe.Vocabulary(open(VOCABULARY, "rb").read())
    for n in (1, 2, 3, 17, 90, 300):
        some = [bytes(rng.choice(b"the andion") for _ in range(n)) for _ in range(30)]
        assert [x.tolist() for x in v.merge_short(some)] == [v.merge_long(w) for w in some]


def test_bpe_frames(spark, library):
    odd = odd_rows(spark)
    rows = bpe.encode(odd, VOCABULARY, decoded=True).collect()
    assert Counter((r["doc_id"], r["decoded"]) for r in rows) == Counter((i, t or "") for i, t in ODD)
    back = bpe.decode(bpe.encode(odd, VOCABULARY), VOCABULARY)
    assert Counter(map(tuple, back.collect())) == Counter((i, t or "") for i, t in ODD)
    assert bpe.encode(odd.limit(0), VOCABULARY).count() == 0


def test_packing(spark, library):
    docs = [*ODD, (50, "some words of a text " * 900), (51, "x" * 3)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), VOCABULARY).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert all(r["length"] & (r["length"] - 1) == 0 and r["length"] <= 1024 and r["offset"] == 0 and len(r["ids"]) == 4 * r["length"] for r in rows)
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["start"])):
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i in (50, 51, 7, 11):
        text = dict(docs)[i]
        got = b"".join(bytes(r["ids"]) for r in sorted(by_doc[i], key=lambda r: r["start"]))
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids + [0]
    assert [(r["start"], r["length"]) for r in by_doc[1]] == [(0, 1)]
    for n in range(1, 5000, 7):
        parts = packing.lengths(n)
        assert sum(parts) == n and parts == sorted(parts, reverse=True) and len(set(p for p in parts if p < 1024)) == len([p for p in parts if p < 1024])
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), VOCABULARY, longest=1000)


def test_packing_by_either_encoder(spark, library, monkeypatch):
    texts = [("a " * 50 + "<|endoftext|> ñ  x\n",), ("",)]
    monkeypatch.setattr(packing, "LIBRARY_CHARS", 0)
    broadcast = spark.sparkContext.broadcast(open(VOCABULARY, "rb").read())
    own = packing._tokens_of(broadcast)
    for (text,) in texts:
        assert own(text).tolist() == library.encode(text, add_special_tokens=False).ids


# ---------------------------------------------------------------- URLs

def test_urls(spark):
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("org", "/fr", "block"),
         ("tie.com", "/a/", "allow"), ("tie.com", "/a/", "block"), ("Up.com", "/x", "block"), (None, None, None)],
        "host string, path string, verdict string")
    urls = [
        (1, "http://a.example.net/en/x?q#f", "allow", "example.net/en/"), (2, "http://net/x", "block", "net/"), (3, "http://b.net", "allow", None), (4, "http://notnet/x", "allow", None),
        (5, "https://x.EXAMPLE.com/de/", "block", "example.com/de/"), (6, "http://s.org/fr/x", "allow", "org/fr/"), (7, "http://s.org/france", "block", "org/fr"), (8, None, "allow", None),
        (9, "no scheme/net/", "allow", None), (10, "http://tie.com/a/b/c", "block", "tie.com/a/"), (11, "http://w.up.com/xyz/1", "block", "up.com/x"), (12, "://", "allow", None), (12, "://", "allow", None),
    ]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u, _, _ in urls], "page_id long, url string, host string, rule string")
    got = Counter((r["page_id"], r["verdict"], r["rule"]) for r in url_filter.judge(pages, rules).collect())
    assert got == Counter((i, v, rule) for i, _, v, rule in urls)
    assert {r["verdict"] for r in url_filter.judge(pages, rules.limit(0)).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_very_long_urls(spark):
    rules = spark.createDataFrame([("example.com", "/a/b/", "block"), ("", "/deep/", "block"), ("x.y.z", "/", "allow")], "host string, path string, verdict string")
    urls = ["http://w.example.com/a/b/" + "c/" * 100_000, "http://" + "w." * 5_000 + "example.com/a/b/c", "http://other.org/deep/" + "/" * 50_000, "http://a.b/" + "/" * 100_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["verdict"], r["rule"]) for r in url_filter.judge(pages, rules).collect()}
    assert got == {0: ("block", "example.com/a/b/"), 1: ("block", "example.com/a/b/"), 2: ("block", "/deep/"), 3: ("allow", None)}


def test_many_rules_join_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 1)
    rules = spark.createDataFrame([(f"h{i}.com", "/", "block") for i in range(50)], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, f"http://a.h{i}.com/p") for i in range(80)], "page_id long, url string")
    assert {r["page_id"] for r in url_filter.judge(pages, rules).where("verdict = 'block'").collect()} == set(range(50))
