"""Spelling variants, sentence pieces with offsets, and the conversation trie, each against brute force or the library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import LOWER, ODD, WORD, odd_rows

from colloquy.llm import prefix_trie, queries, sentence_pieces, spelling

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- spelling variants

def _counts(docs, every):
    out = Counter()
    for i, text in docs:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(LOWER)
            if every and (h := zlib.crc32(f"{'' if i is None else i}:{word}".encode())) % every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= 7:
                out[word] += 1
    return {w: n for w, n in out.items() if n >= 2}


def _one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def _variants(counts):
    near = {w: [x for x in counts if _one_edit(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def _got(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


def test_query_equals_brute_force_on_its_table(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = _got(queries.op11_spelling_variants(spark, SMALL))
    assert got == _variants(_counts(docs, 31)) and len(got) > 100


def test_edits_at_both_ends_chains_and_ties(spark):
    rng = random.Random(3)
    words = ["abcdefgh"] * 3000 + ["abcdefg"] * 200 + ["abcdefgx"] * 20 + ["xbcdefgx"] * 2 + ["bcdefgh"] * 200 + ["aabcdefgh"] * 5 + ["Abcdefghh"] * 7
    words += ["Éclairage"] * 40 + ["éclairage"] * 3 + ["eclairage"] * 4 + ["aaaaaaa"] * 30 + ["aaaaaaaa"] * 3 + ["zzzzzzz"] * 20 + ["zzzzzzy"] * 20 + ["zzzzzzx"] * 2
    for _ in range(400):
        word = "".join(rng.choice("ab") for _ in range(rng.randint(7, 10)))
        words += [word] * rng.choice([2, 3, 40])
    rng.shuffle(words)
    docs = [(i, " ".join(words[i::50])) for i in range(50)] + [(i, t) for i, t in ODD] + [(99, "q" * 5000 + " " + "q" * 5000 + "7" + "q" * 5001 + "_" + "q" * 5001)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for every in (None, 2):
        assert _got(spelling.spelling_variants(frame, typo_every=every)) == _variants(_counts(docs, every))


def test_crowded_keys_are_cut_into_blocks(spark, monkeypatch):
    rng = random.Random(4)
    counts = {"aaa" + "".join(rng.choice("abc") for _ in range(5)) + "zzz": rng.randint(2, 99) for _ in range(250)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = _variants(counts)
    near = {r["word"]: (r["n_near"], r["near_n"]) for r in spelling.near_words(frame, block=16).collect()}
    assert near == {w: (v[3], max(counts[x] for x in counts if _one_edit(w, x))) for w, v in want.items() if v[3]}
    # few rows at once: a group's queries go on after its words were looked at
    monkeypatch.setattr(spelling, "ROWS_AT_ONCE", 8)
    monkeypatch.setattr(spelling, "LANES", 4)
    rows = spelling._keys(frame).orderBy("side", "length", "group", "query").select("side", "length", "group", "word", "n", "query").toArrow().to_batches(max_chunksize=10)
    found = Counter()
    for batch in spelling._search(rows):
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found[word] += n
    assert found == {w: v[3] for w, v in want.items() if v[3]}


def test_variants_of_odd_and_empty_tables(spark):
    assert _got(spelling.spelling_variants(odd_rows(spark), typo_every=31)) == _variants(_counts(ODD, 31))
    assert spelling.spelling_variants(odd_rows(spark).limit(0)).collect() == []


# ---------------------------------------------------------------- sentence pieces

ALPHABET = [
    "a", "b", "the ", "ing", " ", "  ", "\n", "\t", "▁", "é", "中", "文", "\U0001f642", "é", "x", "10", ".", "<s>", "</s>", "<unk>", "<0x41>",
    "\x00", "　", "ﬁ", "\r\n", " the", "http://", "\xa0", "½", "①",
]


def _texts(n):
    rng = random.Random(5)
    return ["", " ", "▁", "a" * 700, " " * 300, "中文" * 200] + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def _expected(library, text):
    proto = library.encode(text, return_type="proto")
    return [p.id for p in proto.pieces], [(p.begin, p.end) for p in proto.pieces]


def _check(library, encoder, texts):
    for text, (ids, ends) in zip(texts, encoder.encode_many(texts)):
        want, spans = _expected(library, text)
        assert ids.tolist() == want, text
        ends = ends.tolist()
        assert ends == [e for _, e in spans], text
        assert encoder.decode(ids) == library.decode(want), text


def test_ids_spans_and_decoding_equal_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoder = sentence_pieces.Encoder(open(MODEL, "rb").read())
    texts = _texts(1500)
    _check(library, encoder, texts)
    for text, (_, ends) in zip(texts, encoder.encode_many(texts)):
        starts = [0, *ends.tolist()]
        assert [(a, b) for a, b in zip(starts, starts[1:])] == _expected(library, text)[1]
    rng = random.Random(6)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3), 259, 29871]) for _ in range(rng.randint(0, 8))]
        assert encoder.decode(ids) == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("remove_extra", [0, 1])
def test_character_maps_keep_the_source_alignment(rule, remove_extra):
    def number(x):
        out = b""
        while True:
            out += bytes([x & 127 | (128 if x > 127 else 0)])
            x >>= 7
            if not x:
                return out

    def field(n, value):
        return number(n << 3 | 2) + number(len(value)) + value

    published = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    spec = dict(sentence_pieces._fields(next(v for n, v in sentence_pieces._fields(published) if n == 3)))
    normaliser = field(2, spec[2]) + b"\x18\x01\x20" + bytes([remove_extra]) + b"\x28\x01"
    contents = b"".join(field(n, normaliser if n == 3 else v) for n, v in sentence_pieces._fields(open(MODEL, "rb").read()))
    _check(sentencepiece.SentencePieceProcessor(model_proto=contents), sentence_pieces.Encoder(contents), _texts(300))


def test_piece_rows_of_odd_tables_and_the_way_back(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = sentence_pieces.encode(odd_rows(spark), MODEL, decoded=True)
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids"], r["decoded"]) for r in rows.collect()), key=str)
    want = [(i, library.encode(t or "")) for i, t in ODD]
    assert got == sorted(((i, len(x), x, library.decode(x)) for i, x in want), key=str)
    back = sentence_pieces.decode(rows.select("doc_id", "ids"), MODEL).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, library.decode(x)) for i, x in want), key=str)
    assert sentence_pieces.encode(odd_rows(spark).limit(0), MODEL).collect() == []


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "REMEMBER_BYTES", 5000)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoder = sentence_pieces.Encoder(open(MODEL, "rb").read())
    texts = _texts(300)
    for some in (texts[:100], texts[50:200], texts):
        assert [i.tolist() for i, _ in encoder.encode_many(some)] == [library.encode(t) for t in some]
    assert all(len(w) <= sentence_pieces.SHORT_WORD for w in encoder.known)


def test_piece_query_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op12_sentence_pieces(spark, SMALL).collect()}
    for doc, text in docs:
        ids = library.encode(text or "")
        assert got[doc] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    assert len(got) == len(docs)


# ---------------------------------------------------------------- conversation trie

def _trie(rows, family):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append(((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]), (role, text)))
    turns = {c: [t for _, t in sorted(v)] for c, v in convs.items()}
    if family:
        h = {c: zlib.crc32(str(c).encode()) % 4 for c in turns}
        turns = {c: turns.get(c - int(math.fmod(c, family)), [])[:h[c]] + t[h[c]:] for c, t in turns.items()}
    members, ends, words = defaultdict(list), defaultdict(list), {}
    for c in sorted(turns):
        for d in range(len(turns[c]) + 1):
            members[tuple(turns[c][:d])].append(c)
        ends[tuple(turns[c])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = sum(saved[x] for x in children[node]) + ((len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0)
    return sorted((
        (m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(children[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
        for n, m in members.items()
    ), key=str)


def _rows_of(frame):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


def test_trie_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _rows_of(queries.op13_prefix_trie(spark, SMALL)) == _trie(rows, 20)


def test_trie_of_odd_rows_split_by_joins_and_in_tasks(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice(["a b", "", None, "c"])) for c in range(60) for t in range(rng.randint(0, 7))]
    rows += [(77, t, "user", f"w{t} x") for t in range(70)] + [(78, t, "user", f"w{t} x") for t in range(55)]  # a long path, shared
    rows += [(5, None, "user", "no turn"), (5, 3, "bot", "tie"), (5, 3, "bot", "tie"), (None, 1, "user", "nobody"), (-3, 0, "user", "a b"), (61, 0, "user", "a b")]
    rows += [(c, 0, "user", "hello") for c in range(100, 140)]
    schema = "conv_id long, turn int, role string, text string, depth string, owner int, prefix string"
    frame = spark.createDataFrame([(*r, "d", 1, "p") for r in rows], schema).repartition(5)
    monkeypatch.setattr(prefix_trie, "SPAN", 16)
    for family, limit in ((None, 4096), (20, 12)):
        paths = prefix_trie.paths(prefix_trie.numbered_turns(frame), family=family)
        assert _rows_of(prefix_trie.prefix_trie(paths, limit)) == _trie(rows, family), (family, limit)
    empty = prefix_trie.paths(prefix_trie.numbered_turns(frame.limit(0)), family=20)
    assert prefix_trie.prefix_trie(empty).collect() == []


def test_centroid_sums_of_random_forests():
    rng = np.random.default_rng(8)
    for n in (1, 2, 50, 400):
        parent = np.array([-1 if i == 0 or rng.random() < 0.05 else rng.integers(max(0, i - rng.integers(1, 40)), i) for i in range(n)])
        depth = np.zeros(n, dtype=np.int64)
        for i in range(n):
            depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
        order = np.argsort(depth, kind="stable")
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        parent = np.where(parent[order] < 0, -1, place[parent[order]])
        values = rng.integers(0, 9, (n, 2))
        want = values.copy()
        for i in reversed(range(n)):
            if parent[i] >= 0:
                want[parent[i]] += want[i]
        assert (prefix_trie._split_here(parent, depth[order], values) == want).all()
