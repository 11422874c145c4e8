"""Byte-level BPE: encoding and decoding with a published vocabulary file.

**Method.** A word's parts are held as two arrays, the ids of the parts and the rank of each neighbouring pair. The least rank is
found by a scan, the boundary between its two parts is deleted, and the ranks of the two new neighbours are looked up again, until no
pair has a rank. A scan is quadratic in the length of a word, so words of more than ``SHORT_WORD`` bytes keep their pairs in a heap.

**Speed.** Text is cut at single spaces first. Such a piece, with its space, splits into the same words as it does within the whole
text unless white space stands at its edge; those texts are split by the full pattern. Ids of recent pieces are kept up to ``REMEMBER_BYTES``; pieces
of more than ``LONG_PIECE`` characters, such as text without spaces has, are not. The vocabulary (1.6 MB, fixed) is read on the driver and broadcast; no text is shuffled.

**Cases.** Null and empty texts have no ids and decode to the empty text. The special token's string in a text becomes its id, as the
tokenizers library has it unless told otherwise. Invalid UTF-8 is read as U+FFFD. Repeated rows and null ids get a row each; an empty
table gives an empty result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import heapq
import json
import struct
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.arrays import batch_of, chunks, map_batches

SHORT_WORD = 128
BLOCK = 8192
LONG_PIECE = 64
REMEMBER_BYTES = 64 << 20
ENTRY_BYTES = 200  # a remembered piece besides its characters and ids
# The pattern that cuts text into words before merging, as published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = 1 << 60


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: printable bytes for themselves, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Vocabulary:
    """Ids of bytes, ranks of pairs of ids, and the bytes of each id, from a vocabulary file's contents."""

    def __init__(self, contents: bytes | str):
        described = json.loads(contents)
        letters = _byte_letters()
        vocab = described["model"]["vocab"]
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in described["added_tokens"])]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.of_byte = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        # pair of ids -> rank, and rank -> id of the merged part
        self.ranks, self.merged = {}, []
        for rank, merge in enumerate(described["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[vocab[left], vocab[right]] = rank
            self.merged.append(vocab[left + right])
        self.merged = np.array(self.merged, dtype=np.int64)
        keys = np.array([a * len(self.bytes_of) + b for a, b in self.ranks], dtype=np.int64)
        self.pair_ranks, self.pair_keys = np.argsort(keys), np.sort(keys)
        self.byte_ids = np.array(self.of_byte, dtype=np.int64)
        grid = np.broadcast_to(self.byte_ids[:, None], (256, 256))
        self.byte_ranks = self.rank_of(grid, grid.T)

    def merge_short(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of words of one length: an array of parts and one of neighbouring ranks, a row for each word."""
        n, longest = len(words), len(words[0])
        letters = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(n, longest)
        left = np.full(n, longest)
        parts = self.byte_ids[letters]
        ranks = np.full((n, longest), NO_RANK, dtype=np.int64)  # of each part with the next; the last has none
        ranks[:, :-1] = self.byte_ranks[letters[:, :-1], letters[:, 1:]]
        out: list = [None] * n
        rows, places = np.arange(n), np.arange(longest)[None, :]
        while len(rows):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            going = least != NO_RANK
            if not going.all():
                done = ~going
                for r, ids, size in zip(rows[done].tolist(), parts[done].astype("<u4"), left[done].tolist()):
                    out[r] = ids[:size]
                rows, at, least, left, parts, ranks = (x[going] for x in (rows, at, least, left, parts, ranks))
                if not len(rows):
                    break
            # Delete the boundary behind part ``at``: what stands behind moves up by one.
            moved = np.minimum(places + (places > at[:, None]), longest - 1)
            parts, ranks = np.take_along_axis(parts, moved, axis=1), np.take_along_axis(ranks, moved, axis=1)
            row = np.arange(len(rows))
            left = left - 1
            parts[row, at] = self.merged[least]
            ranks[row, left - 1] = NO_RANK
            has = np.flatnonzero(at + 1 < left)
            ranks[has, at[has]] = self.rank_of(parts[has, at[has]], parts[has, at[has] + 1])
            has = np.flatnonzero(at > 0)
            ranks[has, at[has] - 1] = self.rank_of(parts[has, at[has] - 1], parts[has, at[has]])
        return out

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * len(self.bytes_of) + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)

    def merge_long(self, word: bytes) -> list[int]:
        parts = [self.of_byte[b] for b in word]
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < n and (rank := self.ranks.get((parts[i], parts[after[i]]))) is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[after[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i], parts[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p >= 0]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, packed."""
        out: list = [b""] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_size.setdefault(len(word) if len(word) <= SHORT_WORD else -1, []).append(i)
        for size, rows in by_size.items():
            if size < 0:
                for i in rows:
                    out[i] = packed(self.merge_long(words[i]))
            elif size:
                for some in (rows[k:k + BLOCK] for k in range(0, len(rows), BLOCK)):
                    for i, ids in zip(some, self.merge_short([words[i] for i in some])):
                        out[i] = ids.tobytes()
        return out


class Encoder:
    def __init__(self, contents: bytes | str):
        self.vocabulary = Vocabulary(contents)
        self.find = regex.compile(PATTERN).findall
        # Ids of pieces that follow a space (kept without it), and of pieces as they are.
        self.after_space: dict[str, bytes | None] = {}
        self.plain: dict[str, bytes | None] = {}
        self.held = {" ": 0, "": 0}
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        # No special token can stand in a piece of letters alone.
        self.letters_only = not any(t.strip().isalpha() for t in special)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def _split(self, piece: str) -> list[str | int]:
        """The words of a piece; a special token is given as its id."""
        if self.special and self.special.search(piece):
            out: list[str | int] = []
            for i, part in enumerate(self.special.split(piece)):
                out += [self.vocabulary.special[part]] if i % 2 else self.find(part)
            return out
        return self.find(piece)

    def _learn(self, known: dict, wanted: set[str], space: str) -> dict[str, bytes | None]:
        """Add the ids of ``wanted``, each behind ``space``, to ``known``; None for those that must stay with their neighbours.

        Long pieces are returned instead of remembered.
        """
        new = wanted.difference(known)
        words: dict[str, int] = {}
        split, single, learnt = [], [], {}
        for piece in new:
            if space and (not piece or piece[0].isspace() or piece[-1].isspace()):
                learnt[piece] = None
                continue
            if self.letters_only and piece.isalpha() and piece.isascii():  # one word, as the pattern has it
                single.append((piece, words.setdefault(space + piece, len(words))))
                continue
            parts = self._split(space + piece)
            split.append((piece, parts))
            for word in parts:
                if isinstance(word, str):
                    words.setdefault(word, len(words))
        ids = self.vocabulary.merge([w.encode() for w in words])
        for piece, i in single:
            learnt[piece] = ids[i]
        for piece, parts in split:
            learnt[piece] = b"".join([ids[words[w]] if isinstance(w, str) else packed([w]) for w in parts])
        long = {piece: i for piece, i in learnt.items() if len(piece) > LONG_PIECE}
        short = {piece: i for piece, i in learnt.items() if len(piece) <= LONG_PIECE}
        size = sum(ENTRY_BYTES + 4 * len(piece) + len(i or b"") for piece, i in short.items())
        if self.held[space] + size > REMEMBER_BYTES // 2:
            short.update((piece, known[piece]) for piece in wanted if piece in known)
            known.clear()
            self.held[space] = 0
        known.update(short)
        self.held[space] += size
        return long

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        cut = [t.split(" ") for t in texts]
        long_first = self._learn(self.plain, {c[0] for c in cut}, "")
        wanted: set[str] = set()
        for c in cut:
            wanted.update(c[1:])
        long = self._learn(self.after_space, wanted, " ")
        out: list = []
        for c in cut:
            try:
                if c[0][-1:].isspace():
                    raise TypeError
                first = long_first[c[0]] if len(c[0]) > LONG_PIECE else self.plain[c[0]]
                try:
                    rest = b"".join(map(self.after_space.__getitem__, c[1:]))
                except KeyError:
                    rest = b"".join([long[p] if len(p) > LONG_PIECE else self.after_space[p] for p in c[1:]])
                out.append(first + rest)
            except TypeError:  # white space at an edge (a None): the text is split as a whole
                out.append(None)
        whole = [i for i, ids in enumerate(out) if ids is None]
        if whole:
            split = [self._split(texts[i]) for i in whole]
            long = self._learn(self.plain, {w for s in split for w in s if isinstance(w, str)}, "")
            for i, parts in zip(whole, split):
                out[i] = b"".join([packed([w]) if not isinstance(w, str) else long[w] if len(w) > LONG_PIECE else self.plain[w] for w in parts])
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> str:
        table = self.vocabulary.bytes_of
        return b"".join(map(table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


_encoders: dict[int, Encoder] = {}


def encoder_of(broadcast) -> Encoder:
    """One encoder per Python worker and broadcast vocabulary."""
    key = hash(broadcast.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(broadcast.value)
    return _encoders[key]


def broadcast_vocabulary(docs: DataFrame, path: str):
    return docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Per row: the id, n_tokens, ids (binary: little-endian unsigned 32-bit numbers) and, if asked for, the decoded text."""
    vocabulary = broadcast_vocabulary(docs, path)

    def apply(batches):
        encoder = encoder_of(vocabulary)
        for batch in batches:
            for first, texts in chunks(batch, "text"):
                ids = encoder.encode_many([t.decode("utf-8", "replace") for t in texts])
                columns = [batch.column(0).slice(first, len(texts)), [len(i) // 4 for i in ids], pa.array(ids, pa.large_binary())]
                names = ["doc_id", "n_tokens", "ids"]
                if decoded:
                    names.append("decoded")
                    columns.append(pa.array([encoder.decode(i) for i in ids], pa.large_string()))
                columns[1] = pa.array(columns[1], pa.int64())
                yield batch_of(names, columns)

    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = map_batches(docs, apply, f"doc_id {kind}, n_tokens bigint, ids binary" + ", decoded string" * decoded)
    return out.withColumnRenamed("doc_id", id_col)


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: the id and the text of its ids; an id outside the vocabulary raises, null ids give the empty text."""
    vocabulary = broadcast_vocabulary(rows, path)

    def apply(batches):
        encoder = encoder_of(vocabulary)
        for batch in batches:
            texts = [encoder.decode(i.as_py() or b"") for i in batch.column(1)]
            yield batch_of(["doc_id", "decoded"], [batch.column(0), pa.array(texts, pa.large_string())])

    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, apply, f"doc_id {kind}, decoded string").withColumnRenamed("doc_id", id_col)
