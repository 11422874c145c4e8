"""SentencePiece BPE with offsets: ids and the source bytes of every piece, and decoding.

**Method.** A text is normalised first: at each place the longest rule of the model's compiled character map (a double array trie) replaces
what it matches, else the character stays; spaces become U+2581 and one is put before the text. Every normalised character remembers
where its source begins, so a piece of the normalised text projects to a span of the original bytes. Pieces are merged by score, the best pair first
and the leftmost of equals; characters outside the vocabulary become byte pieces, the last of which holds the character's span.

**Speed.** No piece of a usual model goes on over a U+2581, from a letter to a mark or over certain control characters, which the model's own pieces tell; there the
normalised text is cut into words. The words of a chunk that are not remembered are merged many at once, as rows of an array of parts and one
of pair ranks; words of more than ``SHORT_WORD`` characters keep their pairs in a heap. Ids of words are remembered up to
``REMEMBER_BYTES``, long words never. Where the map is empty, normalising is a replacement and the alignment follows from the lengths of the
characters. The model (0.5 MB, fixed) is read on the driver and broadcast; no text is shuffled.

**Cases.** Null and empty texts have no ids and decode to the empty text. Invalid UTF-8 is read as U+FFFD. Repeated rows and null ids get a row
each; an empty table gives an empty result. Columns other than the id and the text are not read. Models other than BPE and models with
user-defined or unused pieces are refused.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from itertools import groupby
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.arrays import batch_of, chunks, map_batches

SPACE = "\u2581"
CHUNK_BYTES = 1 << 20
SHORT_WORD = 64
BLOCK = 8192
REMEMBER_BYTES = 96 << 20
ENTRY_BYTES = 200  # a remembered word besides its characters and ids
NO_RANK = np.iinfo(np.int32).max
# Kinds of pieces and the number of a BPE model in the published format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The (number, value) fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at:at + size]
        at += size


class CharacterMap:
    """Longest-prefix replacement through a compiled character map: a double array trie over bytes, and the replacements."""

    def __init__(self, compiled: bytes):
        self.units = np.zeros(0, dtype=np.uint32)
        self.replacements = b""
        if compiled:
            size = struct.unpack_from("<I", compiled)[0]
            self.units = np.frombuffer(compiled, dtype="<u4", offset=4, count=size // 4).tolist()
            self.replacements = compiled[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """How many bytes from ``at`` the longest rule takes, and what it puts in their place."""
        units = self.units
        if not len(units):
            return None

        def offset(unit: int) -> int:
            return (unit >> 10) << ((unit & 512) >> 6)

        node, found = offset(units[0]), None
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(units) or units[node] & 0x800000FF != data[k]:
                break
            unit = units[node]
            node ^= offset(unit)
            if unit >> 8 & 1:
                found = (k + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        size, place = found
        return size, self.replacements[place:self.replacements.index(b"\0", place)].decode()


class Normaliser:
    """``apply(text)``: the normalised text and, for each of its characters and its end, the source byte where it begins."""

    def __init__(self, compiled: bytes, dummy_prefix: bool, remove_extra: bool, escape: bool, suffix: bool = False):
        self.map = CharacterMap(compiled)
        self.plain = not compiled and not remove_extra and not suffix
        self.dummy_prefix, self.remove_extra, self.suffix = dummy_prefix, remove_extra, suffix
        self.space = SPACE if escape else " "

    def apply(self, text: str) -> tuple[str, np.ndarray]:
        if not text:
            return "", np.zeros(1, dtype=np.int32)
        return self._plain(text) if self.plain else self._mapped(text)

    def _plain(self, text: str) -> tuple[str, np.ndarray]:
        code = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        starts = np.zeros(len(code) + 1 + self.dummy_prefix, dtype=np.int32)
        np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF), out=starts[1 + self.dummy_prefix:])
        return (self.space if self.dummy_prefix else "") + text.replace(" ", self.space), starts

    def _prefixes(self, text: str) -> Iterator[tuple[str, int]]:
        """(replacement, source bytes) from the first character to the last."""
        data, at = text.encode(), 0
        while at < len(data):
            rule = self.map.longest(data, at)
            if rule is None:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                rule = (size, data[at:at + size].decode("utf-8", "replace"))
            yield rule[1], rule[0]
            at += rule[0]

    def _mapped(self, text: str) -> tuple[str, np.ndarray]:
        out: list[str] = []
        align: list[int] = []
        consumed, begun, after_space = 0, False, self.remove_extra
        for put, size in self._prefixes(text):
            if not begun and self.remove_extra and put == " ":
                consumed += size
                continue
            if not begun:
                begun = True
                if self.dummy_prefix and not self.suffix:
                    out.append(self.space)
                    align.append(consumed)
            if after_space:
                put = put.lstrip(" ")
            if put:
                out += put.replace(" ", self.space)
                align += [consumed] * len(put)
                after_space = self.remove_extra and put.endswith(" ")
            consumed += size
        if not begun:
            return "", np.zeros(1, dtype=np.int32)
        while self.remove_extra and out and out[-1] == self.space:
            out.pop()
            consumed = align.pop()
        if self.suffix and self.dummy_prefix:
            out.append(self.space)
            align.append(consumed)
        return "".join(out), np.array([*align, consumed], dtype=np.int32)


class Model:
    """The pieces of a model file, its normaliser, and the merges that its scores stand for."""

    def __init__(self, contents: bytes):
        self.pieces: list[str] = []
        scores, self.kinds = [], []
        trainer: dict = {}
        normaliser: dict = {}
        for number, value in _fields(contents):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        if trainer.get(3, 1) != BPE or {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError("only BPE models without user-defined or unused pieces are supported")
        self.normaliser = Normaliser(
            normaliser.get(2, b""), bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)), bool(normaliser.get(5, 1)), bool(trainer.get(24, 0))
        )
        self.unknown = self.kinds.index(UNKNOWN)
        self.unknown_text = trainer.get(44, b" \xe2\x81\x87 ").decode()
        self.byte_ids = [self.pieces.index(f"<0x{b:02X}>") for b in range(256)] if trainer.get(35, 0) else None
        self.ids = {p: i for i, (p, kind) in enumerate(zip(self.pieces, self.kinds)) if kind == NORMAL}
        # Symbols: the pieces, characters that only longer pieces have, and one for all others.
        self.symbol = {p: i for p, i in self.ids.items() if len(p) == 1}
        for piece in self.ids:
            for c in piece if len(piece) > 1 else "":
                self.symbol.setdefault(c, len(self.pieces) + len(self.symbol))
        self.other = len(self.pieces) + len(self.symbol) + 1
        order = {s: r for r, s in enumerate(sorted({scores[i] for p, i in self.ids.items() if len(p) > 1}, reverse=True))}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}  # two symbols -> (rank, merged piece)
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                left, right = (self.ids.get(x, self.symbol.get(x)) for x in (piece[:k], piece[k:]))
                if left is not None and right is not None:
                    self.pairs[left, right] = (order[scores[i]], i)
        keys = np.array([a * (self.other + 1) + b for a, b in self.pairs], dtype=np.int64)
        by_key = np.argsort(keys)
        self.pair_keys = np.append(keys[by_key], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.array([rank for rank, _ in self.pairs.values()], dtype=np.int32)[by_key], NO_RANK).astype(np.int32)
        # The rank of a pair tells what it merges into, unless several pieces share a score (-1).
        self.piece_of_rank = np.zeros(len(order) + 1, dtype=np.int32)
        for rank, i in self.pairs.values():
            self.piece_of_rank[rank] = i if self.piece_of_rank[rank] in (0, i) else -1
        self.size_of = np.array([len(p) for p in self.pieces] + [1] * (self.other + 1 - len(self.pieces)), dtype=np.int64)
        self.symbol_of = np.full(0x110000, self.other, dtype=np.int32)  # by code point
        for c, symbol in self.symbol.items():
            self.symbol_of[ord(c)] = symbol
        self.words = self._cutter([p for p in self.ids if len(p) > 1])
        self.is_control = np.array([kind == CONTROL for kind in self.kinds])
        self.text_of = [
            b"" if kind == CONTROL else self.unknown_text.encode() if kind == UNKNOWN else bytes([int(p[3:5], 16)]) if kind == BYTE
            else p.replace(SPACE, " ").encode()
            for p, kind in zip(self.pieces, self.kinds)
        ]

    def _cutter(self, joined: list[str]):
        """The function that cuts a normalised text into words; None where some piece goes on over a space.

        Two characters that no piece has side by side, nor are linked by others that pieces have side by side, never merge. So a run of the full stop's
        kin, as the pieces have it (punctuation, usually), is a word, as is a run of all others; spaces go with what follows them.
        """
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in joined):
            return None
        kin: dict[str, set[str]] = {}
        for piece in joined:
            for a, b in zip(piece, piece[1:]):
                if a != SPACE:
                    kin.setdefault(a, set()).add(b)
                    kin.setdefault(b, set()).add(a)
        marks, todo = {"."}, ["."]
        while todo:
            new = kin.get(todo.pop(), set()) - marks
            marks |= new
            todo += new
        if "a" in marks:
            marks = set()
        inner = set("".join(joined))
        alone = "".join(re.escape(chr(c)) for c in range(1, 128) if chr(c) not in inner and not chr(c).isalnum())
        runs = "".join(map(re.escape, sorted(marks)))
        kinds = [f"{SPACE}*[^{SPACE}{runs}{alone}]+", *([f"{SPACE}*[{runs}]+"] if runs else []), f"{SPACE}+", *([f"[{alone}]"] if alone else [])]
        return re.compile("|".join(kinds)).findall

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * np.int64(self.other + 1) + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], np.int32(NO_RANK))

    def merge_short(self, words: list[str]) -> list[bytes]:
        """The pieces (see :meth:`pieces_of`) of words of one length: a row of parts and a row of ranks for each word."""
        size = len(words[0])
        parts = self.symbol_of[np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")].reshape(len(words), size)
        ranks = np.full((len(words), size), NO_RANK, dtype=np.int32)
        ranks[:, :-1] = self.rank(parts[:, :-1], parts[:, 1:])
        out: list = [None] * len(words)
        rows, left = np.arange(len(words)), np.full(len(words), size)
        places = np.arange(size)
        while len(rows):
            at = ranks.argmin(axis=1)
            line = np.arange(len(rows))
            going = ranks[line, at] != NO_RANK
            if not going.all():
                done, n_done = parts[~going], left[~going].tolist()
                known = (np.where(places < left[~going, None], done, 0) < len(self.pieces)).all(axis=1).tolist()
                both = np.stack([done, self.size_of[done]], axis=2).astype("<i4")
                for k, (r, n) in enumerate(zip(rows[~going].tolist(), n_done)):
                    out[r] = both[k, :n].tobytes() if known[k] else self.pieces_of(words[r], done[k, :n].tolist())
                rows, left, at, parts, ranks = (x[going] for x in (rows, left, at, parts, ranks))
                line = np.arange(len(rows))
            if not len(rows):
                break
            merged = self.piece_of_rank[ranks[line, at]]
            for k in np.flatnonzero(merged < 0).tolist():
                merged[k] = self.pairs[int(parts[k, at[k]]), int(parts[k, at[k] + 1])][1]
            moved = np.minimum(places + (places > at[:, None]), size - 1)
            parts, ranks = np.take_along_axis(parts, moved, axis=1), np.take_along_axis(ranks, moved, axis=1)
            left = left - 1
            parts[line, at] = merged
            ranks[line, left - 1] = NO_RANK
            for pick, place in ((at + 1 < left, at), (at > 0, at - 1)):
                r = np.flatnonzero(pick)
                p = place[r]
                ranks[r, p] = self.rank(parts[r, p], parts[r, p + 1])
        return out

    def merge_long(self, word: str) -> list[int]:
        parts = [self.symbol.get(c, self.other) for c in word]
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < n and (pair := self.pairs.get((parts[i], parts[after[i]]))) is not None:
                heapq.heappush(heap, (pair[0], i, pair[1], parts[i], parts[after[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, merged, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i], parts[j] = merged, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p >= 0]

    def pieces_of(self, word: str, symbols: list[int]) -> bytes:
        """For each piece its id and the number of normalised characters that it stands for, packed."""
        out: list[int] = []
        at = 0
        for symbol in symbols:
            size = int(self.size_of[symbol])
            if symbol < len(self.pieces):
                out += [symbol, size]
            elif self.byte_ids is None:
                out += [self.unknown, size]
            else:  # the last byte stands for the character
                data = word[at].encode("utf-8", "replace")
                for b in data[:-1]:
                    out += [self.byte_ids[b], 0]
                out += [self.byte_ids[data[-1]], 1]
            at += size
        return struct.pack(f"<{len(out)}i", *out)


class Encoder:
    def __init__(self, contents: bytes):
        self.model = Model(contents)
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0

    def _learn(self, wanted: set[str]) -> dict[str, bytes]:
        """The pieces of all wanted words; short ones are remembered."""
        new = [w for w in wanted if w not in self.known]
        by_size: dict[int, list[str]] = {}
        for word in new:
            by_size.setdefault(len(word) if len(word) <= SHORT_WORD else 0, []).append(word)
        long = {w: self.model.pieces_of(w, self.model.merge_long(w)) for w in by_size.pop(0, [])}
        learnt: dict[str, bytes] = {}
        for words in by_size.values():
            for some in (words[k:k + BLOCK] for k in range(0, len(words), BLOCK)):
                learnt.update(zip(some, self.model.merge_short(some)))
        size = sum(ENTRY_BYTES + 4 * len(w) + len(p) for w, p in learnt.items())
        if self.known_bytes + size > REMEMBER_BYTES:
            learnt.update((w, self.known[w]) for w in wanted if w in self.known)
            self.known, self.known_bytes = {}, 0
        self.known.update(learnt)
        self.known_bytes += size
        return long

    def encode_many(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text the ids, and the source byte where each piece ends; a piece begins where the one before ends."""
        model = self.model
        cut, aligned = [], []
        for text in texts:
            normal, starts = model.normaliser.apply(text)
            cut.append(model.words(normal) if model.words else [normal] if normal else [])
            aligned.append(starts)
        long = self._learn(set().union(*cut) if cut else set())
        out = []
        for words, starts in zip(cut, aligned):
            try:
                pieces = b"".join(map(self.known.__getitem__, words))
            except KeyError:
                pieces = b"".join([long[w] if w in long else self.known[w] for w in words])
            ids, sizes = np.frombuffer(pieces, dtype="<i4").reshape(-1, 2).T
            if model.byte_ids is None and len(ids):  # neighbours that are unknown count as one
                again = (ids[1:] == model.unknown) & (ids[:-1] == model.unknown)
                last = np.append(~again, True)
                ids, ends = ids[last], np.cumsum(sizes)[last]
            else:
                ends = np.cumsum(sizes)
            out.append((ids, starts[ends]))
        return out

    def decode(self, ids: np.ndarray | list[int]) -> str:
        model, numbers = self.model, np.asarray(ids, dtype=np.int64)
        ids = numbers.tolist()
        parts = list(map(model.text_of.__getitem__, ids))
        kinds, normaliser = model.kinds, model.normaliser
        if normaliser.dummy_prefix or normaliser.remove_extra:
            # The first piece loses the space put before the text; with extra spaces removed, so do others until there is text.
            for k, i in enumerate(ids):
                if kinds[i] == CONTROL:
                    continue
                if kinds[i] != NORMAL or not parts[k].startswith(b" "):
                    break
                parts[k] = parts[k][1:]
                if parts[k] or not normaliser.remove_extra:
                    break
        joined = b"".join(parts)
        try:
            text = joined.decode()
        except UnicodeDecodeError:
            text = None
        if text is None or model.is_control[numbers].any():
            # bytes on both sides of a control piece are no character
            return "".join([_decoded(b"".join(p for p, _ in run)) for _, run in groupby(zip(parts, ids), lambda x: kinds[x[1]] == CONTROL)])
        return text


def _decoded(data: bytes) -> str:
    """Each byte that is not part of a character becomes U+FFFD."""
    out, at = [], 0
    while at < len(data):
        lead = data[at]
        size = 1 if lead < 0x80 else 2 if 0xC0 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF8 else 1
        try:
            out.append(data[at:at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("\ufffd")
            at += 1
    return "".join(out)


_encoders: dict[int, Encoder] = {}


def _encoder_of(broadcast) -> Encoder:
    """One encoder per Python worker and broadcast model."""
    key = hash(broadcast.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(broadcast.value)
    return _encoders[key]


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0] + [len(v) for v in values]).astype(np.int32)
    flat = np.concatenate([*values, np.zeros(0, dtype=np.int32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Per row: the id, n_tokens, ids and ends (arrays of int; ends in bytes of the text) and, if asked for, the decoded text."""
    model = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())

    def apply(batches):
        encoder = _encoder_of(model)
        for batch in batches:
            for first, texts in chunks(batch, "text", CHUNK_BYTES):
                encoded = encoder.encode_many([t.decode("utf-8", "replace") for t in texts])
                columns = [
                    batch.column(0).slice(first, len(texts)), pa.array([len(i) for i, _ in encoded], pa.int64()),
                    _lists([i for i, _ in encoded]), _lists([e for _, e in encoded]),
                ]
                names = ["doc_id", "n_tokens", "ids", "ends"]
                if decoded:
                    names.append("decoded")
                    columns.append(pa.array([encoder.decode(i) for i, _ in encoded], pa.string()))
                yield batch_of(names, columns)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = map_batches(rows, apply, f"doc_id {kind}, n_tokens bigint, ids array<int>, ends array<int>" + ", decoded string" * decoded)
    return out.withColumnRenamed("doc_id", id_col)


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: the id and the text of its ids; an id outside the vocabulary raises, null ids give the empty text."""
    model = rows.sparkSession.sparkContext.broadcast(Path(path).read_bytes())

    def apply(batches):
        encoder = _encoder_of(model)
        for batch in batches:
            texts = [encoder.decode(i.as_py() or []) for i in batch.column(1)]
            yield batch_of(["doc_id", "decoded"], [batch.column(0), pa.array(texts, pa.string())])

    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, apply, f"doc_id {kind}, decoded string").withColumnRenamed("doc_id", id_col)
