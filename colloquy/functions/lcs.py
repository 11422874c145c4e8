"""Longest common subsequence scores: the one text metric that needs Python.

Catalyst has no linear-space way to carry a dynamic-programming row, so the two LCS scores
run as one Arrow function. It sees one row at a time and holds a row of the table as a
Python integer, one bit per token.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions import fixed_values as fixed

_TOKENS = re.compile(fixed.ROUGE_TOKEN)


def tokens_of(text: str) -> list[str]:
    return _TOKENS.findall(text)


# So few rows of the table are all kept.
FEW_ROWS = 64
# Up to this many tokens a line keeps a bit row for each token; of a longer one only tokens with so many places do, others are made when asked for.
SHORT_LINE, MANY_PLACES = 2048, 1024


class _Places:
    """The places of each token of a long line, as a bit row on request."""

    def __init__(self, tokens: list[str | None]):
        self.width = len(tokens)
        self.places: dict[str | None, list[int]] = {}
        for j, token in enumerate(tokens):
            self.places.setdefault(token, []).append(j)
        self.rows = {t: self._row(at) for t, at in self.places.items() if len(at) >= MANY_PLACES}

    def _row(self, at: list[int]) -> int:
        if len(at) == 1:
            return 1 << at[0]
        bits = bytearray(self.width // 8 + 1)
        for j in at:
            bits[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(bits, "little")

    def get(self, token: str, default: int = 0) -> int:
        row = self.rows.get(token)
        if row is None and token in self.places:
            row = self._row(self.places[token])
        return default if row is None else row

    def keys(self):
        return self.places.keys()

    def pop(self, token: str | None, default: None = None) -> None:
        self.places.pop(token, default)
        self.rows.pop(token, default)


def _columns_by_token(tokens: list[str]) -> dict[str, int] | _Places:
    if len(tokens) > SHORT_LINE:
        return _Places(tokens)
    places: dict[str, int] = {}
    for j, token in enumerate(tokens):
        places[token] = places.get(token, 0) | (1 << j)
    return places


def _rows(rows: list[str], width: int, places: dict[str, int] | _Places, state: int | None = None):
    """Yield, after each row token, the bits that are 0 where the LCS length steps up; ``state`` is that of the row before."""
    full = (1 << width) - 1
    state = full if state is None else state
    for token in rows:
        hits = state & places.get(token, 0)
        if hits:
            state = ((state + hits) | (state - hits)) & full
        yield state


def lcs_length(a: list[str], b: list[str]) -> int:
    if not a or not b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    state = (1 << len(b)) - 1
    for state in _rows(a, len(b), _columns_by_token(b)):
        pass
    return len(b) - state.bit_count()


def _condensed(candidate: list[str], shared: set[str]) -> list[str | None]:
    """The candidate with each run of tokens that are not ``shared`` as one None: the tracing below only asks whether it stands behind a match."""
    out: list[str | None] = []
    for token in candidate:
        if token in shared:
            out.append(token)
        elif not out or out[-1] is not None:
            out.append(None)
    return out


def _states(tokens: list[str], width: int, hits: dict[str, int] | _Places):
    """A function from row numbers, asked for in falling order, to the states of the table's rows; every sqrt(m)-th is kept."""
    step = max(1, math.isqrt(len(tokens)))
    kept = [(1 << width) - 1]
    for i, state in enumerate(_rows(tokens, width, hits), 1):
        if i % step == 0:
            kept.append(state)
    block, states = -1, []

    def state_of(i: int) -> int:
        nonlocal block, states
        if i // step != block:
            block = i // step
            start = kept[block]
            states = [start, *_rows(tokens[block * step:(block + 1) * step - 1], width, hits, start)]
        return states[i - block * step]

    return state_of


def lcs_reference_positions(
    reference: list[str], candidate: list[str], places: dict[str, int] | _Places | None = None
) -> set[int]:
    """Positions in ``reference`` of one LCS.

    Traced from the end: equal tokens are taken, otherwise step back in the candidate only
    if that keeps a strictly longer subsequence than stepping back in the reference.

    Reference tokens that the candidate lacks are never taken and change no length, so only the others are rows of the table. Of
    its m rows every sqrt(m)-th is kept; the rows between two of them are made again when the trace gets there, so the memory is
    that of 2 sqrt(m) rows and, for long lines, of the bit rows of its few frequent tokens.
    """
    known = places.keys() if places is not None else set(candidate)
    rows = [i for i, token in enumerate(reference) if token in known]
    if not rows:
        return set()
    tokens = [reference[i] for i in rows]
    shared = set(tokens)
    if len(shared) == 1 and len(rows) == 1:
        return {rows[0]}
    if isinstance(places, dict):  # the bit rows of a short line serve as they are
        columns, hits = candidate, places
    else:
        columns = _condensed(candidate, shared)
        hits = _columns_by_token(columns)
        hits.pop(None, None)
    first = (1 << len(columns)) - 1
    if len(rows) <= FEW_ROWS:
        state_of = [first, *_rows(tokens, len(columns), hits)].__getitem__
    else:
        state_of = _states(tokens, len(columns), hits)
    taken: set[int] = set()
    i, j = len(rows), len(columns)
    now = state_of(i)
    here = j - now.bit_count()
    while here:
        above = state_of(i - 1)
        above_here = j - (above & ((1 << j) - 1)).bit_count()
        # Back in the candidate while this row loses nothing by it and the row above is shorter.
        while columns[j - 1] != tokens[i - 1] and above_here < here and now >> (j - 1) & 1:
            above_here -= 1 - (above >> (j - 1) & 1)
            j -= 1
        if columns[j - 1] == tokens[i - 1]:
            taken.add(rows[i - 1])
            j -= 1
            above_here -= 1 - (above >> j & 1)
        i, now, here = i - 1, above, above_here
    return taken


def f_measure(hits: int, n_candidate: int, n_reference: int) -> float:
    if not hits:
        return 0.0
    precision, recall = hits / n_candidate, hits / n_reference
    return 2 * precision * recall / (precision + recall)


def rouge_l_pair(candidate: str, reference: str) -> float:
    cand, ref = tokens_of(candidate), tokens_of(reference)
    return f_measure(lcs_length(cand, ref), len(cand), len(ref))


def rouge_lsum_pair(candidate: str, reference: str) -> float:
    """Line-wise: every reference line takes the union of its LCS with each candidate line,
    and a token counts at most as often as it occurs on both sides."""
    if "\n" not in candidate and "\n" not in reference:
        return rouge_l_pair(candidate, reference)
    cand_lines = [tokens_of(line) for line in candidate.split("\n") if line]
    ref_lines = [tokens_of(line) for line in reference.split("\n") if line]
    left_cand = Counter(token for line in cand_lines for token in line)
    left_ref = Counter(token for line in ref_lines for token in line)
    n_cand, n_ref = sum(left_cand.values()), sum(left_ref.values())
    hits = 0
    places = [_columns_by_token(line) for line in cand_lines]
    whole = {tuple(line) for line in cand_lines}
    for line in ref_lines:
        # A line that the candidate has word for word is found whole.
        union = set(range(len(line))) if tuple(line) in whole else set()
        missing = set() if union else set(line)
        for other, at in zip(cand_lines, places):
            if not missing:
                break
            # A line without any of the tokens that are still to be found adds nothing.
            if not at.keys().isdisjoint(missing):
                union |= lcs_reference_positions(line, other, at)
                missing = {token for i, token in enumerate(line) if i not in union}
        for at in sorted(union):
            token = line[at]
            if left_cand[token] > 0 and left_ref[token] > 0:
                left_cand[token] -= 1
                left_ref[token] -= 1
                hits += 1
    return f_measure(hits, n_cand, n_ref)


@F.pandas_udf(T.DoubleType())
def rouge_l_f1(candidate: pd.Series, reference: pd.Series) -> pd.Series:
    """F1 of the longest common subsequence; both texts already lower-case."""
    return pd.Series(
        [rouge_l_pair(c, r) for c, r in zip(candidate, reference)], dtype="float64"
    )


@F.pandas_udf(T.DoubleType())
def rouge_lsum_f1(candidate: pd.Series, reference: pd.Series) -> pd.Series:
    """F1 of the line-wise union LCS; both texts already lower-case."""
    return pd.Series(
        [rouge_lsum_pair(c, r) for c, r in zip(candidate, reference)], dtype="float64"
    )
