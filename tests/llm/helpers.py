"""Brute-force versions of the operators, and the odd rows that each of them must take."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})

#: (doc_id, text): nulls, blanks, repeats, ties, odd characters, long texts.
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (6, "One two"), (6, "One two"), (None, "one two three"),
    (7, "ñandú 中文 🙂 \x85 x"), (8, "a " * 3000), (9, "word" * 2000), (10, "tab\tand\x0bmore\x0c\r\nlines\n\nlines"), (11, "<|endoftext|> x <|endoftext|>"),
]
CLASHING = "doc_id long, text string, n_words int, kept string, digest string, place long, source string, lang string"


def odd_rows(spark):
    """The odd rows with columns whose names the operators use themselves."""
    rows = [(i, t, 1, "k", "d", 2, None if n % 3 else "s", "en") for n, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, CLASHING)


def words(text):
    return WORD.findall(text or "")


def passage(start, n):
    return " ".join(f"w{i * 7919 % 100003}" for i in range(start, start + n))
