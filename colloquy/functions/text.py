"""Column functions on text: white space, tokens, n-grams, seeded order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed

# The fixed class as Unicode's white space and the separators: one test a character where the list of its ranges takes eleven.
_SPACE = r"(?U)[\s\x1c-\x1f]+"
_WORD = f"[^{fixed.WHITESPACE_CLASS}]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_ws(c: Column | str) -> Column:
    """Runs of white space become one space; none is left at either end.

    After the first step only plain spaces remain, so ``trim`` finishes the job.
    """
    return F.trim(F.regexp_replace(_col(c), _SPACE, " "))


def _pieces(text: Column, gap: str) -> Column:
    """What stands between the matches of ``gap``, without empty pieces."""
    return F.array_remove(F.split(text, gap), "")


def word_count(c: Column | str) -> Column:
    """Number of white-space separated words; 0 for null or blank text."""
    return F.when(_col(c).isNotNull(), F.size(_pieces(_col(c), _SPACE))).otherwise(0)


def quality_flag(c: Column | str, flags: str = fixed.QUALITY_FLAGS) -> Column:
    """True where the flag string holds any of ``flags``; false for null, never null."""
    hit = reduce(lambda a, b: a | b, [_col(c).contains(flag) for flag in flags])
    return F.coalesce(hit, F.lit(False))


def rouge_tokens(c: Column | str) -> Column:
    """Lower-case ASCII letter and digit runs."""
    text = F.lower(F.coalesce(_col(c), F.lit("")))
    return _pieces(text, fixed.ROUGE_TOKEN.replace("[", "[^"))


def _bleu_chain(text: Column) -> Column:
    """The 13a rules that set marks apart, one rewrite after the other."""
    for pattern, replacement in fixed.BLEU_13A_RULES:
        if pattern == r"^|$":
            text = F.concat(F.lit(replacement), text, F.lit(replacement))
        elif "(" in pattern:
            text = F.regexp_replace(text, pattern.replace(r" -\&", r"\!-\&"), replacement)
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


# The same rules in one rewrite: a mark is a token; so is a dash behind a digit, and a full stop or comma unless digits stand on both sides; the rest runs on.
_MARK = r"\{-~\[-`!-&(-+:-@/"
# So blanks go around those tokens, and the text is split at white space.
_BLEU_APART = f"[{_MARK}]|(?<=[0-9])-|(?<![0-9])[.,]|[.,](?![0-9])"
# Where several full stops or commas end at a digit, what the rules do depends on their number; such texts take the rules one by one.
_BLEU_ODD = "[.,][.,][0-9]"


def bleu_tokens(c: Column | str) -> Column:
    """The 13a tokenisation; case is kept.

    Rules without a pattern run as plain replacements, the others as one that sets tokens apart.
    """
    text = F.coalesce(_col(c), F.lit(""))
    for pattern, replacement in fixed.BLEU_13A_RULES:
        if "(" not in pattern and pattern != r"^|$":
            text = F.replace(text, F.lit(pattern.replace(r"\n", "\n")), F.lit(replacement))
    return F.when(text.rlike(_BLEU_ODD), _bleu_chain(text)).otherwise(_pieces(F.regexp_replace(text, _BLEU_APART, " $0 "), _SPACE))


def json_object(c: Column | str) -> Column:
    """The text if the whole of it is one JSON object, else null.

    The reader stops behind the first value it is asked for. So the text is read as the first element of an
    array that ends with an element known beforehand: anything more, or a bracket too many,
    changes the array.
    """
    text = _col(c)
    wrapped = F.from_json(
        F.concat(F.lit("["), text, F.lit(',{"__end":1}]')), "array<string>", {"allowSingleQuotes": "false"}
    )
    alone = (F.size(wrapped) == 2) & (F.get(wrapped, F.lit(1)) == '{"__end":1}') & F.get(wrapped, F.lit(0)).startswith("{")
    return F.when(alone & text.rlike(r"^\s*\{"), text)


def json_object_fields(c: Column | str) -> Column:
    """The fields of a text that :func:`json_object` accepts, as a map of texts; else null. The text is read once."""
    text = _col(c)
    read = F.from_json(
        F.concat(F.lit("["), text, F.lit(',{"__end":1}]')), "array<map<string,string>>", {"allowSingleQuotes": "false"}
    )
    # In a lambda, so that the tests do not read the text again.
    last = lambda a: F.get(a, F.lit(1))
    whole = F.transform(F.array(read), lambda a: F.when(
        (F.size(a) == 2) & (F.size(last(a)) == 1) & (F.try_element_at(last(a), F.lit("__end")) == "1"), F.get(a, F.lit(0))
    ))
    # What does not begin and end as an object is not read at all: an error costs more than reading does.
    return F.when(text.rlike(r"(?s)^\s*\{.*\}\s*\z"), F.get(whole, F.lit(0)))


def seeded_key(c: Column | str, seed: int | str) -> Column:
    """A reproducible pseudo-random sort key for a row id (ties broken by the id itself)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(c).cast("string")).cast("binary"))


def seeded_fraction(c: Column | str, seed: int | str) -> Column:
    """The seeded key read as a number in [0, 1)."""
    head = F.conv(F.substring(seeded_key(c, seed), 1, 12), 16, 10).cast("double")
    return head / F.lit(float(16**12))


def fill(template: str, **values: Column) -> Column:
    """A template with ``{name}`` places filled from columns.

    Built by concatenation, so a ``%`` or a brace inside a value stays as it is.
    """
    parts: list[Column] = []
    rest = template
    while rest:
        places = [(rest.find("{" + k + "}"), k) for k in values if "{" + k + "}" in rest]
        if not places:
            parts.append(F.lit(rest))
            break
        at, key = min(places)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(values[key])
        rest = rest[at + len(key) + 2 :]
    return F.concat(*parts)
