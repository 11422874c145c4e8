"""Personal data by candidates and gradient boosting; DataFrame functions only.

**Generators** propose spans with a high recall: the strict formats of e-mail, IPv4, card and phone, and looser ones (spelled-out e-mail, local phone of two to five groups
with or without a prefix, IBAN, IPv6 in full and compressed, social security numbers, secrets). Spans of different generators may overlap. A generator's pattern is linear in the text: it begins where a run begins, and its
repetitions give nothing back.

**Boosted trees** score the loose candidates from format features (digits, letters, separators, check sums, variety of characters) and context features (cue words before it, what it
touches). They are fitted on labelled sentences made from templates (:mod:`pii_examples`), whose features Spark computes with the same expressions; the fit itself, on a few hundred
rows of small integers, is plain Python on the driver. The trees become one SQL expression. Each kind's threshold is calibrated on the templates held out from the fit: the least score
at which the selected candidates are private with a share of at least ``PRECISION``. Strict formats are always kept.

**Scale.** One pass inside the row, without a shuffle. Positions come from running sums over pieces and matches, in blocks of about the square root of their number.

**Cases.** Null counts as empty: no spans. Positions count code points, ends are exclusive. Repeated rows give a row each; an empty table gives an empty
result. :func:`find` reads the id and the text only; :func:`redact` keeps all columns.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.pii_examples import examples

# Strict formats. The possessive repetitions and the look-behinds change no match; they keep the search linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A number begins where no digit, and no digit with a dot or dash, stands before it, and a dot or dash may follow it unless a digit comes next.
_NUMBER_START, _NUMBER_END = r"(?<![0-9+])(?<![0-9][.-])", r"(?![0-9]|[.-][0-9])"
_CLASSIC = r"(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}"
_V6_START, _V6_END = r"(?:(?<=[Pp][Vv]6:)|(?<![0-9A-Za-z])(?<![0-9A-Fa-f:]:))", r"(?![0-9A-Za-z]|:[0-9A-Fa-f:])"
_V6_GROUPS = r"(?:[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){0,6}+)?+"
LOOSE = {
    "email_text": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[(\[] ?at ?[)\]] ?| at )[A-Za-z0-9-]{1,63}+(?: ?[(\[] ?dot ?[)\]] ?| dot |\.)[A-Za-z]{2,12}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "ipv6": _V6_START + r"(?:[0-9A-Fa-f]{1,4}+:){7}[0-9A-Fa-f]{1,4}+" + _V6_END,
    "phone_local": _NUMBER_START + _CLASSIC + _NUMBER_END,
    "secret": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+",
    "ssn": r"(?<![0-9]|[0-9]-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    # Numbers of two to five groups, and a prefix; what phone_local proposes whole is left to it.
    "phone_groups": _NUMBER_START + r"(?=(?:[ .()-]{0,2}+[0-9]){7})(?!" + _CLASSIC + r"(?![0-9]|[ .-][0-9]))"
    r"(?:[0-9]{1,3}+[ .-]?+(?=\())?+(?:\([0-9]{1,5}+\)[ .-]?+|[0-9]{1,5}+[ .-])"
    r"(?:[0-9]{5,8}+(?:[ .-][0-9]{1,5}+)?+|[0-9]{1,4}+(?:[ .-][0-9]{2,5}+){0,4}+)" + _NUMBER_END,
    "ipv6_short": _V6_START + r"(?=(?:::)?[0-9A-Fa-f])" + _V6_GROUPS + "::" + _V6_GROUPS + _V6_END,
}
KINDS = [*BASE, *LOOSE]
# Cheap conditions on a text without which a pattern cannot match.
NEEDS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "email_text": lambda t: t.rlike(r"(?i)[ (\[]at[ )\]]"),
    "secret": lambda t: t.rlike(r"[A-Za-z0-9+/_-]{20}"),
    "ipv6": lambda t: t.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
    "ipv6_short": lambda t: F.contains(t, F.lit("::")),
}
CUES = {
    "phone": r"(?i)\b(phone|tel|telephone|call|fax|mobile|cell|text|dial|contact|whatsapp)\b",
    "mail": r"(?i)\b(mail|e-mail|email|write|contact|reach|address)\b",
    "bank": r"(?i)\b(iban|bank|account|transfer|pay|card|visa)\b",
    "secret": r"(?i)\b(token|key|secret|password|passwd|pwd|api|bearer|credential|auth)\b",
    "person": r"(?i)\b(ssn|social|security|tax|passport|host|client|ip|server|from)\b",
    "other": r"(?i)\b(order|invoice|version|page|pages|isbn|chapter|part|ticket|figure|commit|sha|md5|checksum|id|build|serial|item|ref|look|arrived|met)\b",
}
FEATURES = [
    "kind", "digits", "letters", "upper", "separators", "variety", "valid", "touches_before", "touches_after", "brackets",
    *[f"cue_{c}" for c in CUES],
]
TREES, DEPTH, RATE, PRECISION = 24, 3, 0.4, 0.97
BEFORE = 32
_SPAN = "struct<kind:string,start:bigint,end:bigint,value:string,before:string,after:string>"


def _let(value: Column, body) -> Column:
    """``body`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def running(values: Column) -> Column:
    """Running sums of an array of numbers, in blocks of about the square root of its length."""
    def blocks(v: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(v))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / size).cast("int") - 1), lambda b: F.slice(v, b * size + 1, size))

    def sums(parts: Column) -> Column:
        return _let(F.transform(parts, _total), lambda totals: F.flatten(F.transform(parts, lambda part, b: _let(
            _total(F.slice(totals, F.lit(1), b)),
            lambda before: F.transform(part, lambda _, i: before + _total(F.slice(part, F.lit(1), i + 1))),
        ))))

    empty = F.array().cast("array<bigint>")
    return _let(values, lambda v: F.when(F.size(v) == 0, empty).otherwise(_let(blocks(v), sums)))


def spans(text: Column, kind: str, pattern: str) -> Column:
    """The matches of a pattern, with their places and what stands around them."""
    def located(found: Column) -> Column:
        pieces, values = found["pieces"], found["values"]
        lengths = F.transform(values, lambda v, i: (F.length(v) + F.length(F.get(pieces, i))).cast("bigint"))
        return _let(running(lengths), lambda ends: F.transform(values, lambda v, i: F.struct(
            F.lit(kind).alias("kind"), (F.get(ends, i) - F.length(v)).alias("start"), F.get(ends, i).alias("end"), v.alias("value"),
            F.right(F.get(pieces, i), F.lit(BEFORE)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(2)).alias("after"),
        ).cast(_SPAN)))

    found = F.struct(
        F.split(text, F.lit(pattern), F.lit(-1)).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values")
    )
    needed = NEEDS.get(kind, lambda t: t.rlike("[0-9]"))(text)
    return F.when(needed & text.rlike(pattern), _let(found, located)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits (one at least) passes the Luhn check."""
    def weighed(i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) + 1 - i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 0, digit * 2).otherwise(digit)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return _total(F.transform(F.sequence(F.lit(1), F.length(digits)), weighed)) % 10 == 0


def valid_strict(kind: str, value: Column) -> Column:
    """The condition a match of a strict format must meet."""
    digits = _digits(value)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= F.lit(3)) & F.forall(
            F.split(value, r"\."), lambda p: F.coalesce(F.right(p, F.lit(4)).try_cast("int"), F.lit(0)) <= 255
        )
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    def strict(kind: str, pattern: str) -> Column:
        return F.filter(spans(text, kind, pattern), lambda s: valid_strict(kind, s["value"]))

    return F.concat(*[strict(k, p) for k, p in BASE.items()])


def loose_spans(text: Column) -> Column:
    return F.concat(*[spans(text, k, p) for k, p in LOOSE.items()])


def _iban_rest(value: Column) -> Column:
    """An IBAN's number modulo 97, letters standing for 10 to 35; 1 if it is valid."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    return F.aggregate(
        F.split(turned, ""), F.lit(0).cast("bigint"),
        lambda rest, c: F.when(c == "", rest).when(c.rlike("[0-9]"), (rest * 10 + c.try_cast("int")) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97),
    )


def features_of(s: Column) -> dict[str, Column]:
    """A candidate's features, each a small integer."""
    value, digits = s["value"], _digits(s["value"])
    count = lambda pattern: F.length(F.regexp_replace(value, pattern, ""))
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("int")
    kind = reduce(lambda out, k: F.when(s["kind"] == k, F.lit(KINDS.index(k))).otherwise(out), LOOSE, F.lit(-1))
    valid = (
        F.when(s["kind"] == "iban", _iban_rest(value) == 1)
        .when(s["kind"] == "ssn", ~value.rlike("^(000|666|9)|-00-|-0000$"))
        .when(s["kind"] == "phone_local", F.length(digits).between(9, 12))
        .when(s["kind"] == "phone_groups", F.length(digits).between(7, 15))
        .when(s["kind"] == "ipv6_short", F.size(F.filter(F.split(value, ":"), lambda g: g != "")) <= 7)
        .when(s["kind"] == "secret", value.rlike("[0-9]") & value.rlike("[A-Za-z]"))
        .otherwise(F.lit(True))
    )
    return {
        "kind": kind, "digits": F.least(F.length(digits), F.lit(40)), "letters": F.least(count("[^A-Za-z]"), F.lit(60)), "upper": F.least(count("[^A-Z]"), F.lit(40)),
        "separators": F.least(count(r"[^\x20._/+-]"), F.lit(10)), "variety": F.size(F.array_distinct(F.split(F.lower(F.left(value, F.lit(64))), ""))),
        "valid": flag(valid), "touches_before": flag(s["before"].rlike(r"[A-Za-z0-9_/.:#=-]$")), "touches_after": flag(s["after"].rlike("^[A-Za-z0-9_/:%]")),
        "brackets": flag(value.rlike(r"[(\[]")), **{f"cue_{c}": flag(s["before"].rlike(p)) for c, p in CUES.items()},
    }


# ---------------------------------------------------------------- fitting (driver, a few hundred rows)

def _grow(rows: list[int], x: list[list[int]], gradient: list[float], hessian: list[float], depth: int):
    """A regression tree: a number, or (feature, limit, tree for values up to it, tree for others)."""
    g, h = sum(gradient[i] for i in rows), sum(hessian[i] for i in rows)
    leaf = g / (h + 1.0)
    if depth == 0 or len(rows) < 4:
        return leaf
    best, choice = 1e-6, None
    for f in range(len(FEATURES)):
        bins: dict[int, list[float]] = {}
        for i in rows:
            b = bins.setdefault(x[i][f], [0.0, 0.0])
            b[0] += gradient[i]
            b[1] += hessian[i]
        left_g = left_h = 0.0
        for value in sorted(bins)[:-1]:
            left_g += bins[value][0]
            left_h += bins[value][1]
            gain = left_g ** 2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g ** 2 / (h + 1)
            if gain > best:
                best, choice = gain, (f, value)
    if choice is None:
        return leaf
    f, value = choice
    return (
        f, value, _grow([i for i in rows if x[i][f] <= value], x, gradient, hessian, depth - 1),
        _grow([i for i in rows if x[i][f] > value], x, gradient, hessian, depth - 1),
    )


def _value(tree, row: list[int]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def boost(x: list[list[int]], y: list[int], trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> list:
    """Gradient-boosted trees for the logistic loss."""
    margins, out = [0.0] * len(x), []
    for _ in range(trees):
        odds = [1 / (1 + math.exp(-m)) for m in margins]
        tree = _grow(list(range(len(x))), x, [t - p for t, p in zip(y, odds)], [p * (1 - p) for p in odds], depth)
        out.append(tree)
        margins = [m + rate * _value(tree, row) for m, row in zip(margins, x)]
    return out


def probability(trees: list, row: list[int], rate: float = RATE) -> float:
    return 1 / (1 + math.exp(-rate * sum(_value(t, row) for t in trees)))


def calibrate(scored: list[tuple[str, float, int]], precision: float = PRECISION) -> dict[str, float]:
    """Per kind the least score from which on a share of at least ``precision`` is private; above 1 where there is none."""
    limits = {}
    for kind in LOOSE:
        limits[kind], right, n = 2.0, 0, 0
        own = sorted(((p, y) for k, p, y in scored if k == kind), reverse=True)
        for i, (p, y) in enumerate(own):
            n, right = n + 1, right + y
            if (i + 1 == len(own) or own[i + 1][0] < p) and right >= precision * n:
                limits[kind] = max(p - 0.02, 0.5)
    return limits


_models: dict[int, tuple[list, dict[str, float]]] = {}


def fitted(spark: SparkSession) -> tuple[list, dict[str, float]]:
    """The trees and thresholds; fitted once per driver (the examples are the same for all data). Runs a small job the first time."""
    if 0 not in _models:
        lines = "\n".join(f"{fold}{label}{sentence}" for sentence, label, fold in examples())
        made = spark.range(1).select(F.explode(F.split(F.lit(lines), "\n")).alias("line"))
        found = made.select(
            F.left("line", F.lit(1)).alias("fold"), F.substring("line", 2, 1).cast("int").alias("label"),
            F.explode(loose_spans(F.substr(F.col("line"), F.lit(3)))).alias("s"),
        )
        features = features_of(F.col("s"))
        rows = found.select("fold", "label", F.col("s.kind").alias("kind"), F.array(*[features[f].cast("int") for f in FEATURES]).alias("x")).collect()
        fit = [r for r in rows if r.fold == "f"]
        trees = boost([list(r.x) for r in fit], [r.label for r in fit])
        _models[0] = trees, calibrate([(r.kind, probability(trees, list(r.x)), r.label) for r in rows if r.fold != "f"])
    return _models[0]


def _tree_column(tree, features: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    f, limit, low, high = tree
    return F.when(F.get(features, F.lit(f)) <= limit, _tree_column(low, features)).otherwise(_tree_column(high, features))


def selected(text: Column, model: tuple[list, dict[str, float]]) -> Column:
    """Loose candidates whose score reaches the threshold of their kind."""
    trees, limits = model

    def keeps(s: Column) -> Column:
        features = features_of(s)
        score = _let(F.array(*[features[f].cast("int") for f in FEATURES]), lambda x: reduce(lambda a, b: a + b, [_tree_column(t, x) for t in trees]))
        limit = reduce(lambda out, k: F.when(s["kind"] == k, F.lit(limits[k])).otherwise(out), LOOSE, F.lit(2.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.lit(RATE) * score)) >= limit

    return F.filter(loose_spans(text), keeps)


def _ordered(found: Column) -> Column:
    """Spans by start, then by kind as listed, as (start, rank, end, kind)."""
    rank = lambda s: reduce(lambda out, k: F.when(s["kind"] == k, F.lit(KINDS.index(k))).otherwise(out), KINDS, F.lit(-1))
    return F.array_sort(F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, base (strict spans) and spans (those and the selected ones): arrays of (start, rank, end, kind) in order."""
    model = fitted(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    rows = rows.withColumn("found", F.struct(base_spans(text).alias("base"), selected(text, model).alias("more")))
    return rows.select(
        F.col("_id").alias(id_col), _ordered(F.col("found.base")).alias("base"), _ordered(F.concat("found.base", "found.more")).alias("spans")
    )


def listed(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _merged(found: Column) -> Column:
    """Ordered spans with overlapping ones joined: (start, end, kind of the first)."""
    kind = "array<struct<start:bigint,end:bigint,kind:string>>"

    def step(out: Column, s: Column) -> Column:
        last = F.element_at(out, -1)
        own = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))).cast(kind)
        joined = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))).cast(kind)
        overlaps = (F.size(out) > 0) & (F.coalesce(F.try_element_at(out, F.lit(-1))["end"], F.lit(-1)) > s["start"])
        return F.when(overlaps, F.concat(F.slice(out, F.lit(1), F.size(out) - 1), joined)).otherwise(F.concat(out, own))

    return F.aggregate(found, F.array().cast(kind), step)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; a null text stays null. Overlapping spans are replaced together."""
    model = fitted(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    rows = rows.withColumn("found", _merged(_ordered(F.concat(base_spans(text), selected(text, model)))))

    def replaced(found: Column) -> Column:
        kept = F.transform(found, lambda s, i: F.concat(
            F.substr(text, (F.coalesce(F.get(found, i - 1)["end"], F.lit(0)) + 1).cast("int"), (s["start"] - F.coalesce(F.get(found, i - 1)["end"], F.lit(0))).cast("int")),
            F.lit("["), F.upper(s["kind"]), F.lit("]"),
        ))
        rest = F.substr(text, (F.element_at(found, -1)["end"] + 1).cast("int"))
        return F.concat(F.array_join(kept, ""), rest)

    new = F.when(F.size("found") > 0, replaced(F.col("found"))).otherwise(F.col("row")[text_col])
    return rows.select(*[(new if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
