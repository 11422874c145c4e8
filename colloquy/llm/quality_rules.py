"""Quality rules with adaptive thresholds; DataFrame functions only.

**Counts.** Words, word characters, symbols, repeated lines and repeated 8-word windows are counted inside the row with array functions, so no text is
shuffled. Windows are compared by a 64-bit hash within one text; only texts that have equal windows at all have their places sorted.

**Thresholds.** Instead of fixed cutoffs, each (language, source) has fences of its own, read off quantile sketches. The sketch of a metric is a
histogram over logarithmic buckets (relative error at most ``ERROR``): counts add up, so sketches merge by summing and combine before the
shuffle, and a language's sketch is the sum of its sources'. A high fence stands ``SPREAD`` times the distance of the lower quartile from the median above the
median, a low one as far below it by the upper quartile: junk on the fence's own side moves neither number until it is half of the rows. The
distance counts as ``MARGINS`` at least, so that a metric which hardly varies (symbols, mostly) does not fail ordinary rows. A source's fence lies at most ``SPREAD`` margins outside
its language's, so a source of mostly junk cannot void its own. Fences tighten and loosen with the data; there is no other limit. A source with fewer than ``MIN_ROWS`` judged
rows uses its language's sketch, and a language with fewer the sketch of all rows. Rows that fail the base rules are not sketched.

**Joined filtering.** The fences have one row per language and source. They are counted, and broadcast while there are at most ``BROADCAST_ROWS``; beyond
that the counts of the rows are joined by a shuffle (narrow rows; AQE splits hot sources).

**Cases.** Null or empty text: no words, base failed. Null language or source: a group of its own. Repeated rows are counted and judged each; an
empty table gives an empty result. Very long texts are counted whole. Other columns, ``n_words`` or ``kept`` included, are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from colloquy.session import durable

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
REPEAT = 8
MIN_WORDS, MAX_REPEAT_SHARE = 20, 30
ERROR = 0.01
SPREAD = 4.0
MIN_ROWS = 200
BROADCAST_ROWS = 20_000
#: metric -> (side, margin): the least distance that counts, in units of the metric.
MARGINS = {
    "symbol_share": ("high", 0.02),
    "dup_line_share": ("high", 0.10),
    "repeat_share": ("high", 0.075),
    "mean_word_high": ("high", 0.4),
    "mean_word_low": ("low", 0.25),
}
#: Metrics that share a sketch.
SKETCH_OF = {"mean_word_high": "mean_word", "mean_word_low": "mean_word"}


def _let(value: Column, body) -> Column:
    """``body`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(places: Column) -> Column:
    """Words in the windows that begin at these ascending places."""
    return _let(places, lambda p: F.aggregate(
        F.sequence(F.lit(1), F.size(p)),
        F.lit(0).cast("bigint"),
        lambda total, i: total + F.when(i == F.size(p), F.lit(REPEAT)).otherwise(
            F.least(F.lit(REPEAT), F.get(p, i) - F.get(p, i - 1))
        ).cast("bigint"),
    ))


def repeated_words(words: Column) -> Column:
    """Words in windows of ``REPEAT`` words that stand twice or more in the text."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def places(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = _let(pairs, lambda s: F.filter(
            F.transform(s, lambda x, k: F.struct(
                x["i"].alias("i"),
                ((F.get(s, k - 1)["h"] == x["h"]) & (k > 0) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))).alias("same"),
            )),
            lambda x: x["same"],
        ))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - (REPEAT - 1)), lambda i: F.xxhash64(F.slice(h, i, REPEAT)))

    counted = _let(hashes, lambda h: F.when(F.size(h) < REPEAT + 1, F.lit(0).cast("bigint")).otherwise(
        _let(windows(h), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(_covered(places(w))))
    ))
    return counted


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words; its own columns of these names are replaced."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACES, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    measured = _let(words, lambda w: _let(lines, lambda a: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size(a).cast("bigint").alias("n_lines"),
        (F.size(a) - F.size(F.array_distinct(a))).cast("bigint").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"),
    )))
    # As a generator's output the counts are made once, whatever later conditions refer to them.
    return docs.select(*[docs[c] for c in docs.columns if c not in COUNTS], F.inline(F.array(measured)))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_SHARE * F.col("n_words"))


#: metric -> (part, whole): the share of two counts, 0 where the whole is 0.
METRICS = {
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "mean_word": ("word_chars", "n_words"),
}


def metric(name: str) -> Column:
    part, whole = METRICS[name]
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def sketches(counted: DataFrame, keys: list[str], error: float = ERROR) -> DataFrame:
    """(keys, metric, bucket, n): one mergeable sketch per key and metric. Values below 1e-4 share the bucket of zero."""
    gamma = math.log((1 + error) / (1 - error))
    found = F.array(*[F.struct(F.lit(name).alias("metric"), metric(name).alias("value")) for name in METRICS])
    values = counted.select(*keys, F.explode(found).alias("m")).select(*keys, "m.metric", "m.value")
    bucket = F.when(F.col("value") > 1e-4, F.ceil(F.log(F.greatest("value", F.lit(1e-4))) / gamma)).cast("bigint")
    return values.groupBy(*keys, "metric", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merge(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser keys, by summing."""
    return sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, keys: list[str], error: float = ERROR) -> DataFrame:
    """(keys, metric, n, low, mid, high): quartiles and median of each sketch. A sketch has some hundred buckets at most."""
    gamma = math.log((1 + error) / (1 - error))
    group = Window.partitionBy(*keys, "metric")
    value = F.when(F.col("bucket").isNull(), F.lit(0.0)).otherwise(F.exp(F.col("bucket") * gamma) * (1 - error))
    upto = sketch.withColumns({
        "upto": F.sum("n").over(group.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)),
        "total": F.sum("n").over(group), "value": value,
    })
    return upto.groupBy(*keys, "metric").agg(
        F.max("total").alias("n"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("value"))).alias("low"),
        F.min(F.when(4 * F.col("upto") >= 2 * F.col("total"), F.col("value"))).alias("mid"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("value"))).alias("high"),
    )


def _fence(q: Column, side: str, margin: float) -> Column:
    if side == "high":
        return q["mid"] + SPREAD * F.greatest(q["mid"] - q["low"], F.lit(margin))
    return q["mid"] - SPREAD * F.greatest(q["high"] - q["mid"], F.lit(margin))


def fences(counted: DataFrame, lang: str = "lang", source: str = "source", min_rows: int = MIN_ROWS) -> DataFrame:
    """(lang, source, and a limit per metric of ``MARGINS``), from the rows that pass the base rules."""
    keys = [lang, source]
    fine = durable(sketches(counted.where(~base_failed()), keys))
    q = F.struct("n", "low", "mid", "high")
    by_source = quartiles(fine, keys).select(*keys, "metric", q.alias("own"))
    by_lang = quartiles(merge(fine, [lang]), [lang]).select(F.col(lang).alias("_l"), F.col("metric").alias("_m"), q.alias("wide"))
    overall = quartiles(merge(fine, []), []).select(F.col("metric").alias("_a"), q.alias("all"))
    chosen = (
        by_source.join(by_lang, F.col(lang).eqNullSafe(F.col("_l")) & (F.col("metric") == F.col("_m")))
        .join(F.broadcast(overall), F.col("metric") == F.col("_a"))
        .withColumn("wide", F.when(F.col("wide.n") >= min_rows, F.col("wide")).otherwise(F.col("all")))
        .withColumn("own", F.when(F.col("own.n") >= min_rows, F.col("own")).otherwise(F.col("wide")))
    )
    limits = []
    for name, (side, margin) in MARGINS.items():
        own, wide = _fence(F.col("own"), side, margin), _fence(F.col("wide"), side, margin)
        fence = F.least(own, wide + SPREAD * margin) if side == "high" else F.greatest(own, wide - SPREAD * margin)
        limits.append(F.max(F.when(F.col("metric") == SKETCH_OF.get(name, name), fence)).alias(f"fence_{name}"))
    return chosen.groupBy(*keys).agg(*limits)


def _verdict() -> Column:
    """True where every metric is within its fence; a source without any sketched row has no fence and no passing row."""
    within = F.lit(True)
    for name, (side, _) in MARGINS.items():
        value, fence = metric(SKETCH_OF.get(name, name)), F.col(f"fence_{name}")
        within = within & F.coalesce(value <= fence if side == "high" else value >= fence, F.lit(True))
    return within


def _judged(counted: DataFrame, limits: DataFrame, lang: str, source: str, own: list[str]) -> DataFrame:
    limits = limits.select(F.col(lang).alias("_lang"), F.col(source).alias("_source"), *[f"fence_{n}" for n in MARGINS])
    if limits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        limits = F.broadcast(limits)
    judged = counted.join(
        limits, F.col(lang).eqNullSafe(F.col("_lang")) & F.col(source).eqNullSafe(F.col("_source")), "left"
    )
    return judged.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & _verdict()).select(
        *own, *COUNTS, "base_failed", "kept"
    )


def judge(
    docs: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source", min_rows: int = MIN_ROWS
) -> DataFrame:
    """``docs`` without its text, with the counts, base_failed and kept (its own columns of these names are replaced).

    Runs two jobs when called: the counts, kept without the text in a checkpoint, and the sketches.
    """
    counted = durable(word_counts(docs, text_col).drop(text_col))
    limits = fences(counted.select(lang, source, *COUNTS), lang, source, min_rows)
    return _judged(counted, limits, lang, source, [c for c in counted.columns if c not in COUNTS and c not in ("base_failed", "kept")])


def keep_good(
    docs: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source", min_rows: int = MIN_ROWS
) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns. Texts are counted for the sketches and again for the filter, and never shuffled."""
    safe = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("_row"),
        F.col(text_col).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"),
    )
    limits = fences(word_counts(safe.drop("_row")).drop("text"), min_rows=min_rows)
    return _judged(word_counts(safe), limits, "lang", "source", ["_row"]).where("kept").select("_row.*")
