"""URL filters by host-suffix and path-prefix expressions.

A URL is expanded into expressions ``host suffix`` + ``path prefix``: suffixes of its host at a label, with prefixes of its path at a slash, for each
(number of labels, number of slashes) that some rule has. A rule stands under one expression, its host and its path up to the last slash. Expressions and rules meet by an equi-join on the first four bytes
of their SHA-256; the full digest and the whole path of the rule are confirmed behind it, and the longest rule that fits decides (of equally long ones, a block). Only
hosts and paths that meet a rule are grouped again, and each is judged once however many rows have it.

The shapes of rules, pairs of two small numbers, are one array. Rules are broadcast while there are at most ``BROADCAST_RULES`` of them, which is counted first; more are joined by a shuffle with the
expressions, grouped per row before.

**Cases.** A null URL, or one without ``://``, has an empty host and path, meets no rule and is allowed. A rule with an empty host fits every URL with its
path. An empty path starts with no slash. Null rules' columns count as empty; a rule without a verdict is left out. Repeated rows and repeated rules
change nothing: each input row gives one row. Columns other than the id and the URL are not read. Empty tables give empty results, and no rules allow all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_RULES = 100_000
DEFAULT = "allow"


def parts_of(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substr(rest, F.length(host) + 1)
    path = F.regexp_extract(after, r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _labels(host: Column) -> Column:
    """How many labels a host has; none if it is empty."""
    return F.when(host == "", F.lit(0)).otherwise(_count(host, ".") + 1)


def _short(digest: Column) -> Column:
    """The first four bytes of a hexadecimal digest as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def expressions(urls: DataFrame, shapes: Column) -> DataFrame:
    """(host, path) -> a row for each expression, with its digest and short prefix.

    ``shapes`` are the (labels, slashes) that rules have: a URL can meet a rule only under an expression of the rule's own shape, so no other is made and
    the work is linear in the URL's length for each shape.
    """
    host, path = F.col("host"), F.col("path")
    shaped = urls.where("host != ''").select("*", F.inline(shapes)).where((F.col("labels") <= _labels(host)) & (F.col("slashes") <= _count(path, "/")))
    suffix = F.call_function("substring_index", host, F.lit("."), -F.col("labels"))
    prefix = F.when(F.col("slashes") == 0, F.lit("")).otherwise(F.concat(F.call_function("substring_index", path, F.lit("/"), F.col("slashes")), F.lit("/")))
    expression = F.concat(suffix, F.lit(" "), prefix)
    return shaped.withColumn("digest", F.sha2(expression.cast("binary"), 256)).withColumn("short", _short(F.col("digest"))).drop("labels", "slashes")


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) under the digest of their expression; one row per host and path, a block before an allow."""
    clean = rules.where("verdict is not null").select(
        F.translate(F.coalesce("host", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"), "verdict",
    ).groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("rule_verdict"))
    upto = F.regexp_extract("rule_path", r"(?s)^(.*/)?", 0)
    return clean.withColumn(
        "rule_digest", F.sha2(F.concat(F.col("rule_host"), F.lit(" "), upto).cast("binary"), 256)
    ).withColumns({
        "rule_short": _short(F.col("rule_digest")), "labels": _labels(F.col("rule_host")).cast("int"), "slashes": _count(F.col("rule_path"), "/").cast("int"),
    })


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT
) -> DataFrame:
    """Per row: the id, host, path, rule (host + path of the one that decides, else null) and verdict.

    ``rules`` has host, path and verdict (``block`` or ``allow``). Counts the rules when called.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("_url"))
    host, path = parts_of(F.col("_url"))
    rows = rows.withColumns({"host": host, "path": path})
    known = prepared_rules(rules)
    if known.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        known = F.broadcast(known)
    shapes = F.coalesce(known.agg(F.collect_set(F.struct("labels", "slashes"))).scalar(), F.array().cast("array<struct<labels:int,slashes:int>>"))
    wins = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"), (F.col("rule_verdict") == "block").alias("blocks"),
        F.length("rule_host").alias("host_size"), F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict"),
    )
    met = (
        expressions(rows.select("host", "path").distinct(), shapes)
        .join(known.drop("labels", "slashes"), F.col("short") == F.col("rule_short"))
        .where("digest = rule_digest and startswith(path, rule_path)")
        .groupBy("host", "path").agg(F.max(wins).alias("win"))
        .select(F.col("host").alias("_host"), F.col("path").alias("_path"), "win")
    )
    out = rows.join(met, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
    return out.select(
        F.col("_id").alias(id_col), "host", "path", F.col("win.rule").alias("rule"),
        F.coalesce("win.verdict", F.lit(default)).alias("verdict"),
    )
