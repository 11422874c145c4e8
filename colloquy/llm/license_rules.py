"""Licence scans with ordered signature rules; DataFrame functions only.

A text is put into a plain form first: A-Z lower-cased and everything but letters, digits and characters beyond ASCII cut to single spaces, so that a rule is a
regular expression over words. A plus right behind a digit stays with it while rules run ("LGPLv2.1+"). A rule has a keyword, the longest piece of text that every match
has, a priority and a label. Only texts with one of a few stems, which every keyword contains, reach the rules, and of those only the rules whose keyword stands in the text are run.

Every rule is matched against the whole text, so detections are intervals of words that may overlap. A detection that lies within one of a rule of higher order is suppressed
(``license`` within ``gnu general public license version 3``); detections that overlap in part both stay. The order is by priority, then by the length of
the rule. The end of the furthest interval of earlier rules is kept for each word, so the test is one lookup. Within one rule matches do not overlap.

The rules are hand-written names, phrases and notices; a rule adds each name's versions, written as usual ("version 2.0", "v2", "GPLv2", "GPL-2.0+"), with and without "or later", as a
grant ("licensed under ...") and as an SPDX identifier.

**Scale.** One pass without a shuffle. Work is linear in the text for each rule that its keyword lets through.

**Cases.** Null counts as empty: no words, no labels, score 0. Repeated rows give a row each; an empty table gives an empty result. Very long texts are read
whole. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label, names (words, as alternatives), versions. "licen[cs]e" takes both spellings.
FAMILIES = [
    ("agpl", "gnu affero general public licen[cs]e|affero general public licen[cs]e|affero gpl|gnu agpl|agpl", "1.0 3.0"),
    ("lgpl", "gnu lesser general public licen[cs]e|gnu library general public licen[cs]e|lesser general public licen[cs]e|library general public licen[cs]e|lesser gpl|gnu lgpl|lgpl", "2.0 2.1 3.0"),
    ("gpl", "gnu general public licen[cs]e|general public licen[cs]e|gnu public licen[cs]e|gnu gpl|gpl", "1.0 2.0 3.0"),
    ("gfdl", "gnu free documentation licen[cs]e|free documentation licen[cs]e|gnu fdl|gfdl", "1.1 1.2 1.3"),
    ("apache", "apache software licen[cs]e|apache licen[cs]e|apache public licen[cs]e|asf licen[cs]e", "1.0 1.1 2.0"),
    ("mpl", "mozilla public licen[cs]e|mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse public licen[cs]e|epl", "1.0 2.0"),
    ("eupl", "european union public licen[cs]e|eupl", "1.0 1.1 1.2"),
    ("cddl", "common development and distribution licen[cs]e|cddl", "1.0 1.1"),
    ("cpl", "common public licen[cs]e", "1.0"),
    ("cpal", "common public attribution licen[cs]e", "1.0"),
    ("artistic", "artistic licen[cs]e", "1.0 2.0"),
    ("afl", "academic free licen[cs]e", "1.1 1.2 2.0 2.1 3.0"),
    ("osl", "open software licen[cs]e", "1.0 1.1 2.0 2.1 3.0"),
    ("apsl", "apple public source licen[cs]e", "1.0 1.1 1.2 2.0"),
    ("ms-pl", "microsoft public licen[cs]e|ms pl licen[cs]e", ""),
    ("ms-rl", "microsoft reciprocal licen[cs]e|ms rl licen[cs]e", ""),
    ("bsl", "boost software licen[cs]e|boost licen[cs]e", "1.0"),
    ("busl", "business source licen[cs]e", "1.1"),
    ("sspl", "server side public licen[cs]e|sspl", "1.0"),
    ("elastic", "elastic licen[cs]e", "2.0"),
    ("ofl", "sil open font licen[cs]e|open font licen[cs]e|sil ofl", "1.0 1.1"),
    ("php", "php licen[cs]e", "3.0 3.01"),
    ("python", "python software foundation licen[cs]e|psf licen[cs]e|python licen[cs]e", "2.0"),
    ("zpl", "zope public licen[cs]e", "1.1 2.0 2.1"),
    ("lppl", "latex project public licen[cs]e|lppl", "1.0 1.1 1.2 1.3"),
    ("cecill", "cecill( free software)? licen[cs]e( agreement)?|cecill", "1.0 1.1 2.0 2.1"),
    ("odbl", "open database licen[cs]e|odbl", "1.0"),
    ("odc-by", "open data commons attribution licen[cs]e", "1.0"),
    ("pddl", "public domain dedication and licen[cs]e|pddl", "1.0"),
    ("qpl", "q public licen[cs]e", "1.0"),
    ("ipl", "ibm public licen[cs]e", "1.0"),
    ("npl", "netscape public licen[cs]e", "1.0 1.1"),
    ("nasa", "nasa open source agreement", "1.3"),
    ("rpl", "reciprocal public licen[cs]e", "1.1 1.5"),
    ("sgi-b", "sgi free software licen[cs]e b", "1.0 1.1 2.0"),
    ("upl", "universal permissive licen[cs]e", "1.0"),
    ("w3c", "w3c software notice and licen[cs]e|w3c licen[cs]e", ""),
    ("bsd-2-clause", "bsd 2 clause( simplified)?( licen[cs]e)?|2 clause bsd( licen[cs]e)?|two clause bsd( licen[cs]e)?|simplified bsd licen[cs]e|freebsd licen[cs]e", ""),
    ("bsd-3-clause", "bsd 3 clause( new| revised)?( licen[cs]e)?|3 clause bsd( licen[cs]e)?|three clause bsd( licen[cs]e)?|new bsd licen[cs]e|revised bsd licen[cs]e|modified bsd licen[cs]e", ""),
    ("bsd-4-clause", "bsd 4 clause( licen[cs]e)?|4 clause bsd( licen[cs]e)?|four clause bsd( licen[cs]e)?|original bsd licen[cs]e", ""),
    ("bsd", "bsd( style| type)? licen[cs]ed?|berkeley software distribution licen[cs]e", ""),
    ("0bsd", "zero clause bsd( licen[cs]e)?|0bsd", ""),
    ("mit-0", "mit no attribution|mit 0 licen[cs]e", ""),
    ("mit", "mit licen[cs]ed?|mit style licen[cs]e|expat licen[cs]e|mit x11 licen[cs]e|licen[cs]e mit|licen[cs]ed mit|licen[cs]ed under( the)? mit", ""),
    ("x11", "x11 licen[cs]e|x consortium licen[cs]e", ""),
    ("isc", "isc licen[cs]ed?|internet systems consortium licen[cs]e", ""),
    ("zlib", "zlib( libpng)? licen[cs]e", ""),
    ("libpng", "libpng licen[cs]e", ""),
    ("openssl", "openssl licen[cs]e", ""),
    ("unlicense", "the unlicense|unlicense org|licen[cs]e unlicense", ""),
    ("wtfpl", "do what the fuck you want to public licen[cs]e|wtfpl", ""),
    ("vim", "vim licen[cs]e", ""),
    ("ruby", "ruby licen[cs]e", ""),
    ("ncsa", "university of illinois ncsa open source licen[cs]e|ncsa licen[cs]e", ""),
    ("postgresql", "postgresql licen[cs]e", ""),
    ("json", "json licen[cs]e", ""),
    ("beerware", "beer ware licen[cs]e|beerware licen[cs]e|beerware", ""),
    ("commons-clause", "commons clause( licen[cs]e condition)?", ""),
    ("ccpl", "creative commons public licen[cs]e", ""),
    ("public-domain", "released into the public domain|placed in the public domain|public domain dedication|dedicated to the public domain", ""),
    ("tcl", "tcl tk licen[cs]e|tcl licen[cs]e", ""),
    ("curl", "curl licen[cs]e", ""),
    ("icu", "icu licen[cs]e|unicode licen[cs]e", ""),
    ("naist", "naist licen[cs]e", ""),
    ("mulan", "mulan permissive software licen[cs]e|mulanpsl", "1.0 2.0"),
    ("osl-hw", "cern open hardware licen[cs]e|cern ohl", "1.1 1.2 2.0"),
    ("polyform", "polyform( noncommercial| small business| shield| strict)? licen[cs]e", "1.0"),
    ("hippocratic", "hippocratic licen[cs]e", "1.0 2.0 2.1"),
    ("parity", "parity public licen[cs]e", "6.0 7.0"),
    ("prosperity", "prosperity public licen[cs]e", "2.0 3.0"),
]
CREATIVE_COMMONS = {
    "by": "attribution", "by-sa": "attribution share ?alike", "by-nd": "attribution no ?deriv(s|atives)", "by-nc": "attribution non ?commercial",
    "by-nc-sa": "attribution non ?commercial share ?alike", "by-nc-nd": "attribution non ?commercial no ?deriv(s|atives)",
}
CREATIVE_COMMONS_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
# Phrases of texts that give rights or keep them, whatever the licence is called.
PHRASES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 80),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 75),
    ("mit", "under mit", 55),
    ("mit", "under the mit", 55),
    ("mit", "under the terms of the mit", 55),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", 80),
    ("bsd", "redistribution and use in source and binary forms with or without modification", 80),
    ("bsd-3-clause", "neither the name of( [^ ]+){1,8} nor the names of (its|the|any)( [^ ]+)? may be used to endorse or promote products", 82),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 84),
    ("bsd", "redistributions of source code must retain the above copyright notice", 72),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", 72),
    ("bsd", "under bsd", 50),
    ("bsd", "under the bsd", 50),
    ("bsd", "under a bsd", 50),
    ("zlib", "this software is provided as is without any express or implied warranty in no event", 80),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", 80),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy", 80),
    ("unlicense", "this is free and unencumbered software released into the public domain", 85),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", 80),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", 85),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public licen[cs]e", 86),
    ("agpl", "it under the terms of the gnu affero general public licen[cs]e as published by the free software foundation", 86),
    ("gpl", "(program|software|file|library) is distributed in the hope that it will be useful but without any warranty", 65),
    ("gpl", "you should have received a copy of the gnu general public licen[cs]e", 84),
    ("lgpl", "you should have received a copy of the gnu lesser general public licen[cs]e", 84),
    ("agpl", "you should have received a copy of the gnu affero general public licen[cs]e", 84),
    ("apache-2.0", "licensed under the apache license version 2 0( the license)?( you)? may not use this file except in compliance with the license", 97),
    ("apache-2.0", "apache ?v?2 0(?! (server|httpd|http|web|tomcat))", 50),
    ("apache-2.0", "(licen[cs]ed?|under|under the)( the)? apache( v| version)? ?v?2( 0)?", 58),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", 97),
    ("mpl", "the contents of this file are subject to the mozilla public license", 84),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", 84),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", 84),
    ("artistic", "same terms as perl itself", 60),
    ("ruby", "same terms as ruby", 60),
    ("wtfpl", "you just do what the fuck you want to", 75),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer in return", 80),
    ("cc0-1.0", "to the extent possible under law( [^ ]+){1,10} waived all copyright and related or neighboring rights", 88),
    ("cc", "this work is licen[cs]ed under a creative commons", 40),
    ("public-domain", "(this|these|the)( [^ ]+)? (is|are) in the public domain", 50),
    ("public-domain", "no copyright reserved", 45),
    ("ofl", "this font software is licensed under the sil open font license", 84),
    ("postgresql", "in no event shall the university of california be liable to any party", 75),
    ("openssl", "this product includes software developed by the openssl project", 75),
    ("php", "this product includes php software freely available from", 75),
    ("python", "psf is making python available to licensee on an as is basis", 75),
    ("ncsa", "developed by( [^ ]+){1,12} permission is hereby granted free of charge", 60),
    ("json", "the software shall be used for good not evil", 75),
    ("sspl", "offering the program as a service", 40),
    ("commons-clause", "the license does not grant to you the right to sell the software", 75),
    ("proprietary", "all rights reserved", 20),
    ("proprietary", "proprietary and confidential", 25),
    ("proprietary", "confidential and proprietary", 25),
    ("proprietary", "unauthori[sz]ed (copying|use|reproduction|distribution)( [^ ]+){0,8} (is )?(strictly )?prohibited", 30),
    ("proprietary", "no part of this( [^ ]+){1,3} may be (reproduced|copied|stored|transmitted)", 30),
    ("proprietary", "may not be (copied|reproduced|distributed)( or (copied|reproduced|distributed))? without (the )?(prior |express )?written permission", 30),
    ("proprietary", "unpublished proprietary (source code|information|work)", 30),
    ("proprietary", "trade secrets? (of|and|or)", 22),
    ("source-available", "for non commercial (use|purposes) only", 30),
    ("source-available", "for noncommercial (use|purposes) only", 30),
    ("source-available", "for (evaluation|educational|research) purposes only", 28),
    ("freeware", "this (software|program|file) is freeware", 40),
    ("freeware", "free for personal use", 25),
    ("shareware", "this (software|program) is shareware", 40),
    ("patent-grant", "perpetual worldwide non exclusive no charge royalty free irrevocable( [^ ]+){0,6} patent license", 35),
    ("as-is", "provided as is without warranty of any kind", 24),
    ("eula", "end user licen[cs]e agreement", 40),
    ("dual", "dual licen[cs]ed( under)?", 15),
]
# Addresses of licence texts.
ADDRESSES = [
    ("apache-2.0", "apache org licenses license 2 0"), ("gpl", "gnu org licenses( old licenses)? gpl"), ("lgpl", "gnu org licenses( old licenses)? lgpl"), ("agpl", "gnu org licenses agpl"),
    ("gfdl", "gnu org licenses fdl"), ("mit", "opensource org licenses mit"), ("bsd", "opensource org licenses bsd"), ("isc", "opensource org licenses isc"),
    ("mpl-2.0", "mozilla org mpl 2 0"), ("mpl-2.0", "mozilla org en us mpl 2 0"), ("epl", "eclipse org legal epl"), ("bsl-1.0", "boost org license 1 0"), ("ofl", "scripts sil org ofl"),
]
# The base phrases and their labels.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
# A text without any of these stems has no keyword; keywords without one are stems themselves.
STEMS = [
    "licen", "gpl", "spdx", "cc by", "cc0", "creative commons", "creativecommons", "public domain", "redistribut", "copyright", "prohibited", "permission", "warranty", "clause",
    "proprietary", "this product includes", "this software", " apache", " mpl", " epl", "the mit", "bsd", "mozilla org", "same terms as", "the fuck you", "purposes only",
]
GRANT = "(this (work|software|file|program|project) is )?(licen[cs]ed|released|distributed|published|available|provided) under( the terms of)?( the| a| an)?"
ENDING = "( international| unported| license| licence| public license){0,3}"
LATER = r"(\+| (or|and)( at your option)?( any)? (later|newer|higher)( versions?)?)"
START, END = "\x01", "\x02"


def _number(version: str) -> str:
    """The words of a version; a last 0 may be left out, where no other number follows."""
    major, minor = version.split(".")
    return f"{major}( {minor})?(?! [0-9] )" if minor == "0" else f"{major} {minor}"


def _version(version: str) -> str:
    """A version behind a name, glued to it or not."""
    return f"(( version| vers| ver)| ?v)? ?{_number(version)}"


def _alternatives(names: str) -> list[str]:
    """``names`` split at the bars that stand outside of parentheses."""
    out, depth = [""], 0
    for c in names:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def _gate(pattern: str) -> str:
    """A piece of plain text that every match of this pattern has: the longest, one with a stem if there is any. A match begins with a space."""
    outside = f" {pattern}"
    while (inner := re.sub(r"\([^()]*\)(\?|\{\d+,\d+\})?", "\n", outside)) != outside:
        outside = inner
    pieces = re.sub(r"\[[^\]]*\]\??|.\?", "\n", outside).split("\n")
    return max((piece.rstrip() for piece in pieces), key=lambda piece: (any(stem in piece for stem in STEMS), len(piece.strip())))


def build_rules() -> list[tuple[str, str, str, int]]:
    """(keyword, regular expression, label, priority), from the first in order down."""
    rules = []

    def add(names: str, body: str, label: str, priority: int) -> None:
        for name in _alternatives(names):
            rules.append((_gate(name), body.replace("NAME", name), label, priority))

    for label, names, versions in FAMILIES:
        for version in versions.split():
            written = f"NAME{_version(version)}"
            add(names, f"({GRANT} )?{written}{LATER}", f"{label}-{version}-or-later", 95)
            add(names, f"({GRANT} )?{written}{ENDING}", f"{label}-{version}", 90)
            before = f"(version|ver|v) ?{_number(version)}"
            add(names, f"{before}{LATER} of the NAME", f"{label}-{version}-or-later", 95)
            add(names, f"{before} of the NAME", f"{label}-{version}", 90)
        add(names, f"({GRANT} )?NAME", label, 60)
        for version in versions.split() or [""]:
            identifier = f"{label}-{version}" if version else label
            words = re.sub(r"[^a-z0-9]+", " ", identifier)
            rules.append(("spdx", rf"spdx license identifier {words}(\+| or later)", f"{identifier}-or-later", 100))
            rules.append(("spdx", f"spdx license identifier {words}( only)?", identifier, 100))
    for code, long in CREATIVE_COMMONS.items():
        short = code.replace("-", " ")
        for version in CREATIVE_COMMONS_VERSIONS:
            words = version.replace(".", " ")
            rules.append(("creativecommons", f"creativecommons org licenses {short} {words}( legalcode| deed)?", f"cc-{code}-{version}", 98))
            rules.append(("spdx", f"spdx license identifier cc {short} {words}", f"cc-{code}-{version}", 100))
            rules.append(("cc by", f"({GRANT} )?cc {short}( v)? ?v?{words}{ENDING}", f"cc-{code}-{version}", 90 + len(short.split())))
            rules.append(("creative commons", f"({GRANT} )?creative commons {long} {words}{ENDING}", f"cc-{code}-{version}", 90 + len(short.split())))
        rules.append(("cc by", f"({GRANT} )?cc {short}", f"cc-{code}", 60 + len(short.split())))
        rules.append(("creative commons", f"({GRANT} )?creative commons {long}", f"cc-{code}", 60 + len(short.split())))
    rules.append(("cc0", f"({GRANT} )?cc0( 1 0)?( universal)?", "cc0-1.0", 90))
    rules.append(("creativecommons", "creativecommons org publicdomain zero 1 0", "cc0-1.0", 98))
    for label, words, priority in PHRASES:
        rules.append((_gate(words), words, label, priority))
    rules.append(("licen", "(licen[cs]ed|released|distributed|published) under (the|a) [^ ]+ licen[cs]e", "unknown", 10))
    for label, address in ADDRESSES:
        rules.append((_gate(address), f"(https? )?(www )?{address}", label, 88))
    distinct = list(dict.fromkeys((g, f" ({p})(?= )", label, priority) for g, p, label, priority in rules))
    return sorted(distinct, key=lambda r: (-r[3], -len(r[1]), r[1], r[2]))


def stems_of(rules: list[tuple[str, str, str, int]]) -> list[str]:
    """Few texts, one of which each keyword contains."""
    keywords = {g for g, *_ in rules}
    used = [s for s in STEMS if any(s in k for k in keywords)]
    return used + sorted(k for k in keywords if not any(s in k for s in used))


def _lower(text: Column) -> Column:
    """A-Z lower-cased, and other letters in any case: none of them becomes a letter of ASCII, for the two that would are lower-cased by hand."""
    exact = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(text.contains("K") | text.contains("İ"), exact).otherwise(F.lower(text))


def plain(text: Column, plus: bool = False) -> Column:
    """The words of a text, each with a space before and the last with one behind; a single space without words. With ``plus``, one that ends a number stays."""
    between = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    if plus:
        between = r"(?:[\x00-\x2A\x2C-\x2F\x3A-\x60\x7B-\x7F]|(?<![0-9])\+|\+(?![\x00-\x2F\x3A-\x60\x7B-\x7F]))+"
    return F.regexp_replace(F.concat(F.lit(" "), _lower(text), F.lit(" ")), between, " ")


def _places(marked: Column, mark: str, at_start: bool) -> Column:
    """Numbers of the words that begin or end with a mark, in order."""
    words = F.split(F.substr(marked, F.lit(2)), " ", -1)
    flags = F.transform(words, lambda w, i: F.when(F.startswith(w, F.lit(mark)) if at_start else F.endswith(w, F.lit(mark)), i))
    return F.filter(flags, lambda i: i.isNotNull())


_FOUND = "array<struct<start:int,words:int,label:string,priority:int>>"


def _matches(text: Column, rule: Column) -> Column:
    """The intervals of a rule's matches, in order."""
    marked = F.regexp_replace(text, rule["pattern"], f" {START}$1{END}")
    return F.zip_with(_places(marked, START, True), _places(marked, END, False), lambda a, b: F.struct(
        a.alias("start"), (b - a + 1).alias("words"), rule["label"].alias("label"), rule["priority"].alias("priority")
    )).cast(_FOUND)


def _reach(spans: Column) -> Column:
    """For each word up to the last match: the last word of the match it lies in, or -1."""
    return F.flatten(F.transform(spans, lambda s, i: F.concat(
        F.array_repeat(F.lit(-1), s["start"] - F.coalesce(F.get(spans, i - 1)["start"] + F.get(spans, i - 1)["words"], F.lit(0))),
        F.array_repeat(s["start"] + s["words"] - 1, s["words"]),
    )))


def _apply(state: Column, rule: Column, text: Column) -> Column:
    """One rule: its matches, but for those within a match of an earlier rule, are added to ``found``; ``reach`` takes them all."""
    one = F.transform(F.array(_matches(text, rule)), lambda spans: F.struct(
        F.zip_with(state["reach"], _reach(spans), lambda a, b: F.greatest(a, b)).alias("reach"),
        F.concat(state["found"], F.filter(spans, lambda s: F.coalesce(F.get(state["reach"], s["start"]), F.lit(-1)) < s["start"] + s["words"] - 1)).alias("found"),
    ))
    return F.when(F.rlike(text, rule["pattern"]), F.element_at(one, 1)).otherwise(state)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[tuple[str, str, str, int]] | None = None) -> DataFrame:
    """Per row: the id, n_words, base (array of start, label), found (array of start, words, label, priority) and score.

    ``start`` counts words from 0; ``rules`` are (keyword, pattern, label, priority), those first in order first. The score is the highest priority found, of
    100; base phrases count as 60.
    """
    rules = build_rules() if rules is None else rules
    # Rules of one keyword stand together, so that a text is searched once for each keyword. The table is one literal, read when the plan is made.
    by_keyword: dict[str, list[dict]] = {}
    for place, (keyword, pattern, label, priority) in enumerate(rules):
        by_keyword.setdefault(keyword, []).append({"place": place, "pattern": pattern, "label": label, "priority": priority})
    kind = "array<struct<keyword:string,rules:array<struct<place:int,pattern:string,label:string,priority:int>>>>"
    table = F.from_json(F.lit(json.dumps([{"keyword": keyword, "rules": own} for keyword, own in by_keyword.items()])), kind)
    any_of = lambda c, parts: reduce(lambda a, b: a | b, [c.contains(p) for p in parts], F.lit(False))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("whole"))
    rows = rows.withColumn("text", plain(F.col("whole")))
    rows = rows.withColumn("n_words", (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) - 1).cast("bigint"))
    phrases = "|".join(p for p, _ in BASE)
    has_base = any_of(F.col("text"), [f" {p} " for p, _ in BASE])
    marked = F.regexp_replace("text", f" ({phrases})(?= )", f" {START}$1")
    words = F.split(F.substr(marked, F.lit(2)), " ", -1)
    begins = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("start"), w.alias("word"))), lambda x: F.startswith(x["word"], F.lit(START)))
    base = F.transform(begins, lambda x: F.struct(x["start"].alias("start"), _label_of(x["word"]).alias("label")))
    none = F.array().cast("array<struct<start:int,label:string>>")
    rows = rows.withColumn("base", F.when(has_base, base).otherwise(none))
    rows = rows.withColumn("ruled", F.when(any_of(F.col("text"), stems_of(rules)), plain(F.col("whole"), plus=True)))
    text = F.col("ruled")
    start = F.struct(F.array().cast("array<int>").alias("reach"), F.array().cast(_FOUND).alias("found"))
    let_through = F.array_sort(F.flatten(F.transform(F.filter(table, lambda g: F.contains(text, g["keyword"])), lambda g: g["rules"])))
    found = F.aggregate(let_through, start, lambda state, rule: _apply(state, rule, text), lambda s: s["found"])
    rows = rows.withColumn("found", F.when(text.isNotNull(), found).otherwise(F.array().cast(_FOUND)))
    best = F.greatest(F.coalesce(F.array_max(F.transform("found", lambda x: x["priority"])), F.lit(0)), F.when(F.size("base") > 0, F.lit(60)).otherwise(F.lit(0)))
    return rows.select(F.col("_id").alias(id_col), "n_words", "base", "found", (best / 100.0).alias("score"))


def _label_of(word: Column) -> Column:
    """The label of a base phrase by its first word, which differs for each."""
    out = F.lit(None).cast("string")
    for phrase, label in BASE:
        out = F.when(word == F.lit(START + phrase.split()[0]), F.lit(label)).otherwise(out)
    return out


def summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A scan's places and labels as plain columns: n_base, first_word, last_word, base_labels, labels."""
    of = lambda col: F.array_distinct(F.transform(col, lambda x: x["label"]))
    starts = F.transform("base", lambda x: x["start"].cast("bigint"))
    return scanned.select(
        id_col, "n_words", F.size("base").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(of(F.col("base"))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(of(F.col("base")), of(F.col("found")))), ",").alias("labels"), "score",
    )
