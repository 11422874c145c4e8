"""Labelled sentences for the boosted trees of :mod:`pii`, filled in from templates.

A template has one candidate. ``{...}`` stands for a made-up value of a form; half of the templates are held out for calibration.
"""

from __future__ import annotations

import random

# Private (1) and harmless (0) contexts of each form.
TEMPLATES = [
    (1, "please write to {mail} for details"), (1, "my mail is {mail} thanks"), (1, "contact: {mail}"), (1, "reach me under {mail} any day"), (1, "e-mail {mail}"),
    (0, "we look at things dot by dot"), (0, "they met at noon.Then it rained"), (0, "look at page.The end"), (0, "she arrived at home.Later she slept"), (0, "they arrived at work.Nobody was there"),
    (0, "was at last.He went"), (0, "sold at cost.They left"), (0, "seen at night.All is calm"), (0, "look at it.Now go"),
    (1, "call {local} before noon"), (1, "phone {local}"), (1, "tel: {local}"), (1, "my mobile is {local} now"), (1, "dial {local} to order"), (1, "fax {local}"),
    (0, "order {local} was sent"), (0, "invoice {local} is due"), (0, "isbn {local}"), (0, "part {local} of the engine"), (0, "serial {local}"), (0, "ticket {local} closed"),
    (0, "values 12 345 678 were seen"), (0, "pages 100 200 3000 were torn"), (0, "about 10 000 0000 grains"), (0, "between 120 300 400 and more"),
    (1, "bank account {iban}"), (1, "iban {iban}"), (1, "transfer to {iban} today"), (1, "pay into {iban}"), (1, "the number is {iban}"), (1, "see {iban} below"),
    (0, "part {noiban} is sold out"), (0, "serial {noiban}"), (0, "order {noiban} shipped"), (0, "build {noiban}"), (0, "model {noiban} was shown"), (0, "see {noiban} below"),
    (1, "from host {six} yesterday"), (1, "client {six} logged in"), (1, "ip {six}"), (1, "seen at {six} again"),
    (1, "ssn {ssn}"), (1, "social security {ssn}"), (1, "her social security number is {ssn}"), (1, "tax id {ssn}"), (1, "security number {ssn} on file"),
    (0, "part {ssn}"), (0, "order {ssn}"), (0, "item {ssn} in stock"), (0, "invoice {nossn}"), (0, "number {nossn}"), (0, "ref {nossn}"),
    (1, 'token = "{hex}"'), (1, "api key: {base}"), (1, "password={base}"), (1, "secret {hex}"), (1, "bearer {base}"), (1, "auth {hex} is used"), (1, 'key = "{base}"'),
    (0, "commit {hex} fixed it"), (0, "sha {hex}"), (0, "md5 {hex} matches"), (0, "checksum {hex}"), (0, "build {hex} passed"),
    (0, "the {long} was built"), (0, "see {path} for more"), (0, "{line} and then"), (0, "a {long} again"), (0, "in {path} there are"), (0, "word {long} is long"),
    (0, "key {long} words"), (0, "the secret {line} stands"), (0, "a token {long}"), (0, "password {line} follows"), (0, "key {path} holds"),
    (1, "call {groups} before noon"), (1, "phone {groups}"), (1, "tel: {groups}"), (1, "my mobile is {groups} now"), (1, "dial {groups} to order"), (1, "fax {groups}."),
    (1, "Call {groups}."), (1, "telephone ({groups})"), (1, "call us under {groups} - any day"), (1, "text {groups}, please"),
    (0, "order {groups} was sent"), (0, "invoice {groups} is due"), (0, "isbn {groups}"), (0, "part {groups} of the engine"), (0, "serial {groups}."), (0, "ticket {groups} closed"),
    (0, "on {date} it rained"), (0, "the years {years} were dry"), (0, "from {years}."), (0, "until {date}."), (0, "it cost {large} in all"), (0, "about {large} grains"),
    (0, "a share of {fraction} was left"), (0, "the ratio is {fraction}."), (0, "values {list} were seen"), (0, "between {list} and more"),
    (0, "contact us before {date}."), (0, "call {years} a dry time"), (0, "phone prices rose in {years}"), (0, "fax of {date} was read"), (0, "call on {date} at noon"), (0, "text of {years} is lost"),
    (1, "from host {short} yesterday"), (1, "client {short} logged in"), (1, "ip {short}"), (1, "seen at {short} again"), (1, "the server {short}."), (1, "ping {short}, then wait"),
    (0, "use {scope} here"), (0, "the call {scope} fails"), (0, "from {scope} on"), (0, "client {scope} is a class"), (0, "see {scope}."), (0, "type {scope} then"),
]
COPIES = 6


def _iban(rng: random.Random, right: bool) -> str:
    country, account = rng.choice(["DE", "FR", "GB", "ES", "NL"]), "".join(rng.choice("0123456789") for _ in range(18))
    number = int("".join(str(int(c, 36)) for c in account + country + "00"))
    check = 98 - number % 97
    if not right:
        check = (check + rng.randint(1, 90)) % 97
    plain = f"{country}{check:02d}{account}"
    return plain if rng.random() < 0.5 else " ".join(plain[i:i + 4] for i in range(0, len(plain), 4))


def _fill(rng: random.Random, form: str) -> str:
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    if form == "mail":
        at, dot = rng.choice([("(at)", "(dot)"), (" [at] ", " [dot] "), (" at ", " dot "), (" (at) ", ".")])
        return f"{letters(4)}.{letters(5)}{at}{letters(7)}{dot}{rng.choice(['com', 'org', 'net', 'de'])}"
    if form == "local":
        gap = rng.choice(" .-")
        return rng.choice([f"({digits(3)}) {digits(3)}{gap}{digits(4)}", f"{digits(3)}{gap}{digits(3)}{gap}{digits(4)}"])
    if form == "groups":
        gap = rng.choice(" -." if rng.random() < 0.3 else " ")
        return rng.choice([
            f"0{digits(3)}{gap}{digits(7)}", f"({digits(4)}) {digits(6)}", f"{digits(3)}{gap}{digits(4)}", f"0{digits(1)}{gap}" + gap.join(digits(2) for _ in range(4)),
            f"1{gap}{digits(3)}{gap}{digits(3)}{gap}{digits(4)}", f"1 ({digits(3)}) {digits(3)}{gap}{digits(4)}", f"0{digits(2)}{gap}{digits(3)}{gap}{digits(2)}{gap}{digits(2)}",
        ])
    if form == "date":
        y, m, d = f"{rng.randint(1900, 2030)}", f"{rng.randint(1, 12):02d}", f"{rng.randint(1, 28):02d}"
        return rng.choice([f"{y}-{m}-{d}", f"{d}.{m}.{y}", f"{m}-{d}-{y}", f"{y} {m} {d}"])
    if form == "years":
        y = rng.randint(1800, 2020)
        return f"{y}{rng.choice('- ')}{y + rng.randint(1, 20)}"
    if form == "large":
        return rng.choice([f"{digits(2)} {digits(3)} {digits(3)}", f"1 {digits(3)} {digits(3)}", f"{digits(3)}.{digits(3)}.{digits(3)}"])
    if form == "fraction":
        return f"{digits(rng.randint(1, 3))}.{digits(rng.randint(6, 8))}"
    if form == "list":
        return " ".join(digits(rng.randint(2, 4)) for _ in range(5))
    if form == "short":
        part = lambda n: ":".join("".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(1, 4))) for _ in range(n))
        return rng.choice([f"2001:db8::{part(1)}", f"fe80::{part(4)}", f"{part(2)}::{part(2)}", f"::ffff:{part(2)}", f"2a0{digits(1)}:{part(2)}::"])
    if form == "scope":
        word = lambda: rng.choice(["add", "bad", "dead", "beef", "face", "cafe", "fade", "deed", "feed", "a", "b"])
        return rng.choice([f"{word()}::{word()}", f"::{word()}", f"{word()}::"])
    if form == "six":
        return ":".join("".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(1, 4))) for _ in range(8))
    if form == "ssn":
        return f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"
    if form == "nossn":
        return f"{rng.choice(['000', '666', '900'])}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"
    if form == "hex":
        return "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([32, 40, 64])))
    if form == "base":
        return "a1B2" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-") for _ in range(rng.randint(20, 40)))
    if form == "long":
        return letters(rng.randint(20, 30))
    if form == "path":
        return "/".join(letters(rng.randint(4, 8)) for _ in range(5))
    if form == "line":
        return rng.choice("-_") * rng.randint(20, 60)
    return _iban(rng, form == "iban")


def examples(copies: int = COPIES, seed: int = 11) -> list[tuple[str, int, str]]:
    """(sentence, label, fold): ``f`` to fit on, ``c`` to calibrate on; whole templates go to one fold."""
    rng, out = random.Random(seed), []
    for i, (label, template) in enumerate(TEMPLATES):
        for _ in range(copies if "{" in template else 1):
            text = template
            for form in ("mail", "local", "iban", "noiban", "six", "nossn", "ssn", "hex", "base", "long", "path", "line",
                         "groups", "date", "years", "large", "fraction", "list", "short", "scope"):
                if "{" + form + "}" in text:
                    text = text.replace("{" + form + "}", _fill(rng, form))
            out.append((text, label, "cf"[i % 2]))
    return out
