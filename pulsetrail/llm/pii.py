"""Personal data by anchor expansion.

One Aho-Corasick automaton finds anchors: at-signs, digits, plus signs, URL schemes and identifier cues. At each anchor
a local parser expands to the value's borders and validates it. Spans are code point offsets, end exclusive.

Kinds: email, ip, card and phone by the base rules; `url` (a URL with user data before its host), `iban` (checked modulo
97), `ssn` and `account` (a number of 6 to 18 digits) after a cue. Null texts are empty and hold nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import scan, wrapped

KINDS = ("email", "ip", "card", "phone", "url", "iban", "ssn", "account")
BASE = KINDS[:4]

# Cues that stand before an identifier.
CUES = {
    "ssn": ["ssn", "social security number", "social security no"],
    "iban": ["iban"],
    "account": ["account number", "account no", "acct no", "acct number", "routing number", "passport number",
                "passport no", "kontonummer", "numéro de compte", "número de cuenta"],
}

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
DIAL = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
USERINFO = re.compile(r"://[^\s/?#@]+@[^\s/?#@]+")
AFTER_CUE = r"[ \t:=#.\"']{0,4}"
PARSERS = {
    "ssn": re.compile(AFTER_CUE + r"(?P<v>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])"),
    "iban": re.compile(AFTER_CUE + r"(?P<v>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])"),
    "account": re.compile(AFTER_CUE + r"(?P<v>[0-9](?:[ -]?[0-9]){5,17})(?![0-9])"),
}


def luhn(digits: str) -> bool:
    doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return sum(doubled[int(d)] if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def iban(value: str) -> bool:
    bare = value.replace(" ", "")
    return 15 <= len(bare) <= 34 and int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for anchor, kind in [("@", "@"), ("+", "+"), ("://", "url"), *[(str(d), "digit") for d in range(10)]]:
        found.add_word(anchor, (kind, len(anchor)))
    for kind, cues in CUES.items():
        for cue in cues:
            for form in {cue, cue.upper(), cue.title(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def is_byte(digits: str) -> bool:
    """A number of any length is at most 255."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def spans(text: str | None, found) -> list[tuple[int, int, int]]:
    """(start, kind's number, end), sorted. Of each kind the spans are leftmost and do not overlap."""
    text = text or ""
    out: list[tuple[int, int, int]] = []
    over = dict.fromkeys([*KINDS, "run"], 0)   # up to where a kind has consumed the text

    def take(kind: str, start: int, end: int) -> None:
        out.append((start, KINDS.index(kind), end))
        over[kind] = end

    for last, (kind, length) in found.iter(text):
        at = last + 1 - length
        if kind == "digit":
            if at < over["run"]:
                continue                        # inside a run that was looked at
            over["run"] = DIGITS.match(text, at).end()
            start = max(at, over["ip"])         # a match may have ended inside this run
            if start < over["run"] and (m := DOTTED.match(text, start)):
                over["ip"] = m.end()
                if all(is_byte(x) for x in m[0].split(".")):
                    take("ip", start, m.end())
            if at >= over["card"] and (m := CHAIN.match(text, at)):
                over["card"] = m.end()
                digits = re.sub("[ -]", "", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    take("card", at, m.end())
        elif kind == "@":
            start = at
            while start > over["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                take("email", start, m.end())
        elif kind == "+":
            if at >= over["phone"] and (m := DIAL.match(text, at)):
                over["phone"] = m.end()
                if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
                    take("phone", at, m.end())
        elif kind == "url":
            start = at
            while start > over["url"] and text[start - 1].isascii() and text[start - 1].isalpha():
                start -= 1
            if start < at and (m := USERINFO.match(text, at)):
                take("url", start, m.end())
        elif (at == 0 or not text[at - 1].isalnum()) and (m := PARSERS[kind].match(text, last + 1)):
            if m.start("v") >= over[kind] and (kind != "iban" or iban(m["v"])):
                take(kind, m.start("v"), m.end("v"))
    return sorted(out)


def find(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds `pii`: an array of (start, end, kind), by start and then kind."""

    def start():
        found = automaton()
        return lambda texts: [([{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in spans(t, found)],)
                              for t in texts]

    return scan(df, start, "pii array<struct<start:int,end:int,kind:string>>", text)


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """Each span gives way to its kind in angle brackets; overlapping spans give way together, to the first one's kind.

    Texts without personal data, and null texts, stay as they are."""

    def start():
        found = automaton()

        def one(t: str | None) -> tuple[str | None]:
            parts, at = [], 0
            for s, k, e in spans(t, found):
                if s >= at:
                    parts += [t[at:s], f"<{KINDS[k].upper()}>"]
                at = max(at, e)
            return ("".join(parts) + t[at:] if at else t,)

        return lambda texts: [one(t) for t in texts]

    out = scan(wrapped(df, text), start, "redacted string", text)
    return out.select(*[F.col("redacted").alias(c) if c == text else F.col("row")[c].alias(c) for c in df.columns])


def report(docs: DataFrame) -> DataFrame:
    """doc_id, a count per base kind, the hash of the base spans and all spans as text; one row per input row."""
    shown = lambda array: F.array_join(F.transform(array, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of = lambda *kinds: F.filter("pii", lambda x: x["kind"].isin(*kinds))
    counted = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return find(docs.select("doc_id", "text")).select(
        "doc_id", *counted, F.sha2(shown(of(*BASE)).cast("binary"), 256).alias("base_sha256"),
        shown(F.col("pii")).alias("spans"))
