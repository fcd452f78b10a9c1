"""Personal data by anchor expansion.

An Aho-Corasick automaton runs over the whole text once and stops at anchors: at-signs, plus signs,
digits, scheme marks and the words that announce an account or a secret. From each anchor a deterministic parser
expands to the boundaries of what may stand there, and a check decides: octets up to 255, Luhn, digit
counts, mod-97 for account numbers that have it.

Base kinds are ``email``, ``ip``, ``card`` and ``phone``; their spans are those of a leftmost,
non-overlapping search per kind with failing matches dropped and not tried again. The method adds
``account`` (an announced account number), ``login`` (user and password in front of a host) and
``secret`` (a value assigned to a token, key, password and the like; it has letters and digits, or
stands in quotes or is long).

Offsets are code points, ends exclusive. Null text counts as empty. Rows are independent of each other.
"""

from __future__ import annotations

import hashlib
import re
import string
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from respondry.llm.common import schema_with, text_bytes

KINDS = ("email", "ip", "card", "phone", "account", "login", "secret")
BASE = 4
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])*")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOGIN = re.compile(r"[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+")
CUES = ("account", "acct", "iban", "konto", "compte", "cuenta")
AFTER_CUE = re.compile(r"(?:[ ]?(?:no|nr|number)\b\.?)?[ :#=]{1,3}", re.ASCII | re.IGNORECASE)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", re.ASCII)
NUMBER = re.compile(r"[0-9](?:-?[0-9]){5,16}(?![A-Za-z0-9])", re.ASCII)
SECRETS = ("token", "secret", "password", "passwd", "pwd", "passphrase", "credential", "key", "bearer", "authorization")
ASSIGNED = re.compile(r"""[A-Za-z_]{0,8}["']?[ \t]{0,4}(?::=|=>|[:=])[ \t]{0,4}(?:bearer[ ]+)?|(?<=bearer)[ ]+""", re.ASCII | re.IGNORECASE)
QUOTED = re.compile(r"""(["'`])([^"'`\s]{6,})\1""")
BARE = re.compile(r"[A-Za-z0-9][A-Za-z0-9+/_.~-]{7,}={0,2}", re.ASCII)
Span = tuple[int, int, int]


@cache
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, what in [("@", "@"), ("+", "+"), ("://", "/"), *((d, "0") for d in string.digits)]:
        found.add_word(word, (what, len(word)))
    for what, cues in (("cue", CUES), ("secret", SECRETS)):
        for cue in cues:
            for form in (cue, cue.capitalize(), cue.upper()):
                found.add_word(form, (what, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    doubled = [2 * int(x) for x in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(x - 9 * (x > 9) for x in doubled)) % 10 == 0


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def mod_97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(x, 36)) for x in turned)) % 97 == 1


def _addresses(text: str, start: int, end: int) -> list[Span]:
    """Of a run of dotted numbers every four in turn."""
    out, parts = [], text[start:end].split(".")
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        size = sum(map(len, four)) + 3
        if all(map(small, four)):
            out.append((start, 1, start + size))
        start += size + 1
    return out


def _account(text: str, at: int) -> Span | None:
    gap = AFTER_CUE.match(text, at)
    if not gap:
        return None
    at = gap.end()
    if (found := IBAN.match(text, at)) and mod_97(found[0].replace(" ", "")):
        return at, 4, found.end()
    found = NUMBER.match(text, at)
    return (at, 4, found.end()) if found else None


def _secret(text: str, start: int, at: int) -> Span | None:
    """The value assigned to the cue that stands from ``start`` to ``at``."""
    if start and text[start - 1].isalpha() and not text[start].isupper():
        return None
    if not (gap := ASSIGNED.match(text, at)):
        return None
    if found := QUOTED.match(text, gap.end()):
        return found.start(2), 6, found.end(2)
    found = BARE.match(text, gap.end())
    if found and (any(map(str.isdigit, found[0])) and any(map(str.isalpha, found[0])) or len(found[0]) >= 24):
        return found.start(), 6, found.end()
    return None


def spans(text: str) -> list[Span]:
    """``(start, kind, end)`` in order of start, then kind."""
    out: list[Span] = []
    email_end = dotted_end = grouped_end = account_end = secret_end = 0
    for last, (what, size) in automaton().iter(text):
        if what == "0":
            if last >= dotted_end:
                dotted_end = DOTTED.match(text, last).end()
                if dotted_end - last >= 7:
                    out += _addresses(text, last, dotted_end)
            if last >= grouped_end:
                grouped_end = GROUPED.match(text, last).end()
                if grouped_end - last >= 12:
                    digits = text[last:grouped_end].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        out.append((last, 2, grouped_end))
        elif what == "@":
            start = last
            while start > email_end and text[start - 1] in LOCAL:
                start -= 1
            if start < last and (found := DOMAIN.match(text, last + 1)):
                email_end = found.end()
                out.append((start, 0, email_end))
        elif what == "+":
            if found := PHONE.match(text, last):
                if 9 <= sum(map(str.isdigit, found[0])) <= 15:
                    out.append((last, 3, found.end()))
        elif what == "/":
            if found := LOGIN.match(text, last + 1):
                out.append((last + 1, 5, found.end()))
        elif what == "secret":
            if last >= secret_end and (found := _secret(text, last + 1 - size, last + 1)):
                out.append(found)
                secret_end = found[2]
        elif last + 1 > account_end and (found := _account(text, last + 1)):
            out.append(found)
            account_end = found[2]
    return sorted(out)


def written_out(found: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def redacted(text: str, found: list[Span]) -> str:
    """``text`` with every span, overlapping ones as one, replaced by the name of its first kind."""
    out, at, shown = [], 0, 0
    for start, kind, end in found:
        if start >= at or not out:
            out += [text[shown:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
        shown = at
    return "".join(out) + text[shown:]


def found(docs: DataFrame, key: str) -> DataFrame:
    """Per row: ``key``, counts of the base kinds, ``base_sha256``, ``spans``, ``n_added``."""
    names = [f"n_{kind}" for kind in KINDS[:BASE]]

    def run(rows):
        for batch in rows:
            each = [spans(text.decode("utf-8", "replace")) for text in batch["text"].to_pylist()]
            base = [[x for x in found if x[1] < BASE] for found in each]
            columns = [pa.array([sum(x[1] == kind for x in found) for found in base], pa.int64()) for kind in range(BASE)]
            digests = [hashlib.sha256(written_out(found).encode()).hexdigest() for found in base]
            yield pa.RecordBatch.from_arrays(
                [
                    batch[key], *columns, pa.array(digests, pa.string()), pa.array(map(written_out, each), pa.string()),
                    pa.array([len(a) - len(b) for a, b in zip(each, base)], pa.int64()),
                ],
                names=[key, *names, "base_sha256", "spans", "n_added"],
            )

    added = ", ".join(f"{x} long" for x in names) + ", base_sha256 string, spans string, n_added long"
    return docs.select(key, text_bytes("text")).mapInArrow(run, schema_with(docs.select(key), added))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans of the column ``text`` replaced by their kind's name; null stays null."""

    def run(rows):
        for batch in rows:
            texts = [x if x is None else redacted(x, spans(x)) for x in batch["text"].to_pylist()]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)
