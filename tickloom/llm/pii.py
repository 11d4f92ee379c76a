"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Four base kinds are always reported: e-mail addresses, IP addresses, payment
cards (Luhn) and phone numbers. Beyond them come bank account numbers (IBAN,
mod-97) and social security numbers; these are reported if their score, raised by
words nearby, reaches a threshold. Positions count code points, ends are
exclusive, and matches of a kind are leftmost and do not overlap.

Defined cases: a null text is an empty one; every row gives one row, repeated rows
and null ids too; an empty table gives an empty result; other columns of the
input are left out.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.tables import table

BASE = ("email", "ip", "card", "phone")
EXTRA = ("iban", "ssn")
KINDS = BASE + EXTRA
# Score of a confirmed span without context, gain by a context word, threshold of extra kinds.
SCORES = {"email": 0.9, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.9, "ssn": 0.3}
GAIN = 0.3
THRESHOLD = 0.5
# Code points on either side in which context words count.
NEAR = 48
# Words that go with a kind, lower case.
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "server", "host"),
    "card": ("card", "visa", "credit", "payment", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "taxpayer"),
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


# Possessive runs and lookbehinds keep the search linear on long runs; they match
# the same spans, because a run that fails at its start fails everywhere in it.
LOCAL_TAIL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGIT = re.compile("[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
# Characters of an account number by country, from the public registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22,
    "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23,
    "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30,
    "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22,
    "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29,
    "VA": 22, "VG": 24, "XK": 20,
}
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The bank account check: the first four characters go last, letters count from 10."""
    account = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A match starts at the first local character before its @ that is still free."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and LOCAL_TAIL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        else:
            free = at + 1
        at = text.find("@", max(free, at + 1))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        # Without leading zeros: Python reads no number of more than 4,300 digits.
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            yield m.span()


@functools.cache
def iban_tail(least: int, most: int) -> re.Pattern:
    """What follows an account number's first four characters, blanks allowed."""
    return re.compile(rf"(?: ?[A-Z0-9]){{{least},{most}}}(?![A-Za-z0-9])")


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers of their country's length; of other countries the longest run counts."""
    head = IBAN_HEAD.search(text)
    while head:
        length = IBAN_LENGTHS.get(head[0][:2])
        tail = iban_tail(length - 4, length - 4) if length else iban_tail(11, 30)
        rest = tail.match(text, head.end())
        found = rest and mod97(text[head.start() : rest.end()])
        if found:
            yield head.start(), rest.end()
        head = IBAN_HEAD.search(text, rest.end() if found else head.end())


def ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "ssn": ssns}


def score(text: str, kind: str, start: int, end: int) -> float:
    around = (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()
    near = any(word in around for word in CONTEXT[kind])
    return min(1.0, SCORES[kind] + GAIN * near)


def find(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """All reported spans of a text, by kind as listed, then start."""
    has_digit = DIGIT.search(text) is not None
    wanted = {"email": "@" in text, "phone": has_digit and "+" in text}
    spans = []
    for kind in KINDS:
        if wanted.get(kind, has_digit):
            for start, end in FINDERS[kind](text):
                span = Span(kind, start, end, score(text, kind, start, end))
                if kind in BASE or span.score >= threshold:
                    spans.append(span)
    return spans


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


SPAN_TYPE = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
    )
)


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of every text: doc_id, spans (kind, start, end, score)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[s._asdict() for s in find(t or "")] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, SPAN_TYPE)], names=["doc_id", "spans"]
            )

    rows = docs.select(id, text)
    kind = rows.schema[0].dataType.simpleString()
    spans = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
    return rows.mapInArrow(task, f"doc_id {kind}, spans {spans}")


def report(found: DataFrame) -> DataFrame:
    """Counts, the base spans' digest and all spans as text, per row of ``scan``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[Span(**s) for s in spans] for spans in batch.column(1).to_pylist()]
            base = [[s for s in spans if s.kind in BASE] for spans in rows]
            counts = [
                pa.array([sum(s.kind == kind for s in spans) for spans in rows], pa.int64())
                for kind in KINDS
            ]
            digests = [hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *counts,
                    pa.array(digests, pa.string()),
                    pa.array([joined(spans) for spans in rows], pa.string()),
                    pa.array([max((s.score for s in spans), default=0.0) for spans in rows], pa.float64()),
                ],
                names=names,
            )

    kind = found.schema[0].dataType.simpleString()
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "top_score"]
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return found.mapInArrow(
        task, f"doc_id {kind}, {counts}, base_sha256 string, spans string, top_score double"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: personal data in every document."""
    return report(scan(table(spark, sf_dir, "documents")))
