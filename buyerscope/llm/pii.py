"""Personal data: expressions propose spans, checksums confirm them, words nearby change the score.

The base kinds (email, ip, card, phone) are found by fixed expressions and checks and
always stay. The method adds what these miss: IBANs that pass mod 97, cards of 12 to 13
digits that pass Luhn, and phone numbers without a plus sign. A proposal starts with the
score of its kind and check, gains for each kind of word nearby that speaks for it and
loses for those that speak against it; it is added from ``ENOUGH`` on, unless it touches
a span that is there already.

Every expression runs in time that grows with the text: runs of characters are entered
at their first one only.

Defined cases: a null or empty text has no span. Rows are judged one by one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from buyerscope.llm.common import slices, utf8

KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]
#: Characters looked at on either side of a proposal.
NEARBY = 40
ENOUGH = 0.75
#: Score of a proposal by itself, gain and loss by words nearby.
ALONE = {"iban": 0.9, "card": 0.35, "phone": 0.35}
GAIN, LOSS = 0.45, 0.5
FOR = {
    "iban": re.compile(r"\b(?:iban|bank|account|konto|compte|cuenta)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|maestro|mastercard|credit|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|fax|telefon|téléphone|teléfono|handy)\b", re.I),
}
AGAINST = re.compile(r"\b(?:isbn|issn|order|serial|version|invoice|doi|page)\b", re.I)

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{2,5}\)|[0-9]{2,5})[\x20./-][0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the run of local characters before an @, then the domain."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        after = found.end() if found else at + 1
        if found:
            yield start, after
        at = text.find("@", after)


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, in no order."""
    out = [(a, b, "email") for a, b in _emails(text)]
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    if "." in text:
        # a part of more than three digits may still be at most 255 with leading zeros
        parts = ((m, [p.lstrip("0") or "0" for p in m[0].split(".")]) for m in _IP.finditer(text))
        out += [(m.start(), m.end(), "ip") for m, p in parts if all(len(x) <= 3 and int(x) <= 255 for x in p)]
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    return out


def _proposals(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _IBAN.finditer(text):
        if mod97(m[0]):
            yield m.start(), m.end(), "iban"
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() and 12 <= len(d := _digits(m[0])) <= 13 and luhn(d):
            yield m.start(), m.end(), "card"
    for m in _LOCAL_PHONE.finditer(text):
        if 7 <= len(_digits(m[0])) <= 12:
            yield m.start(), m.end(), "phone"


def score(text: str, start: int, end: int, kind: str) -> float:
    """Between 0 and 1: the kind's own score, with the words around it."""
    around = text[max(0, start - NEARBY) : start] + "\n" + text[end : end + NEARBY]
    value = ALONE[kind] + GAIN * bool(FOR[kind].search(around)) - LOSS * bool(AGAINST.search(around))
    return min(1.0, max(0.0, value))


def spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and all spans, each by start, then kind as listed."""
    order = lambda s: (s[0], KINDS.index(s[2]))
    base = sorted(base_spans(text), key=order)
    taken = list(base)
    for start, end, kind in _proposals(text):
        if score(text, start, end, kind) >= ENOUGH and all(end <= a or b <= start for a, b, _ in taken):
            taken.append((start, end, kind))
    return base, sorted(taken, key=order)


def written(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_* and base_sha256 of the base spans, spans) of every row."""
    names = ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            counts, digests, all_spans = [], [], []
            for raw in b.column("text").to_pylist():
                base, every = spans(raw.decode())
                counts.append([sum(s[2] == k for s in base) for k in BASE])
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                all_spans.append(written(every))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(BASE))]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns, pa.array(digests, pa.string()), pa.array(all_spans, pa.string())], names)

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text")).mapInArrow(run, schema)
