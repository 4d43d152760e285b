"""Personal data: patterns propose spans, checksums confirm them, context moves the score.

Base kinds are email, ip, card (Luhn) and phone. The method adds ``iban``
(mod-97 confirmed) and ``national_id`` (nine digits in groups of 3-2-4, valid
area and serial, and only with a context word nearby). Every span has a score
from its kind, its confirmation and the words within CONTEXT_CHARS of it; base
spans stay whatever their score.

Null and empty texts have no spans. Texts are read whole, in time linear in
their length. Repeated rows give equal rows; other columns pass through, and
an input column with the name of the output column is replaced.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPAN_ARROW, SPAN_TYPE, batched, count_spans, documents, joined_spans, small_batches, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id")
CONTEXT_CHARS = 40
#: Start of the score by kind; a context word adds, a contrary word takes off.
PRIOR = {"email": 0.9, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.85, "national_id": 0.3}
CONTEXT_GAIN, CONTEXT_LOSS = 0.25, 0.3
CONTEXT = {
    "email": ("mail", "contact", "write", "@"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "national_id": ("ssn", "social security", "national id", "tax id", "passport"),
}
CONTRARY = {"ip": ("version", "release", " v"), "card": ("order", "invoice", "serial"), "phone": ("order", "serial"), "email": (), "iban": (), "national_id": ()}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){12,}+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")


def luhn(digits: str) -> bool:
    """Whether the Luhn sum of the digits is divisible by ten."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN without spaces has the remainder 1 of ISO 7064 mod 97-10."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def find_emails(text: str):
    """Spans of [local]+@label(.label)+, leftmost and non-overlapping, going from one @ to the next."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", last)


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = (text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]).lower()
    gain = CONTEXT_GAIN * any(w in near for w in CONTEXT[kind]) - CONTEXT_LOSS * any(w in near for w in CONTRARY[kind])
    return round(min(1.0, max(0.0, PRIOR[kind] + gain)), 4)


def find_pii(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start; code points, end exclusive."""
    found = [("email", a, b) for a, b in find_emails(text)]
    if "." in text:
        for m in _IP.finditer(text):
            parts = [x.lstrip("0") for x in m.group().split(".")]  # a long run of digits is never made a number
            if all(len(x) <= 3 and int(x or 0) <= 255 for x in parts):
                found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append(("phone", m.start(), m.end()))
    for m in _IBAN.finditer(text):
        run = m.group().replace(" ", "")
        if 15 <= len(run) <= 34 and mod97(run):
            found.append(("iban", m.start(), m.end()))
    scored = [(k, a, b, _score(k, text, a, b)) for k, a, b in found]
    if "-" in text:
        for m in _NATIONAL.finditer(text):
            area, group, serial = m.groups()
            if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
                if (s := _score("national_id", text, *m.span())) > PRIOR["national_id"]:
                    scored.append(("national_id", *m.span(), s))
    return scored


def scan_pii(df: DataFrame, text: str = "text", out: str = "pii_spans") -> DataFrame:
    """Add column ``out``: array of (kind, start, end, score) by kind, then start; empty if there are none."""
    small_batches(df.sparkSession)
    names = ("kind", "start", "end", "score")
    make = lambda: lambda texts: pa.array([[dict(zip(names, s)) for s in find_pii(x)] for x in texts_of(texts)], SPAN_ARROW)
    return df.withColumn(out, batched(make, SPAN_TYPE, F.col(text)))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts of base kinds, the digest of base spans, all spans and their scores."""
    found = scan_pii(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "pii_spans")
    spans = F.col("pii_spans")
    return found.select(
        "doc_id",
        *[count_spans(spans, k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined_spans(spans, BASE_KINDS), 256).alias("base_sha256"),
        joined_spans(spans, KINDS).alias("spans"),
        F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
