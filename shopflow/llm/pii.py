"""Personal data: regular expressions propose spans, checksums confirm them, and nearby context words adjust the score.

The base kinds (email, ip, card, phone) stay whatever their context.  The further kinds iban (mod-97) and ssn (range
rules) need a score of MIN_SCORE: a prior, plus a bonus for context words of the kind nearby.

All matchers are linear in the text, so very long texts and long runs of digits or letters are safe.

Defined cases.  Null text is read as empty: no spans.  Texts are judged row by row, so ties, repeated rows and other
columns don't matter.  Spans count code points, end exclusive; overlapping spans of different kinds are all reported, and
masking covers their union.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tune

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
MIN_SCORE = 0.5
#: Characters on either side in which context words count.
CONTEXT = 60

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
#: Context words of each kind.
WORDS = {
    "email": ("mail", "email", "contact", "write"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "telephone", "telefono"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "tax"),
}
NEAR = {kind: re.compile(r"\b(?:" + "|".join(words) + r")\b", re.IGNORECASE) for kind, words in WORDS.items()}
BONUS = 0.2


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(text: str) -> bool:
    s = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """At each @ the longest local part to its left that no earlier match has taken."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans that their validators confirm."""
    for start, end in emails(text):
        yield "email", start, end
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m[0].split(".")):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37 and 12 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            yield "card", *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield "phone", *m.span()
    for m in IBAN.finditer(text):
        if 15 <= len(d := m[0].replace(" ", "")) <= 34 and mod97(d):
            yield "iban", *m.span()
    for m in SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0] < "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "ssn", *m.span()


def find(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind in the order of KINDS."""
    out = []
    for kind, start, end in proposals(text):
        around = text[max(0, start - CONTEXT):start] + " " + text[end:end + CONTEXT]
        score = min(1.0, PRIOR[kind] + BONUS * bool(NEAR[kind].search(around)))
        if kind in BASE_KINDS or score >= MIN_SCORE:
            out.append((kind, start, end, round(score, 3)))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _spans(col: pa.Array) -> pa.Array:
    return pa.array([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find(t or "")] for t in col.to_pylist()],
                    pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))


SPANS = "array<struct<kind: string, start: bigint, end: bigint, score: double>>"


def spans_of(text: Column) -> Column:
    return F.arrow_udf(_spans, SPANS)(text)


def digest(spans: str, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the spans, comma-joined; only of the given kinds."""
    some = f"filter({spans}, s -> s.kind in ({', '.join(repr(k) for k in kinds)}))" if kinds else spans
    return F.expr(f"array_join(transform({some}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def mask(text: str, spans: list[dict]) -> str:
    """The text with each run of spans replaced by <KIND> of its first span."""
    out, done, at = [], 0, 0
    for s in spans:
        if s["start"] >= done:
            out += [text[at:s["start"]], f"<{s['kind'].upper()}>"]
        done = at = max(done, s["end"])
    return "".join(out) + text[at:]


def masked_text(text: Column) -> Column:
    def run(col: pa.Array) -> pa.Array:
        return pa.array([None if t is None else mask(t, [{"kind": k, "start": a, "end": b} for k, a, b, _ in find(t)]) for t in col.to_pylist()], pa.string())
    return F.arrow_udf(run, "string")(text)


def with_spans(docs: DataFrame) -> DataFrame:
    """docs with the array column __pii of (kind, start, end, score)."""
    tune(docs.sparkSession)
    return docs.withColumn("__pii", spans_of(F.col("text")))
