"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Kinds ``email ip card phone`` are exact patterns with exact checks. ``iban`` (mod-97 confirmed) and ``ssn`` (a grouped
number, kept only if its score reaches the threshold thanks to context) are added by the method.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.shared import shared_dir

# fixed values: the patterns of the kinds, in the order of the digest
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match that fails at the first digit of a run fails at the others too
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")

#: Score of a span by its form and check alone.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4}
#: Words before or after a span that speak for its kind, or against personal data.
FOR = {
    "email": ("mail", "email", "e-mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "client"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "telefon", "fax", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "tax"),
}
AGAINST = ("version", "order", "isbn", "serial", "example", "part", "ticket")
WORD = re.compile(r"[^\W\d_][\w-]*")
#: Characters looked at on either side of a span.
NEAR = 40


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    bare = iban.replace(" ", "")
    if not 15 <= len(bare) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@`` and a domain, in time linear in the text.

    A match holds one @. From each, the local part is as long as characters and the match before allow.
    """
    out: list[tuple[int, int]] = []
    at, low = text.find("@"), 0
    while at >= 0:
        start = at
        while start > low and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
        low = domain.end() if domain else at + 1
        at = text.find("@", low)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the four base kinds that pass their checks, by kind and start."""
    out = []
    if "@" in text:
        out += [("email", *span) for span in emails(text)]
    if "." in text:
        # a part of many digits is above 255 whatever its value
        out += [("ip", *m.span()) for m in IP.finditer(text)
                if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def added_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("iban", *m.span()) for m in IBAN.finditer(text) if mod97(m.group())]
    if "-" in text:
        out += [("ssn", *m.span()) for m in SSN.finditer(text)]
    return out


def score(text: str, kind: str, start: int, end: int) -> float:
    """Prior of the kind, moved by the context words within ``NEAR`` characters."""
    near = f"{text[max(0, start - NEAR):start]} {text[end:end + NEAR]}".lower()
    words = set(WORD.findall(near))
    up = 0.3 if words.intersection(FOR[kind]) else 0.0
    down = 0.3 if words.intersection(AGAINST) else 0.0
    return round(min(1.0, max(0.0, PRIOR[kind] + up - down)), 2)


def find(text: str | None, threshold: float = 0.5) -> list[tuple[str, int, int, float]]:
    """All spans of a text by kind and start; base kinds always stay, added ones from the threshold on."""
    text = text or ""
    spans = [(k, s, e, score(text, k, s, e)) for k, s, e in base_spans(text)]
    more = [(k, s, e, score(text, k, s, e)) for k, s, e in added_spans(text)]
    return spans + [x for x in more if x[3] >= threshold]


def redact(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one, named after the first."""
    out, at, last = [], 0, 0
    for kind, start, end, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= last:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = last = max(last, end)
    return "".join([*out, text[at:]])


SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def detect(docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = 0.5, redacted: bool = False) -> DataFrame:
    """``id, pii`` per row, ``pii`` the spans ``(kind, start, end, score)`` in code points, end exclusive.

    Whole texts are read, one row at a time inside Arrow batches; nothing is shuffled. Null and empty texts have no
    spans, repeated rows repeat. With ``redacted`` the column ``redacted`` has the text with spans replaced (null for
    null) and every column of ``docs`` stays; the added names must not be among them.
    """
    shared_dir(docs.sparkSession)
    if redacted:
        keep = docs.columns
        if {"pii", "redacted"} & set(keep):
            raise ValueError("the columns pii and redacted are added and must not exist")
    else:
        keep = [id_column]
    # columns go by their place: Arrow functions resolve names, in which dots and quotes would count
    source = docs.select(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(keep)], F.col(f"`{text}`").alias("_pii_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    schema = f"{fields}, pii array<struct<kind:string,start:bigint,end:bigint,score:double>>"
    schema += ", redacted string" if redacted else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = [find(t, threshold) for t in texts]
            spans = pa.array([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in f] for f in found], SPAN_TYPE)
            arrays = [*batch.columns[:-1], spans]
            names = [*batch.schema.names[:-1], "pii"]
            if redacted:
                arrays.append(pa.array([t if not f or t is None else redact(t, f) for t, f in zip(texts, found, strict=True)], pa.string()))
                names.append("redacted")
            yield pa.RecordBatch.from_arrays(arrays, names)

    found = source.mapInArrow(run, schema)
    return found.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(keep)], *found.columns[len(keep):])


def joined(spans: list) -> str:
    """``kind:start:end`` by kind, then start, joined by commas."""
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in ordered)


def digest(spans: list) -> str:
    return hashlib.sha256(joined([s for s in spans if s[0] in BASE]).encode()).hexdigest()
