"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Base spans are what four plain patterns and their checks give: e-mail addresses, IPv4
addresses, card numbers (Luhn) and international phone numbers. They always stay.
Further spans are proposed more freely and need a score of ``least``: a checksum, a
usual shape and words of the same matter nearby add to it, words of another matter
take from it.

* ``iban``: country, its length and the mod-97 remainder; the remainder is enough.
* ``card``: numbers inside longer rows of digits, or divided by dots, that pass Luhn.
* ``phone``: national numbers and those that begin with 00; only next to fitting words.
* ``email``: addresses with (at) and (dot) written out in brackets.

Added spans never overlap base spans or one another. Candidates are found from rare
characters (an @, a plus, a row of digits, two capitals and two digits), in one pass
whose time grows with the length of a text, whatever it holds.

Defined cases: null and empty texts have no span; a null doc_id is kept; each row is
judged by itself, so repeated rows give repeated results; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import mapped

KINDS = ("email", "ip", "card", "phone", "iban")

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A row of digits and what may divide them; addresses and card numbers lie inside one.
DIGITS = re.compile(r"[0-9][0-9. -]*")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DOTTED = re.compile(r"[0-9]+(?:[ .-][0-9]+)*")
NATIONAL = re.compile(r"\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])|00[1-9][0-9](?:[ .-]?[0-9]){7,11}(?![0-9])")
WRITTEN_AT = re.compile(r" ?(?:\(at\)|\[at\]) ?", re.IGNORECASE)
WRITTEN_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?: ?(?:\(dot\)|\[dot\]) ?|\.)[A-Za-z0-9-]{1,63})+", re.IGNORECASE)
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ -]?[A-Z0-9])")

# Lengths of account numbers (IBAN) by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22,
    "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22,
    "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}
# First digits of card numbers, and how their digits are grouped.
ISSUER = re.compile(r"4|5[1-5]|2[2-7]|3[4-9]|6[0245]|50|5[6-8]")
GROUPINGS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), (13,), (14,), (15,), (16,), (19,)}

#: Words that speak for a kind, in the languages of the tables, and words that speak against any.
FOR = {
    "email": r"e-?mail|mail|contact|kontakt|correo|courriel",
    "ip": r"ip|host|server|address|adresse|dirección",
    "card": r"card|credit|debit|visa|mastercard|amex|karte|kreditkarte|tarjeta|carte",
    "phone": r"phone|tel|telephone|mobile|cell|call|fax|whatsapp|telefon|handy|anruf|teléfono|móvil|llamar|téléphone|portable|appeler",
    "iban": r"iban|account|bank|bic|swift|konto|cuenta|compte|banque",
}
AGAINST = r"order|invoice|tracking|version|isbn|issn|serial|hash|sha|bestellung|rechnung|pedido|factura|commande|facture"
_FOR = {kind: re.compile(rf"(?<!\w)(?:{words})(?!\w)", re.IGNORECASE) for kind, words in FOR.items()}
_AGAINST = re.compile(rf"(?<!\w)(?:{AGAINST})(?!\w)", re.IGNORECASE)


class Settings(NamedTuple):
    least: float = 0.75  # score of an added span
    before: int = 48  # characters before a span in which words count
    after: int = 24


class Span(NamedTuple):
    kind: str
    start: int  # code points
    end: int
    score: float
    base: bool


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def mod97(account: str) -> bool:
    """Whether a number that ends with country and check digits (put first in writing) leaves 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: what may stand before an @ reaches back to the @ or the address before it."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = floor + len(text[floor:at].rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        floor = m.end() if m else at + 1
        at = text.find("@", floor)


def written_emails(text: str) -> Iterator[tuple[int, int]]:
    floor = 0
    for m in WRITTEN_AT.finditer(text):
        start = floor + len(text[floor : m.start()].rstrip(LOCAL))
        domain = WRITTEN_DOMAIN.match(text, m.end()) if start < m.start() else None
        if domain:
            yield start, domain.end()
        floor = domain.end() if domain else m.end()


def small_parts(address: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in address.split("."))


def phones(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("+")
    while at >= 0:
        m = PHONE.match(text, at)
        if m and 9 <= len(digits_of(m[0])) <= 15:
            yield m.span()
        at = text.find("+", m.end() if m else at + 1)


def cards_inside(row: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, usual grouping) of whole groups of digits, divided by one sign, that together pass Luhn."""
    for chain in DOTTED.finditer(row):
        groups = [(m.start() + chain.start(), m.end() + chain.start()) for m in re.finditer("[0-9]+", chain[0])]
        k = 0
        while k < len(groups):
            total, found = 0, None
            for j in range(k, len(groups)):
                total += groups[j][1] - groups[j][0]
                if total > 19:
                    break
                if total >= 13:
                    sizes = tuple(b - a for a, b in groups[k : j + 1])
                    number = digits_of(row[groups[k][0] : groups[j][1]])
                    if ISSUER.match(number) and luhn(number) and (found is None or sizes in GROUPINGS):
                        found = (j, sizes in GROUPINGS)
            if found:
                yield groups[k][0], groups[found[0]][1], found[1]
            k = found[0] + 1 if found else k + 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in IBAN.finditer(text):
        left, at = IBAN_LENGTH.get(m[0][:2], 0) - 4, m.end()
        account = m[0]
        while left > 0 and at < len(text):
            at += text[at] in " -" and at + 1 < len(text)
            c = text[at]
            if not ("0" <= c <= "9" or "A" <= c <= "Z"):
                break
            account += c
            at, left = at + 1, left - 1
        if left == 0 and not (at < len(text) and text[at].isalnum()) and mod97(account):
            yield m.start(), at


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", *x) for x in emails(text)] + [("phone", *x) for x in phones(text)]
    for row in DIGITS.finditer(text):
        at = row.start()
        if row.end() - at < 7:
            continue
        out += [("ip", at + m.start(), at + m.end()) for m in IP.finditer(row[0]) if small_parts(m[0])]
        if row.end() - at >= 13:
            out += [("card", at + m.start(), at + m.end()) for m in CARD.finditer(row[0]) if 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    return out


def proposals(text: str) -> Iterator[tuple[str, int, int, float]]:
    """Further spans with what their own shape is worth."""
    for x in ibans(text):
        yield "iban", *x, 0.8
    for row in DIGITS.finditer(text):
        if row.end() - row.start() >= 13:
            for a, b, usual in cards_inside(row[0]):
                yield "card", row.start() + a, row.start() + b, 0.8 if usual else 0.5
        if row.end() - row.start() >= 10 or text[max(0, row.start() - 1)] == "(" or text[row.end() : row.end() + 1] == ")":
            m = NATIONAL.match(text, row.start() - (text[max(0, row.start() - 1)] == "(" and row.start() > 0))
            if m:
                yield "phone", *m.span(), 0.5
    if "(at)" in (low := text.lower()) or "[at]" in low:
        for x in written_emails(text):
            yield "email", *x, 0.8


def context(text: str, kind: str, start: int, end: int, s: Settings) -> float:
    """What nearby words add or take."""
    near = (text[max(0, start - s.before) : start], text[end : end + s.after])
    found = any(_FOR[kind].search(x) for x in near)
    return 0.3 * found - 0.3 * (not found and any(_AGAINST.search(x) for x in near))


def spans(text: str | None, s: Settings = Settings()) -> list[Span]:
    """All spans, by kind as listed in ``KINDS``, then by start."""
    if not text:
        return []
    out = [Span(kind, a, b, 0.8 + context(text, kind, a, b, s), True) for kind, a, b in base_spans(text)]
    taken = sorted((x.start, x.end) for x in out)
    added = [Span(kind, a, b, worth, False) for kind, a, b, worth in proposals(text)]
    added = [x._replace(score=x.score + context(text, x.kind, x.start, x.end, s)) for x in added]
    # The best first; of equal ones the first, then the first kind.
    chosen = sorted((x for x in added if x.score >= s.least - 1e-9), key=lambda x: (-x.score, x.start, KINDS.index(x.kind)))
    held = Taken(taken)
    out += [x for x in chosen if held.add(x.start, x.end)]
    return sorted((x._replace(score=round(min(max(x.score, 0.0), 1.0), 3)) for x in out), key=lambda x: (KINDS.index(x.kind), x.start))


class Taken:
    """Parts of a text that are taken; base spans of different kinds may overlap one another."""

    def __init__(self, parts: list[tuple[int, int]]):
        self.cells: dict[int, list[tuple[int, int]]] = {}
        for part in parts:
            self.put(*part)

    def put(self, start: int, end: int) -> None:
        for cell in range(start >> 6, (end >> 6) + 1):
            self.cells.setdefault(cell, []).append((start, end))

    def add(self, start: int, end: int) -> bool:
        """Take a part if nothing of it is taken."""
        if any(a < end and start < b for cell in range(start >> 6, (end >> 6) + 1) for a, b in self.cells.get(cell, ())):
            return False
        self.put(start, end)
        return True


def find(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id and spans (kind, start, end, score and base) of every row."""

    def work(part: pa.RecordBatch) -> dict:
        found = [spans(text, settings) for text in part.column(1).to_pylist()]
        flat = [x for own in found for x in own]
        names = ["kind", "start", "end", "score", "base"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
        rows = pa.StructArray.from_arrays([pa.array([x[i] for x in flat], t) for i, t in enumerate(kinds)], names)
        at = np.concatenate([[0], np.cumsum([len(own) for own in found], dtype=np.int64)])
        return {"doc_id": part.column(0), "spans": pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows)}

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double,base:boolean>>")


def redact(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with every span's text replaced by its kind in angle brackets; all other columns stay."""

    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            columns[at] = pa.array([blanked(t, settings) for t in columns[at].to_pylist()], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(work, docs.schema)


def blanked(text: str | None, s: Settings) -> str | None:
    if not text:
        return text
    out, at = [], 0
    for x in sorted(spans(text, s), key=lambda x: (x.start, -x.end)):
        if x.end <= at:
            continue
        out += [text[at : x.start], f"<{x.kind.upper()}>"]
        at = x.end
    return "".join([*out, text[at:]])


def summary(found: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, a digest of the base spans, and all spans as text."""
    shown = lambda column: F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["base"])
    count = lambda kind: F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(kind) for kind in KINDS[:4]], F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
