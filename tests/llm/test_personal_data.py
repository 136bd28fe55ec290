import hashlib
import random
import re

import pytest

from ledgerloom.llm import personal_data
from ledgerloom.llm.personal_data import KINDS, blanked, spans

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checked(number):
    total = 0
    for i, d in enumerate(number[::-1]):
        total += sum(map(int, str(int(d) * (1 + i % 2))))
    return total % 10 == 0


def plain(text):
    """Base spans by the patterns as they are written."""
    text = text or ""
    number = lambda m: re.sub("[^0-9]", "", m.group())
    return [
        *[("email", *m.span()) for m in EMAIL.finditer(text)],
        *[("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        *[("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(number(m)) <= 19 and checked(number(m))],
        *[("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(number(m)) <= 15],
    ]


def slow_ibans(text):
    """Every place and every length, without patterns."""
    out = []
    for a in range(len(text)):
        if a and re.match("[A-Za-z0-9]", text[a - 1]):
            continue
        for b in range(a + 15, min(len(text), a + 70) + 1):
            body = re.sub("[ -]", "", text[a:b])
            ok = re.fullmatch("[A-Z]{2}[0-9]{2}(?:[ -]?[A-Z0-9])+", text[a:b]) and len(body) == personal_data.IBAN_LENGTH.get(body[:2]) and not text[b : b + 1].isalnum()
            if ok and int("".join(str("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ".index(c)) for c in body[4:] + body[:4])) % 97 == 1:
                out.append((a, b))
    return out


def base(text):
    return [(x.kind, x.start, x.end) for x in spans(text) if x.base]


def row(doc_id, text):
    found = plain(text)
    told = lambda x: ",".join(f"{k}:{a}:{b}" for k, a, b in x)
    counts = [sum(k == kind for k, *_ in found) for kind in KINDS[:4]]
    return (doc_id, *counts, hashlib.sha256(told(found).encode()).hexdigest(), told((x.kind, x.start, x.end) for x in spans(text)))


def got(docs):
    return sorted(map(tuple, personal_data.summary(personal_data.find(docs)).collect()), key=str)


def fuzz(n):
    rng = random.Random(4)
    bits = ["@", "a@b.c", "x.y", ".", "+", "+1", " ", "-", "(", ")", "4111111111111111", "4111 1111 1111 1111", "1.2.3.4", "255", "256", "007", "9", "12", "é", "東", "\n", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "tel ", "(743) 555-3824", "A", "\U0001f600"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 25))) for _ in range(n)]


def test_base_spans_of_random_texts():
    for text in fuzz(20000):
        assert base(text) == plain(text), text


def test_base_spans_stay_and_added_ones_overlap_nothing():
    for text in fuzz(5000):
        found = spans(text)
        assert [(KINDS.index(x.kind), x.start) for x in found] == sorted((KINDS.index(x.kind), x.start) for x in found)
        for x in found:
            assert x.score >= personal_data.Settings().least - 1e-9 or x.base
            assert x.base or not any(y is not x and y.start < x.end and x.start < y.end for y in found)


def test_ibans_of_random_texts():
    for text in fuzz(1500):
        assert sorted(personal_data.ibans(text)) == slow_ibans(text), text


ADDED = [
    ("4465758382889437 4465758382889437", "card", ["4465758382889437", "4465758382889437"]),  # 32 digits: no base span
    ("5555.5555.5555.4444", "card", ["5555.5555.5555.4444"]),
    ("4111 1111 1111 1111 2024", "card", ["4111 1111 1111 1111"]),
    ("order 4111 1111 1111 1111 2024", "card", []),
    ("4111111111111112 4111111111111112", "card", []),  # Luhn
    ("call (743) 555-3824 now", "phone", ["(743) 555-3824"]),
    ("the (743) 555-3824 now", "phone", []),
    ("Telefon: 0049 30 901820", "phone", ["0049 30 901820"]),
    ("write to jo.doe (at) example (dot) org please", "email", ["jo.doe (at) example (dot) org"]),
    ("IBAN DE89 3704 0044 0532 0130 00 AND", "iban", ["DE89 3704 0044 0532 0130 00"]),
    ("GB82WEST12345698765432", "iban", ["GB82WEST12345698765432"]),
    ("GB82WEST12345698765433", "iban", []),
    ("XX82WEST12345698765432", "iban", []),
]


@pytest.mark.parametrize(("text", "kind", "expected"), ADDED)
def test_added_spans(text, kind, expected):
    assert [text[x.start : x.end] for x in spans(text) if x.kind == kind and not x.base] == expected


def test_words_nearby_move_the_score():
    score = lambda text: [x.score for x in spans(text)]
    (plain_,), (paid,), (other,) = map(score, ("lorem 4111111111111111", "credit card 4111111111111111", "invoice 4111111111111111"))
    assert other < plain_ < paid


def test_whole_table_against_brute_force(table):
    docs = table("documents")
    expected = sorted((row(r.doc_id, r.text) for r in docs.collect()), key=str)
    assert got(docs) == expected and sum(r[3] for r in expected) and sum(r[1] for r in expected)


def test_edges(edge_docs, edge_rows, no_docs):
    assert got(edge_docs) == sorted((row(*r[:2]) for r in edge_rows), key=str)
    assert got(no_docs) == []
    assert sorted(personal_data.redact(edge_docs).columns) == sorted(edge_docs.columns)


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "mail a.b@c.example, call +1 (743) 555-3824"), (2, None)], "id long, text string")
    assert [r.text for r in personal_data.redact(docs).orderBy("id").collect()] == ["mail <EMAIL>, call <PHONE>", None]
    assert blanked("", personal_data.Settings()) == ""


@pytest.mark.parametrize("piece", ["@", "a", "1", "1 ", "1.", "+1", "a@", "A1", "AB12", "(at)", "4111111111111111 ", "(743) 555-3824 tel "])
def test_time_grows_with_length(piece):
    """400,000 characters of whatever could be gone over again and again."""
    import time

    began = time.perf_counter()
    spans(piece * (400_000 // len(piece)))
    assert time.perf_counter() - began < 20
