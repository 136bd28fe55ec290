import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import periodic_runs
from ledgerloom.llm.queries import repeated_tail
from ledgerloom.llm.shared import text_bytes
from ledgerloom.llm.sql import SQL
from ledgerloom.llm.words import words
from tests.llm.test_words import WORD


def all_runs(w, least=12):
    """Every distance, one after another."""
    best = {}
    for q in range(1, len(w) // 2 + 1):
        begin = 0
        for i in range(len(w) - q + 1):
            if i == len(w) - q or w[i] != w[i + q]:
                if i - begin >= q and i - begin + q >= least:
                    best.setdefault((begin, i - begin + q), q)
                begin = i + 1
    return sorted((s, length, q) for (s, length), q in best.items())


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def collapse(w, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def row(doc_id, text):
    w = planted(doc_id, WORD.findall(text or ""))
    found = all_runs(w)
    top = min(((-length, s, q) for s, length, q in found), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = (top[1], -top[0], top[2], 1000 * -top[0] // top[2]) if top else (None,) * 4
    return (doc_id, len(found), *best, sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(collapse(w, found)))


def got(docs):
    return sorted(map(tuple, periodic_runs.summary(periodic_runs.find(docs, reorder=repeated_tail)).collect()), key=str)


def found_in(texts, least=12):
    raw, off = text_bytes(pa.array(texts))
    w = words(raw, off)
    r = periodic_runs.periodic_runs(w.hashes, w.offsets, least)
    return [sorted((int(s), int(n), int(q)) for d, s, n, q in zip(*r, strict=True) if d == k) for k in range(len(texts))]


def strings():
    """Texts with runs inside runs, runs that meet, long periods, and few different words."""
    rng = random.Random(7)
    out = []
    for _ in range(150):
        out.append("".join(rng.choice("ab") for _ in range(rng.randrange(1, 120))))
    for _ in range(150):
        piece = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
        block = piece * rng.randrange(1, 30) + "".join(rng.choice("abc") for _ in range(rng.randrange(3)))
        out.append("".join(rng.choice("abc") for _ in range(rng.randrange(9))) + block * rng.randrange(1, 6) + piece * rng.randrange(4))
    for _ in range(40):
        piece = [rng.randrange(30) for _ in range(rng.randrange(14, 130))]
        out.append([rng.randrange(30) for _ in range(rng.randrange(50))] + piece * rng.randrange(2, 5) + piece[: rng.randrange(len(piece))] + [rng.randrange(30) for _ in range(rng.randrange(50))])
    a, b = "a", "ab"
    for _ in range(12):
        a, b = b, b + a
    thue = "a"
    for _ in range(9):
        thue += thue.translate(str.maketrans("ab", "ba"))
    square = "ab"
    for _ in range(6):
        square = square * 2 + "a"
    out += [b, thue, thue * 3, square, "ab" * 40 + "a" + "ab" * 40 + "a" + "ab" * 17, "a" * 300 + "b" + "a" * 200 + "b" + "a" * 260, ("a" * 20 + "b") * 9 + ("a" * 20 + "c") * 5]
    return [" ".join(map(str, x)) for x in out]


def test_all_runs_of_repetitive_texts():
    texts = strings()
    assert found_in(texts) == [all_runs(t.split()) for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_random_nested_texts(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        w = [rng.choice("ab") for _ in range(rng.randrange(1, 20))]
        while len(w) < 500:
            a, b = sorted((rng.randrange(len(w) + 1), rng.randrange(len(w) + 1)))
            w = w[:b] + w[a:b] * rng.randrange(1, 4) + [rng.choice("abc") for _ in range(rng.randrange(2))] + w[b:]
        texts.append(" ".join(w[:900]))
    assert found_in(texts) == [all_runs(t.split()) for t in texts]


def test_misled_names_are_compared_again(monkeypatch):
    """With names of eight values, what seeds give is wrong nearly always, and no run that is told is."""
    texts = strings()[:60]
    mix = periodic_runs.Texts.agree
    monkeypatch.setattr(periodic_runs.Texts, "agree", lambda self, i, j, size: mix(self, i, j, size) | ((i + j + size) % 8 == 0))
    for t, found in zip(texts, found_in(texts), strict=True):
        assert set(found) <= set(all_runs(t.split()))


def test_whole_table_against_brute_force(table):
    docs = table("documents")
    small = docs.filter("length(text) < 4000")
    assert got(small) == sorted((row(r.doc_id, r.text) for r in small.collect()), key=str)


def test_edges(edge_docs, edge_rows, no_docs, duck):
    short = [r for r in edge_rows if r[0] != 17]
    assert got(edge_docs.filter("doc_id is null or doc_id <> 17")) == sorted((row(*r[:2]) for r in short), key=str)
    # A text of 20,000 words has runs only where its tail is repeated.
    assert [r[0] for r in got(edge_docs.filter("doc_id = 17"))] == [17]
    assert got(no_docs) == []
    one = [r for r in edge_rows if r[0] is not None and [x[0] for x in edge_rows].count(r[0]) == 1 and r[0] not in (16, 17)]
    names, rows = duck(SQL["op12_periodic_runs"], one)
    assert names == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(rows) == sorted(row(*r[:2]) for r in one)


def test_long_text_with_few_words(spark):
    """200,000 words with a period of 3 and a break: no quadratic work."""
    text = "a b c " * 40000 + "d " + "a b c " * 26000
    (r,) = periodic_runs.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [tuple(x) for x in r.runs] == [(0, 120000, 3), (120001, 78000, 3)]
    assert r.collapsed == "a b c d a b c"


def test_least_of_windows():
    rng = np.random.default_rng(2)
    v = rng.integers(0, 99, 200).astype(np.uint64)
    assert periodic_runs.least_of(v, 16).tolist() == [v[i : i + 16].min() for i in range(200)]
