import random
import re
import zlib
from collections import Counter

import numpy as np

from ledgerloom.llm import spelling_variants
from ledgerloom.llm.spelling_variants import Settings
from ledgerloom.llm.sql import SQL
from tests.llm.test_words import fold

RUN = re.compile("[A-Za-z\u00C0-\u00FF]+")


def counts(rows):
    """n of each word, one run at a time."""
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in RUN.findall(text or ""):
            low = fold(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 97 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            n[low] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(rows):
    """All pairs of words, one edit tried after another."""
    n = counts(rows)
    out = {}
    for w in n:
        mates = sorted((-n[x], x) for x in n if abs(len(x) - len(w)) < 2 and near(w, x))
        form = mates[0][1] if mates and n[mates[0][1]] >= 2 * n[w] else None
        out[w] = (form, n[w], len(mates), n[form] if form else None)
    for w, (form, *rest) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        yield (w, form, root, *rest)


def got(docs, **options):
    return {tuple(r) for r in spelling_variants.variants(docs, Settings(**options)).collect()}


def test_whole_table_against_brute_force(table):
    docs = table("documents")
    expected = set(brute(docs.collect()))
    assert len(expected) > 500 and any(form for _, form, *_ in expected) and got(docs) == expected


def test_small_leaves_and_parts_lose_nothing(table):
    """Leaves of a few words, a tree from a few words only, and leaves dealt to many tasks give the same."""
    docs = table("documents").limit(40)
    expected = set(brute(docs.collect()))
    assert got(docs, leaf=4) == got(docs, sample=30, leaf=4) == got(docs, part=5) == expected


def test_edges(edge_docs, edge_rows, no_docs, spark, duck):
    expected = set(brute(edge_rows))
    assert got(edge_docs) == expected
    names, rows = duck(SQL["op11_spelling_variants"], edge_rows)
    assert names == ["word", "form", "root", "n", "n_near", "form_n"] and set(rows) == expected
    assert got(no_docs) == set()


def test_anagrams_repeats_accents_and_long_runs(spark):
    """Words that share all letter counts, chains of forms, letters past z (also x00D7 and x00F7), and runs of thousands of letters."""
    rng = random.Random(3)
    letters = list("abcdefgh")
    words = []
    for _ in range(300):
        rng.shuffle(letters)
        words += ["".join(letters)] * rng.randrange(3, 30)
    words += ["größere"] * 40 + ["grössere"] * 9 + ["gr×ßere"] * 4 + ["größer÷"] * 3 + ["GRÖßERE"] * 20 + ["ÀÉÎÕÜ"] * 5 + ["àéîõü"] * 3
    words += ["x" * 5000] * 8 + ["x" * 4999] * 4 + ["x" * 2500 + "y" + "x" * 2499] * 3 + ["z" * 130] * 4 + ["z" * 131] * 12 + ["z" * 132] * 40
    rng.shuffle(words)
    rows = [(k, " ".join(words[k::50])) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = set(brute(rows))
    assert got(docs, leaf=16) == expected
    assert {"größere", "grössere", "gr×ßere"} <= {w for w, *_ in expected} and any(root not in (w, form) for w, form, root, *_ in expected)


def test_checksums_of_runs():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 4000).astype(np.uint8)
    starts = np.arange(0, 3000, 100)
    ends = starts + rng.integers(0, 200, len(starts))
    begun = rng.integers(0, 1 << 32, len(starts)).astype(np.uint32)
    want = [zlib.crc32(raw[a:b].tobytes(), int(c)) for a, b, c in zip(starts, ends, begun, strict=True)]
    assert spelling_variants.checksums(raw, starts, ends, begun).tolist() == want
