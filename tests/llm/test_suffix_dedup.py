import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import suffix_dedup
from ledgerloom.llm.suffix_dedup import Settings


def brute(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    count = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for r, b in zip(rows, texts, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((r[0], len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(docs, s):
    return sorted(map(tuple, suffix_dedup.dedup(docs, s).drop("kept_bytes").collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(97 + x % 2 for x in b)), max_size=25), st.integers(0, 6))
def test_order_of_deep_shallow_sorting(strings, shallow):
    order = suffix_dedup.deep_shallow(strings, 0, shallow)
    assert sorted(order) == list(range(len(strings)))
    assert [strings[i] for i in order] == sorted(strings)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=4), st.text("ab", min_size=4, max_size=8)), min_size=1, max_size=12))
def test_repeated_offsets_of_a_group(pairs):
    """Windows of 6 bytes around an anchor of 2 (offsets 0 to 4), against comparing all of them."""
    s = Settings(6, 2, 100)
    left, right = [p[0].encode() for p in pairs], [b"zz" + p[1].encode()[:4] for p in pairs]
    got = [{j for a, b in found for j in range(a, b + 1)} for found in suffix_dedup.repeated_offsets(left, right, s, 2)]
    window = lambda i, j: left[i][len(left[i]) - j :] + right[i][: 6 - j] if j <= len(left[i]) and 6 - j <= len(right[i]) else None
    for i in range(len(pairs)):
        assert got[i] == {j for j in range(5) if window(i, j) is not None and any(window(i, j) == window(k, j) for k in range(len(pairs)) if k != i)}


@pytest.mark.parametrize("s", [Settings(20, 6, 3), Settings(24, 24, 2), Settings(30, 8, 1000)])
def test_against_brute_force(spark, s):
    rng = random.Random(s.length)
    passages = ["".join(rng.choice("abcé") for _ in range(rng.randrange(10, 90))) for _ in range(5)]
    rows = [(d, "".join(rng.choice(passages)[rng.randrange(3) :] if rng.random() < 0.6 else "".join(rng.choice("wxyz") for _ in range(9)) for _ in range(rng.randrange(5)))) for d in range(40)]
    rows += [(41, "a" * 150), (42, None), (None, passages[0]), rows[0]]
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), s) == brute(rows, s.length)


def test_edges_with_production_settings(edge_docs, edge_rows):
    assert result(edge_docs, Settings()) == brute(edge_rows, 400)


def test_a_hot_passage_is_split(spark):
    """One passage in many texts, each with other surroundings: more contexts of an anchor than a group may hold."""
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh") for _ in range(130))
    rows = [(d, "".join(rng.choice("stuvwx") for _ in range(60)) + passage + "".join(rng.choice("stuvwx") for _ in range(60))) for d in range(80)]
    s = Settings(40, 12, 8)
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), s) == brute(rows, 40)


def test_empty(no_docs):
    assert suffix_dedup.dedup(no_docs).count() == 0
