import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm.minhash_dedup import distinct_shingles, min_matches
from ledgerloom.llm.shared import passes, text_bytes
from ledgerloom.llm.words import shingles, windows, words

TEXTS = st.lists(st.one_of(st.none(), st.text("ab é\n\t\x0b 东Z", max_size=40)), max_size=8)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    raw, off = text_bytes(pa.array(texts, pa.string()))
    w = words(raw, off, lower=True)
    own = [[raw[a:b].tobytes().decode() for a, b in zip(w.starts[x:y], w.ends[x:y], strict=True)] for x, y in zip(w.offsets[:-1], w.offsets[1:], strict=True)]
    expected = [WORD.findall(t or "") for t in texts]
    assert own == expected
    names = [fold(x) for t in expected for x in t]
    assert len(set(w.hashes.tolist())) == len(set(names))
    for width in (1, 3, 5):
        h, first = windows(w.hashes, w.offsets, width)
        runs = [tuple(map(fold, t[i : i + width])) for t in expected for i in range(len(t) - width + 1)]
        assert len(h) == len(runs) and len(set(h.tolist())) == len(set(runs))
    sh, at = shingles(w.hashes, w.offsets, 5)
    sets = [{tuple(map(fold, t[i : i + 5])) for i in range(max(1, len(t) - 4))} if t else set() for t in expected]
    assert [len(set(sh[a:b].tolist())) for a, b in zip(at[:-1], at[1:], strict=True)] == [len(s) for s in sets]
    sh, at = distinct_shingles(raw, off, 5)
    assert np.diff(at).tolist() == [len(s) for s in sets]


def test_passes_cover_all_rows_and_bound_bytes():
    batch = pa.record_batch([pa.array(["x" * n for n in (0, 5, 30, 1, 1, 0, 200, 3)])], names=["text"])
    parts = list(passes(batch, limit=32))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or sum(map(len, p.column(0).to_pylist())) <= 32 for p in parts)


def test_min_matches_bounds_the_miss():
    from math import comb

    t = min_matches(40, 0.75, 1e-6)
    assert sum(comb(40, i) * 0.75**i * 0.25 ** (40 - i) for i in range(t)) <= 1e-6 < sum(comb(40, i) * 0.75**i * 0.25 ** (40 - i) for i in range(t + 1))
