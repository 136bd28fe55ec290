import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import decontaminate
from tests.llm.test_words import WORD, fold


def words(text):
    return [fold(x) for x in WORD.findall(text or "")]


def grams(w):
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def brute(rows, items, percent=75):
    """The best weighted similarity of any item-sized run; items under five words as a whole."""
    listed = [(i, words(t)) for i, t in items if words(t)]
    out = {}
    for doc_id, text, *_ in rows:
        w = words(text)
        s = grams(w) if len(w) >= 5 else []
        for item_id, own in listed:
            if len(own) < 5:
                if any(w[k : k + len(own)] == own for k in range(len(w))):
                    out[doc_id, item_id] = 1.0
                continue
            need = Counter(grams(own))
            if not need.keys() & set(s):
                continue
            n = need.total()
            best = max(((both := (Counter(part) & need).total()) / (n + len(part) - both) for a in range(-n + 1, len(s)) if (part := s[max(a, 0) : max(a + n, 0)])), default=0)
            if 100 * best >= percent:
                out[doc_id, item_id] = best
    return out


def found(docs, items, **options):
    return {(r.doc_id, r.item_id): r.similarity for r in decontaminate.matches(docs, items, **options).collect()}


def test_whole_tables(table):
    docs, items = table("documents", "sf0.01"), table("benchmark", "sf0.01")
    expected = brute([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert expected and found(docs, items) == pytest.approx(expected)


@pytest.mark.parametrize("n", [5, 7, 12, 20, 33, 39, 60, 120])
def test_edited_passages(spark, n):
    """Every passage at or over the threshold is found, wherever it was edited."""
    rng = random.Random(n)
    noise = lambda k: [f"n{rng.randrange(10**6)}" for _ in range(k)]
    items = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))) for i in range(15)]
    rows = []
    for d in range(90):
        w = rng.choice(items)[1].split()
        for _ in range(rng.randrange(4)):
            at, how = rng.randrange(len(w)), rng.randrange(3)
            w[at : at + 1] = [[f"e{d}"], [], [w[at], f"e{d}"]][how]
        w = w[rng.randrange(2) : len(w) - rng.randrange(2)]
        rows.append((d, " ".join([*noise(rng.randrange(9)), *w, *noise(rng.randrange(9))]).title()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    expected = brute(rows, items)
    assert expected and found(docs, spark.createDataFrame(items, "item_id long, text string")) == pytest.approx(expected)


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    items = decontaminate.index_items([(0, " ".join(f"w{i}" for i in range(40)))], 75)
    index = items.indexes[0]
    prints = index.prints[rng.integers(len(index.prints), size=500)].copy()
    for i in range(len(prints)):
        for bit in rng.choice(64, rng.integers(0, 6), replace=False):
            prints[i] ^= np.uint64(1) << np.uint64(bit)
    query, other = decontaminate.within_radius(index, prints, 3)
    distance = np.bitwise_count(prints[:, None] ^ index.prints[None, :])
    assert set(zip(query.tolist(), other.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(distance <= 3)), strict=True))


def test_edges(spark, edge_docs, edge_rows, no_docs):
    passage = edge_rows[18 + 2][1].split("\n")[0]
    items = [(1, passage), (2, None), (3, ""), (4, " \n"), (None, "größe 東京"), (5, "word"), (6, passage), (7, "Größe 東京 ñandú x #*$%&|<> 123")]
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(edge_rows, items)
    assert expected and found(edge_docs, table) == pytest.approx(expected)
    assert found(edge_docs, table, block_items=2) == pytest.approx(expected)
    docs = {d for d, _ in expected}
    by_doc = defaultdict(set)
    for d, i in expected:
        by_doc[d].add(i)
    rows = {r.doc_id: r for r in decontaminate.contaminated(edge_docs, table).collect()}
    assert set(rows) == docs and all(set(r["items"]) == {i for i in by_doc[d] if i is not None} and r.kept is False for d, r in rows.items())
    clean = decontaminate.remove(edge_docs, table, block_items=3)
    assert clean.columns == edge_docs.columns
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((r[0] for r in edge_rows if not brute([r], items)), key=str)
    assert found(no_docs, table) == {} and found(edge_docs, spark.createDataFrame([], "item_id long, text string")) == {}
