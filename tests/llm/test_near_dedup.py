import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import linking, minhash_dedup
from ledgerloom.llm.sql import SQL
from tests.llm.test_words import WORD, fold


def sets_of(rows):
    out = []
    for doc_id, text, *_ in rows:
        w = [fold(x) for x in WORD.findall(text or "")]
        out.append((doc_id, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    return out


def reach(edges, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, percent=75):
    sets = sets_of(rows)
    edges = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y)]
    home = reach(edges, {a for a, _ in sets if a is not None})
    return sorted(((a, len(x), home.get(a), a is None or home[a] == a) for a, x in sets), key=str)


def test_edges_against_brute_force(edge_docs, edge_rows):
    assert sorted(map(tuple, minhash_dedup.near_duplicates(edge_docs).collect()), key=str) == brute(edge_rows)


def test_whole_table_against_sql(table, duck):
    docs = table("documents")
    columns, expected = duck(SQL["op2_near_dedup"], [tuple(r) for r in docs.collect()])
    assert sorted(map(tuple, minhash_dedup.near_duplicates(docs).select(*columns).collect())) == sorted(expected)


def test_group_of_variants_is_one_component(spark):
    """Variants that are linked through their origin only, which is not the smallest id."""
    import random

    rng = random.Random(4)
    origin = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for n in range(60):
        words = list(origin)
        for at in rng.sample(range(200), 3):
            words[at] = f"v{n}x{at}"
        rows.append((n, " ".join(words)))
    rows += [(500, " ".join(origin)), (501, " ".join(origin))] + [(600 + n, " ".join(f"q{rng.randrange(10**6)}" for _ in range(50))) for n in range(20)]
    assert sorted(map(tuple, minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str) == brute(rows)


def test_dedup_keeps_columns_and_one_of_each_group(edge_docs, edge_rows):
    out = minhash_dedup.dedup(edge_docs)
    assert out.columns == edge_docs.columns
    kept = {r[0] for r in brute(edge_rows) if r[3]}
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted((r[0] for r in edge_rows if r[0] in kept), key=str)


def test_empty(no_docs):
    assert minhash_dedup.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(9, 3), (3, 7), (20, 21), (21, 22), (5, 9), (22, 20)]])
def test_components(spark, edges):
    got = {r.id: r.component for r in linking.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == reach(edges, {x for e in edges for x in e})


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_link_loses_no_link(spark, rounds):
    """Any pair of one key that is a link ends in one component, whatever the leaders."""
    import random

    rng = random.Random(rounds)
    links = {(a, b) for a in range(60) for b in range(a + 1, 60) if rng.random() < 0.03}
    keys = defaultdict(set)
    for _ in range(12):
        for x in rng.sample(range(60), 15):
            keys[len(keys) % 12 if rng.random() < 0.1 else rng.randrange(12)].add(x)
    postings = spark.createDataFrame([(k, x, rng.randrange(3)) for k, v in keys.items() for x in v], "key long, id long, rank long")
    truth = spark.createDataFrame(sorted(links) or [(0, 0)], "a long, b long")
    got = linking.link(postings, lambda pairs: pairs.join(truth, ["a", "b"]), rounds=rounds).collect()
    met = [(a, b) for a, b in links if any(a in v and b in v for v in keys.values())]
    expected = reach(met, {x for e in met for x in e})
    assert {r.id: r.component for r in got} == expected


def test_loose_copies_are_told_apart_by_masks(spark):
    """Copies of one text, each with a few changed words: the same components, and hardly any pair that is no link is made."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**6)}" for _ in range(90)]
    rows = []
    for k in range(150):
        own = list(base)
        for i in rng.sample(range(90), rng.randrange(3, 7)):
            own[i] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [(k, {tuple(t.split()[i : i + 5]) for i in range(86)}) for k, t in rows]
    pairs = [(a, b) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= 75 * len(x | y)]
    home = reach(pairs, [k for k, _ in rows])
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(docs).collect()}
    least = {h: min(k for k in home if home[k] == h) for h in set(home.values())}
    assert got == {k: least[home[k]] for k, _ in rows} and len(set(got.values())) > 1
    ids = minhash_dedup.shingle_sets(docs, 5)
    sided = lambda c: linking.masked(ids)(ids.select("id", F.size("shingles").alias("n"))).select(*[F.col(x).alias(f"{x}_{c}") for x in ("id", "n", *linking._MASK)])
    of = lambda c: {x: F.col(f"{x}_{c}") for x in ("n", *linking._MASK)}
    near = {tuple(r) for r in sided("a").join(sided("b"), F.col("id_a") < F.col("id_b")).filter(linking.within_masks(75)(of("a"), of("b"))).select("id_a", "id_b").collect()}
    assert set(pairs) <= near and len(near) <= 1.3 * len(pairs) + 50
