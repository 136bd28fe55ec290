from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixture
from ledgerloom.llm.sql import SQL
from tests.llm.test_words import WORD


def water_fill(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda s: s.encode()) + [n for n in sizes if n is None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if level * weight[n] > 2 * sizes[n]}
        if not over:
            return target | {n: level * weight[n] for n in open_}
        for n in over:
            target[n] = 2.0 * sizes[n]
            left -= target[n]
        open_ -= over
    return target


def check(rows, got):
    size = lambda t: len(WORD.findall(t or ""))
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += size(text)
    goals = water_fill(dict(sizes))
    assert sorted(((r.doc_id, r.source, r.size) for r in got), key=str) == sorted(((r[0], r[3], size(r[1])) for r in rows), key=str)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goals[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, goal in goals.items():
        assert goal - 1 - 1e-6 <= taken[source] <= goal + 1e-6
    cut = defaultdict(int)
    for r in got:
        cut[r.source] += r.size > 0 and r.taken % r.size > 0
    assert all(n <= 1 for n in cut.values())


def test_edges(edge_docs, edge_rows):
    check(edge_rows, mixture.mix(edge_docs).collect())


def test_whole_table_against_sql(table, duck):
    docs = table("documents")
    rows = [tuple(r) for r in docs.collect()]
    mixed = mixture.mix(docs)
    check(rows, mixed.collect())
    columns, expected = duck(SQL["op3_mix"], rows)
    assert sorted(map(tuple, mixed.select(*columns).collect())) == sorted(expected)


def test_ranges_do_not_change_the_mix(spark, table):
    docs = table("documents")
    first = sorted(map(tuple, mixture.mix(docs).collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert sorted(map(tuple, mixture.mix(docs.repartition(5)).collect())) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_empty(no_docs):
    assert mixture.mix(no_docs).count() == 0
    assert mixture.materialise(no_docs, mixture.mix(no_docs)).count() == 0


def test_materialise_gives_the_words_of_the_mix(edge_docs):
    mixed = mixture.mix(edge_docs)
    out = mixture.materialise(edge_docs, mixed)
    assert out.columns == edge_docs.columns
    words = {(r.doc_id, r.source): r.n for r in out.groupBy("doc_id", "source").agg(F.sum(mixture.word_count(F.col("text"))).alias("n")).collect()}
    assert words == {(r.doc_id, r.source): r.n for r in mixed.filter("taken > 0").groupBy("doc_id", "source").agg(F.sum("taken").alias("n")).collect()}
    starts = {r.doc_id: r.text for r in edge_docs.filter("doc_id = 17").collect()}
    assert all(starts[17].startswith(r.text) for r in out.filter("doc_id = 17").collect())
