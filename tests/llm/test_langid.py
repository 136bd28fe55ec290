import random

from pyspark.sql import functions as F

from ledgerloom.llm import langid


def test_held_out_accuracy(table):
    docs = table("documents", "sf0.01")
    got = langid.identify(docs, langid.learn(docs)).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = [r.lang == r.lang_pred for r in got]
    assert len(got) > 150 and sum(right) / len(right) > 0.95
    sure = [r.lang == r.lang_pred for r in got if r.accepted]
    assert sum(sure) / len(sure) >= sum(right) / len(right)
    assert all(0 <= r.score <= 1 for r in got)


def test_the_held_out_part_teaches_nothing(table):
    docs = table("documents", "sf0.01")
    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert langid.learn(other) == langid.learn(docs)


def test_edges(edge_docs, edge_rows, no_docs):
    dictionaries = langid.learn(edge_docs)
    assert set(dictionaries) <= {"en", "de", "fr", "es"} and dictionaries
    got = langid.identify(edge_docs, dictionaries).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((r[0] for r in edge_rows), key=str)
    for r in got:
        if r.doc_id in (2, 3, 4, 15, 21):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        elif r.doc_id is not None:
            assert r.lang_pred in dictionaries
    assert all(r.held_out for r in got if r.doc_id is None)
    assert langid.learn(no_docs) == {}
    assert {r.lang_pred for r in langid.identify(edge_docs, {}).collect()} == {"und"}
    assert langid.identify(no_docs, dictionaries).count() == 0


def test_every_byte_counts():
    """A text's size is the sum over all its pieces; a foreign tail changes it."""
    sizes = langid.classifier({"a": b" alpha beta gamma delta" * 20, "b": b" uno dos tres cuatro" * 20}, 64, 1 << 15)
    head, tail = "alpha beta gamma delta " * 40, "uno dos tres cuatro " * 200
    s = sizes([head, head + tail, tail])
    assert s[0].argmin() == 0 and s[1].argmin() == 1 and s[2].argmin() == 1
    assert (s[1] > s[0]).all()


def test_short_lines_teach(spark):
    """A language whose lines all have under 40 characters, one of them without blanks, and more than 200 languages."""
    rng = random.Random(2)
    vocabulary = lambda letters: ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 7))) for _ in range(150)]
    text = lambda words, n, end: end.join(rng.choice(words) for _ in range(n))
    kinds = {"prose": (vocabulary("abcdefgh"), " "), "verse": (vocabulary("mnopqrst"), "\n"), "signs": (vocabulary("天地玄黄宇宙洪荒"), "\n")}
    rows = [(i, text(kinds[k][0], 120, kinds[k][1]), k) for i, k in enumerate(list(kinds) * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(docs, langid.learn(docs)).filter("held_out").collect()
    assert len(got) > 10 and all(r.lang_pred == rows[r.doc_id][2] for r in got)
    many = [(i, text(kinds["prose"][0], 60, " "), f"l{i % 210}") for i in range(1050)]
    content = langid.learn(spark.createDataFrame(many, "doc_id long, text string, lang string"), all_lines=420)
    assert len(content) == 210 and all(content.values())
