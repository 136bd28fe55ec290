import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity


def test_learns_marked_words_and_their_forms():
    """Texts with one of a few words, or of a stem with unseen endings, somewhere in the text."""
    rng = np.random.default_rng(3)
    syllables = ["ba", "de", "ti", "no", "ru", "ke", "la", "mi", "so", "pu"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 5)))
    def text(bad):
        w = [word() for _ in range(rng.integers(20, 200))]
        if bad:
            w[rng.integers(len(w))] = rng.choice(["Zorg!", "vlax", "qwarn" + word()])
        return " ".join(w)
    labels = rng.integers(0, 2, 900)
    texts = [text(y) for y in labels]
    model = toxicity.fit(texts[:600], labels[:600], ["en"] * 600)
    p = toxicity.probabilities(model, pa.array(texts[600:]))
    assert ((p >= 0.5) == labels[600:]).mean() > 0.97


def test_held_out_part_of_a_table(table):
    docs, labels = table("documents", "sf0.1"), table("labels", "sf0.1")
    model = toxicity.train(docs, labels, per_class=700)
    got = toxicity.score(docs, model).filter("held_out").join(labels, "doc_id").collect()
    y, p = np.array([r.toxic for r in got]), np.array([r.score for r in got])
    assert len(y) > 500 and ((p >= 0.5) == y).mean() > 0.97 and (p[y == 1] >= 0.5).mean() > 0.85
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)


def test_held_out_labels_teach_nothing(table):
    docs, labels = table("documents"), table("labels")
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = toxicity.train(docs, labels, per_class=20), toxicity.train(docs, other, per_class=20)
    assert all(np.array_equal(a, b) for a, b in zip(one.tables, two.tables, strict=True))


def test_edges(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(1, 1, 1), (5, 1, 0), (6, 0, 1), (7, 1, 0), (None, 1, 1), (8, None, None), (1, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(edge_docs, labels)
    got = toxicity.score(edge_docs, model).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((r[0] for r in edge_rows), key=str)
    assert all(0 <= r.score <= 1 for r in got) and all(r.held_out for r in got if r.doc_id is None)
    assert len({r.score for r in got if r.doc_id in (2, 3, 4, 21)}) == 1
    kept = toxicity.remove(edge_docs, model)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in got)
    for name in ("doc_id long, quality int, toxic int",):
        empty = spark.createDataFrame([], name)
        assert {r.score for r in toxicity.score(edge_docs, toxicity.train(edge_docs, empty)).collect()} == {0.0}
    assert toxicity.score(no_docs, model).count() == 0 and toxicity.remove(no_docs, model).count() == 0


def test_gradient_of_the_network_is_that_of_the_loss():
    """One small step of training lowers the loss of the batch it was made from."""
    texts, y = ["red blue", "green blue grey", "red", "grey green"] * 8, np.array([1, 0, 1, 0] * 8)
    loss = lambda m: float(np.mean(np.log1p(np.exp(-(2 * y - 1) * toxicity.logits(m, *toxicity.tokens(*toxicity.text_bytes(pa.array(texts))))))))
    losses = [loss(toxicity.fit(texts, y, [None] * 32, epochs=n)) for n in (0, 1, 4)]
    assert losses[0] > losses[1] > losses[2]


def test_labels_without_usable_text_take_no_place(spark):
    """Most labelled documents are too long or absent; the sample is full all the same."""
    docs = spark.createDataFrame([(i, "x" * (500 if i % 10 else 20), "en") for i in range(2000)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i // 10 % 2) for i in range(4000)], "doc_id long, toxic int")
    got = toxicity.training_rows(docs, labels, per_class=30, max_chars=100).collect()
    assert sorted(r.toxic for r in got) == [0] * 30 + [1] * 30 and {len(r.text) for r in got} == {20}
