from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows, marks and several alphabets."""
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, line = prose(60), prose(12)
    base = prose(120).split()
    near = [*base[:118], "other", "end"]
    rows = [
        (1, prose(80), "en", "a"), (2, None, "en", "a"), (3, "", None, "b"), (None, prose(40), "en", "a"), (4, "  \n\t\n ", "de", None),
        (5, f"{prose(30)}\n{passage}\n{prose(20)}", "en", "a"), (6, f"{prose(25)} {passage} {prose(9)}", "fr", "b"), (7, " ".join(base), "en", "c"),
        (8, " ".join(near), "en", "c"), (9, " ".join(base).upper(), "en", "c"), (10, f"{line}\n{prose(30)}\n{line}", "de", "a"), (11, f"  {line.upper()} \n\nx\nx", "de", "a"),
        (12, "word", "en", "d"), (13, "word", "en", "d"), (14, "Größe 東京 ñandú x #*$%&|<> 123", "es", "a"), (15, "12 34 !!", None, "a"),
        (16, "ab " * 3000, "en", "a"), (17, prose(20000), "en", "e"), (18, "x" * 5000, "en", "a"), (None, None, None, None), (19, f"{passage}\n" * 2, "en", "a"),
        (20, "tail\n", "fr", "b"), (21, "\n", "fr", "b"),
    ]
    rows += [rows[0], rows[5], (1, prose(70), "en", "a")]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows, with further columns whose names clash with those the operators make."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows, DOCS)
    clash = ("id", "th", "key", "pos", "gone", "lines", "size", "kept", "score", "n", "start", "target", "component", "hash", "h1", "taken", "_gone", "item_id")
    return df.withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def table(spark):
    return lambda name, sf="sf0.001": spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")


@pytest.fixture(scope="session")
def duck():
    """Rows that a statement gives in DuckDB over a table named documents."""
    import duckdb
    import pyarrow as pa

    def run(sql: str, rows: list[tuple]):
        names = [c.split()[0] for c in DOCS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
        documents = pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
        con = duckdb.connect()
        con.register("documents", documents)
        rel = con.sql(sql)
        return rel.columns, rel.fetchall()

    return run
