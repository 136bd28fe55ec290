from ledgerloom.llm import line_dedup
from ledgerloom.llm.sql import SQL


def keys(text):
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    return [low(x.strip(" \t\n\x0b\x0c\r")) for x in (text or "").split("\n")]


def brute(rows):
    first, docs = {}, {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            for k in keys(text):
                if len(k) >= 10:
                    first[k] = min(first.get(k, doc_id), doc_id)
                    docs.setdefault(k, set()).add(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        stay = [x for x, k in zip(lines, keys(text), strict=True) if doc_id is None or len(docs.get(k, ())) < 2 or first[k] >= doc_id]
        out.append((doc_id, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def test_edges_against_brute_force(edge_docs, edge_rows):
    for batches in (1, 4):
        got = line_dedup.dedup(edge_docs, batches=batches, fanout=2).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
        assert sorted(map(tuple, got), key=str) == brute(edge_rows)


def test_whole_table_against_sql(spark, table, duck):
    docs = table("documents")
    columns, expected = duck(SQL["op1_line_dedup"], [tuple(r) for r in docs.collect()])
    got = line_dedup.dedup(docs).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_empty(no_docs):
    assert line_dedup.dedup(no_docs).count() == 0


def test_store_compacts_and_survives_a_repeat(spark):
    store = line_dedup.LineStore(spark, fanout=2, buckets=2)
    line = "a line that is long enough"
    for n in range(5):
        batch = spark.createDataFrame([(n, f"{line}\nonly in document number {n}")], "doc_id long, text string")
        gone = store.add(f"b{n}", batch).collect()
        assert [r.gone for r in gone] == ([] if n == 0 else [[0]])
    assert max(r["level"] for r in store.runs) >= 2 and len(store.runs) <= 3
    assert sum(spark.table(r["table"]).count() for r in store.runs) == 6
    again = line_dedup.LineStore(spark, root=store.root, fanout=2)
    assert again.runs == store.runs and again.buckets == 2
    # The last batch comes once more, as after a crash: it does not meet its own run.
    assert [r.gone for r in again.add("b4", batch).collect()] == [[0]]
    assert sum(spark.table(r["table"]).count() for r in again.runs) == 6


def test_runs_are_joined_without_a_shuffle(spark):
    store = line_dedup.LineStore(spark, fanout=9, buckets=3)
    docs = spark.createDataFrame([(1, "a line that is long enough")], "doc_id long, text string")
    store.add("a", docs)
    store.add("b", docs)
    one, two = (spark.table(r["table"]) for r in store.runs)
    plan = one.join(two.hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_main_path_has_no_python(spark, table):
    plan = line_dedup.dedup(table("documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
