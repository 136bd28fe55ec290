"""The merge-on-read store: what is read and written, conflicts, dead writers, compaction."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.incremental import EVENTS, MergeRule
from ledgerloom.plans import batch, buckets
from tests.test_incremental import DDL, RULE, rows


def table(frame, n, status="a", version="2024-01-05"):
    return frame([(i, status, "x", "2024-01-05", version) for i in range(n)], DDL)


def used(df):
    return {f.split("/data/")[1] for f in df.inputFiles()}


def test_a_merge_reads_and_writes_only_the_buckets_of_its_keys(spark, frame, tmp_path):
    path, audit = str(tmp_path / "t"), str(tmp_path / "audit")
    s = buckets.create(table(frame, 400), path, "id", buckets=16)
    delta = frame([(7, "b", "y", "2024-01-05", "2024-02-01"), (1000, "n", "y", "2024-01-05", "2024-02-01"), (8, "old", "y", "2024-01-05", "2023-01-01")], DDL)
    home = {r[0] for r in delta.select(s.bucket_of()).collect()}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in used(buckets.lookup(s, delta))} <= home and len(home) < 16
    plan = buckets.lookup(s, delta)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(id" in plan
    before = used(buckets.read(spark, path))
    assert tuple(buckets.merge(spark, path, delta, RULE, audit, "1").first()) == (1, 1)
    after = used(buckets.read(spark, path))
    assert before <= after and {f.split("bucket=")[1].split("/")[0] for f in after - before} <= {str(b) for b in home}
    got = rows(buckets.read(spark, path))
    assert got == [(i, "b" if i == 7 else "a", "x") for i in range(400)] + [(1000, "n", "y")]
    # Buckets without a delta are scanned as they are: no join, no aggregate over them.
    untouched = [e for e in buckets.snapshot(spark, path).entries if e.bucket not in home]
    assert "Exchange" not in buckets._live(spark, s, untouched)._jdf.queryExecution().executedPlan().toString()


def test_files_carry_bloom_filters(spark, frame, tmp_path):
    path, jvm = str(tmp_path / "t"), spark._jvm
    buckets.create(table(frame, 100), path, "id", buckets=2)
    file = jvm.org.apache.hadoop.fs.Path(buckets.read(spark, path).inputFiles()[0])
    footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(spark._jsc.hadoopConfiguration(), file)
    assert footer.getBlocks().get(0).getColumns().get(0).getBloomFilterOffset() > 0


def test_versions_stack_up_and_fold(spark, frame, tmp_path):
    path, audit = str(tmp_path / "t"), str(tmp_path / "audit")
    buckets.create(table(frame, 60), path, "id", buckets=3)
    for k in range(5):
        delta = frame([(i, f"s{k}", "y", "2024-01-05", f"2024-03-0{k + 1}") for i in range(k, 60, 2)], DDL)
        buckets.merge(spark, path, delta, RULE, audit, f"{k}")
    want = [(0, "s0", "x")] + [(i, "a" if i == 0 else "s4" if i % 2 == 0 and i >= 4 else "s3" if i % 2 and i >= 3 else "s2" if i == 2 else "s1", "x") for i in range(1, 60)]
    assert rows(buckets.read(spark, path)) == want
    assert buckets.compact(spark, path, deltas=100) == []
    assert buckets.compact(spark, path, deltas=2) == [0, 1, 2]
    s = buckets.snapshot(spark, path)
    assert all(e.base for e in s.entries) and rows(buckets.read(spark, path)) == want
    assert len(buckets.vacuum(spark, path)) == 6 and rows(buckets.read(spark, path)) == want
    assert spark.read.parquet(f"{audit}/t").count() == sum(len(range(k, 60, 2)) for k in range(5))


def test_two_writers_from_one_version(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    s = buckets.create(table(frame, 10), path, "id", buckets=2)
    buckets.append(frame([(1, "one", "y", "2024-01-05", "2024-03-01")], DDL), s)
    with pytest.raises(buckets.Conflict):
        buckets.append(frame([(1, "two", "y", "2024-01-05", "2024-03-01")], DDL), s)
    assert [r for r in rows(buckets.read(spark, path)) if r[0] == 1] == [(1, "one", "y")]


def test_folding_beside_a_writer_keeps_its_delta(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    buckets.append(frame([(1, "one", "y", "2024-01-05", "2024-03-01")], DDL), buckets.create(table(frame, 10), path, "id", buckets=1))
    write = buckets._write

    def meanwhile(df, s, run):
        monkeypatch.setattr(buckets, "_write", write)
        buckets.append(frame([(2, "two", "y", "2024-01-05", "2024-03-01")], DDL), buckets.snapshot(spark, path))
        return write(df, s, run)

    monkeypatch.setattr(buckets, "_write", meanwhile)
    assert buckets.compact(spark, path, deltas=1) == [0]
    assert [r[:2] for r in rows(buckets.read(spark, path))][:3] == [(0, "a"), (1, "one"), (2, "two")]


def test_a_dead_writer_changes_nothing_and_a_rerun_completes(spark, frame, tmp_path, monkeypatch):
    path, audit = str(tmp_path / "t"), str(tmp_path / "audit")
    buckets.create(table(frame, 6), path, "id", buckets=2)
    delta = frame([(1, "b", "y", "2024-01-05", "2024-03-01"), (9, "n", "y", "2024-01-05", "2024-03-01")], DDL)

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(buckets, "_commit", die)
        with pytest.raises(RuntimeError):
            buckets.merge(spark, path, delta, RULE, audit, "1")
    assert rows(buckets.read(spark, path)) == [(i, "a", "x") for i in range(6)]
    for _ in range(2):
        assert tuple(buckets.merge(spark, path, delta, RULE, audit, "1").first()) == (1, 1)
    assert [r[:2] for r in rows(buckets.read(spark, path))] == [(0, "a"), (1, "b"), (2, "a"), (3, "a"), (4, "a"), (5, "a"), (9, "n")]
    assert len([e for e in buckets.snapshot(spark, path).entries if not e.base]) <= 2


def test_empty_tables_empty_deltas_null_keys_and_loading_again(spark, frame, tmp_path):
    path, audit = str(tmp_path / "t"), str(tmp_path / "audit")
    none = table(frame, 3).limit(0)
    buckets.create(none, path, "id")
    assert buckets.read(spark, path).count() == 0
    assert tuple(buckets.merge(spark, path, none, RULE, audit, "1").first()) == (0, 0)
    assert tuple(buckets.merge(spark, path, table(frame, 3).unionByName(frame([(None, "a", "x", None, "2024-01-05")], DDL)), RULE, audit, "2").first()) == (3, 0)
    buckets.create(table(frame, 2, "z"), path, "id")
    assert rows(buckets.read(spark, path)) == [(0, "z", "x"), (1, "z", "x")]
    with pytest.raises(FileNotFoundError):
        buckets.read(spark, str(tmp_path / "none"))


def test_events_are_only_added(spark, tmp_path):
    path, audit = str(tmp_path / "t"), str(tmp_path / "audit")
    events = lambda lo, hi, stage: spark.range(lo, hi).select(F.col("id").alias("event_id"), F.lit(stage).alias("stage"))
    buckets.create(events(0, 50, "VIEW"), path, "event_id", buckets=4)
    assert tuple(buckets.merge(spark, path, events(40, 60, "CART"), EVENTS, audit, "1").first()) == (10, 0)
    assert {r[0]: r[1] for r in buckets.read(spark, path).groupBy("stage").count().collect()} == {"VIEW": 50, "CART": 10}


def test_a_table_whose_merge_lost_the_race_is_merged_again(spark, frame, tmp_path):
    """The refresh job meets another writer: it raises, moves no watermark, and a rerun gives the whole result."""
    rule = MergeRule("t", "id", ("status",), True)
    path, audit = str(tmp_path / "t"), str(tmp_path / "audit")
    buckets.create(table(frame, 4), path, "id", buckets=1)
    stale = buckets.snapshot(spark, path)
    buckets.merge(spark, path, frame([(1, "b", "y", "2024-01-05", "2024-02-01")], DDL), rule, audit, "1")
    with pytest.raises(buckets.Conflict):
        buckets.append(frame([(1, "c", "y", "2024-01-05", "2024-03-01")], DDL), stale)
    buckets.merge(spark, path, frame([(1, "c", "y", "2024-01-05", "2024-03-01")], DDL), rule, audit, "2")
    assert [r[:2] for r in rows(buckets.read(spark, path))] == [(0, "a"), (1, "c"), (2, "a"), (3, "a")]
    assert batch.MERGE_GROUPS[1] == ("fact_orders",)


def test_a_merge_leaves_no_scratch_rows_and_makes_no_checkpoint(spark, frame, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame

    path, audit = str(tmp_path / "t"), str(tmp_path / "audit")
    buckets.create(table(frame, 40), path, "id", buckets=2)
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda *_: pytest.fail("whole rows in a checkpoint"))
    delta = frame([(7, "b", "y", "2024-01-05", "2024-02-01"), (1000, "n", "y", "2024-01-05", "2024-02-01")], DDL)
    assert tuple(buckets.merge(spark, path, delta, RULE, audit, "1").first()) == (1, 1)
    assert not list((tmp_path / "t" / "_scratch").iterdir()) and isinstance(delta, DataFrame)


def test_large_tables_get_more_buckets_than_asked_for(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "ROWS_A_BUCKET", 10)
    assert buckets.create(table(frame, 95), str(tmp_path / "t"), "id", buckets=4).buckets == 10
    assert buckets.create(table(frame, 5), str(tmp_path / "u"), "id", buckets=4).buckets == 4


def test_a_merge_in_passes_writes_down_only_what_changes(spark, frame, tmp_path, monkeypatch):
    # Every key is in the delta, most of them stale: rows written down are the delta once, and the changes of each pass.
    audit, written, keep = str(tmp_path / "audit"), [], buckets.scratch

    @contextmanager
    def counted(spark, path):
        with keep(spark, path) as put:

            def count(df, *by):
                out = put(df, *by)
                written.append((out.count(), out.columns))
                return out

            yield count

    monkeypatch.setattr(buckets, "scratch", counted)
    delta = frame([(i, "b" if i % 10 == 0 else "old", "y", "2024-01-05", "2024-02-01" if i % 10 == 0 else "2023-01-01") for i in range(100)] + [(500, "n", "y", "2024-01-05", "2023-01-01")], DDL)
    found = []
    for a_pass in (64, 3):
        monkeypatch.setattr(buckets, "BUCKETS_A_PASS", a_pass)
        path = str(tmp_path / f"t{a_pass}")
        buckets.create(table(frame, 100), path, "id", buckets=8)
        written.clear()
        counts = buckets.merge(spark, path, delta, replace(RULE, audit=True), audit, f"{a_pass}")
        assert tuple(counts.first()) == (1, 10)
        assert [n for n, _ in written][0] == 101 and len(written) == 1 + (3 if a_pass == 3 else 1) and sum(n for n, _ in written[1:]) == 11
        assert buckets.compact(spark, path, deltas=1)
        was = spark.read.parquet(f"{audit}/{RULE.table}/run={a_pass}")
        found.append((rows(buckets.read(spark, path)), sorted((r.id, r.status, str(r.audit_ts), str(r.updated_at)) for r in was.collect())))
    assert found[0] == found[1]
    assert found[0][0] == [(i, "b" if i % 10 == 0 else "a", "x") for i in range(100)] + [(500, "n", "y")]
    assert found[0][1] == [(i, "a", "2024-02-01 00:00:00", "2024-01-05 00:00:00") for i in range(0, 100, 10)]
