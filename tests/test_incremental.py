"""Merge laws, audit, watermarks, and reruns of the refresh job."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import incremental as inc
from ledgerloom.operators import snapshots
from ledgerloom.plans import batch, monthly
from ledgerloom.plans.publish import current, publish, versions

RULE = inc.MergeRule("t", "id", ("status",), True)
DDL = "id long, status string, place string, created_at timestamp, updated_at timestamp"


@pytest.fixture()
def sides(frame):
    old = frame([(1, "a", "x", "2024-01-05", "2024-01-05"), (2, "b", "x", "2024-01-06", "2024-01-06"), (3, "c", "x", "2024-02-07", "2024-02-07")], DDL)
    new = frame([(1, "A", "y", "2024-01-05", "2024-03-01"), (2, "B", "y", "2024-01-06", "2024-01-06"), (3, "C", "y", "2024-02-07", "2024-01-01"),
                 (4, "D", "y", "2024-02-08", "2024-02-08")], DDL)
    return old, new


def rows(df):
    return sorted((r.id, r.status, r.place) for r in df.collect())


def test_newer_updates_equal_and_older_are_ignored(sides):
    r = inc.merge(*sides, RULE)
    assert rows(r.merged) == [(1, "A", "x"), (2, "b", "x"), (3, "c", "x"), (4, "D", "y")]
    assert tuple(r.counts.first()) == (1, 1)
    assert [(a.id, a.status, a.audit_action) for a in r.audit.collect()] == [(1, "a", "UPDATE")]


def test_merge_is_idempotent(sides):
    old, new = sides
    once = inc.merge(old, new, RULE).merged
    again = inc.merge(once, new, RULE)
    assert rows(again.merged) == rows(once)
    assert tuple(again.counts.first()) == (0, 0)
    assert again.audit.count() == 0


def test_every_delta_row_is_inserted_updated_or_stale(house):
    for name, rule in inc.RULES.items():
        r = inc.merge_table(house, name)
        ins, upd = r.counts.first()
        delta = house[f"stg_{name}"]
        stale = delta.alias("s").join(house[name].alias("t"), rule.key).where("s.updated_at <= t.updated_at").count()
        assert ins + upd + stale == delta.count(), name
        assert r.audit.count() == upd


def test_last_part_wins_a_tie(frame):
    a = frame([(1, "COMPLETED", "x", "2024-01-01", "2024-01-01")], DDL)
    b = frame([(1, "RETURNED", "x", "2024-01-01", "2024-01-01")], DDL)
    assert inc.dedupe_latest(inc.concat_delta(a, b), ["id"]).first().status == "RETURNED"
    assert inc.dedupe_latest(inc.concat_delta(b, a), ["id"]).first().status == "COMPLETED"


def test_extract_window_is_open_then_closed(frame):
    df = frame([(i, "s", "p", "2024-01-01", f"2024-01-0{i}") for i in (1, 2, 3, 4)], DDL)
    assert sorted(r.id for r in inc.extract(df, "2024-01-02 00:00:00", "2024-01-03 00:00:00").collect()) == [3]


def test_watermark_default_and_upsert(frame):
    ctl = frame([("a", "2024-01-01 00:00:00")], "source_name string, last_processed_ts timestamp")
    now = F.lit("2024-05-01 12:00:00")
    assert str(inc.watermark_or_default(ctl, "new", now).first()[0]) == "2024-05-01 11:30:00"
    ctl = inc.watermark_set(inc.watermark_set(ctl, "a", now), "b", now)
    assert {r[0]: str(r[1]) for r in ctl.collect()} == {"a": "2024-05-01 12:00:00", "b": "2024-05-01 12:00:00"}


def test_monthly_merge_rewrites_touched_months_only_and_survives_a_rerun(spark, sides, tmp_path):
    old, new = sides
    path, audit = str(tmp_path / "t"), str(tmp_path / "audit")
    far = old.select("*").limit(0).unionByName(old.where("id = 3").withColumn("id", F.lit(9)).withColumn("created_at", F.to_timestamp(F.lit("2020-01-01"))))
    batch.init_table(old.unionByName(far), path, RULE)
    before = {f for f in monthly.read(spark, path).inputFiles() if "2020-01" in f}
    assert tuple(batch.merge_into(spark, path, new, RULE, audit, "0001").first()) == (1, 1)
    assert before == {f for f in monthly.read(spark, path).inputFiles() if "2020-01" in f}
    assert [r[0] for r in rows(monthly.read(spark, path))] == [1, 2, 3, 4, 9]
    assert tuple(batch.merge_into(spark, path, new, RULE, audit, "0002").first()) == (0, 0)
    assert spark.read.parquet(f"{audit}/t").where("run = 1").count() == 1
    assert tuple(batch.merge_into(spark, path, new, RULE, audit, "0001").first()) == (1, 1)  # the first run again
    assert spark.read.parquet(f"{audit}/t").where("run = 1").count() == 1
    assert [r[0] for r in rows(monthly.read(spark, path))] == [1, 2, 3, 4, 9]
    assert len(monthly.vacuum(spark, path)) == 2 and [r[0] for r in rows(monthly.read(spark, path))] == [1, 2, 3, 4, 9]


def test_update_whose_creation_date_moved_stays_one_row(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    batch.init_table(frame([(1, "a", "x", "2024-01-05", "2024-01-05")], DDL), path, RULE)
    batch.merge_into(spark, path, frame([(1, "b", "x", "2024-06-05", "2024-06-05")], DDL), RULE, str(tmp_path / "a"), "1")
    got = monthly.read(spark, path).collect()
    assert [(r.id, r.status, r.month) for r in got] == [(1, "b", "2024-01")]


def test_rows_without_a_date_survive_a_merge(spark, frame, tmp_path):
    path, audit = str(tmp_path / "t"), str(tmp_path / "a")
    batch.init_table(frame([(i, "a", "x", None if i % 2 else "2024-01-05", "2024-01-05") for i in range(20)], DDL), path, RULE)
    assert tuple(batch.merge_into(spark, path, frame([(1, "b", "x", None, "2024-06-05")], DDL), RULE, audit, "1").first()) == (0, 1)
    assert rows(monthly.read(spark, path)) == [(i, "b" if i == 1 else "a", "x") for i in range(20)]


def test_loading_again_replaces_everything(spark, sides, tmp_path):
    old, new = sides
    path = str(tmp_path / "t")
    batch.init_table(old, path, RULE)
    batch.merge_into(spark, path, new, RULE, str(tmp_path / "a"), "1")
    batch.init_table(old.where("id = 3"), path, RULE)
    assert rows(monthly.read(spark, path)) == [(3, "c", "x")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_merge_into_an_empty_table_and_of_an_empty_delta(spark, sides, tmp_path):
    old, new = sides
    path = str(tmp_path / "t")
    batch.init_table(old.limit(0), path, RULE)
    assert rows(monthly.read(spark, path)) == []
    assert tuple(batch.merge_into(spark, path, old, RULE, str(tmp_path / "a"), "1").first()) == (3, 0)
    assert tuple(batch.merge_into(spark, path, new.limit(0), RULE, str(tmp_path / "a"), "2").first()) == (0, 0)
    assert rows(monthly.read(spark, path)) == rows(old)


def test_a_writer_that_dies_changes_nothing(spark, sides, tmp_path, monkeypatch):
    old, new = sides
    path, audit = str(tmp_path / "t"), str(tmp_path / "a")
    batch.init_table(old, path, RULE)

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(monthly, "_point", die)
        with pytest.raises(RuntimeError):
            batch.merge_into(spark, path, new, RULE, audit, "1")
    assert rows(monthly.read(spark, path)) == rows(old)
    assert tuple(batch.merge_into(spark, path, new, RULE, audit, "1").first()) == (1, 1)
    assert rows(monthly.read(spark, path)) == [(1, "A", "x"), (2, "b", "x"), (3, "c", "x"), (4, "D", "y")]


def test_readers_see_only_complete_versions(spark, tmp_path):
    root = str(tmp_path)
    publish(spark.range(3), root, "m", "0001")
    (tmp_path / "m" / "0002").mkdir()
    assert versions(spark, root, "m") == ["0001"]
    assert current(spark, root, "m").count() == 3
    with pytest.raises(FileNotFoundError):
        current(spark, root, "other")


def test_snapshot_of_an_empty_warehouse_has_no_nulls(house):
    names = ("fact_orders", "fact_order_items", "fact_payments", "fact_shipments", "fact_returns", "dim_product")
    empty = {n: house[n].limit(0) for n in names}
    got = snapshots.snapshot(empty, "before", "2024-01-01 00:00:00").collect()
    assert len(got) == 16 and all(r.metric_value == 0 for r in got)


def test_before_after_needs_both_sides(frame):
    one = frame([("2024-01-01", "before", m, 1) for m in snapshots.COMPARED], "snapshot_ts timestamp, label string, metric_name string, metric_value decimal(20,4)")
    assert snapshots.before_after(one).count() == 0


def test_late_returns_cover_every_delivered_line_without_one(house):
    from parity.registry import CASES

    got = CASES["inc_late_returns"].run(house).select("order_item_id")
    done = house["fact_orders"].where("order_status in ('DELIVERED', 'COMPLETED')")
    lines = house["fact_order_items"].join(done, "order_id", "left_semi").join(house["fact_returns"], "order_item_id", "left_anti").select("order_item_id")
    assert got.count() == lines.count() > house["fact_returns"].count() / 6
    assert got.exceptAll(lines).isEmpty()
