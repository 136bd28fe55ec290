"""Marts that follow merges: equal to a rebuild, few rows written, a dead job run again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import incremental, marts
from ledgerloom.plans import batch, buckets, maintained

NAMES = ("fact_orders", "fact_order_items", "fact_payments", "fact_shipments", "fact_returns", "fact_funnel_events")


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()


def plain(df):
    """Money as text of four places, so that wider decimals compare equal."""
    return df.select(*[F.col(c).cast("decimal(30,4)").cast("string").alias(c) if t.startswith(("decimal", "double")) else F.col(c).cast("string").alias(c) for c, t in df.dtypes])


def test_marts_follow_merges(spark, house, tmp_path, monkeypatch):
    root = str(tmp_path)
    batch.init_tables(house, root, NAMES, buckets=2)
    maintained.follow(spark, root, width=2)
    assert set(maintained.follow(spark, root).values()) == {0}
    some = house["fact_orders"].orderBy("order_id").limit(3).select("order_id")
    later = F.col("updated_at") + F.make_dt_interval(F.lit(9000))
    orders = house["fact_orders"].join(some, "order_id").withColumn("order_status", F.lit("CANCELLED")).withColumn("updated_at", later)
    lines = house["fact_order_items"].join(some, "order_id").withColumn("qty", F.lit(1)).withColumn("updated_at", later)
    merge = lambda name, df, run: buckets.merge(spark, f"{root}/{name}", df.select(*house[name].columns), incremental.RULES[name], f"{root}/_audit", run)
    merge("fact_orders", orders, "1")
    merge("fact_order_items", lines, "1")

    def die(df, s, marks=None):
        if s.path.endswith(maintained.DAYS):
            raise RuntimeError("killed")
        return append(df, s, marks)

    append = buckets.append
    with monkeypatch.context() as m:
        m.setattr(buckets, "append", die)
        with pytest.raises(RuntimeError):
            maintained.follow(spark, root)
    written = maintained.follow(spark, root)
    # The three orders' days, and those alone; what was done before the job died is not done again.
    assert written[maintained.ORDER_SUMS] == 0 and 0 < written[maintained.DAYS] <= 3
    now = {**{n: house[n] for n in ("dim_date",)}, **{n: buckets.read(spark, f"{root}/{n}") for n in NAMES}}
    assert same(plain(maintained.exec_daily(spark, root, house)), plain(marts.exec_daily(now)))
    assert same(plain(maintained.finance_profitability(spark, root, house)), plain(marts.finance_profitability(now)))
    # Put back: the days' sums return to what they were.
    merge("fact_orders", house["fact_orders"].join(some, "order_id").withColumn("updated_at", later + F.make_dt_interval(F.lit(1))), "2")
    maintained.follow(spark, root)
    maintained.compact(spark, root, deltas=1)
    now["fact_orders"] = buckets.read(spark, f"{root}/fact_orders")
    assert same(plain(maintained.exec_daily(spark, root, house)), plain(marts.exec_daily(now)))


def test_a_state_begins_as_a_table_of_its_size(spark, house, tmp_path, monkeypatch):
    # The first sums are the base itself, in as many buckets as they need, and nothing written down on the way stays.
    root, looked = str(tmp_path), []
    monkeypatch.setattr(buckets, "ROWS_A_BUCKET", 100)
    monkeypatch.setattr(buckets, "lookup", lambda *a: looked.append(a))
    batch.init_tables(house, root, NAMES)
    written = maintained.follow(spark, root, width=2)
    assert not looked
    for f in maintained.FOLLOWERS:
        s = buckets.snapshot(spark, f"{root}/{f.name}")
        assert s.buckets == max(2, -(-written[f.name] // 100)) and all(e.base for e in s.entries) and set(s.marks) == set(f.below)
        assert buckets.read(spark, s.path).count() == written[f.name] > 0 and not list((tmp_path / f.name / "_scratch").iterdir())
