"""What the plans promise: pushdown, early limits, no pair explosions."""

from __future__ import annotations

import pytest

from ledgerloom.operators import finance, kpis, shop, views
from ledgerloom.plans import batch


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_status_filter_and_columns_reach_the_scan(house):
    text = plan(house["orders"].where("o_orderstatus = 'F'").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    assert "o_totalprice" not in plan(views.orders_completed(house).select("order_id"))


def test_top_k_keeps_k_rows_per_task(house):
    assert "TakeOrderedAndProject(limit=10" in plan(kpis.top_products(house))


@pytest.mark.parametrize("df", [lambda h: kpis.top3_per_category(h), lambda h: shop.reviews_latest(h, 3), lambda h: shop.outbox_latest(h, 2), lambda h: shop.newest_orders(h, 5)])
def test_rank_limits_apply_before_the_shuffle(house, df):
    text = plan(df(house))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_no_cartesian_products(house):
    for df in (finance.order_pnl(house), finance.item_pnl(house), finance.customer_pnl(house)):
        assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def test_a_mart_refresh_lets_go_of_each_marts_shuffles(spark, house, tmp_path, monkeypatch):
    done = []
    publish = batch.publish
    monkeypatch.setattr(batch, "publish", lambda df, root, name, version: done.append(name) or publish(df, root, name, version))
    monkeypatch.setattr(batch, "release", lambda s: done.append("release"))
    out = batch.refresh_marts(house, str(tmp_path), "0001", ["mart_finance_profitability", "mart_funnel_conversion"])
    assert done == ["order_pnl", "release", "mart_finance_profitability", "release", "mart_funnel_conversion", "release"]
    assert all(f.endswith(".zstd.parquet") for df in out.values() for f in df.inputFiles())
