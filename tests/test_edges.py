"""Edge cases on hand-made tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import admin, finance, forecast, funnel, kpis, marts, measures, quality, segments
from ledgerloom.sources import schemas

EVENT = "event_id long, event_ts timestamp, session_id string, customer_id long, product_id long, order_id long, stage string, channel string, device string, failure_reason string"


@pytest.fixture()
def shop(frame):
    """Two orders: one with two payments, two shipments and a line returned twice; one without lines."""
    o = schemas.schema("fact_orders").simpleString()[7:-1].replace(":", " ")

    def t(name, rows):
        return frame(rows, schemas.schema(name).simpleString()[7:-1].replace(":", " "))

    assert o
    d = "2024-01-01"
    return {
        "dim_product": t("dim_product", [(1, "S1", "P", "c", "d", "b", 5, 10, d, d), (2, "S2", "P", "c", "d", "b", 5, 0, d, d)]),
        "fact_orders": t("fact_orders", [(1, 1, 1, "2024-01-10 10:00:00", "DELIVERED", "WEB", "USD", 100, 0, 7, 107, d, d),
                                         (2, 1, 1, "2024-01-12 10:00:00", "PLACED", "WEB", "USD", 0, 0, 0, 0, d, d),
                                         (3, 2, 1, "2024-01-13 10:00:00", "CANCELLED", "WEB", "USD", 50, 0, 0, 50, d, d)]),
        "fact_order_items": t("fact_order_items", [(11, 1, 1, 2, 10, 8, 5, 4, 1, 17, d, d), (12, 1, 1, 1, 10, 4, 5, 6, 0, 4, d, d)]),
        "fact_payments": t("fact_payments", [(1, 1, "CARD", "FAILED", "VISA", 20, 1, None, None, "X", 0, False, None, None, None, d, d),
                                             (2, 1, "CARD", "CAPTURED", "VISA", 20, 2, d, d, None, 0, False, None, None, None, d, d)]),
        "fact_shipments": t("fact_shipments", [(1, 1, 1, "UPS", None, "2024-01-14", "2024-01-15", 3, True, d, d), (2, 1, 1, "UPS", d, "2024-01-14", None, 4, False, d, d)]),
        "fact_returns": t("fact_returns", [(1, 1, 11, 1, "2024-01-20", "DAMAGED", 6, "REFUNDED", True, d, d), (2, 1, 11, 1, "2024-01-21", "DAMAGED", 5, "REFUNDED", True, d, d)]),
    }


def test_order_pnl_sums_each_fact_once(shop):
    got = {r.order_id: r for r in finance.order_pnl(shop).collect()}
    assert set(got) == {1, 2}
    r = got[1]
    assert (float(r.revenue_ex_tax), float(r.cogs), float(r.shipping_cost), float(r.gateway_fee_amount), float(r.refund_amount)) == (20, 15, 7, 2, 11)
    assert float(r.net_profit_ex_tax) == -15 and r.loss_order_flag and r.sla_breached_flag and r.has_return_flag
    assert r.discount_heavy_flag  # 10 / 30 is above 30 %
    assert float(got[2].revenue_ex_tax) == 0 and float(got[2].gross_margin_pct) == 0 and not got[2].loss_order_flag


def test_item_pnl_keeps_or_removes_the_fan_out(shop):
    kept = finance.item_pnl(shop).collect()
    assert sorted(r.order_item_id for r in kept) == [11, 11, 12]  # the line returned twice
    # shipping 7 x 2 payments x 2 returns, fee 2 x 2 shipments x 2 returns, shared 16:4
    twelve = [r for r in kept if r.order_item_id == 12][0]
    assert (float(twelve.alloc_shipping_cost), float(twelve.alloc_gateway_fee)) == (5.6, 1.6)
    once = {r.order_item_id: r for r in finance.item_pnl(shop, dedup=True).collect()}
    assert sorted(once) == [11, 12] and float(once[11].line_refund_amount) == 11
    assert (float(once[12].alloc_shipping_cost), float(once[12].alloc_gateway_fee)) == (1.4, 0.4)


def test_payment_failures_repeat_per_line_unless_deduplicated(shop):
    a = funnel.payment_failures(shop).first()
    b = funnel.payment_failures(shop, dedup=True).first()
    assert (a.failed_payments, float(a.amount_attempted), float(a.revenue_at_risk_ex_tax)) == (2, 40, 20)
    assert (b.failed_payments, float(b.amount_attempted), float(b.revenue_at_risk_ex_tax)) == (1, 20, 20)
    assert str(a.event_dt) == "2024-01-01"  # falls back to the creation day


def test_shipping_share_counts_revenue_per_shipment(shop):
    assert float(kpis.shipping_pct(shop).first()[0]) == round(100 * 7 / 214, 2)
    assert float(kpis.shipping_pct(shop, dedup=True).first()[0]) == round(100 * 7 / 107, 2)


def test_zero_list_price_is_left_out_of_the_sell_ratio(shop):
    assert abs(funnel.sell_ratio(shop).first()[0] - (0.8 + 0.4) / 2) < 1e-9
    empty = {"fact_order_items": shop["fact_order_items"].limit(0)}
    assert funnel.sell_ratio(empty).first()[0] == 0.88


def test_session_over_midnight_counts_on_both_days_but_once_overall(frame):
    e = frame([(1, "2024-01-01 23:59:00", "s1", None, 5, None, "ADD_TO_CART", None, None, None),
               (2, "2024-01-02 00:01:00", "s1", None, None, 9, "ORDER_PLACED", None, None, None),
               (3, "2024-01-02 10:00:00", "s2", None, 5, None, "ADD_TO_CART", None, None, None)], EVENT)
    days = {str(r.event_dt): r for r in funnel.daily_metrics({"fact_funnel_events": e}).collect()}
    assert days["2024-01-01"].add_to_cart == 1 and days["2024-01-02"].orders_placed == 1
    assert float(days["2024-01-02"].conversion_rate) == 0  # an order without a view
    assert [r.session_id for r in funnel.abandoned_sessions(e).collect()] == ["s2"]


def test_null_products_and_orders_never_join(frame, shop):
    e = frame([(1, "2024-01-01", "s1", None, None, None, "PAYMENT_FAILED", None, None, None), (2, "2024-01-01", "s1", None, None, None, "ADD_TO_CART", None, None, None)], EVENT)
    assert funnel.failed_orders(e).count() == 0
    assert funnel.abandoned_products(e).count() == 0
    assert funnel.product_leakage({**shop, "fact_funnel_events": e}).count() == 0


def test_exec_mart_fills_gaps_with_zero_and_conserves_revenue(shop, frame, spark):
    from ledgerloom.functions.calendar import date_dimension

    t = {**shop, "fact_funnel_events": frame([], EVENT), "dim_date": date_dimension(spark, "2024-01-01", "2024-02-01")}
    m = marts.exec_daily(t)
    assert m.count() == 21  # 1 January (a shipment's creation day) to 21 January (a return)
    assert float(m.agg(F.sum("revenue_ex_tax")).first()[0]) == float(finance.order_pnl(t).agg(F.sum("revenue_ex_tax")).first()[0])
    gap = m.where("kpi_dt = '2024-01-11'").first()
    assert gap.orders == 0 and float(gap.aov_ex_tax) == 0 and gap.funnel_product_views == 0


def test_repeated_quantile_edges_raise_or_stay(frame):
    rows = [(c, c, 1, "2024-01-01", "PLACED", "WEB", "USD", 1, 0, 0, 10) for c in range(10)]
    o = frame(rows, "order_id long, customer_id long, geo_id long, order_ts timestamp, order_status string, channel string, currency string, "
              "gross_amount decimal(14,2), discount_amount decimal(14,2), tax_amount decimal(14,2), net_amount decimal(14,2)")
    with pytest.raises(Exception, match="not distinct"):
        segments.rfm_scores({"fact_orders": o}).collect()
    kept = segments.rfm_scores({"fact_orders": o}, duplicates="keep").collect()
    assert {(r.recency_days, r.r_score, r.m_score) for r in kept} == {(1, 5, 1)}


def test_rfm_bins_match_pandas(house):
    import pandas as pd

    got = segments.rfm_scores(house).toPandas().sort_values("customer_id").reset_index(drop=True)
    money = got["monetary"].astype(float)
    assert got["m_score"].tolist() == pd.qcut(money, 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert got["r_score"].tolist() == pd.qcut(got["recency_days"], 5, labels=[5, 4, 3, 2, 1]).astype(int).tolist()
    assert got["f_score"].tolist() == pd.qcut(got["frequency"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()


def test_series_fills_missing_days_and_line_is_least_squares(house):
    import numpy as np

    s = forecast.daily_series(house).orderBy("dt").toPandas()
    assert s["day_no"].tolist() == list(range(len(s)))
    line = np.polyfit(s["day_no"], s["net_revenue"].astype(float), 1)
    fc = forecast.linear(house, horizon_days=5).orderBy("dt").toPandas()
    assert np.allclose(fc["forecast_lr"], np.polyval(line, len(s) + np.arange(5)))


def test_arima_follows_a_constant_drift():
    import numpy as np

    from ledgerloom.operators.forecast import _fit_arima

    rng = np.random.default_rng(1)
    d = np.zeros(200)
    for i in range(1, 200):
        d[i] = 0.6 * d[i - 1] + rng.normal()
    y = 50 + np.cumsum(d)
    fc = _fit_arima(y, 3)
    assert abs((fc[0] - y[-1]) - 0.6 * d[-1]) < 0.5
    assert list(_fit_arima(np.ones(10), 2)) == [1, 1]


def test_category_share_of_nothing_is_an_error(frame):
    m = frame([("2024-01-01", "a", 0)], "dt date, category_l1 string, revenue_ex_tax decimal(14,2)")
    with pytest.raises(Exception, match="no revenue"):
        admin.category_share(m, "2024-01-02").collect()
    with pytest.raises(ValueError):
        admin.category_share(m, "2024-01-02", level="brand")


def test_limits_are_checked(house):
    with pytest.raises(ValueError):
        finance.loss_orders(house, limit=500)
    with pytest.raises(ValueError):
        funnel.summary_window(house, "2024-01-31", 400)


def test_merge_map_treats_null_names_as_equal(frame):
    p = frame([(3, None), (1, None), (2, "x")], "product_id long, product_name string")
    assert [(r.old_id, r.canonical_id) for r in quality.merge_map(p).collect()] == [(3, 1)]
    assert tuple(quality.name_duplicate_stats(p).first()) == (3, 1, 1)
    assert tuple(quality.name_duplicate_stats(p.limit(0)).first()) == (0, 0, 0)


def test_measures_slice_by_what_a_mart_can_reach(house):
    from parity.cases_bi import Marts

    with pytest.raises(ValueError, match="cannot be sliced"):
        measures.measure(Marts(house), ["refund_amount"], ["brand"])
    with pytest.raises(ValueError, match="unknown measure"):
        measures.measure(Marts(house), ["nope"])


def test_dense_rank_counts_ties_once(frame):
    m = {"mart_product_performance": frame([(1, 50), (2, 30), (3, 30), (4, 5), (5, 0)], "product_id long, revenue_ex_tax decimal(14,2)")}
    got = {r.product_id: r for r in measures.pareto(m).collect()}
    assert [got[i].revenue_rank for i in range(1, 6)] == [1, 2, 2, 3, 4]
    assert [float(got[i].cumulative) for i in range(1, 6)] == [50, 110, 110, 115, 115]
    assert [got[i].abc_class for i in range(1, 6)] == ["A", "C", "C", "C", "C"]


def test_regressed_arima_finds_its_parameters_and_tells_short_and_flat_series(spark):
    """A long simulated series gives back phi and theta by its forecast; short, flat and single-day series are carried forward."""
    import datetime

    import numpy as np

    from ledgerloom.operators.forecast import LEAST_STEPS, arima_regression

    rng = np.random.default_rng(3)
    e = rng.normal(0, 100, 1500)
    d = np.zeros(1500)
    for i in range(1, 1500):
        d[i] = 0.6 * d[i - 1] + e[i] + 0.3 * e[i - 1]
    y = np.round(1e5 + np.cumsum(d), 2)
    day = lambda k: datetime.date(2020, 1, 1) + datetime.timedelta(days=k)
    rows = [("long", day(k), float(v)) for k, v in enumerate(y)]
    rows += [("short", day(k), float(k * k)) for k in range(LEAST_STEPS)] + [("flat", day(k), 7.0) for k in range(40)] + [("one", day(0), 3.0)]
    docs = spark.createDataFrame(rows, "name string, dt date, net_revenue double")
    got = {}
    for r in arima_regression(docs, ["name"], 5).orderBy("dt").collect():
        got.setdefault(r.name, []).append((r.dt, r.status, r.forecast_arima))
    assert {k: {s for _, s, _ in v} for k, v in got.items()} == {"long": {"fitted"}, "short": {"short"}, "flat": {"flat"}, "one": {"short"}}
    assert [v for _, _, v in got["flat"]] == [7.0] * 5 and [v for _, _, v in got["one"]] == [3.0] * 5 and got["one"][0][0] == day(1)
    moves = np.diff([y[-1], *[v for _, _, v in got["long"]]])
    assert np.allclose(moves[1:] / moves[:-1], moves[1] / moves[0]) and abs(moves[1] / moves[0] - 0.6) < 0.12
    assert abs(moves[0] - (0.6 * d[-1] + 0.3 * e[-1])) < 30
