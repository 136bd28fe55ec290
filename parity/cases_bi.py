"""BI measures and dashboard data."""

from __future__ import annotations

from collections.abc import Mapping

from ledgerloom.operators import dashboards, marts, measures
from parity.cases_core import BAD_PAY, exact
from parity.registry import FRAGMENTS, ORDER_DAY, case


class Marts(Mapping):
    """The marts of a warehouse, built when asked for, next to its dimensions."""

    def __init__(self, w):
        self._w = w

    def __getitem__(self, name):
        return marts.MARTS[name](self._w) if name in marts.MARTS else self._w[name]

    def __iter__(self):
        return iter([*marts.MARTS, "dim_date", "dim_geo"])

    def __len__(self):
        return len(marts.MARTS) + 2


def q(num: str, den: str) -> str:
    return f"cast({num} as double) / nullif(cast({den} as double), 0)"


def m(names: str, by: str = ""):
    return lambda w: measures.measure(Marts(w), names.split(), by.split())


FRAGMENTS["fin_t"] = """select sum(revenue_ex_tax) as rev, count(distinct order_id) as n, sum(cogs) as c, sum(gross_profit_ex_tax) as gp, sum(net_profit_ex_tax) as np from finance_rows"""
FRAGMENTS["exec_t"] = """select sum(refund_amount_return_dt) as rf, sum(return_lines) as rl, sum(shipping_cost_attrib) as sh, avg(cast(sla_breach_pct as double)) as sla, sum(active_customers) as act,
  sum(discount_amount) as di, sum(gateway_fee_amount) as fe from exec_rows"""
FRAGMENTS["fun_t"] = """select sum(product_views) as v, sum(add_to_cart) as a, sum(checkout_started) as c, sum(payment_attempts) as p, sum(orders_placed) as o,
  avg(cast(cart_abandonment_rate as double)) as ab, avg(cast(payment_failure_rate as double)) as pf from slice_funnel"""
FRAGMENTS["prod_t"] = """select sum(revenue_lost_cart_abandonment) as lost, sum(revenue_at_risk_ex_tax) as risk, sum(revenue_ex_tax) as rev, sum(units_sold) as u, sum(gross_profit_ex_tax) as gp,
  sum(return_lines) as rl from product_rows"""
FRAGMENTS["seg_t"] = """select count(*) as n, count(*) filter (repeat_customer_flag) as r, avg(cast(revenue_ex_tax as double)) as ltv from segment_rows"""

case("bi_core", m("net_revenue orders aov", "year month"), "year:i month:i net_revenue:m orders:i aov:m",
     f"""select year(order_dt) as year, month(order_dt) as month, sum(revenue_ex_tax) as net_revenue, count(distinct order_id) as orders, {q('sum(revenue_ex_tax)', 'count(distinct order_id)')} as aov
         from finance_rows group by 1, 2""")
case("bi_profit", m("cogs gross_profit net_profit gross_margin net_margin contribution_profit", "channel region"),
     "channel:s region:s cogs:m gross_profit:m net_profit:m gross_margin:m net_margin:m contribution_profit:m",
     f"""select *, {q('gross_profit', 'rev')} as gross_margin, {q('net_profit', 'rev')} as net_margin, net_profit as contribution_profit from (
         select channel, region, sum(revenue_ex_tax) as rev, sum(cogs) as cogs, sum(gross_profit_ex_tax) as gross_profit, sum(net_profit_ex_tax) as net_profit
         from finance_rows join dim_geo using (geo_id) group by 1, 2)""")
case("bi_refund", m("refund_amount return_lines", "year quarter"), "year:i quarter:i refund_amount:m return_lines:i",
     "select year(kpi_dt) as year, quarter(kpi_dt) as quarter, sum(refund_amount_return_dt) as refund_amount, sum(return_lines) as return_lines from exec_rows group by 1, 2")
case("bi_ops", m("shipping_cost sla_breach_pct shipping_cost_pct_of_revenue", "year"), "year:i shipping_cost:m sla_breach_pct:m shipping_cost_pct_of_revenue:m",
     f"""select year, shipping_cost, sla_breach_pct, {q('shipping_cost', 'rev')} as shipping_cost_pct_of_revenue from (
         select year(kpi_dt) as year, sum(shipping_cost_attrib) as shipping_cost, cast(sum(cast(sla_breach_pct as decimal(18,4))) as double) / count(*) as sla_breach_pct from exec_rows group by 1)
         left join (select year(order_dt) as year, sum(revenue_ex_tax) as rev from finance_rows group by 1) using (year)""")
case("bi_retention", m("customers repeat_customers repeat_purchase_rate ltv_estimate", "acquisition_channel"),
     "acquisition_channel:s customers:i repeat_customers:i repeat_purchase_rate:m ltv_estimate:m2",
     f"""select acquisition_channel, count(*) as customers, count(*) filter (repeat_customer_flag) as repeat_customers, {q('count(*) filter (repeat_customer_flag)', 'count(*)')} as repeat_purchase_rate,
         avg(cast(revenue_ex_tax as double)) as ltv_estimate from segment_rows group by 1""")
case("bi_active_customers", m("active_customers_daily", "year month"), "year:i month:i active_customers_daily:i",
     "select year(kpi_dt) as year, month(kpi_dt) as month, sum(active_customers) as active_customers_daily from exec_rows group by 1, 2")
case("bi_ltv_alt", m("ltv_horizon"), "ltv_horizon:m", f"select {q('rev', 'fin_t.n')} * (1 + {q('r', 'seg_t.n')}) as ltv_horizon from fin_t, seg_t")
case("bi_leakage", m("discount_amount gateway_fees leakage_total", "year"), "year:i discount_amount:m gateway_fees:m leakage_total:m",
     """select year(kpi_dt) as year, sum(discount_amount) as discount_amount, sum(gateway_fee_amount) as gateway_fees,
        sum(discount_amount + shipping_cost_attrib + refund_amount_return_dt + gateway_fee_amount) as leakage_total from exec_rows group by 1""")
case("bi_to_date", lambda w: measures.to_date(Marts(w)), "dt:d net_revenue:m mtd:m qtd:m ytd:m",
     """select kpi_dt as dt, revenue_ex_tax as net_revenue, sum(revenue_ex_tax) over (partition by date_trunc('month', kpi_dt) order by kpi_dt) as mtd,
        sum(revenue_ex_tax) over (partition by date_trunc('quarter', kpi_dt) order by kpi_dt) as qtd, sum(revenue_ex_tax) over (partition by year(kpi_dt) order by kpi_dt) as ytd from exec_rows""")
case("bi_prev_period", lambda w: measures.previous_periods(Marts(w)), "dt:d net_revenue:m prev_month:m growth_mom:m prev_week:m growth_wow:m",
     f"""select a.kpi_dt as dt, a.revenue_ex_tax as net_revenue, b.revenue_ex_tax as prev_month, {q('(a.revenue_ex_tax - b.revenue_ex_tax)', 'b.revenue_ex_tax')} as growth_mom,
         c.revenue_ex_tax as prev_week, {q('(a.revenue_ex_tax - c.revenue_ex_tax)', 'c.revenue_ex_tax')} as growth_wow from exec_rows a
         left join exec_rows b on b.kpi_dt = cast(a.kpi_dt - interval 1 month as date) left join exec_rows c on c.kpi_dt = a.kpi_dt - 7""")
case("bi_anomaly", lambda w: measures.anomalies(Marts(w)), "dt:d net_revenue:m z:m flag:i",
     """select dt, net_revenue, z, cast(abs(z) >= 2 as int) as flag from (select kpi_dt as dt, revenue_ex_tax as net_revenue,
        (cast(revenue_ex_tax as double) - avg(cast(revenue_ex_tax as double)) over ()) / stddev_pop(cast(revenue_ex_tax as double)) over () as z from exec_rows)""")
case("bi_funnel", m("product_views add_to_cart checkout_started payment_attempts orders_placed conversion_rate cart_abandonment_rate payment_failure_rate", "channel"),
     "channel:s product_views:i add_to_cart:i checkout_started:i payment_attempts:i orders_placed:i conversion_rate:m cart_abandonment_rate:m payment_failure_rate:m",
     f"""select channel, sum(product_views) as product_views, sum(add_to_cart) as add_to_cart, sum(checkout_started) as checkout_started, sum(payment_attempts) as payment_attempts,
         sum(orders_placed) as orders_placed, {q('sum(orders_placed)', 'sum(product_views)')} as conversion_rate, avg(cast(cart_abandonment_rate as double)) as cart_abandonment_rate,
         avg(cast(payment_failure_rate as double)) as payment_failure_rate from (select * replace (cast(cart_abandonment_rate as decimal(18,4)) as cart_abandonment_rate) from slice_funnel) group by 1""")
case("bi_leakage_adv", m("revenue_lost_cart_abandonment revenue_at_risk net_revenue_after_leakage"), "revenue_lost_cart_abandonment:m revenue_at_risk:m net_revenue_after_leakage:m2",
     "select lost as revenue_lost_cart_abandonment, risk as revenue_at_risk, fin_t.rev - (di + sh + rf + fe) - lost - risk as net_revenue_after_leakage from fin_t, exec_t, prod_t")
case("bi_rfm", lambda w: measures.rfm(Marts(w), ORDER_DAY), "customer_id:i recency_days:i frequency:i monetary:m",
     f"select customer_id, date '{ORDER_DAY}' - last_order_dt as recency_days, orders as frequency, revenue_ex_tax as monetary from segment_rows")
case("bi_churn_risk", lambda w: measures.churn_risk(Marts(w), ORDER_DAY), "churn_risk_customers:i",
     f"select count(*) as churn_risk_customers from segment_rows where orders >= 2 and last_order_dt < date '{ORDER_DAY}' - 60")
case("bi_product", m("product_revenue product_units_sold product_gross_profit return_rate", "category_l1 brand"),
     "category_l1:s brand:s product_revenue:m product_units_sold:i product_gross_profit:m return_rate:m",
     f"""select category_l1, brand, sum(revenue_ex_tax) as product_revenue, sum(units_sold) as product_units_sold, sum(gross_profit_ex_tax) as product_gross_profit,
         {q('sum(return_lines)', 'sum(units_sold)')} as return_rate from product_rows group by 1, 2""")
case("bi_pareto", lambda w: measures.pareto(Marts(w)), "product_id:i revenue:m revenue_rank:i cumulative:m cumulative_pct:m6 abc_class:s",
     f"""select *, case when cumulative_pct <= 0.8 then 'A' when cumulative_pct <= 0.95 then 'B' else 'C' end as abc_class from (
         select product_id, revenue, dense_rank() over (order by revenue desc) as revenue_rank, sum(revenue) over (order by revenue desc range unbounded preceding) as cumulative,
           {q('sum(revenue) over (order by revenue desc range unbounded preceding)', 'sum(revenue) over ()')} as cumulative_pct
         from (select product_id, sum(revenue_ex_tax) as revenue from product_rows group by 1))""")
case("bi_ops_refund_pct", m("refund_pct_of_revenue", "year"), "year:i refund_pct_of_revenue:m",
     f"""select year, {q('a', 'b')} as refund_pct_of_revenue from (select year(kpi_dt) as year, sum(refund_amount_return_dt) as a from exec_rows group by 1)
         left join (select year(order_dt) as year, sum(revenue_ex_tax) as b from finance_rows group by 1) using (year)""")
for _key, _norm, _div in (("bi_risk_index", False, "1.0"), ("bi_risk_index_normalized", True, "100.0")):
    case(_key, lambda w, n=_norm: measures.risk_index(Marts(w), normalize=n), "sla_breach_pct:m refund_pct_of_revenue:m payment_failure_rate:m risk_index:m",
         f"""select *, 100 * (0.4 * sla_breach_pct / {_div} + 0.3 * refund_pct_of_revenue + 0.3 * payment_failure_rate) as risk_index
             from (select sla as sla_breach_pct, {q('rf', 'rev')} as refund_pct_of_revenue, pf as payment_failure_rate from exec_t, fin_t, fun_t)""")

# ---------------------------------------------------------------- dashboards
case("dash_growth_drivers", dashboards.growth_drivers, "category_l1:s channel:s country:s level:i net_revenue:m",
     """select category_l1, channel, country, grouping(category_l1) * 4 + grouping(channel) * 2 + grouping(country) as level, sum(ex_tax) as net_revenue
        from lines_x join (select order_id, channel, country from done_orders join dim_geo using (geo_id)) using (order_id) group by rollup (category_l1, channel, country)""")
case("dash_moving_avg", lambda w: dashboards.moving_average(Marts(w)), "dt:d net_revenue:m ma_7:m ma_30:m",
     """select kpi_dt as dt, revenue_ex_tax as net_revenue, cast(sum(r) over (order by kpi_dt rows 6 preceding) as double) / count(*) over (order by kpi_dt rows 6 preceding) as ma_7,
        cast(sum(r) over (order by kpi_dt rows 29 preceding) as double) / count(*) over (order by kpi_dt rows 29 preceding) as ma_30
        from (select *, cast(revenue_ex_tax as decimal(24,2)) as r from exec_rows)""")


def _steps(pairs: str) -> str:
    return f"""select step, label, amount, sum(amount) over (order by step) as level from fin_t, exec_t, prod_t, lateral (values {pairs}) x(step, label, amount)"""


case("dash_waterfall", lambda w: dashboards.waterfall(Marts(w)), "step:i label:s amount:m2 level:m2",
     _steps("(1, 'net_revenue', cast(fin_t.rev as double)), (2, 'discount_amount', -di), (3, 'shipping_cost', -sh), (4, 'refund_amount', -rf), (5, 'gateway_fees', -fe)"))
case("dash_funnel_waterfall", lambda w: dashboards.funnel_waterfall(Marts(w)), "step:i label:s amount:m2 level:m2",
     _steps("(1, 'net_revenue', cast(fin_t.rev as double)), (2, 'revenue_lost_cart_abandonment', -lost), (3, 'revenue_at_risk', -risk), (4, 'refund_amount', -rf)"))
case("dash_funnel_breakdown", lambda w: dashboards.funnel_breakdown(Marts(w)), "channel:s device:s level:i product_views:i orders_placed:i conversion_rate:m",
     f"""select channel, device, grouping(channel) * 2 + grouping(device) as level, sum(product_views) as product_views, sum(orders_placed) as orders_placed,
         {q('sum(orders_placed)', 'sum(product_views)')} as conversion_rate from slice_funnel group by cube (channel, device)""")
case("dash_funnel_category", lambda w: dashboards.category_leakage(Marts(w)), "category_l1:s category_l2:s revenue_lost_cart_abandonment:m revenue_at_risk:m",
     "select category_l1, category_l2, sum(revenue_lost_cart_abandonment) as revenue_lost_cart_abandonment, sum(revenue_at_risk_ex_tax) as revenue_at_risk from product_rows group by 1, 2")
case("dash_rule_segments", lambda w: dashboards.rule_segments(Marts(w), ORDER_DAY), "customer_id:i labels:s first_label:s",
     f"""select customer_id, array_to_string(l, ',') as labels, l[1] as first_label from (select customer_id, list_filter([case when orders = 1 and gap <= 30 then 'New' end,
           case when orders >= 2 and gap <= 60 then 'Returning' end, case when orders >= 3 and value_quartile = 1 then 'Loyal' end, case when orders >= 2 and gap > 60 then 'Churn-risk' end,
           case when value_quartile = 1 and revenue_ex_tax > (select ltv from seg_t) then 'High-value' end], lambda x: x is not null) as l
         from (select *, date '{ORDER_DAY}' - last_order_dt as gap from segment_rows))""")
for _key, _by in (("dash_segment_counts", "lifecycle_segment value_quartile"), ("dash_geo", "region country"), ("dash_acquisition", "acquisition_channel")):
    _c = ", ".join(_by.split())
    case(_key, lambda w, b=_by: dashboards.segment_counts(Marts(w), b.split()),
         " ".join(f"{c}:{'i' if c == 'value_quartile' else 's'}" for c in _by.split()) + " customers:i revenue_ex_tax:m net_profit_ex_tax:m",
         f"select {_c}, count(*) as customers, sum(revenue_ex_tax) as revenue_ex_tax, sum(net_profit_ex_tax) as net_profit_ex_tax from segment_rows group by {_c}")
_L2 = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
case("dash_heatmap", lambda w: dashboards.heatmap(Marts(w), _L2), "category_l1:s " + " ".join(f"{c}:m" for c in _L2),
     "select category_l1, " + ", ".join(f"coalesce(sum(revenue_ex_tax) filter (category_l2 = '{c}'), 0) as {c}" for c in _L2) + " from product_rows group by 1")
case("dash_heatmap_long", lambda w: dashboards.heatmap_long(Marts(w)), "category_l1:s category_l2:s revenue_ex_tax:m",
     "select category_l1, category_l2, sum(revenue_ex_tax) as revenue_ex_tax from product_rows group by all")
case("dash_dead_stock", lambda w: dashboards.dead_stock(Marts(w), w, 25), "product_id:i product_name:s units_sold:i revenue_ex_tax:m",
     """select product_id, any_value(p.product_name) as product_name, coalesce(sum(units_sold), 0) as units_sold, coalesce(sum(revenue_ex_tax), 0) as revenue_ex_tax
        from dim_product p left join product_rows using (product_id) group by 1 order by 3, 1 limit 25""")
case("dash_return_rate", lambda w: dashboards.high_return_rate(Marts(w), 25), "product_id:i return_lines:i units_sold:i return_rate:m",
     f"""select product_id, sum(return_lines) as return_lines, sum(units_sold) as units_sold, {q('sum(return_lines)', 'sum(units_sold)')} as return_rate
         from product_rows group by 1 order by 4 desc nulls last, 1 limit 25""")
FRAGMENTS["fc_sla"] = f"select fc_id, fc_name, count(*) as shipments, {exact('count(*) filter (sla_breached_flag)', 'count(*)', 2)} as sla_breach_pct from fact_shipments join dim_fc using (fc_id) group by 1, 2"
case("dash_sla_by_fc", dashboards.sla_by_fc, "fc_id:i fc_name:s shipments:i sla_breach_pct:m", "from fc_sla")
case("dash_shipping_matrix", dashboards.shipping_matrix, "fc_name:s from_region:s to_region:s shipments:i shipping_cost:m",
     """select fc_name, a.region as from_region, b.region as to_region, count(*) as shipments, sum(shipping_cost) as shipping_cost
        from fact_shipments join (select order_id, geo_id as to_geo from fact_orders) using (order_id) join dim_fc f using (fc_id)
        join dim_geo a on a.geo_id = f.geo_id join dim_geo b on b.geo_id = to_geo group by 1, 2, 3""")
case("dash_failures_by", dashboards.failures_by, "dimension:s value:s failed_payments:i amount:m",
     " union all ".join(f"select '{d}' as dimension, {d} as value, count(*) as failed_payments, sum(amount) as amount from fact_payments where payment_status in {BAD_PAY} group by 2"
                        for d in ("payment_method", "payment_provider", "failure_reason")))
case("dash_alerts", dashboards.alerts, "alert:s subject:s value:m threshold:m",
     f"""select 'SLA_CARRIER' as alert, carrier as subject, {exact('count(*) filter (sla_breached_flag)', 'count(*)', 2)} as value, 8 as threshold from fact_shipments group by 2 having value > 8
         union all select 'SLA_FC', fc_name, sla_breach_pct, 8 from fc_sla where sla_breach_pct > 8
         union all select 'PAYMENT_FAILURE', payment_method, {exact(f'count(*) filter (payment_status in {BAD_PAY})', 'count(*)', 2)} as value, 4 from fact_payments group by 2 having value > 4
         union all select 'RETURN_RATE', category_l1, {exact('n', 'u', 2)} as value, 6 from (select category_l1, sum(qty) as u from lines_x group by 1)
           join (select category_l1, count(*) as n from fact_returns join dim_product using (product_id) group by 1) using (category_l1) where value > 6""")
for _key, _by in (("dash_margin_by_channel", "channel"), ("dash_margin_by_region", "region")):
    case(_key, lambda w, b=_by: dashboards.margin_by(Marts(w), [b]), f"{_by}:s net_revenue:m net_profit:m net_margin:m",
         f"""select {_by}, sum(revenue_ex_tax) as net_revenue, sum(net_profit_ex_tax) as net_profit, {q('sum(net_profit_ex_tax)', 'sum(revenue_ex_tax)')} as net_margin
             from finance_rows join dim_geo using (geo_id) group by 1""")
case("dash_margin_by", lambda w: dashboards.discount_heavy_products(w), "product_id:i lines:i heavy_lines:i heavy_pct:m",
     f"""select product_id, count(*) as lines, count(*) filter (discount_heavy_flag) as heavy_lines, {exact('count(*) filter (discount_heavy_flag)', 'count(*)', 4)} as heavy_pct
         from item_pnl_rows group by 1 order by 4 desc, 1 limit 20""")
case("dash_refund_trend", dashboards.refund_trend, "dt:d refund_amount:m return_lines:i",
     "select cast(return_ts as date) as dt, sum(refund_amount) as refund_amount, count(*) as return_lines from fact_returns group by 1")

