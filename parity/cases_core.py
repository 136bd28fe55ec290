"""Views, KPI pack, funnel, finance, marts and customer analytics."""

from __future__ import annotations

from ledgerloom.operators import finance, forecast, funnel, kpis, marts, segments, views
from parity.registry import EVENT_DAY, FRAGMENTS, ORDER_DAY, case

DONE = "('PLACED', 'DELIVERED', 'COMPLETED', 'RETURNED')"
BAD_PAY = "('FAILED', 'DECLINED')"


def exact(num: str, den: str, scale: int, factor: str = "100.0") -> str:
    """factor*num/den in SQL, rounded half-up, NULL for a zero denominator."""
    return f"round(cast(cast({factor} as double) * cast({num} as double) / nullif(cast({den} as double), 0) as decimal(38,{scale + 6})), {scale})"


def exact0(num: str, den: str, scale: int, factor: str = "100.0") -> str:
    return f"case when {den} > 0 then {exact(num, den, scale, factor)} else 0 end"


# ---------------------------------------------------------------- views
FRAGMENTS["done_orders"] = f"select *, cast(order_ts as date) as order_dt from fact_orders where order_status in {DONE}"
FRAGMENTS["lines_x"] = """select i.*, p.category_l1, p.category_l2, p.brand, p.product_name, i.qty * i.unit_cost as line_cogs,
  i.line_net_revenue - i.qty * i.unit_cost as line_gross_profit, i.qty * i.unit_sell_price as ex_tax
  from fact_order_items i, dim_product p where i.product_id = p.product_id"""

case("vw_orders_core", views.orders_core,
     "order_id:i customer_id:i geo_id:i order_ts:t order_dt:d order_status:s channel:s currency:s gross_amount:m discount_amount:m tax_amount:m net_amount:m",
     "select *, cast(order_ts as date) as order_dt from fact_orders")
case("vw_orders_completed", views.orders_completed,
     "order_id:i customer_id:i geo_id:i order_ts:t order_dt:d order_status:s channel:s currency:s gross_amount:m discount_amount:m tax_amount:m net_amount:m",
     "from done_orders")
case("vw_item_profitability", views.item_profitability,
     "order_item_id:i order_id:i product_id:i category_l1:s category_l2:s brand:s qty:i unit_sell_price:m unit_cost:m line_discount:m line_tax:m "
     "line_net_revenue:m line_cogs:m line_gross_profit:m", "from lines_x")
case("vw_sla", views.sla,
     "shipment_id:i order_id:i fc_id:i fc_name:s carrier:s shipped_ts:t promised_delivery_dt:d delivered_dt:d shipping_cost:m sla_breached_flag:b",
     "select s.*, f.fc_name from fact_shipments s, dim_fc f where f.fc_id = s.fc_id")
case("vw_returns_enriched", views.returns_enriched,
     "return_id:i order_id:i order_item_id:i product_id:i category_l1:s category_l2:s return_ts:t return_dt:d return_reason:s refund_amount:m return_status:s restocked_flag:b",
     "select r.*, cast(return_ts as date) as return_dt, category_l1, category_l2 from fact_returns r join dim_product using (product_id)")

_KIND = {
    "order_ts": "t", "shipped_ts": "t", "created_at": "t", "delivered_dt": "d", "authorized_ts": "t", "captured_ts": "t", "snapshot_ts": "t",
    "net_amount": "m", "unit_cost": "m", "list_price": "m", "amount": "m", "refund_amount": "m", "gateway_fee_amount": "m", "metric_value": "m",
    "chargeback_flag": "b", "qty": "i",
}


def _shape(cols: str) -> str:
    return " ".join(f"{c}:{_KIND.get(c, 'i' if c.endswith('_id') else 's')}" for c in cols.split())


for _view, (_table, _cols) in views.PROJECTIONS.items():
    if _table != "kpi_snapshots":
        case(_view, lambda w, v=_view: views.projection(w, v), _shape(_cols), f"select {', '.join(_cols.split())} from {_table}")
case("vw_customer_order_items", views.customer_order_items, "order_id:i product_id:i product_name:s qty:i", "from lines_x")

# ---------------------------------------------------------------- KPI pack
case("kpi_01_monthly_revenue", kpis.monthly_revenue, "month:d orders:i net_revenue:m",
     "select date_trunc('month', order_dt) as month, count(distinct order_id) as orders, sum(net_amount) as net_revenue from done_orders group by all")
case("kpi_02_mom_growth", kpis.mom_growth, "month:d net_revenue:m mom_growth_pct:m",
     f"""select month, net_revenue, {exact('net_revenue - before', 'before', 2)} as mom_growth_pct from (
       select *, lag(net_revenue) over (order by month) as before from (
         select date_trunc('month', order_dt) as month, sum(net_amount) as net_revenue from done_orders group by 1))""")
case("kpi_03_rolling_7d", kpis.rolling_7d, "dt:d rev:m rolling_7d_rev:m",
     """select dt, rev, sum(rev) over (order by dt rows 6 preceding) as rolling_7d_rev
        from (select order_dt as dt, sum(net_amount) as rev from done_orders group by 1)""")
for _key, _best in (("kpi_04_top_products", True), ("kpi_05_bottom_products", False)):
    case(_key, lambda w, b=_best: kpis.top_products(w, best=b), "product_id:i product_name:s revenue:m",
         f"""select product_id, any_value(product_name) as product_name, sum(line_net_revenue) as revenue from lines_x
             group by product_id order by revenue {'desc' if _best else 'asc'}, product_id limit 10""")
case("kpi_06_category_margin", kpis.category_margin, "category_l1:s revenue:m cogs:m gross_profit:m gross_margin_pct:m",
     f"""select category_l1, sum(line_net_revenue) as revenue, sum(line_cogs) as cogs, sum(line_gross_profit) as gross_profit,
         {exact('sum(line_gross_profit)', 'sum(line_net_revenue)', 2)} as gross_margin_pct from lines_x group by category_l1""")
case("kpi_07_category_discount", kpis.category_discount, "category_l1:s total_discount:m gross_sales_before_discount:m discount_pct:m",
     f"""select category_l1, sum(line_discount) as total_discount, sum(line_net_revenue + line_discount) as gross_sales_before_discount,
         {exact('sum(line_discount)', 'sum(line_net_revenue + line_discount)', 2)} as discount_pct from lines_x group by category_l1""")
case("kpi_08_active_customers", kpis.active_customers, "month:d active_customers:i",
     "select date_trunc('month', order_dt) as month, count(distinct customer_id) as active_customers from done_orders group by 1")
case("kpi_09_repeat_pct", kpis.repeat_pct, "repeat_customer_pct:m",
     f"""select {exact('count(*) filter (n > 1)', 'count(*)', 2)} as repeat_customer_pct
         from (select customer_id, count(*) as n from done_orders group by customer_id)""")
FRAGMENTS["last_seen"] = "select customer_id, max(order_ts) as last_order_ts from done_orders group by customer_id"
case("kpi_10_churned", lambda w: kpis.churned(w, ORDER_DAY), "churned_customers:i",
     f"select count(*) as churned_customers from last_seen where last_order_ts < date '{ORDER_DAY}' - interval 90 day")
FRAGMENTS["cohorts"] = """select cohort_month, cast(datediff('month', cohort_month, active_month) as int) as months_since_cohort, count(*) as customers from (
  select distinct customer_id, date_trunc('month', order_dt) as active_month,
    date_trunc('month', min(order_dt) over (partition by customer_id)) as cohort_month from done_orders) group by all"""
case("kpi_11_cohort_retention", kpis.cohort_retention, "cohort_month:d months_since_cohort:i customers:i", "from cohorts")
case("kpi_12_sla_by_carrier", kpis.sla_by_carrier, "carrier:s shipments:i sla_breach_pct:m",
     f"select carrier, count(*) as shipments, {exact('sum(cast(sla_breached_flag as int))', 'count(*)', 2)} as sla_breach_pct from fact_shipments group by 1")
case("kpi_13_shipping_pct", kpis.shipping_pct, "shipping_cost_pct_of_revenue:m",
     f"select {exact('sum(s.shipping_cost)', 'sum(o.net_amount)', 2)} as shipping_cost_pct_of_revenue from fact_shipments s, done_orders o where o.order_id = s.order_id")
case("kpi_14_return_rate", kpis.return_rate, "category_l1:s sold_qty:i return_lines:i return_rate_proxy_pct:m",
     f"""select category_l1, sold_qty, coalesce(n, 0) as return_lines, {exact('coalesce(n, 0)', 'sold_qty', 2)} as return_rate_proxy_pct
         from (select category_l1, sum(qty) as sold_qty from lines_x group by 1)
         left join (select category_l1, count(*) as n from fact_returns join dim_product using (product_id) group by 1) using (category_l1)""")
case("kpi_15_return_reasons", kpis.return_reasons, "return_reason:s returns:i",
     "select return_reason, count(*) as returns from fact_returns group by 1 order by 2 desc, 1 limit 10")
case("kpi_16_monthly_refunds", kpis.monthly_refunds, "month:d total_refunds:m",
     "select date_trunc('month', return_ts) as month, sum(refund_amount) as total_refunds from fact_returns group by 1")
case("kpi_17_payment_failure", kpis.payment_failure, "payment_method:s total_attempts:i failure_pct:m",
     f"select payment_method, count(*) as total_attempts, {exact(f'count(*) filter (payment_status in {BAD_PAY})', 'count(*)', 2)} as failure_pct from fact_payments group by 1")
case("kpi_18_chargeback", kpis.chargeback, "chargeback_pct:m",
     f"select {exact('count(*) filter (chargeback_flag)', 'count(*)', 3)} as chargeback_pct from fact_payments")
case("kpi_19_top3_per_category", kpis.top3_per_category, "category_l1:s product_id:i product_name:s revenue:m rnk:i",
     """select *, dense_rank() over (partition by category_l1 order by revenue desc) as rnk from (
          select category_l1, product_id, any_value(product_name) as product_name, sum(line_net_revenue) as revenue from lines_x group by category_l1, product_id)
        qualify rnk < 4""")
case("kpi_20_leakage_breakdown", kpis.leakage_breakdown, "net_rev:m discounts:m shipping_cost:m refunds:m leakage_total:m",
     """select *, discounts + shipping_cost + refunds as leakage_total from (select (select sum(net_amount) from done_orders) as net_rev,
        (select sum(discount_amount) from done_orders) as discounts, (select sum(shipping_cost) from fact_shipments) as shipping_cost,
        (select sum(refund_amount) from fact_returns) as refunds)""")

# ---------------------------------------------------------------- funnel
_RATES = f"""{exact0('orders_placed', 'product_views', 4, '1.0')} as conversion_rate,
  {exact0('(add_to_cart - checkout_started)', 'add_to_cart', 4, '1.0')} as cart_abandonment_rate,
  {exact0('failed_sessions', 'payment_attempts', 4, '1.0')} as payment_failure_rate"""
_COUNTS = """count(*) filter (viewed) as product_views, count(*) filter (added) as add_to_cart, count(*) filter (checkout) as checkout_started,
  count(*) filter (pay_attempt) as payment_attempts, count(*) filter (ordered) as orders_placed, count(*) filter (pay_failed) as failed_sessions"""


def _flags(keys: str, source: str = "fact_funnel_events") -> str:
    stage = {"viewed": "VIEW_PRODUCT", "added": "ADD_TO_CART", "checkout": "CHECKOUT_STARTED", "pay_attempt": "PAYMENT_ATTEMPTED",
             "pay_failed": "PAYMENT_FAILED", "ordered": "ORDER_PLACED"}
    flags = ", ".join(f"list_contains(list(stage), '{s}') as {f}" for f, s in stage.items())
    return f"select {keys}, session_id, {flags} from {source} group by all"


FRAGMENTS["day_flags"] = _flags("cast(event_ts as date) as event_dt")
FRAGMENTS["session_sum"] = _flags("0 as k")
FRAGMENTS["day_funnel"] = f"select *, {_RATES} from (select event_dt, {_COUNTS} from day_flags group by event_dt)"
FRAGMENTS["price_ratio"] = """select coalesce(cast(sum(cast(cast(unit_sell_price as double) / nullif(cast(unit_list_price as double), 0) as decimal(18,12))) as double)
  / count(nullif(unit_list_price, 0)), 0.88) as ratio from fact_order_items"""


def _leak(ev: str = "", od: str = "", rt: str = "") -> str:
    """The leakage row, with optional extra conditions on events, orders and returns."""
    return f"""select *, net_revenue_ex_tax - refunds_leakage - revenue_lost_cart_abandonment - revenue_lost_payment_failures as net_revenue_after_leakage from (select
      (select coalesce(sum(net_amount - tax_amount), 0) from done_orders where true {od}) as net_revenue_ex_tax,
      (select coalesce(sum(refund_amount), 0) from fact_returns where true {rt}) as refunds_leakage,
      (select coalesce(sum(qty * unit_sell_price), 0) from fact_order_items where order_id in
         (select order_id from fact_funnel_events where stage = 'PAYMENT_FAILED' {ev})) as revenue_lost_payment_failures,
      (select round(cast(cast(coalesce(sum(list_price), 0) as double) * (select ratio from price_ratio) as decimal(38,12)), 6) from (select distinct session_id, product_id from fact_funnel_events
         where stage = 'ADD_TO_CART' {ev} and session_id not in (select session_id from fact_funnel_events where stage = 'ORDER_PLACED' {ev}))
         join dim_product using (product_id)) as revenue_lost_cart_abandonment)"""


_DAILY = "event_dt:d product_views:i add_to_cart:i checkout_started:i payment_attempts:i orders_placed:i conversion_rate:m cart_abandonment_rate:m payment_failure_rate:m"
_LEAK = "net_revenue_ex_tax:m revenue_lost_cart_abandonment:m revenue_lost_payment_failures:m refunds_leakage:m net_revenue_after_leakage:m"
case("fn_session_flags", funnel.daily_session_flags, "event_dt:d session_id:s viewed:b added:b checkout:b pay_attempt:b pay_failed:b ordered:b", "from day_flags")
case("fn_daily_metrics", funnel.daily_metrics, _DAILY, "from day_funnel")
case("fn_sell_ratio", funnel.sell_ratio, "sell_ratio:m8", "select ratio as sell_ratio from price_ratio")
case("fn_abandoned_sessions", lambda w: funnel.abandoned_sessions(w["fact_funnel_events"]), "session_id:s", "select session_id from session_sum where added and not ordered")
case("fn_abandoned_products", lambda w: funnel.abandoned_products(w["fact_funnel_events"]), "session_id:s product_id:i",
     "select distinct session_id, product_id from fact_funnel_events where stage = 'ADD_TO_CART' and session_id in (select session_id from session_sum where not ordered)")
case("fn_failed_orders", lambda w: funnel.failed_orders(w["fact_funnel_events"]), "order_id:i",
     "select distinct order_id from fact_funnel_events where stage = 'PAYMENT_FAILED' and order_id is not null")
case("fn_revenue_leakage", funnel.revenue_leakage, _LEAK, _leak())
FRAGMENTS["product_leak"] = """select v.*, coalesce(f.failed_orders, 0) as failed_orders, coalesce(f.money, 0) as revenue_lost_payment_failures,
    round(cast(cast(abandoned_adds * list_price as double) * ratio as decimal(38,8)), 2) as revenue_lost_cart_abandonment
  from (select product_id, any_value(product_name) as product_name, any_value(list_price) as list_price, count(distinct case when stage = 'VIEW_PRODUCT' then session_id end) as product_views,
      count(distinct case when stage = 'ADD_TO_CART' then session_id end) as add_to_cart,
      count(distinct case when stage = 'ADD_TO_CART' and not s.ordered then session_id end) as abandoned_adds
    from fact_funnel_events join session_sum s using (session_id) join dim_product using (product_id) group by product_id) v
  left join (select product_id, count(distinct order_id) as failed_orders, sum(qty * unit_sell_price) as money from fact_order_items
    where order_id in (select order_id from fact_funnel_events where stage = 'PAYMENT_FAILED') group by product_id) f using (product_id), price_ratio"""
_PL = "product_id:i product_name:s product_views:i add_to_cart:i abandoned_adds:i revenue_lost_cart_abandonment:m failed_orders:i revenue_lost_payment_failures:m"
case("fn_product_leakage", funnel.product_leakage, _PL, "from product_leak")
FRAGMENTS["bad_payments"] = f"""select cast(coalesce(p.authorized_ts, p.created_at) as date) as event_dt, payment_method, payment_provider, failure_reason,
    count(*) as failed_payments, sum(p.amount) as amount_attempted, coalesce(sum(i.qty * i.unit_sell_price), 0) as revenue_at_risk_ex_tax
  from fact_payments p left join fact_order_items i using (order_id) where payment_status in {BAD_PAY} group by 1, 2, 3, 4"""
_PF = "event_dt:d payment_method:s payment_provider:s failure_reason:s failed_payments:i amount_attempted:m revenue_at_risk_ex_tax:m"
case("fn_payment_failures", funnel.payment_failures, _PF, "from bad_payments")
case("fn_payment_failures_dedup", lambda w: funnel.payment_failures(w, dedup=True), _PF,
     f"""select cast(coalesce(p.authorized_ts, p.created_at) as date) as event_dt, payment_method, payment_provider, failure_reason,
           count(*) as failed_payments, sum(amount) as amount_attempted, coalesce(sum(money), 0) as revenue_at_risk_ex_tax
         from fact_payments p left join (select order_id, sum(qty * unit_sell_price) as money from fact_order_items group by 1) using (order_id)
         where payment_status in {BAD_PAY} group by 1, 2, 3, 4""")
_EV = f"and event_ts >= timestamp '{EVENT_DAY}' - interval 20 day"
case("fn_summary_window", lambda w: funnel.summary_window(w, EVENT_DAY, 20),
     _DAILY.split(" ", 1)[1] + " " + _LEAK,
     f"""select * from (select *, {_RATES} from (select {_COUNTS} from ({_flags('0 as k', f"(from fact_funnel_events where true {_EV})")}))),
         ({_leak(_EV, _EV.replace('event_ts', 'order_ts'), _EV.replace('event_ts', 'return_ts'))})""")
case("fn_daily_window", lambda w: funnel.daily_window(w, EVENT_DAY, 14), _DAILY, f"from day_funnel where event_dt >= date '{EVENT_DAY}' - 14")
case("fn_product_leakage_topn", lambda w: funnel.product_leakage_topn(w, 25, 5), _PL,
     "from product_leak order by revenue_lost_cart_abandonment + revenue_lost_payment_failures desc, product_id limit 25 offset 5")
case("fn_payment_failures_topn", lambda w: funnel.payment_failures_topn(w, ORDER_DAY, 365, 50), _PF,
     f"""from bad_payments where event_dt >= date '{ORDER_DAY}' - 365
         order by failed_payments desc, event_dt, payment_method, payment_provider, failure_reason limit 50""")
FRAGMENTS["slice_funnel"] = f"""select *, {_RATES}, cast(strftime(event_dt, '%Y%m%d') as int) as date_id from (select event_dt, channel, device, {_COUNTS} from (
  {_flags("cast(event_ts as date) as event_dt, coalesce(channel, 'WEB') as channel, coalesce(device, 'DESKTOP') as device")}) group by 1, 2, 3)"""
_STAGES = "('product_views', product_views), ('add_to_cart', add_to_cart), ('checkout_started', checkout_started), ('payment_attempts', payment_attempts), ('orders_placed', orders_placed)"
_SUMMED = f"""select sum(product_views) as product_views, sum(add_to_cart) as add_to_cart, sum(checkout_started) as checkout_started,
  sum(payment_attempts) as payment_attempts, sum(orders_placed) as orders_placed from slice_funnel where event_dt >= date '{EVENT_DAY}' - 30"""
case("fn_stage_totals", lambda w: funnel.stage_totals(marts.funnel_conversion(w), EVENT_DAY), "stage:s sessions:i",
     f"select stage, sessions from ({_SUMMED}) s, lateral (values {_STAGES}) v(stage, sessions)")
case("fn_stage_pct", lambda w: funnel.stage_pct(marts.funnel_conversion(w), EVENT_DAY), "stage:s sessions:i pct_of_base:m",
     f"""select stage, sessions, round(cast(greatest(0, least(100, cast(100 * sessions as double) / product_views)) as decimal(38,10)), 4) as pct_of_base
         from ({_SUMMED}) s, lateral (values {_STAGES}) v(stage, sessions)""")

# ---------------------------------------------------------------- finance
FRAGMENTS["pnl_sums"] = f"""select o.*, coalesce(rev, 0) as revenue_ex_tax, coalesce(cost, 0) as cogs, coalesce(disc, 0) as line_disc, coalesce(tax, 0) as line_taxes,
    coalesce(ship, 0) as shipping_cost, coalesce(fee, 0) as gateway_fee_amount, coalesce(back, 0) as refund_amount, coalesce(late, false) as sla_breached_flag
  from done_orders o
  left join (select order_id, sum(qty * unit_sell_price) as rev, sum(qty * unit_cost) as cost, sum(line_discount) as disc, sum(line_tax) as tax from fact_order_items group by 1) using (order_id)
  left join (select order_id, sum(shipping_cost) as ship, bool_or(sla_breached_flag) as late from fact_shipments group by 1) using (order_id)
  left join (select order_id, sum(gateway_fee_amount) filter (payment_status not in {BAD_PAY}) as fee from fact_payments group by 1) using (order_id)
  left join (select order_id, sum(refund_amount) as back from fact_returns group by 1) using (order_id)"""
FRAGMENTS["pnl"] = f"""select order_id, customer_id, geo_id, order_ts, order_dt, order_status, channel, currency, revenue_ex_tax, line_disc as discount_amount,
    line_taxes as tax_amount, cogs, shipping_cost, gateway_fee_amount, refund_amount, sla_breached_flag,
    revenue_ex_tax - cogs as gross_profit_ex_tax, revenue_ex_tax - cogs - shipping_cost - gateway_fee_amount - refund_amount as net_profit_ex_tax,
    {exact0('(revenue_ex_tax - cogs)', 'revenue_ex_tax', 4)} as gross_margin_pct,
    {exact0('(revenue_ex_tax - cogs - shipping_cost - gateway_fee_amount - refund_amount)', 'revenue_ex_tax', 4)} as net_margin_pct,
    refund_amount > 0 as has_return_flag, revenue_ex_tax > 0 and coalesce(cast(line_disc as double) / nullif(cast(revenue_ex_tax + line_disc as double), 0), 0) > 0.30 as discount_heavy_flag,
    revenue_ex_tax - cogs - shipping_cost - gateway_fee_amount - refund_amount < 0 as loss_order_flag from pnl_sums"""
_MONEY = "revenue_ex_tax:m cogs:m shipping_cost:m gateway_fee_amount:m refund_amount:m gross_profit_ex_tax:m net_profit_ex_tax:m"
_PNL = ("order_id:i customer_id:i geo_id:i order_ts:t order_dt:d order_status:s channel:s currency:s discount_amount:m tax_amount:m " + _MONEY +
        " gross_margin_pct:m net_margin_pct:m sla_breached_flag:b has_return_flag:b discount_heavy_flag:b loss_order_flag:b")
case("fin_order_pnl", finance.order_pnl, _PNL, "from pnl")


def _item_sql(dedup: bool) -> str:
    if dedup:
        costs = "select order_id, shipping_cost as ship, gateway_fee_amount as fee from pnl"
        back = "(select order_item_id, sum(refund_amount) as refund_amount from fact_returns group by 1)"
    else:
        costs = f"""select o.order_id, coalesce(sum(s.shipping_cost), 0) as ship, coalesce(sum(p.gateway_fee_amount) filter (p.payment_status not in {BAD_PAY}), 0) as fee
          from done_orders o left join fact_shipments s using (order_id) left join fact_payments p using (order_id) left join fact_returns r using (order_id) group by 1"""
        back = "fact_returns"
    return f"""select *, ex_tax as line_revenue_ex_tax, ex_tax - line_cogs as line_gross_profit_ex_tax,
      round(cast(a_ship as decimal(38,8)), 2) as alloc_shipping_cost, round(cast(a_fee as decimal(38,8)), 2) as alloc_gateway_fee,
      cast(cast(ex_tax - line_cogs as double) - a_ship - a_fee - cast(line_refund_amount as double) as decimal(38,12)) as line_net_profit_ex_tax,
      line_refund_amount > 0 as return_leakage_flag,
      ex_tax > 0 and coalesce(cast(line_discount as double) / nullif(cast(ex_tax + line_discount as double), 0), 0) > 0.30 as discount_heavy_flag
    from (select l.*, coalesce(r.refund_amount, 0) as line_refund_amount,
        case when t.total > 0 then cast(c.ship as double) * (cast(ex_tax as double) / cast(t.total as double)) else 0.0 end as a_ship,
        case when t.total > 0 then cast(c.fee as double) * (cast(ex_tax as double) / cast(t.total as double)) else 0.0 end as a_fee
      from lines_x l join ({costs}) c using (order_id) join (select order_id, sum(ex_tax) as total from lines_x group by 1) t using (order_id)
      left join {back} r using (order_item_id))"""


FRAGMENTS["item_pnl_rows"] = _item_sql(False)
FRAGMENTS["item_pnl_once"] = _item_sql(True)
_ITEM = ("order_item_id:i order_id:i product_id:i category_l1:s category_l2:s brand:s qty:i unit_list_price:m unit_sell_price:m unit_cost:m line_discount:m line_tax:m "
         "line_revenue_ex_tax:m line_cogs:m line_gross_profit_ex_tax:m line_refund_amount:m alloc_shipping_cost:m alloc_gateway_fee:m line_net_profit_ex_tax:m return_leakage_flag:b discount_heavy_flag:b")
case("fin_item_pnl", finance.item_pnl, _ITEM, "from item_pnl_rows")
case("fin_item_pnl_dedup", lambda w: finance.item_pnl(w, dedup=True), _ITEM, "from item_pnl_once")
FRAGMENTS["product_pnl_rows"] = f"""select *, {exact0('net_profit_ex_tax', 'revenue_ex_tax', 4)} as net_margin_pct, net_profit_ex_tax < 0 as loss_product_flag from (
  select product_id, any_value(product_name) as product_name, category_l1, category_l2, brand, sum(line_revenue_ex_tax) as revenue_ex_tax, sum(line_cogs) as cogs, sum(line_gross_profit_ex_tax) as gross_profit_ex_tax,
    sum(alloc_shipping_cost) as shipping_cost, sum(alloc_gateway_fee) as gateway_fee_amount, sum(line_refund_amount) as refund_amount, sum(line_net_profit_ex_tax) as net_profit_ex_tax
  from item_pnl_rows group by product_id, category_l1, category_l2, brand)"""
case("fin_product_pnl", finance.product_pnl, "product_id:i category_l1:s category_l2:s brand:s " + _MONEY + " net_margin_pct:m loss_product_flag:b", "from product_pnl_rows")
_SUM7 = ", ".join(f"sum({c}) as {c}" for c in finance.SUMS)
FRAGMENTS["customer_pnl_rows"] = f"""select *, {exact0('net_profit_ex_tax', 'revenue_ex_tax', 4)} as net_margin_pct, net_profit_ex_tax < 0 as loss_customer_flag from (
  select customer_id, acquisition_channel, region, country, count(distinct order_id) as orders, {_SUM7}
  from (select * exclude (geo_id) from pnl) join dim_customer using (customer_id) join dim_geo using (geo_id) group by all)"""
case("fin_customer_pnl", finance.customer_pnl, "customer_id:i acquisition_channel:s region:s country:s orders:i " + _MONEY + " net_margin_pct:m loss_customer_flag:b", "from customer_pnl_rows")
case("fin_summary", finance.summary,
     "orders:i " + _MONEY + " loss_orders:i discount_heavy_orders:i return_orders:i sla_breached_orders:i gross_margin_pct:m net_margin_pct:m",
     f"""select *, {exact0('gross_profit_ex_tax', 'revenue_ex_tax', 4)} as gross_margin_pct, {exact0('net_profit_ex_tax', 'revenue_ex_tax', 4)} as net_margin_pct from (
         select count(*) as orders, {_SUM7}, count(*) filter (loss_order_flag) as loss_orders, count(*) filter (discount_heavy_flag) as discount_heavy_orders,
           count(*) filter (has_return_flag) as return_orders, count(*) filter (sla_breached_flag) as sla_breached_orders from pnl)""")
case("fin_loss_orders", lambda w: finance.loss_orders(w, 100, 10),
     "order_id:i customer_id:i order_ts:t order_status:s " + _MONEY + " discount_amount:m loss_order_flag:b discount_heavy_flag:b has_return_flag:b sla_breached_flag:b",
     "from pnl where loss_order_flag order by net_profit_ex_tax, order_id limit 100 offset 10")
case("fin_top_products", finance.top_products,
     "product_id:i product_name:s category_l1:s category_l2:s brand:s revenue_ex_tax:m net_profit_ex_tax:m net_margin_pct:m loss_product_flag:b",
     "from product_pnl_rows order by net_profit_ex_tax desc, product_id limit 50")
case("fin_top_customers", finance.top_customers,
     "customer_id:i acquisition_channel:s region:s country:s orders:i revenue_ex_tax:m net_profit_ex_tax:m net_margin_pct:m loss_customer_flag:b",
     "from customer_pnl_rows order by net_profit_ex_tax desc, customer_id limit 50")

# ---------------------------------------------------------------- marts
FRAGMENTS["exec_rows"] = f"""select md5(cast(date_id as varchar)) as exec_daily_sk, date_id, date_value as kpi_dt, coalesce(s.orders, 0) as orders, coalesce(active_customers, 0) as active_customers,
    coalesce(rev, 0) as revenue_ex_tax, coalesce(cogs, 0) as cogs, coalesce(gp, 0) as gross_profit_ex_tax, coalesce(np, 0) as net_profit_ex_tax,
    {exact0('coalesce(gp, 0)', 'coalesce(rev, 0)', 4)} as gross_margin_pct, {exact0('coalesce(np, 0)', 'coalesce(rev, 0)', 4)} as net_margin_pct,
    {exact0('coalesce(rev, 0)', 'coalesce(s.orders, 0)', 2, '1.0')} as aov_ex_tax, coalesce(disc, 0) as discount_amount, coalesce(ship, 0) as shipping_cost_attrib,
    coalesce(fee, 0) as gateway_fee_amount, coalesce(back, 0) as refund_amount_order_attrib, coalesce(return_lines, 0) as return_lines, coalesce(rback, 0) as refund_amount_return_dt,
    coalesce(shipments, 0) as shipments, {exact0('coalesce(breaches, 0)', 'coalesce(shipments, 0)', 4)} as sla_breach_pct,
    coalesce(product_views, 0) as funnel_product_views, coalesce(add_to_cart, 0) as funnel_add_to_cart, coalesce(checkout_started, 0) as funnel_checkout_started,
    coalesce(payment_attempts, 0) as funnel_payment_attempts, coalesce(orders_placed, 0) as funnel_orders_placed, coalesce(conversion_rate, 0) as funnel_conversion_rate,
    coalesce(cart_abandonment_rate, 0) as funnel_cart_abandonment_rate, coalesce(payment_failure_rate, 0) as funnel_payment_failure_rate
  from (select date_id, date_value from dim_date where date_value between
      (select min(d) from (select cast(order_ts as date) as d from fact_orders union all select cast(event_ts as date) from fact_funnel_events
        union all select cast(return_ts as date) from fact_returns union all select cast(coalesce(shipped_ts, created_at) as date) from fact_shipments))
      and (select max(d) from (select cast(order_ts as date) as d from fact_orders union all select cast(event_ts as date) from fact_funnel_events
        union all select cast(return_ts as date) from fact_returns union all select cast(coalesce(shipped_ts, created_at) as date) from fact_shipments))) dd
  left join (select order_dt, count(*) as orders, count(distinct customer_id) as active_customers, sum(revenue_ex_tax) as rev, sum(cogs) as cogs, sum(gross_profit_ex_tax) as gp,
      sum(net_profit_ex_tax) as np, sum(discount_amount) as disc, sum(shipping_cost) as ship, sum(gateway_fee_amount) as fee, sum(refund_amount) as back from pnl group by 1) s on s.order_dt = date_value
  left join (select cast(return_ts as date) as rd, count(*) as return_lines, sum(refund_amount) as rback from fact_returns group by 1) on rd = date_value
  left join (select cast(coalesce(shipped_ts, created_at) as date) as sd, count(*) as shipments, count(*) filter (sla_breached_flag) as breaches from fact_shipments group by 1) on sd = date_value
  left join day_funnel f on f.event_dt = date_value"""
_EXEC = ("exec_daily_sk:s date_id:i kpi_dt:d orders:i active_customers:i revenue_ex_tax:m cogs:m gross_profit_ex_tax:m net_profit_ex_tax:m gross_margin_pct:m net_margin_pct:m aov_ex_tax:m "
         "discount_amount:m shipping_cost_attrib:m gateway_fee_amount:m refund_amount_order_attrib:m return_lines:i refund_amount_return_dt:m shipments:i sla_breach_pct:m funnel_product_views:i "
         "funnel_add_to_cart:i funnel_checkout_started:i funnel_payment_attempts:i funnel_orders_placed:i funnel_conversion_rate:m funnel_cart_abandonment_rate:m funnel_payment_failure_rate:m")
case("mart_exec_daily", marts.exec_daily, _EXEC, "from exec_rows")
FRAGMENTS["finance_rows"] = "select *, md5(cast(order_id as varchar)) as finance_order_sk, cast(strftime(order_dt, '%Y%m%d') as int) as date_id from pnl"
case("mart_finance", marts.finance_profitability,
     "finance_order_sk:s date_id:i " + _PNL.replace("order_ts:t ", "").replace("order_status:s ", ""), "from finance_rows")
case("mart_funnel", marts.funnel_conversion, "funnel_conv_sk:s date_id:i channel:s device:s " + _DAILY,
     "select *, md5(concat_ws('|', cast(date_id as varchar), channel, device)) as funnel_conv_sk from slice_funnel")
FRAGMENTS["product_rows"] = """select md5(cast(date_id as varchar) || '|' || cast(product_id as varchar)) as product_perf_sk, date_id, k.dt, product_id, category_l1, category_l2, brand,
    coalesce(units_sold, 0) as units_sold, coalesce(rev, 0) as revenue_ex_tax, coalesce(cost, 0) as cogs, coalesce(rev - cost, 0) as gross_profit_ex_tax, coalesce(disc, 0) as discount_amount,
    coalesce(return_lines, 0) as return_lines, coalesce(back, 0) as refund_amount, coalesce(add_sessions, 0) as add_sessions, coalesce(lost_adds, 0) as abandoned_add_sessions,
    round(cast(cast(coalesce(lost_adds, 0) * list_price as double) * ratio as decimal(38,12)), 6) as revenue_lost_cart_abandonment,
    coalesce(failed_orders, 0) as failed_orders, coalesce(risk, 0) as revenue_at_risk_ex_tax
  from (select dt, product_id from sold union select dt, product_id from sent_back union select dt, product_id from added_x union select dt, product_id from risky) k
  join dim_date on date_value = k.dt join dim_product using (product_id) left join sold using (dt, product_id) left join sent_back using (dt, product_id)
  left join added_x using (dt, product_id) left join risky using (dt, product_id), price_ratio"""
FRAGMENTS["sold"] = """select order_dt as dt, product_id, sum(qty) as units_sold, sum(ex_tax) as rev, sum(line_cogs) as cost, sum(line_discount) as disc
  from lines_x join (select order_id, order_dt from done_orders) using (order_id) group by 1, 2"""
FRAGMENTS["sent_back"] = "select cast(return_ts as date) as dt, product_id, count(*) as return_lines, sum(refund_amount) as back from fact_returns group by 1, 2"
FRAGMENTS["added_x"] = """select dt, product_id, count(*) as add_sessions, count(*) filter (not ordered) as lost_adds from (
  select session_id, product_id, min(cast(event_ts as date)) as dt from fact_funnel_events where stage = 'ADD_TO_CART' group by 1, 2) join session_sum using (session_id) group by 1, 2"""
FRAGMENTS["risky"] = """select dt, product_id, count(distinct order_id) as failed_orders, sum(ex_tax) as risk from lines_x join (
  select order_id, min(cast(event_ts as date)) as dt from fact_funnel_events where stage = 'PAYMENT_FAILED' group by 1) using (order_id) group by 1, 2"""
_PROD = ("product_perf_sk:s date_id:i dt:d product_id:i category_l1:s category_l2:s brand:s units_sold:i revenue_ex_tax:m cogs:m gross_profit_ex_tax:m discount_amount:m return_lines:i refund_amount:m "
         "add_sessions:i abandoned_add_sessions:i revenue_lost_cart_abandonment:m failed_orders:i revenue_at_risk_ex_tax:m")
case("mart_product", marts.product_performance, _PROD, "from product_rows")
FRAGMENTS["segment_rows"] = f"""select *, md5(cast(customer_id as varchar)) as customer_segment_sk, cast(strftime(customer_created_dt, '%Y%m%d') as int) as customer_created_date_id,
    cast(strftime(first_order_dt, '%Y%m%d') as int) as first_order_date_id, cast(strftime(last_order_dt, '%Y%m%d') as int) as last_order_date_id,
    {exact0('revenue_ex_tax', 'orders', 2, '1.0')} as aov_ex_tax, orders >= 2 as repeat_customer_flag,
    ntile(4) over (order by revenue_ex_tax desc, customer_id) as value_quartile,
    ['PROSPECT', 'ONE_TIME', 'REPEAT'][cast(least(orders, 2) + 1 as int)] as lifecycle_segment
  from (select c.customer_id, c.geo_id, region, country, city, acquisition_channel, cast(customer_created_ts as date) as customer_created_dt,
      min(order_dt) as first_order_dt, max(order_dt) as last_order_dt, count(order_id) as orders, {", ".join(f"coalesce(sum({c}), 0) as {c}" for c in finance.SUMS)}
    from dim_customer c join dim_geo using (geo_id) left join (select * exclude (geo_id) from pnl) p on p.customer_id = c.customer_id group by all)"""
_SEG = ("customer_segment_sk:s customer_id:i geo_id:i region:s country:s city:s acquisition_channel:s customer_created_date_id:i customer_created_dt:d first_order_date_id:i first_order_dt:d "
        "last_order_date_id:i last_order_dt:d orders:i revenue_ex_tax:m gross_profit_ex_tax:m net_profit_ex_tax:m refund_amount:m shipping_cost:m gateway_fee_amount:m aov_ex_tax:m "
        "repeat_customer_flag:b value_quartile:i lifecycle_segment:s")
case("mart_customer", marts.customer_segments, _SEG, "from segment_rows")

# ---------------------------------------------------------------- customer analytics
FRAGMENTS["rfm_rows"] = """select customer_id, cast(floor((epoch((select max(order_ts) from done_orders)) + 86400 - epoch(max(order_ts))) / 86400) as int) as recency_days,
  count(distinct order_id) as frequency, sum(net_amount) as monetary from done_orders group by 1"""
case("an_rfm_base", segments.rfm_base, "customer_id:i recency_days:i frequency:i monetary:m", "from rfm_rows")


def _bins(value: str, edges: str) -> str:
    return "1 + " + " + ".join(f"cast(cast({value} as double) > {edges}[{i}] as int)" for i in range(1, 5))


FRAGMENTS["rfm_scored"] = f"""select *, 6 - ({_bins('recency_days', 're')}) as r_score, {_bins('monetary', 'me')} as m_score,
    cast(greatest(1, ceil((row_number() over (order by frequency, customer_id) - 1) * 5.0 / (count(*) over () - 1))) as int) as f_score
  from rfm_rows, (select quantile_cont(cast(recency_days as double), [0.2, 0.4, 0.6, 0.8]) as re, quantile_cont(cast(monetary as double), [0.2, 0.4, 0.6, 0.8]) as me from rfm_rows)"""
case("an_rfm_scores", segments.rfm_scores, "customer_id:i recency_days:i frequency:i monetary:m r_score:i f_score:i m_score:i", "from rfm_scored")
case("an_rfm_segment", segments.rfm_segments, "customer_id:i recency_days:i frequency:i monetary:m r_score:i f_score:i m_score:i segment:s rfm_score:i",
     """select *, 100 * r_score + 10 * f_score + m_score as rfm_score, case
          when r_score >= 4 then case when f_score >= 4 then 'Champions' when f_score <= 2 then 'New Customers' else 'Potential Loyalist' end
          when r_score <= 2 then case when f_score >= 4 then 'At Risk Loyal' when f_score <= 2 then 'Lost' else 'Potential Loyalist' end
          else 'Potential Loyalist' end as segment from rfm_scored""")
case("an_churn_list", lambda w: segments.churn_list(w, ORDER_DAY), "customer_id:i last_order_ts:t", f"from last_seen where last_order_ts < date '{ORDER_DAY}' - interval 90 day")
COHORT_MONTHS = list(range(80))
case("an_cohort_matrix", lambda w: segments.cohort_matrix(w, COHORT_MONTHS), "cohort_month:d " + " ".join(f"m{m}:i" for m in COHORT_MONTHS),
     "select cohort_month, " + ", ".join(f"coalesce(sum(customers) filter (months_since_cohort = {m}), 0) as m{m}" for m in COHORT_MONTHS) + " from cohorts group by 1")
FRAGMENTS["disc_rows"] = """select customer_id, order_id, d as discount_amount, n + d as gross_before_discount, n as net_revenue,
    case when n + d = 0 then 0.0 else cast(100.0 as double) * (cast(d as double) / cast(n + d as double)) end as discount_pct
  from (select order_id, sum(line_discount) as d, sum(line_net_revenue) as n from fact_order_items group by 1) join (select order_id, customer_id from done_orders) using (order_id)"""
case("an_order_discount", segments.order_discount, "customer_id:i order_id:i discount_amount:m gross_before_discount:m net_revenue:m discount_pct:m", "from disc_rows")
FRAGMENTS["back_rows"] = "select customer_id, count(*) as return_lines, sum(refund_amount) as refund_amount from fact_returns join fact_orders using (order_id) group by 1"
case("an_return_totals", segments.return_totals, "customer_id:i return_lines:i refund_amount:m", "from back_rows")
FRAGMENTS["cust_disc"] = """select customer_id, orders, avg_discount_pct, p95_discount_pct, net_revenue, coalesce(return_lines, 0) as return_lines, coalesce(refund_amount, 0) as refund_amount
  from (select customer_id, count(distinct order_id) as orders, cast(sum(cast(discount_pct as decimal(18,12))) as double) / count(*) as avg_discount_pct,
    quantile_cont(discount_pct, 0.95) as p95_discount_pct, sum(net_revenue) as net_revenue from disc_rows group by 1) left join back_rows using (customer_id)"""
_CD = "customer_id:i orders:i avg_discount_pct:m p95_discount_pct:m net_revenue:m return_lines:i refund_amount:m"
case("an_customer_discount", segments.customer_discount, _CD, "from cust_disc")
FRAGMENTS["fences"] = """select measure, q[1] - 1.5 * (q[2] - q[1]) as lo, q[2] + 1.5 * (q[2] - q[1]) as hi from (
  select 'avg_discount_pct' as measure, quantile_cont(avg_discount_pct, [0.25, 0.75]) as q from cust_disc
  union all select 'refund_amount', quantile_cont(cast(refund_amount as double), [0.25, 0.75]) from cust_disc)"""
case("an_iqr_bounds", segments.outlier_bounds, "measure:s lo:m hi:m", "from fences")
case("an_outlier_flags", segments.outlier_flags, _CD + " flag_discount_abuse:b flag_refund_abuse:b flag_any:b",
     """select *, flag_discount_abuse or flag_refund_abuse as flag_any from (select *,
        avg_discount_pct > (select hi from fences where measure = 'avg_discount_pct') as flag_discount_abuse,
        refund_amount > (select hi from fences where measure = 'refund_amount') as flag_refund_abuse from cust_disc)""")
FRAGMENTS["series"] = """select dt, cast(dt - lo as int) as day_no, coalesce(rev, 0) as net_revenue from (
    select cast(unnest(generate_series(min(order_dt), max(order_dt), interval 1 day)) as date) as dt, min(order_dt) as lo from done_orders)
  left join (select order_dt as dt, sum(net_amount) as rev from done_orders group by 1) using (dt)"""
case("an_daily_series", forecast.daily_series, "dt:d day_no:i net_revenue:m", "from series")
case("an_forecast_linear", forecast.linear, "dt:d forecast_lr:m2",
     """select last_dt + cast(k as int) as dt, a + b * (last_no + k) as forecast_lr from (select max(dt) as last_dt, max(day_no) as last_no,
          regr_slope(cast(net_revenue as double), cast(day_no as double)) as b, regr_intercept(cast(net_revenue as double), cast(day_no as double)) as a from series), range(1, 31) r(k)""")
FRAGMENTS["channel_series"] = """select channel, dt, cast(dt - lo as int) as day_no, coalesce(rev, 0) as net_revenue from (
    select channel, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as dt, lo from (select channel, min(order_dt) as lo, max(order_dt) as hi from done_orders group by 1))
  left join (select channel, order_dt as dt, sum(net_amount) as rev from done_orders group by 1, 2) using (channel, dt)"""
case("an_forecast_linear_by_channel", lambda w: forecast.linear(w, ["channel"]), "channel:s dt:d forecast_lr:m2",
     """select channel, last_dt + cast(k as int) as dt, a + b * (last_no + k) as forecast_lr from (select channel, max(dt) as last_dt, max(day_no) as last_no,
          regr_slope(cast(net_revenue as double), cast(day_no as double)) as b, regr_intercept(cast(net_revenue as double), cast(day_no as double)) as a from channel_series group by 1), range(1, 31) r(k)""")
case("an_forecast_arima", lambda w: forecast.arima(w, ["channel"]), "channel:s dt:d forecast_arima:m2")

FRAGMENTS["line_days"] = """select category_l1, region, cast(o.order_ts as date) as dt, cast(sum(line_net_revenue) as decimal(18,2)) as y
  from fact_order_items join done_orders o using (order_id) join dim_product using (product_id) join dim_geo using (geo_id) group by 1, 2, 3"""
FRAGMENTS["line_steps"] = """select *, lag(d0, 1) over w as d1, lag(d0, 2) over w as d2, lag(d0, 3) over w as d3 from (
    select *, cast(y - lag(y) over (partition by category_l1, region order by dt) as decimal(19,2)) as d0 from (
      select category_l1, region, dt, coalesce(y, 0)::decimal(18,2) as y from (select category_l1, region, unnest(generate_series(min(dt), max(dt), interval 1 day))::date as dt from line_days group by 1, 2)
      left join line_days using (category_l1, region, dt)))
  window w as (partition by category_l1, region order by dt)"""
FRAGMENTS["line_ar"] = """select category_l1, region, (r1 * (s22 * s33 - s23 * s23) - s12 * (r2 * s33 - s23 * r3) + s13 * (r2 * s23 - s22 * r3)) / det as a1,
    (s11 * (r2 * s33 - s23 * r3) - r1 * (s12 * s33 - s23 * s13) + s13 * (s12 * r3 - r2 * s13)) / det as a2,
    (s11 * (s22 * r3 - r2 * s23) - s12 * (s12 * r3 - r2 * s13) + r1 * (s12 * s23 - s22 * s13)) / det as a3
  from (select *, nullif(s11 * (s22 * s33 - s23 * s23) - s12 * (s12 * s33 - s23 * s13) + s13 * (s12 * s23 - s22 * s13), 0) as det from (
    select category_l1, region, sum(d1 * d1)::double as s11, sum(d1 * d2)::double as s12, sum(d1 * d3)::double as s13, sum(d2 * d2)::double as s22, sum(d2 * d3)::double as s23,
      sum(d3 * d3)::double as s33, sum(d0 * d1)::double as r1, sum(d0 * d2)::double as r2, sum(d0 * d3)::double as r3 from line_steps where d3 is not null group by 1, 2))"""
FRAGMENTS["line_shocks"] = """select *, lag(e0) over (partition by category_l1, region order by dt) as e1 from (
    select l.*, round(d0::double - (a1 * d1::double + a2 * d2::double + a3 * d3::double), 4)::decimal(19,4) as e0 from line_steps l left join line_ar using (category_l1, region))"""
FRAGMENTS["line_fit"] = """select category_l1, region, last_dt, level, changes, last_d, last_e, greatest(-0.99, least(0.99, (r1 * ee - de * r2) / nullif(dd * ee - de * de, 0))) as phi,
    greatest(-0.99, least(0.99, (dd * r2 - r1 * de) / nullif(dd * ee - de * de, 0))) as theta, nullif(dd * ee - de * de, 0) is null as loose
  from (select category_l1, region, max(dt) as last_dt, count(d0) as changes, arg_max(y, dt)::double as level, last(d0 order by dt)::double as last_d, last(e0 order by dt)::double as last_e,
      sum(d1 * d1) filter (e1 is not null)::double as dd, sum(d1 * e1)::double as de, sum(e1 * e1)::double as ee, sum(d0 * d1) filter (e1 is not null)::double as r1, sum(d0 * e1)::double as r2
    from line_shocks group by 1, 2)"""
case("an_forecast_arima_series", lambda w: forecast.arima_regression(forecast.line_series(w), ["category_l1", "region"]), "category_l1:s region:s dt:d status:s forecast_arima:m2",
     f"""select category_l1, region, last_dt + k::int as dt, status, case when status = 'fitted' then level + (phi * last_d + theta * last_e) * (1 - pow(phi, k)) / (1 - phi) else level end as forecast_arima
         from (select *, case when changes < {forecast.LEAST_STEPS} then 'short' when loose or last_e is null then 'flat' else 'fitted' end as status from line_fit), range(1, 31) r(k)""")
