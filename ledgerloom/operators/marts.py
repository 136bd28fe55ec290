"""The five BI marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.expr import attach, pct0, ratio0, rounded, rows, surrogate_key, total, zero
from ledgerloom.functions.ranking import running, tile_of
from ledgerloom.operators import finance, funnel
from ledgerloom.operators.views import Tables, orders_completed


# Defaults for events that name no channel or device.
DEFAULT_CHANNEL, DEFAULT_DEVICE = "WEB", "DESKTOP"


def _shipped_day():
    return F.to_date(F.coalesce("shipped_ts", "created_at"))


def activity_bounds(t: Tables) -> DataFrame:
    """First and last day with any order, event, return or shipment (one row)."""
    days = [
        t["fact_orders"].select(F.to_date("order_ts").alias("d")),
        t["fact_funnel_events"].select(F.to_date("event_ts").alias("d")),
        t["fact_returns"].select(F.to_date("return_ts").alias("d")),
        t["fact_shipments"].select(_shipped_day().alias("d")),
    ]
    parts = [x.agg(F.min("d").alias("lo"), F.max("d").alias("hi")) for x in days]
    return reduce(DataFrame.unionByName, parts).agg(F.min("lo").alias("first_dt"), F.max("hi").alias("last_dt"))


def exec_daily(t: Tables, pnl: DataFrame | None = None) -> DataFrame:
    """One row per calendar day between the first and last activity.

    The four sources are reduced to one row per day before any join, so the
    joins only ever see as many rows as there are days.
    """
    pnl = finance.order_pnl(t) if pnl is None else pnl
    per_customer = pnl.groupBy("order_dt", "customer_id").agg(rows().alias("orders"), *[F.sum(c).alias(c) for c in DAILY_MONEY])
    sales = per_customer.groupBy(F.col("order_dt").alias("d")).agg(
        F.sum("orders").alias("orders"), rows().alias("active_customers"), *[F.sum(c).alias(c) for c in DAILY_MONEY]
    )
    back = t["fact_returns"].groupBy(F.to_date("return_ts").alias("d")).agg(
        rows().alias("return_lines"), F.sum("refund_amount").alias("refund_amount_return_dt")
    )
    ship = t["fact_shipments"].groupBy(_shipped_day().alias("d")).agg(
        rows().alias("shipments"), F.count_if("sla_breached_flag").alias("breaches")
    )
    fun = funnel.daily_metrics(t).withColumnRenamed("event_dt", "d")
    bounds = activity_bounds(t)
    days = attach(t["dim_date"].select("date_id", F.col("date_value").alias("d")), bounds)
    days = days.where(F.col("d").between(F.col("first_dt"), F.col("last_dt"))).select("date_id", "d")
    return daily_rows(reduce(lambda left, right: left.join(right, "d", "left"), (sales, back, ship, fun), days))


DAILY_MONEY = ("revenue_ex_tax", "cogs", "gross_profit_ex_tax", "net_profit_ex_tax", "discount_amount", "shipping_cost", "gateway_fee_amount", "refund_amount")


def daily_rows(joined: DataFrame) -> DataFrame:
    """The mart's rows from days (date_id, d) beside the sums of each day."""
    rev = zero("revenue_ex_tax")
    return joined.select(
        surrogate_key("date_id").alias("exec_daily_sk"), "date_id", F.col("d").alias("kpi_dt"),
        zero("orders").alias("orders"), zero("active_customers").alias("active_customers"),
        *[zero(c).alias(c) for c in DAILY_MONEY[:4]],
        pct0(zero("gross_profit_ex_tax"), rev, 4).alias("gross_margin_pct"),
        pct0(zero("net_profit_ex_tax"), rev, 4).alias("net_margin_pct"),
        _aov(rev, zero("orders")).alias("aov_ex_tax"),
        zero("discount_amount").alias("discount_amount"),
        zero("shipping_cost").alias("shipping_cost_attrib"),
        zero("gateway_fee_amount").alias("gateway_fee_amount"),
        zero("refund_amount").alias("refund_amount_order_attrib"),
        zero("return_lines").alias("return_lines"),
        zero("refund_amount_return_dt").alias("refund_amount_return_dt"),
        zero("shipments").alias("shipments"),
        pct0(zero("breaches"), zero("shipments"), 4).alias("sla_breach_pct"),
        *[zero(c).alias(f"funnel_{c}") for c in (*funnel.STAGE_COUNTS, "conversion_rate", "cart_abandonment_rate", "payment_failure_rate")],
    )


def _aov(revenue, orders):
    return ratio0(revenue, orders, 2)


def finance_profitability(t: Tables, pnl: DataFrame | None = None) -> DataFrame:
    """Order P&L with its calendar key, one row per completed order."""
    pnl = finance.order_pnl(t) if pnl is None else pnl
    dd = t["dim_date"].select("date_id", F.col("date_value").alias("order_dt"))
    return pnl.join(dd, "order_dt").select(
        surrogate_key("order_id").alias("finance_order_sk"), "date_id", "order_dt", "order_id", "customer_id", "geo_id", "channel", "currency",
        "revenue_ex_tax", "discount_amount", "tax_amount", "cogs", "shipping_cost", "gateway_fee_amount", "refund_amount",
        "gross_profit_ex_tax", "net_profit_ex_tax", "gross_margin_pct", "net_margin_pct",
        "sla_breached_flag", "has_return_flag", "discount_heavy_flag", "loss_order_flag",
    )


def funnel_conversion(t: Tables) -> DataFrame:
    flags = funnel.session_flags(
        t["fact_funnel_events"],
        F.to_date("event_ts").alias("event_dt"),
        F.coalesce("channel", F.lit(DEFAULT_CHANNEL)).alias("channel"),
        F.coalesce("device", F.lit(DEFAULT_DEVICE)).alias("device"),
        "session_id",
    )
    keys = ("event_dt", "channel", "device")
    dd = t["dim_date"].select("date_id", F.col("date_value").alias("event_dt"))
    m = funnel.metrics(flags, *keys).join(dd, "event_dt")
    return m.select(surrogate_key("date_id", "channel", "device").alias("funnel_conv_sk"), "date_id", *[c for c in m.columns if c != "date_id"])


PRODUCT_MEASURES = (
    "units_sold", "revenue_ex_tax", "cogs", "gross_profit_ex_tax", "discount_amount", "return_lines", "refund_amount",
    "add_sessions", "abandoned_add_sessions", "failed_orders", "revenue_at_risk_ex_tax",
)


def product_performance(t: Tables) -> DataFrame:
    """One row per day and product with any sale, return, abandoned add or failed payment.

    Each source yields partial measures on (day, product); one union and one
    aggregation replace the key spine and its joins.
    """
    events = t["fact_funnel_events"]
    qty, sell, cost = F.col("qty"), F.col("unit_sell_price"), F.col("unit_cost")
    done = orders_completed(t).select("order_id", F.col("order_dt").alias("dt"))
    per_line = t["fact_order_items"].groupBy("order_id", "product_id").agg(
        F.sum("qty").alias("units_sold"), F.sum(qty * sell).alias("revenue_ex_tax"), F.sum(qty * cost).alias("cogs"),
        F.sum("line_discount").alias("discount_amount"),
    )
    sales = per_line.join(done, "order_id").select(
        "dt", "product_id", "units_sold", "revenue_ex_tax", "cogs", (F.col("revenue_ex_tax") - F.col("cogs")).alias("gross_profit_ex_tax"), "discount_amount"
    )
    back = t["fact_returns"].select(F.to_date("return_ts").alias("dt"), "product_id", F.lit(1).cast("long").alias("return_lines"), "refund_amount")
    first_add = (
        events.where((F.col("stage") == "ADD_TO_CART") & F.col("product_id").isNotNull())
        .groupBy("session_id", "product_id").agg(F.min(F.to_date("event_ts")).alias("dt"))
    )
    outcome = funnel.session_outcome(events).select("session_id", "ordered")
    adds = first_add.join(outcome, "session_id").select(
        "dt", "product_id", F.lit(1).cast("long").alias("add_sessions"), F.when(F.col("ordered"), 0).otherwise(1).cast("long").alias("abandoned_add_sessions")
    )
    failed = (
        events.where((F.col("stage") == "PAYMENT_FAILED") & F.col("order_id").isNotNull())
        .groupBy("order_id").agg(F.min(F.to_date("event_ts")).alias("dt"))
    )
    risk = per_line.join(failed, "order_id").select(
        "dt", "product_id", F.lit(1).cast("long").alias("failed_orders"), F.col("revenue_ex_tax").alias("revenue_at_risk_ex_tax")
    )
    parts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (sales, back, adds, risk))
    summed = parts.groupBy("dt", "product_id").agg(*[total(c).alias(c) for c in PRODUCT_MEASURES])
    dd = t["dim_date"].select("date_id", F.col("date_value").alias("dt"))
    prod = t["dim_product"].select("product_id", "category_l1", "category_l2", "brand", "list_price")
    lost = rounded((F.col("abandoned_add_sessions") * F.col("list_price")).cast("double") * F.col("sell_ratio"), 6)
    return attach(summed.join(dd, "dt").join(prod, "product_id"), funnel.sell_ratio(t)).select(
        surrogate_key("date_id", "product_id").alias("product_perf_sk"), "date_id", "dt", "product_id", "category_l1", "category_l2", "brand",
        *PRODUCT_MEASURES, lost.alias("revenue_lost_cart_abandonment"),
    )


def customer_segments(t: Tables, pnl: DataFrame | None = None) -> DataFrame:
    """All customers with order history, value quartile (1 = highest revenue) and lifecycle.

    Quartile ties go to the smaller customer id.
    """
    pnl = finance.order_pnl(t) if pnl is None else pnl
    money = ("revenue_ex_tax", "gross_profit_ex_tax", "net_profit_ex_tax", "refund_amount", "shipping_cost", "gateway_fee_amount")
    hist = pnl.groupBy("customer_id").agg(
        F.min("order_dt").alias("first_order_dt"), F.max("order_dt").alias("last_order_dt"), rows().alias("orders"), *[F.sum(c).alias(c) for c in money]
    )
    people = t["dim_customer"].select("customer_id", "geo_id", "acquisition_channel", F.to_date("customer_created_ts").alias("customer_created_dt"))
    joined = people.join(hist, "customer_id", "left").select(
        *people.columns, "first_order_dt", "last_order_dt", zero("orders").alias("orders"), *[zero(c).alias(c) for c in money]
    )
    ranked = running(joined, [("revenue_ex_tax", True), ("customer_id", False)])
    orders = F.col("orders")
    life = F.when(orders == 0, "PROSPECT").when(orders == 1, "ONE_TIME").otherwise("REPEAT")
    out = ranked.join(t["dim_geo"].select("geo_id", "region", "country", "city"), "geo_id")
    for role in ("customer_created", "first_order", "last_order"):
        role_day = t["dim_date"].select(F.col("date_id").alias(f"{role}_date_id"), F.col("date_value").alias(f"{role}_dt"))
        out = out.join(role_day, f"{role}_dt", "left")
    return out.select(
        surrogate_key("customer_id").alias("customer_segment_sk"), "customer_id", "geo_id", "region", "country", "city", "acquisition_channel",
        "customer_created_date_id", "customer_created_dt", "first_order_date_id", "first_order_dt", "last_order_date_id", "last_order_dt",
        "orders", *money, _aov(F.col("revenue_ex_tax"), orders).alias("aov_ex_tax"), (orders >= 2).alias("repeat_customer_flag"),
        tile_of(F.col("row_no"), F.col("group_n"), 4).alias("value_quartile"), life.alias("lifecycle_segment"),
    )


# Mart name -> builder, in refresh order.
MARTS = {
    "mart_exec_daily_kpis": exec_daily,
    "mart_finance_profitability": finance_profitability,
    "mart_funnel_conversion": funnel_conversion,
    "mart_product_performance": product_performance,
    "mart_customer_segments": customer_segments,
}
