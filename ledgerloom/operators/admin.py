"""Operations queries: order audit log, order monitor, journeys and mart charts' data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.expr import attach, check_bounds, check_limit, page, rounded, rows, since, total
from ledgerloom.operators.views import Tables


def _in_window(col: str, as_of: str, days: int) -> Column:
    return F.col(col) >= F.date_sub(F.to_date(F.lit(as_of)), days)


def audit_log(t: Tables, limit: int | None = 200, offset: int = 0) -> DataFrame:
    """Status changes of all orders, newest first; cancellations only if that table exists."""
    check_limit(limit, 500)

    def event(df: DataFrame, ts: Column, action: str, reason: Column, actor: str) -> DataFrame:
        return df.select(ts.cast("timestamp").alias("event_ts"), "order_id", F.lit(action).alias("action"), reason.alias("reason"), F.lit(actor).alias("actor_type"))

    moved = "STATUS_CHANGED"
    ships = t["fact_shipments"].groupBy("order_id").agg(F.max("shipped_ts").alias("s"), F.max("delivered_dt").alias("d"))
    parts = [
        event(t["fact_orders"], F.col("order_ts"), moved, F.lit("NEW→PLACED"), "customer"),
        event(ships, F.col("s"), moved, F.lit("PLACED→SHIPPED"), "system"),
        event(ships, F.col("d"), moved, F.lit("SHIPPED→DELIVERED"), "system"),
    ]
    if "order_cancellations" in t:
        parts.append(event(t["order_cancellations"], F.col("created_at"), "CANCELLED", F.col("reason"), "customer"))
    events = reduce(DataFrame.unionByName, parts).where(F.col("event_ts").isNotNull())
    return page(events, [F.col("event_ts").desc(), F.col("order_id"), F.col("reason")], limit, offset)


def orders_monitor(t: Tables, limit: int | None = 50, offset: int = 0) -> DataFrame:
    """Newest orders with customer name (profile first, else the order's recipient) and e-mail."""
    orders = t["fact_orders"]
    recipient = F.col("recipient_name") if "recipient_name" in orders.columns else F.lit(None).cast("string")
    head = orders.select("order_id", "customer_id", "order_ts", "order_status", "net_amount", "channel", recipient.alias("_recipient"))
    users = t["app_users"].select("customer_id", "display_name", "email")
    name = F.coalesce(F.nullif("display_name", F.lit("")), F.nullif("_recipient", F.lit("")))
    out = head.join(users, "customer_id", "left").select(
        "order_id", "customer_id", name.alias("customer_name"), F.col("email").alias("customer_email"), "order_ts", "order_status", "net_amount", "channel"
    )
    return page(out, [F.col("order_ts").desc(), F.col("order_id")], limit, offset)


def journey_sessions(t: Tables, as_of: str, window_hours: int = 72, customer_id: int | None = None, limit: int | None = 100, offset: int = 0) -> DataFrame:
    """Sessions active in the last hours, latest first."""
    check_bounds("window_hours", window_hours, 1, 24 * 30)
    events = t["fact_funnel_events"].where(since("event_ts", as_of, hours=window_hours))
    if customer_id is not None:
        events = events.where(F.col("customer_id") == customer_id)
    sessions = events.groupBy("session_id").agg(
        F.max("customer_id").alias("customer_id"), F.min("event_ts").alias("first_event_ts"), F.max("event_ts").alias("last_event_ts"),
        rows().alias("event_count"), F.max("channel").alias("channel"), F.max("device").alias("device"),
    )
    return page(sessions, [F.col("last_event_ts").desc(), F.col("session_id")], limit, offset)


def journey_events(t: Tables, session_id: str | None = None) -> DataFrame:
    """Events of one session in order, or those of all sessions in no order."""
    events = t["fact_funnel_events"]
    if session_id is not None:
        events = events.where(F.col("session_id") == session_id)
    cols = ("event_id", "event_ts", "session_id", "customer_id", "stage", "channel", "device", "product_id", "order_id", "failure_reason")
    out = events.select(*cols)
    return out if session_id is None else out.orderBy("event_ts", "event_id")


def sales_trend(exec_mart: DataFrame, as_of: str, window_days: int = 90) -> DataFrame:
    check_bounds("window_days", window_days, 7, 365)
    cols = ("orders", "revenue_ex_tax", "net_profit_ex_tax", "refund_amount_return_dt")
    return exec_mart.where(_in_window("kpi_dt", as_of, window_days)).select(F.col("kpi_dt").alias("dt"), *cols).orderBy("dt")


def orders_vs_revenue(exec_mart: DataFrame, as_of: str, window_days: int = 90) -> DataFrame:
    check_bounds("window_days", window_days, 7, 3650)
    return exec_mart.where(_in_window("kpi_dt", as_of, window_days)).select(F.col("kpi_dt").alias("dt"), "orders", "revenue_ex_tax").orderBy("dt")


def top_products(product_mart: DataFrame, products: DataFrame, as_of: str, window_days: int = 30, top_n: int | None = 10) -> DataFrame:
    check_bounds("window_days", window_days, 7, 3650)
    if top_n is not None:
        check_bounds("top_n", top_n, 5, 50)
    sums = product_mart.where(_in_window("dt", as_of, window_days)).groupBy("product_id").agg(total("revenue_ex_tax").alias("revenue_ex_tax"))
    best = page(sums, [F.col("revenue_ex_tax").desc(), F.col("product_id")], top_n)
    named = best.join(products.select("product_id", "product_name"), "product_id")
    return named.select("product_id", "product_name", "revenue_ex_tax").orderBy(F.col("revenue_ex_tax").desc(), "product_id")


def category_share(product_mart: DataFrame, as_of: str, window_days: int = 30, level: str = "category_l1", top_n: int | None = 10) -> DataFrame:
    """Top categories and each one's share of the shown total. A total of 0 or less is an error."""
    check_bounds("window_days", window_days, 7, 3650)
    if top_n is not None:
        check_bounds("top_n", top_n, 3, 50)
    level = (level or "").strip().lower()
    if level not in ("category_l1", "category_l2"):
        raise ValueError("level must be category_l1 or category_l2")
    recent = product_mart.where(_in_window("dt", as_of, window_days) & F.col(level).isNotNull())
    sums = recent.groupBy(F.col(level).alias("category")).agg(total("revenue_ex_tax").alias("revenue_ex_tax"))
    top = page(sums, [F.col("revenue_ex_tax").desc(), F.col("category")], top_n)
    shown = top.agg(F.sum("revenue_ex_tax").cast("double").alias("_total"))
    whole = F.when(F.col("_total") > 0, F.col("_total")).otherwise(F.raise_error(F.lit("no revenue in the window")).cast("double"))
    share = rounded(F.col("revenue_ex_tax").cast("double") / whole * 100.0, 4)
    return attach(top, shown).select("category", "revenue_ex_tax", share.alias("share_pct"))


def refund_leakage(finance_mart: DataFrame, as_of: str, window_days: int = 90) -> DataFrame:
    recent = finance_mart.where(_in_window("order_dt", as_of, window_days))
    sums = [total(c).alias(c) for c in ("revenue_ex_tax", "refund_amount", "net_profit_ex_tax")]
    return recent.groupBy(F.col("order_dt").alias("dt")).agg(*sums).orderBy("dt")


def stock_band(positions: DataFrame) -> DataFrame:
    """Pieces of each product that are left after reservations, and whether there are any."""
    return positions.select("product_id", F.col("available_qty").alias("stock_qty"), (F.col("available_qty") > 0).alias("in_stock"))
