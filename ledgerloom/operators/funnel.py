"""Funnel conversion and revenue leakage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.expr import attach, check_bounds, check_limit, divide, page, ratio0, rounded, rows, side_by_side, since, total, zero
from ledgerloom.operators.views import Tables, is_failed, orders_completed

# Event stages, as flag column -> stage, and the default price ratio.
STAGE_FLAGS = {
    "viewed": "VIEW_PRODUCT",
    "added": "ADD_TO_CART",
    "checkout": "CHECKOUT_STARTED",
    "pay_attempt": "PAYMENT_ATTEMPTED",
    "pay_failed": "PAYMENT_FAILED",
    "ordered": "ORDER_PLACED",
}
STAGE_COUNTS = {
    "product_views": "viewed",
    "add_to_cart": "added",
    "checkout_started": "checkout",
    "payment_attempts": "pay_attempt",
    "orders_placed": "ordered",
}
DEFAULT_SELL_RATIO = 0.88


def _hit(stage: str) -> Column:
    return F.bool_or(F.col("stage") == stage)


def session_flags(events: DataFrame, *keys) -> DataFrame:
    """Which stages each group of ``keys`` reached; merged map-side, so a hot session stays one row per task."""
    return events.groupBy(*keys).agg(*[_hit(stage).alias(flag) for flag, stage in STAGE_FLAGS.items()])


def daily_session_flags(t: Tables) -> DataFrame:
    return session_flags(t["fact_funnel_events"], F.to_date("event_ts").alias("event_dt"), "session_id")


def stage_counts() -> list[Column]:
    return [F.count_if(F.col(flag)).alias(name) for name, flag in STAGE_COUNTS.items()]


def rates(failed: str = "payment_failed") -> list[Column]:
    """Conversion, abandonment and failure from counted columns; 0 where the base is 0."""
    return [
        ratio0("orders_placed", "product_views", 4).alias("conversion_rate"),
        ratio0(F.col("add_to_cart") - F.col("checkout_started"), "add_to_cart", 4).alias("cart_abandonment_rate"),
        ratio0(failed, "payment_attempts", 4).alias("payment_failure_rate"),
    ]


def metrics(flags: DataFrame, *keys: str) -> DataFrame:
    counted = flags.groupBy(*keys).agg(*stage_counts(), F.count_if(F.col("pay_failed")).alias("payment_failed"))
    return counted.select(*keys, *STAGE_COUNTS, *rates())


def daily_metrics(t: Tables) -> DataFrame:
    return metrics(daily_session_flags(t), "event_dt")


def sell_ratio(t: Tables) -> DataFrame:
    """Mean of sell/list price over all lines, as one row; per-line quotients are summed exactly."""
    q = divide("unit_sell_price", "unit_list_price").cast("decimal(18,12)")
    mean = F.sum(q).cast("double") / F.nullif(F.count(q), F.lit(0))
    return t["fact_order_items"].agg(F.coalesce(mean, F.lit(DEFAULT_SELL_RATIO)).alias("sell_ratio"))


def session_outcome(events: DataFrame) -> DataFrame:
    return events.groupBy("session_id").agg(_hit("ADD_TO_CART").alias("added"), _hit("ORDER_PLACED").alias("ordered"))


def abandoned_sessions(events: DataFrame) -> DataFrame:
    return session_outcome(events).where("added and not ordered").select("session_id")


def abandoned_products(events: DataFrame) -> DataFrame:
    adds = events.where((F.col("stage") == "ADD_TO_CART") & F.col("product_id").isNotNull())
    return adds.select("session_id", "product_id").distinct().join(abandoned_sessions(events), "session_id", "left_semi")


def failed_orders(events: DataFrame) -> DataFrame:
    return events.where((F.col("stage") == "PAYMENT_FAILED") & F.col("order_id").isNotNull()).select("order_id").distinct()


def _order_revenue(t: Tables) -> DataFrame:
    return t["fact_order_items"].groupBy("order_id").agg(F.sum(F.col("qty") * F.col("unit_sell_price")).alias("revenue"))


def leakage(t: Tables, events: DataFrame, orders: DataFrame, returns: DataFrame) -> DataFrame:
    """One row: realised revenue, the three losses, and what is left."""
    realised = orders.agg(total(F.col("net_amount") - F.col("tax_amount")).alias("net_revenue_ex_tax"))
    refunds = returns.agg(total("refund_amount").alias("refunds_leakage"))
    failures = _order_revenue(t).join(failed_orders(events), "order_id", "left_semi").agg(
        total("revenue").alias("revenue_lost_payment_failures")
    )
    # Sum list prices per product first, then scale once by the ratio.
    per_product = abandoned_products(events).groupBy("product_id").agg(rows().alias("adds"))
    listed = per_product.join(t["dim_product"].select("product_id", "list_price"), "product_id").agg(
        total(F.col("adds") * F.col("list_price")).alias("listed")
    )
    lost = rounded(F.col("listed").cast("double") * F.col("sell_ratio"), 6)
    one_row = side_by_side(realised, refunds, failures, listed, sell_ratio(t))
    out = one_row.select(
        "net_revenue_ex_tax", lost.alias("revenue_lost_cart_abandonment"), "revenue_lost_payment_failures", "refunds_leakage"
    )
    after = (
        F.col("net_revenue_ex_tax") - F.col("refunds_leakage")
        - F.col("revenue_lost_cart_abandonment") - F.col("revenue_lost_payment_failures")
    )
    return out.withColumn("net_revenue_after_leakage", after)


def revenue_leakage(t: Tables) -> DataFrame:
    return leakage(t, t["fact_funnel_events"], orders_completed(t), t["fact_returns"])


def product_leakage(t: Tables) -> DataFrame:
    events = t["fact_funnel_events"]
    seen = events.where(F.col("product_id").isNotNull()).groupBy("product_id", "session_id").agg(
        _hit("VIEW_PRODUCT").alias("viewed"), _hit("ADD_TO_CART").alias("added")
    )
    outcome = session_outcome(events).select("session_id", "ordered")
    per_product = seen.join(outcome, "session_id").groupBy("product_id").agg(
        F.count_if("viewed").alias("product_views"),
        F.count_if("added").alias("add_to_cart"),
        F.count_if(F.col("added") & ~F.col("ordered")).alias("abandoned_adds"),
    )
    lost_items = (
        t["fact_order_items"]
        .groupBy("product_id", "order_id")
        .agg(F.sum(F.col("qty") * F.col("unit_sell_price")).alias("revenue"))
        .join(failed_orders(events), "order_id", "left_semi")
        .groupBy("product_id")
        .agg(rows().alias("failed_orders"), F.sum("revenue").alias("failed_revenue"))
    )
    lost = rounded((F.col("abandoned_adds") * F.col("list_price")).cast("double") * F.col("sell_ratio"), 2)
    joined = per_product.join(t["dim_product"].select("product_id", "product_name", "list_price"), "product_id").join(lost_items, "product_id", "left")
    return attach(joined, sell_ratio(t)).select(
        "product_id", "product_name", "product_views", "add_to_cart", "abandoned_adds",
        lost.alias("revenue_lost_cart_abandonment"),
        zero("failed_orders").alias("failed_orders"),
        zero("failed_revenue").alias("revenue_lost_payment_failures"),
    )


def payment_failures(t: Tables, dedup: bool = False) -> DataFrame:
    """Failed payments by day, method, provider and reason.

    Counts and amounts repeat per line of the order, as published; with
    ``dedup=True`` a payment counts once. Either way lines are summed per
    order first, so the join carries one row per payment.
    """
    day = F.to_date(F.coalesce("authorized_ts", "created_at")).alias("event_dt")
    lines = t["fact_order_items"].groupBy("order_id").agg(
        rows().alias("lines"), F.sum(F.col("qty") * F.col("unit_sell_price")).alias("revenue")
    )
    times = F.lit(1) if dedup else F.coalesce(F.col("lines"), F.lit(1))
    return (
        t["fact_payments"].where(is_failed()).join(lines, "order_id", "left")
        .groupBy(day, "payment_method", "payment_provider", "failure_reason")
        .agg(
            F.sum(times).alias("failed_payments"),
            total(F.col("amount") * times).alias("amount_attempted"),
            total("revenue").alias("revenue_at_risk_ex_tax"),
        )
    )


def summary_window(t: Tables, as_of: str, window_days: int = 30) -> DataFrame:
    """Funnel counts and leakage for the last N days; the price ratio uses all lines."""
    check_bounds("window_days", window_days, 1, 365)
    events = t["fact_funnel_events"].where(since("event_ts", as_of, window_days))
    orders = orders_completed(t).where(since("order_ts", as_of, window_days))
    returns = t["fact_returns"].where(since("return_ts", as_of, window_days))
    counted = session_flags(events, "session_id").agg(*stage_counts(), F.count_if("pay_failed").alias("payment_failed"))
    return side_by_side(counted.select(*STAGE_COUNTS, *rates()), leakage(t, events, orders, returns))


def daily_window(t: Tables, as_of: str, window_days: int = 30) -> DataFrame:
    check_bounds("window_days", window_days, 1, 365)
    recent = daily_metrics(t).where(F.col("event_dt") >= F.date_sub(F.to_date(F.lit(as_of)), window_days))
    return recent.orderBy(F.col("event_dt").desc())


def product_leakage_topn(t: Tables, limit: int | None = 25, offset: int = 0) -> DataFrame:
    check_limit(limit, 200)
    loss = F.col("revenue_lost_cart_abandonment") + F.col("revenue_lost_payment_failures")
    return page(product_leakage(t), [loss.desc(), F.col("product_id")], limit, offset)


def payment_failures_topn(t: Tables, as_of: str, window_days: int = 30, limit: int | None = 50, offset: int = 0) -> DataFrame:
    check_limit(limit, 500)
    recent = payment_failures(t).where(F.col("event_dt") >= F.date_sub(F.to_date(F.lit(as_of)), window_days))
    order = [F.col("failed_payments").desc(), *[F.col(c).asc_nulls_first() for c in ("event_dt", "payment_method", "payment_provider", "failure_reason")]]
    return page(recent, order, limit, offset)


def stage_totals(mart: DataFrame, as_of: str, window_days: int = 30) -> DataFrame:
    """Stage counts of a funnel mart summed over a window, one row per stage."""
    recent = mart.where(F.col("event_dt") >= F.date_sub(F.to_date(F.lit(as_of)), window_days))
    sums = recent.agg(*[total(c).alias(c) for c in STAGE_COUNTS])
    return sums.unpivot([], list(STAGE_COUNTS), "stage", "sessions")


def stage_pct(mart: DataFrame, as_of: str, window_days: int = 30, base: str = "product_views") -> DataFrame:
    """Stage counts as a percentage of the base stage, held within 0..100."""
    recent = mart.where(F.col("event_dt") >= F.date_sub(F.to_date(F.lit(as_of)), window_days))
    sums = recent.agg(*[total(c).alias(c) for c in STAGE_COUNTS]).withColumn("_base", F.col(base))
    long = sums.unpivot(["_base"], list(STAGE_COUNTS), "stage", "sessions")
    share = F.greatest(F.lit(0.0), F.least(F.lit(100.0), zero(divide(F.col("sessions") * 100, "_base"))))
    return long.select("stage", "sessions", rounded(share, 4).alias("pct_of_base"))
