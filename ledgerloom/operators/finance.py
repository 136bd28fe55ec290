"""Profit and loss at order, line, product and customer level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.expr import WIDE, check_limit, divide, page, pct0, rounded, rows, total, zero
from ledgerloom.operators.views import Tables, is_failed, orders_completed
from ledgerloom.session import cut

# Fixed value: the share of list value above which a discount is heavy.
HEAVY_DISCOUNT = 0.30

SUMS = ("revenue_ex_tax", "cogs", "shipping_cost", "gateway_fee_amount", "refund_amount", "gross_profit_ex_tax", "net_profit_ex_tax")


def _heavy(revenue: Column, discount: Column) -> Column:
    share = divide(discount, revenue + discount)
    return F.coalesce((revenue > 0) & (share > HEAVY_DISCOUNT), F.lit(False))


def fee() -> Column:
    return F.when(is_failed(), 0).otherwise(F.col("gateway_fee_amount"))


def order_pnl(t: Tables) -> DataFrame:
    """One row per completed order.

    Every fact is summed per order before it meets the order header, all on
    the same key: one exchange per fact, none for the joins, and an order with
    very many lines arrives as one row.
    """
    lines = t["fact_order_items"].groupBy("order_id").agg(
        F.sum(F.col("qty") * F.col("unit_sell_price")).alias("_revenue"),
        F.sum(F.col("qty") * F.col("unit_cost")).alias("_cogs"),
        F.sum("line_discount").alias("_discount"),
        F.sum("line_tax").alias("_tax"),
    )
    ship = t["fact_shipments"].groupBy("order_id").agg(
        F.sum("shipping_cost").alias("_ship"), F.bool_or("sla_breached_flag").alias("_late")
    )
    pay = t["fact_payments"].groupBy("order_id").agg(F.sum(fee()).alias("_fee"))
    back = t["fact_returns"].groupBy("order_id").agg(F.sum("refund_amount").alias("_refund"))
    head = orders_completed(t).select("order_id", "customer_id", "geo_id", "order_ts", "order_dt", "order_status", "channel", "currency")
    joined = head
    for part in (lines, ship, pay, back):
        joined = joined.join(part, "order_id", "left")
    return pnl_of(joined, head.columns)


def pnl_of(joined: DataFrame, head: list[str]) -> DataFrame:
    """The P&L from completed orders (columns ``head``) beside the sums of their facts."""
    rev, cogs, disc = zero("_revenue"), zero("_cogs"), zero("_discount")
    base = joined.select(
        *head,
        rev.alias("revenue_ex_tax"), disc.alias("discount_amount"), zero("_tax").alias("tax_amount"), cogs.alias("cogs"),
        zero("_ship").alias("shipping_cost"), zero("_fee").alias("gateway_fee_amount"), zero("_refund").alias("refund_amount"),
        (rev - cogs).alias("gross_profit_ex_tax"),
        F.coalesce("_late", F.lit(False)).alias("sla_breached_flag"),
    )
    net = F.col("gross_profit_ex_tax") - F.col("shipping_cost") - F.col("gateway_fee_amount") - F.col("refund_amount")
    return base.withColumn("net_profit_ex_tax", net).select(
        "*",
        pct0("gross_profit_ex_tax", "revenue_ex_tax", 4).alias("gross_margin_pct"),
        pct0("net_profit_ex_tax", "revenue_ex_tax", 4).alias("net_margin_pct"),
        (F.col("refund_amount") > 0).alias("has_return_flag"),
        _heavy(F.col("revenue_ex_tax"), F.col("discount_amount")).alias("discount_heavy_flag"),
        (F.col("net_profit_ex_tax") < 0).alias("loss_order_flag"),
    )


def _order_costs(t: Tables, dedup: bool) -> DataFrame:
    """Shipping and fees per completed order.

    The published figures join shipments, payments and returns before summing,
    so each sum repeats by the row counts of the other two. The same product is
    formed here from per-order sums and counts; ``dedup=True`` leaves it out.
    """
    ship = t["fact_shipments"].groupBy("order_id").agg(F.sum("shipping_cost").alias("_ship"), rows().alias("_ships"))
    pay = t["fact_payments"].groupBy("order_id").agg(F.sum(fee()).alias("_fee"), rows().alias("_pays"))
    back = t["fact_returns"].groupBy("order_id").agg(rows().alias("_backs"))
    joined = orders_completed(t).select("order_id")
    for part in (ship, pay) if dedup else (ship, pay, back):
        joined = joined.join(part, "order_id", "left")
    one = F.lit(1)

    def times(c: str) -> Column:
        return F.coalesce(F.col(c), one)

    ship_x = one if dedup else times("_pays") * times("_backs")
    fee_x = one if dedup else times("_ships") * times("_backs")
    return joined.select(
        "order_id", (zero("_ship") * ship_x).alias("_ship_cost"), (zero("_fee") * fee_x).alias("_gateway_fee")
    )


def item_pnl(t: Tables, dedup: bool = False) -> DataFrame:
    """One row per line of a completed order, with order costs shared out by revenue.

    A line returned twice yields two rows, as published; ``dedup=True`` sums
    its refunds first. The sums per order are written down while the plan is
    built: read back they are exchanged for the join like the lines, and so an
    order with very many lines is split at run time.
    """
    lines = t["fact_order_items"]
    totals = lines.groupBy("order_id").agg(F.sum(F.col("qty") * F.col("unit_sell_price")).alias("_order_revenue"))
    per_order = cut(_order_costs(t, dedup).join(totals, "order_id", "left"))
    back = t["fact_returns"].select("order_item_id", "refund_amount")
    if dedup:
        back = back.groupBy("order_item_id").agg(F.sum("refund_amount").alias("refund_amount"))
    joined = (
        lines.join(per_order, "order_id")
        .join(back, "order_item_id", "left")
        .join(t["dim_product"].select("product_id", "category_l1", "category_l2", "brand"), "product_id")
    )
    revenue, cogs = F.col("qty") * F.col("unit_sell_price"), F.col("qty") * F.col("unit_cost")
    share = divide(revenue, "_order_revenue")
    has_revenue = zero("_order_revenue") > 0

    def shared(cost: str) -> Column:
        return F.when(has_revenue, F.col(cost).cast("double") * share).otherwise(F.lit(0.0))

    refund = zero("refund_amount")
    net = (revenue - cogs).cast("double") - shared("_ship_cost") - shared("_gateway_fee") - refund.cast("double")
    return joined.select(
        "order_item_id", "order_id", "product_id", "category_l1", "category_l2", "brand", "qty",
        "unit_list_price", "unit_sell_price", "unit_cost", "line_discount", "line_tax",
        revenue.alias("line_revenue_ex_tax"), cogs.alias("line_cogs"), (revenue - cogs).alias("line_gross_profit_ex_tax"),
        refund.alias("line_refund_amount"),
        rounded(shared("_ship_cost"), 2).alias("alloc_shipping_cost"),
        rounded(shared("_gateway_fee"), 2).alias("alloc_gateway_fee"),
        net.cast(WIDE).alias("line_net_profit_ex_tax"),
        (refund > 0).alias("return_leakage_flag"),
        _heavy(revenue, F.col("line_discount")).alias("discount_heavy_flag"),
    )


def product_pnl(t: Tables, dedup: bool = False) -> DataFrame:
    out = item_pnl(t, dedup).groupBy("product_id", "category_l1", "category_l2", "brand").agg(
        F.sum("line_revenue_ex_tax").alias("revenue_ex_tax"),
        F.sum("line_cogs").alias("cogs"),
        F.sum("line_gross_profit_ex_tax").alias("gross_profit_ex_tax"),
        F.sum("alloc_shipping_cost").alias("shipping_cost"),
        F.sum("alloc_gateway_fee").alias("gateway_fee_amount"),
        F.sum("line_refund_amount").alias("refund_amount"),
        F.sum("line_net_profit_ex_tax").alias("net_profit_ex_tax"),
    )
    return out.select(
        "*", pct0("net_profit_ex_tax", "revenue_ex_tax", 4).alias("net_margin_pct"),
        (F.col("net_profit_ex_tax") < 0).alias("loss_product_flag"),
    )


def customer_pnl(t: Tables) -> DataFrame:
    per = order_pnl(t).groupBy("customer_id").agg(rows().alias("orders"), *[F.sum(c).alias(c) for c in SUMS])
    place = t["dim_customer"].select("customer_id", "acquisition_channel", "geo_id").join(
        t["dim_geo"].select("geo_id", "region", "country"), "geo_id"
    )
    return per.join(place, "customer_id").select(
        "customer_id", "acquisition_channel", "region", "country", "orders", *SUMS,
        pct0("net_profit_ex_tax", "revenue_ex_tax", 4).alias("net_margin_pct"),
        (F.col("net_profit_ex_tax") < 0).alias("loss_customer_flag"),
    )


def summary(t: Tables) -> DataFrame:
    sums = order_pnl(t).agg(
        rows().alias("orders"),
        *[total(c).alias(c) for c in SUMS],
        F.count_if("loss_order_flag").alias("loss_orders"),
        F.count_if("discount_heavy_flag").alias("discount_heavy_orders"),
        F.count_if("has_return_flag").alias("return_orders"),
        F.count_if("sla_breached_flag").alias("sla_breached_orders"),
    )
    return sums.select(
        "*", pct0("gross_profit_ex_tax", "revenue_ex_tax", 4).alias("gross_margin_pct"),
        pct0("net_profit_ex_tax", "revenue_ex_tax", 4).alias("net_margin_pct"),
    )


def loss_orders(t: Tables, limit: int | None = 50, offset: int = 0) -> DataFrame:
    check_limit(limit, 200)
    bad = order_pnl(t).where("loss_order_flag").select(
        "order_id", "customer_id", "order_ts", "order_status", *SUMS, "discount_amount",
        "loss_order_flag", "discount_heavy_flag", "has_return_flag", "sla_breached_flag",
    )
    return page(bad, [F.col("net_profit_ex_tax"), F.col("order_id")], limit, offset)


def top_products(t: Tables, limit: int | None = 50, offset: int = 0) -> DataFrame:
    check_limit(limit, 200)
    best = page(product_pnl(t), [F.col("net_profit_ex_tax").desc(), F.col("product_id")], limit, offset)
    named = best.join(t["dim_product"].select("product_id", "product_name"), "product_id")
    return named.select(
        "product_id", "product_name", "category_l1", "category_l2", "brand", "revenue_ex_tax", "net_profit_ex_tax", "net_margin_pct", "loss_product_flag"
    ).orderBy(F.col("net_profit_ex_tax").desc(), "product_id")


def top_customers(t: Tables, limit: int | None = 50, offset: int = 0) -> DataFrame:
    check_limit(limit, 200)
    cols = ("customer_id", "acquisition_channel", "region", "country", "orders", "revenue_ex_tax", "net_profit_ex_tax", "net_margin_pct", "loss_customer_flag")
    return page(customer_pnl(t).select(*cols), [F.col("net_profit_ex_tax").desc(), F.col("customer_id")], limit, offset)
