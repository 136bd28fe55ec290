"""The KPI pack: twenty business questions over the views.

Line facts are summed per product before the product join, so the join and any
hot product see one row per product and task instead of every line. Order ids
are the key of their table, so orders are counted, not de-duplicated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import month_of
from ledgerloom.functions.expr import pct, rows, share_if, side_by_side, since, zero
from ledgerloom.operators.views import Tables, is_failed, orders_completed, with_product


def monthly_revenue(t: Tables) -> DataFrame:
    return orders_completed(t).groupBy(month_of("order_ts").alias("month")).agg(rows().alias("orders"), F.sum("net_amount").alias("net_revenue"))


def mom_growth(t: Tables) -> DataFrame:
    # One row per calendar month reaches the unpartitioned window.
    m = monthly_revenue(t).select("month", "net_revenue")
    prev = F.lag("net_revenue").over(Window.orderBy("month"))
    return m.select("month", "net_revenue", pct(F.col("net_revenue") - prev, prev, 2).alias("mom_growth_pct"))


def daily_revenue(t: Tables) -> DataFrame:
    return orders_completed(t).groupBy(F.col("order_dt").alias("dt")).agg(F.sum("net_amount").alias("rev"))


def rolling_7d(t: Tables) -> DataFrame:
    """Sum over the last seven days that had sales (a row frame: missing days are not filled)."""
    w = Window.orderBy("dt").rowsBetween(-6, 0)  # one row per calendar day
    return daily_revenue(t).select("dt", "rev", F.sum("rev").over(w).alias("rolling_7d_rev"))


def product_revenue(t: Tables) -> DataFrame:
    per_product = t["fact_order_items"].groupBy("product_id").agg(F.sum("line_net_revenue").alias("revenue"))
    return with_product(per_product, t, "product_name", "category_l1")


def top_products(t: Tables, n: int = 10, best: bool = True) -> DataFrame:
    rev = F.col("revenue").desc_nulls_last() if best else F.col("revenue").asc_nulls_last()
    return product_revenue(t).select("product_id", "product_name", "revenue").orderBy(rev, "product_id").limit(n)


def _category_sums(t: Tables) -> DataFrame:
    lines = t["fact_order_items"]
    per_product = lines.groupBy("product_id").agg(
        F.sum("line_net_revenue").alias("revenue"),
        F.sum(F.col("qty") * F.col("unit_cost")).alias("cogs"),
        F.sum("line_discount").alias("discount"),
        F.sum("qty").alias("qty"),
    )
    return with_product(per_product, t, "category_l1").groupBy("category_l1").agg(
        F.sum("revenue").alias("revenue"), F.sum("cogs").alias("cogs"), F.sum("discount").alias("discount"), F.sum("qty").alias("qty")
    )


def category_margin(t: Tables) -> DataFrame:
    profit = F.col("revenue") - F.col("cogs")
    return _category_sums(t).select(
        "category_l1", "revenue", "cogs", profit.alias("gross_profit"), pct(profit, "revenue", 2).alias("gross_margin_pct")
    )


def category_discount(t: Tables) -> DataFrame:
    gross = F.col("revenue") + F.col("discount")
    return _category_sums(t).select(
        "category_l1", F.col("discount").alias("total_discount"), gross.alias("gross_sales_before_discount"),
        pct("discount", gross, 2).alias("discount_pct"),
    )


def active_customers(t: Tables, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return orders_completed(t).groupBy(month_of("order_ts").alias("month")).agg(distinct(F.col("customer_id")).alias("active_customers"))


def repeat_pct(t: Tables) -> DataFrame:
    per_customer = orders_completed(t).groupBy("customer_id").agg(rows().alias("orders"))
    return per_customer.agg(share_if(F.col("orders") >= 2, 2).alias("repeat_customer_pct"))


def last_orders(t: Tables) -> DataFrame:
    return orders_completed(t).groupBy("customer_id").agg(F.max("order_ts").alias("last_order_ts"))


def churned(t: Tables, as_of: str, days: int = 90) -> DataFrame:
    return last_orders(t).where(~since("last_order_ts", as_of, days)).agg(rows().alias("churned_customers"))


def cohort_retention(t: Tables) -> DataFrame:
    """Distinct customers by first-purchase month and months since.

    Purchases are reduced to (customer, month) first, so a customer with a
    huge history is a handful of rows when joined to their cohort.
    """
    active = orders_completed(t).select("customer_id", month_of("order_ts").alias("active_month")).distinct()
    born = active.groupBy("customer_id").agg(F.min("active_month").alias("cohort_month"))
    gap = (F.year("active_month") - F.year("cohort_month")) * 12 + F.month("active_month") - F.month("cohort_month")
    return (
        active.join(born, "customer_id")
        .groupBy("cohort_month", gap.alias("months_since_cohort"))
        .agg(rows().alias("customers"))
    )


def sla_by_carrier(t: Tables) -> DataFrame:
    known = t["fact_shipments"].join(t["dim_fc"].select("fc_id"), "fc_id")
    return known.groupBy("carrier").agg(
        rows().alias("shipments"), share_if(F.col("sla_breached_flag"), 2).alias("sla_breach_pct"), F.sum("shipping_cost").alias("shipping_cost")
    )


def shipping_pct(t: Tables, dedup: bool = False) -> DataFrame:
    """Shipping as a share of revenue over shipped orders.

    An order with several shipments counts its revenue once per shipment;
    ``dedup=True`` counts it once.
    """
    ship = t["fact_shipments"].groupBy("order_id").agg(F.sum("shipping_cost").alias("cost"), rows().alias("parcels"))
    weight = F.lit(1) if dedup else F.col("parcels")
    joined = ship.join(orders_completed(t).select("order_id", "net_amount"), "order_id")
    return joined.agg(pct(F.sum("cost"), F.sum(F.col("net_amount") * weight), 2).alias("shipping_cost_pct_of_revenue"))


def return_rate(t: Tables) -> DataFrame:
    back = t["fact_returns"].groupBy("product_id").agg(rows().alias("lines"))
    back = with_product(back, t, "category_l1").groupBy("category_l1").agg(F.sum("lines").alias("return_lines"))
    lines = zero("return_lines")
    return (
        _category_sums(t)
        .select("category_l1", F.col("qty").alias("sold_qty"))
        .join(back, "category_l1", "left")
        .select("category_l1", "sold_qty", lines.alias("return_lines"), pct(lines, "sold_qty", 2).alias("return_rate_proxy_pct"))
    )


def return_reasons(t: Tables, n: int = 10) -> DataFrame:
    per = t["fact_returns"].groupBy("product_id", "return_reason").agg(rows().alias("lines"))
    known = per.join(t["dim_product"].select("product_id"), "product_id")
    out = known.groupBy("return_reason").agg(F.sum("lines").alias("returns"))
    return out.orderBy(F.col("returns").desc(), "return_reason").limit(n)


def monthly_refunds(t: Tables) -> DataFrame:
    per = t["fact_returns"].groupBy("product_id", month_of("return_ts").alias("month")).agg(F.sum("refund_amount").alias("refunds"))
    known = per.join(t["dim_product"].select("product_id"), "product_id")
    return known.groupBy("month").agg(F.sum("refunds").alias("total_refunds"))


def payment_failure(t: Tables) -> DataFrame:
    return t["fact_payments"].groupBy("payment_method").agg(
        rows().alias("total_attempts"), share_if(is_failed(), 2).alias("failure_pct")
    )


def chargeback(t: Tables) -> DataFrame:
    return t["fact_payments"].agg(share_if(F.col("chargeback_flag"), 3).alias("chargeback_pct"))


def top3_per_category(t: Tables, k: int = 3) -> DataFrame:
    """Best k revenue ranks per category; the rank limit is applied before the shuffle as well as after."""
    w = Window.partitionBy("category_l1").orderBy(F.col("revenue").desc())
    ranked = product_revenue(t).withColumn("rnk", F.dense_rank().over(w)).where(F.col("rnk") <= k)
    return ranked.select("category_l1", "product_id", "product_name", "revenue", "rnk")


def leakage_breakdown(t: Tables) -> DataFrame:
    orders = orders_completed(t).agg(F.sum("net_amount").alias("net_rev"), F.sum("discount_amount").alias("discounts"))
    ship = t["fact_shipments"].agg(F.sum("shipping_cost").alias("shipping_cost"))
    back = t["fact_returns"].agg(F.sum("refund_amount").alias("refunds"))
    leak = F.col("discounts") + F.col("shipping_cost") + F.col("refunds")
    return side_by_side(orders, ship, back).select("*", leak.alias("leakage_total"))
