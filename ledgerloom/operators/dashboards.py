"""Data behind the dashboard pages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.expr import attach, divide, listed, pct, rows, share_if, total, zero
from ledgerloom.operators import finance, kpis, measures
from ledgerloom.operators.measures import Marts
from ledgerloom.operators.views import Tables, is_failed, orders_completed

# Alert thresholds in percent.
SLA_ALERT, RETURN_ALERT, PAYMENT_ALERT = 8.0, 6.0, 4.0


def growth_drivers(t: Tables) -> DataFrame:
    """Net revenue drilled from category to channel to country, with subtotals.

    Lines shrink to (order, product) sums, then to the finest slice; the
    subtotals are formed from those few rows.
    """
    lines = t["fact_order_items"].groupBy("order_id", "product_id").agg(F.sum(F.col("qty") * F.col("unit_sell_price")).alias("r"))
    head = orders_completed(t).select("order_id", "channel", "geo_id")
    place = t["dim_geo"].select("geo_id", "country")
    per_product = lines.join(head, "order_id").groupBy("product_id", "channel", "geo_id").agg(F.sum("r").alias("r"))
    finest = (
        per_product.join(t["dim_product"].select("product_id", "category_l1"), "product_id").join(place, "geo_id")
        .groupBy("category_l1", "channel", "country").agg(F.sum("r").alias("r"))
    )
    return finest.rollup("category_l1", "channel", "country").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("r").alias("net_revenue")
    )


def moving_average(marts: Marts) -> DataFrame:
    """7- and 30-day moving averages over the full calendar (one row per day reaches the window)."""
    d = measures.daily_net_revenue(marts).select("dt", F.col("net_revenue").cast("decimal(24,2)").alias("net_revenue"))

    def mean(days: int) -> Column:
        w = Window.orderBy("dt").rowsBetween(-(days - 1), 0)
        return F.sum("net_revenue").over(w).cast("double") / F.count("net_revenue").over(w)

    return d.select("dt", "net_revenue", mean(7).alias("ma_7"), mean(30).alias("ma_30"))


def _waterfall(marts: Marts, names: Sequence[str]) -> DataFrame:
    """First measure minus the others, as ordered steps with a running level."""
    one = measures.measure(marts, names)
    signed = [F.col(names[0]), *[-F.col(n) for n in names[1:]]]
    steps = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("label"), zero(v).alias("amount")) for i, (n, v) in enumerate(zip(names, signed))])
    long = one.select(F.inline(steps))
    return long.withColumn("level", F.sum("amount").over(Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)))  # a handful of steps


def waterfall(marts: Marts) -> DataFrame:
    return _waterfall(marts, ("net_revenue", "discount_amount", "shipping_cost", "refund_amount", "gateway_fees"))


def funnel_waterfall(marts: Marts) -> DataFrame:
    return _waterfall(marts, ("net_revenue", "revenue_lost_cart_abandonment", "revenue_at_risk", "refund_amount"))


def funnel_breakdown(marts: Marts) -> DataFrame:
    """Conversion for every combination of channel and device, with subtotals."""
    m = marts["mart_funnel_conversion"]
    cubed = m.cube("channel", "device").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("product_views").alias("product_views"), F.sum("orders_placed").alias("orders_placed")
    )
    return cubed.withColumn("conversion_rate", divide("orders_placed", "product_views"))


def category_leakage(marts: Marts) -> DataFrame:
    return measures.measure(marts, ["revenue_lost_cart_abandonment", "revenue_at_risk"], ["category_l1", "category_l2"])


def rule_segments(marts: Marts, as_of: str) -> DataFrame:
    """Overlapping rule segments per customer: all labels met, and the first one.

    High-value asks for the top quartile and revenue above the mean customer's.
    """
    seg = marts["mart_customer_segments"]
    recency = F.date_diff(F.to_date(F.lit(as_of)), "last_order_dt")
    mean = seg.agg(F.avg("revenue_ex_tax").cast("double").alias("_mean"))
    n, q, rev = F.col("orders"), F.col("value_quartile"), F.col("revenue_ex_tax")
    rules = {
        "New": (n == 1) & (recency <= 30),
        "Returning": (n >= 2) & (recency <= 60),
        "Loyal": (n >= 3) & (q == 1),
        "Churn-risk": (n >= 2) & (recency > 60),
        "High-value": (q == 1) & (rev.cast("double") > F.col("_mean")),
    }
    labels = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]), lambda x: x.isNotNull())
    return attach(seg, mean).select("customer_id", labels.alias("labels")).select(
        "customer_id", F.array_join("labels", ",").alias("labels"), F.get("labels", F.lit(0)).alias("first_label")
    )


def segment_counts(marts: Marts, by: Sequence[str] = ("lifecycle_segment",)) -> DataFrame:
    return marts["mart_customer_segments"].groupBy(*by).agg(
        rows().alias("customers"), F.sum("revenue_ex_tax").alias("revenue_ex_tax"), F.sum("net_profit_ex_tax").alias("net_profit_ex_tax")
    )


def heatmap(marts: Marts, columns: Sequence[str], value: str = "revenue_ex_tax") -> DataFrame:
    """Category l1 by l2 matrix for the given l2 values; 0 where a pair has no sales, an error for any other l2 value."""
    per = heatmap_long(marts, value).withColumn("category_l2", listed("category_l2", columns))
    return per.groupBy("category_l1").pivot("category_l2", list(columns)).agg(F.sum(value)).na.fill(0)


def heatmap_long(marts: Marts, value: str = "revenue_ex_tax") -> DataFrame:
    """A row for each pair of categories that there is."""
    return marts["mart_product_performance"].groupBy("category_l1", "category_l2").agg(F.sum(value).alias(value))


def dead_stock(marts: Marts, t: Tables, limit: int = 20) -> DataFrame:
    """Products that sell least, unsold ones included."""
    sold = marts["mart_product_performance"].groupBy("product_id").agg(F.sum("units_sold").alias("units"), F.sum("revenue_ex_tax").alias("revenue"))
    j = t["dim_product"].select("product_id", "product_name").join(sold, "product_id", "left")
    units = zero("units")
    return j.select("product_id", "product_name", units.alias("units_sold"), zero("revenue").alias("revenue_ex_tax")).orderBy("units_sold", "product_id").limit(limit)


def high_return_rate(marts: Marts, limit: int = 20) -> DataFrame:
    """Products by returned lines per unit sold, highest first."""
    per = marts["mart_product_performance"].groupBy("product_id").agg(F.sum("return_lines").alias("return_lines"), F.sum("units_sold").alias("units_sold"))
    rate = divide("return_lines", "units_sold")
    return per.withColumn("return_rate", rate).orderBy(F.col("return_rate").desc_nulls_last(), "product_id").limit(limit)


def sla_by_fc(t: Tables) -> DataFrame:
    per = t["fact_shipments"].groupBy("fc_id").agg(rows().alias("shipments"), share_if(F.col("sla_breached_flag"), 2).alias("sla_breach_pct"))
    return per.join(t["dim_fc"].select("fc_id", "fc_name"), "fc_id")


def shipping_matrix(t: Tables) -> DataFrame:
    """Shipping cost by fulfilment centre and lane (its region to the order's region)."""
    head = t["fact_orders"].select("order_id", F.col("geo_id").alias("to_geo"))
    per = (
        t["fact_shipments"].groupBy("order_id", "fc_id").agg(F.sum("shipping_cost").alias("c"), rows().alias("n"))
        .join(head, "order_id").groupBy("fc_id", "to_geo").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))
    )
    geo = t["dim_geo"].select("geo_id", "region")
    fc = t["dim_fc"].select("fc_id", "fc_name", "geo_id").join(geo, "geo_id").select("fc_id", "fc_name", F.col("region").alias("from_region"))
    dest = geo.select(F.col("geo_id").alias("to_geo"), F.col("region").alias("to_region"))
    return per.join(fc, "fc_id").join(dest, "to_geo").groupBy("fc_name", "from_region", "to_region").agg(
        F.sum("n").alias("shipments"), F.sum("c").alias("shipping_cost")
    )


def failures_by(t: Tables) -> DataFrame:
    """Failed payments by method, by provider and by reason, in one long table."""
    dims = ["payment_method", "payment_provider", "failure_reason"]
    per = t["fact_payments"].where(is_failed()).groupBy(*dims).agg(rows().alias("n"), F.sum("amount").alias("a"))
    long = per.unpivot(["n", "a"], dims, "dimension", "value")
    return long.groupBy("dimension", "value").agg(F.sum("n").alias("failed_payments"), F.sum("a").alias("amount"))


def alerts(t: Tables) -> DataFrame:
    """Carriers, centres, categories and methods beyond their thresholds."""
    def over(df: DataFrame, kind: str, name: str, metric: str, limit: float) -> DataFrame:
        return df.where(F.col(metric) > limit).select(
            F.lit(kind).alias("alert"), F.col(name).alias("subject"), F.col(metric).cast("double").alias("value"), F.lit(limit).alias("threshold")
        )

    parts = [
        over(kpis.sla_by_carrier(t), "SLA_CARRIER", "carrier", "sla_breach_pct", SLA_ALERT),
        over(sla_by_fc(t), "SLA_FC", "fc_name", "sla_breach_pct", SLA_ALERT),
        over(kpis.return_rate(t), "RETURN_RATE", "category_l1", "return_rate_proxy_pct", RETURN_ALERT),
        over(kpis.payment_failure(t), "PAYMENT_FAILURE", "payment_method", "failure_pct", PAYMENT_ALERT),
    ]
    return reduce(DataFrame.unionByName, parts)


def margin_by(marts: Marts, by: Sequence[str]) -> DataFrame:
    return measures.measure(marts, ["net_revenue", "net_profit", "net_margin"], by)


def discount_heavy_products(t: Tables, limit: int = 20) -> DataFrame:
    """Products by the share of their lines that carry a heavy discount."""
    items = finance.item_pnl(t).groupBy("product_id").agg(rows().alias("lines"), F.count_if("discount_heavy_flag").alias("heavy_lines"))
    return items.withColumn("heavy_pct", pct("heavy_lines", "lines", 4)).orderBy(F.col("heavy_pct").desc(), "product_id").limit(limit)


def refund_trend(t: Tables) -> DataFrame:
    return t["fact_returns"].groupBy(F.to_date("return_ts").alias("dt")).agg(total("refund_amount").alias("refund_amount"), rows().alias("return_lines"))
