"""KPI snapshots in long form, the latest one, and the before/after comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.expr import attach, pct, ratio, side_by_side, total, zero
from ledgerloom.operators import finance, funnel
from ledgerloom.operators.views import Tables, is_failed, orders_completed

# Snapshot metrics in their published order.
METRICS = (
    "net_revenue_total", "orders_total", "refund_amount_total", "shipping_cost_total", "cogs_total", "gateway_fee_total",
    "gross_profit_total", "net_profit_total", "gross_margin_pct", "net_margin_pct", "loss_orders_total", "conversion_rate",
    "cart_abandonment_rate", "payment_failure_rate", "revenue_lost_due_to_failures", "revenue_lost_due_to_abandonment",
)
COMPARED = ("net_revenue_total", "orders_total", "refund_amount_total", "shipping_cost_total")


def _funnel_metrics(t: Tables) -> DataFrame:
    """All-time session rates and losses; zeros when the warehouse has no event table."""
    names = ("conversion_rate", "cart_abandonment_rate", "payment_failure_rate", "revenue_lost_due_to_failures", "revenue_lost_due_to_abandonment")
    if "fact_funnel_events" not in t:
        return t["fact_orders"].agg(*[F.count(F.lit(None)).alias(n) for n in names])
    counted = funnel.session_flags(t["fact_funnel_events"], "session_id").agg(*funnel.stage_counts(), F.count_if("pay_failed").alias("failed"))
    leak = funnel.revenue_leakage(t)
    return side_by_side(counted, leak).select(
        zero(ratio("orders_placed", "product_views", 4)).alias(names[0]),
        zero(ratio(F.col("add_to_cart") - F.col("checkout_started"), "add_to_cart", 4)).alias(names[1]),
        zero(ratio("failed", "payment_attempts", 4)).alias(names[2]),
        F.col("revenue_lost_payment_failures").alias(names[3]),
        F.col("revenue_lost_cart_abandonment").alias(names[4]),
    )


def _order_metrics(t: Tables) -> DataFrame:
    """All metrics of orders and their facts, as one row. Each fact is read once: summed per order, put together by union, and counted by order."""
    qty = F.col("qty")
    parts = [
        orders_completed(t).select("order_id", (F.col("net_amount") - F.col("tax_amount")).alias("net"), F.lit(1).alias("done")),
        t["fact_order_items"].groupBy("order_id").agg(F.sum(qty * F.col("unit_sell_price")).alias("revenue"), F.sum(qty * F.col("unit_cost")).alias("cogs")),
        t["fact_payments"].groupBy("order_id").agg(F.sum(finance.fee()).alias("fee"), F.sum(F.when(~is_failed(), F.col("gateway_fee_amount"))).alias("paid_fee")),
        t["fact_returns"].groupBy("order_id").agg(F.sum("refund_amount").alias("refund")),
        t["fact_shipments"].groupBy("order_id").agg(F.sum("shipping_cost").alias("shipping")),
    ]
    sums = ("net", "done", "revenue", "cogs", "fee", "paid_fee", "refund", "shipping")
    per = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).groupBy("order_id").agg(*[F.sum(c).alias(c) for c in sums])
    done = F.col("done") > 0
    of_done = lambda c: total(F.when(done, F.col(c)))
    profit = zero("revenue") - zero("cogs") - zero("shipping") - zero("fee") - zero("refund")
    return per.agg(
        of_done("net").alias("net_revenue_total"), F.count_if(done).alias("orders_total"), total("refund").alias("refund_amount_total"), total("shipping").alias("shipping_cost_total"),
        of_done("cogs").alias("cogs_total"), of_done("paid_fee").alias("gateway_fee_total"), F.count_if(done & (profit < 0)).alias("loss_orders_total"),
    )


def snapshot(t: Tables, label: str, snapshot_ts: str) -> DataFrame:
    """Sixteen metrics as (snapshot_ts, label, metric_name, metric_value) rows.

    The value column allows no NULL, so a margin or rate without a base is 0.
    """
    one = side_by_side(_order_metrics(t), _funnel_metrics(t))
    gross = F.col("net_revenue_total") - F.col("cogs_total")
    net = F.col("gross_profit_total") - F.col("shipping_cost_total") - F.col("gateway_fee_total") - F.col("refund_amount_total")
    one = one.withColumn("gross_profit_total", gross).withColumn("net_profit_total", net)
    one = one.withColumn("gross_margin_pct", zero(pct("gross_profit_total", "net_revenue_total", 4)))
    one = one.withColumn("net_margin_pct", zero(pct("net_profit_total", "net_revenue_total", 4)))
    wide = one.select(*[F.col(m).cast("decimal(20,4)").alias(m) for m in METRICS])
    return wide.unpivot([], list(METRICS), "metric_name", "metric_value").select(
        F.to_timestamp(F.lit(snapshot_ts)).alias("snapshot_ts"), F.lit(label).alias("label"), "metric_name", "metric_value"
    )


def latest(snapshots: DataFrame, label: str | None = None) -> DataFrame:
    """The rows of the newest snapshot, optionally of one label."""
    mine = snapshots if label is None else snapshots.where(F.col("label") == label)
    newest = mine.agg(F.max("snapshot_ts").alias("_ts"))
    return attach(mine, newest).where(F.col("snapshot_ts") == F.col("_ts")).drop("_ts")


def before_after(snapshots: DataFrame) -> DataFrame:
    """Latest 'before' against latest 'after': four metrics and their differences, one row if both exist."""
    wide = (
        snapshots.where(F.col("label").isin("before", "after"))
        .groupBy("label", "snapshot_ts").pivot("metric_name", list(COMPARED)).agg(F.max("metric_value"))
    )
    pick = wide.groupBy("label").agg(F.max_by(F.struct(*wide.columns), "snapshot_ts").alias("s"))
    short = {"net_revenue_total": "net_revenue", "orders_total": "orders", "refund_amount_total": "refunds", "shipping_cost_total": "shipping_cost"}
    sides = [
        pick.where(F.col("label") == side).select(
            F.col("s.snapshot_ts").alias(f"{side}_snapshot_ts"), *[F.col(f"s.{m}").alias(f"{side}_{short[m]}_total") for m in COMPARED]
        )
        for side in ("before", "after")
    ]
    both = side_by_side(*sides).where("before_snapshot_ts is not null and after_snapshot_ts is not null")
    return both.select("*", *[(F.col(f"after_{s}_total") - F.col(f"before_{s}_total")).alias(f"delta_{s}") for s in short.values()])


