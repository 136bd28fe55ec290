"""BI measures over the marts, sliceable by any dimension a mart can reach."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.expr import attach, divide, zero
from ledgerloom.functions.ranking import running
from ledgerloom.session import cut

Marts = Mapping[str, DataFrame]

# Base measures as mart -> {measure: aggregate}. Orders and customers are counted by
# row: one row per order and per customer is the grain of their marts.
BASE: dict[str, dict[str, str]] = {
    "mart_finance_profitability": {
        "net_revenue": "sum(revenue_ex_tax)", "orders": "count(order_id)", "cogs": "sum(cogs)",
        "gross_profit": "sum(gross_profit_ex_tax)", "net_profit": "sum(net_profit_ex_tax)",
    },
    "mart_exec_daily_kpis": {
        "refund_amount": "sum(refund_amount_return_dt)", "return_lines": "sum(return_lines)", "shipping_cost": "sum(shipping_cost_attrib)",
        "sla_breach_pct": "avg(cast(sla_breach_pct as decimal(18,4)))", "active_customers_daily": "sum(active_customers)",
        "discount_amount": "sum(discount_amount)", "gateway_fees": "sum(gateway_fee_amount)",
    },
    "mart_customer_segments": {
        "customers": "count(customer_id)", "repeat_customers": "count_if(repeat_customer_flag)", "ltv_estimate": "avg(revenue_ex_tax)",
        "frequency": "sum(orders)", "monetary": "sum(revenue_ex_tax)",
    },
    "mart_funnel_conversion": {
        "product_views": "sum(product_views)", "add_to_cart": "sum(add_to_cart)", "checkout_started": "sum(checkout_started)",
        "payment_attempts": "sum(payment_attempts)", "orders_placed": "sum(orders_placed)",
        "cart_abandonment_rate": "avg(cast(cart_abandonment_rate as decimal(18,4)))",
        "payment_failure_rate": "avg(cast(payment_failure_rate as decimal(18,4)))",
    },
    "mart_product_performance": {
        "revenue_lost_cart_abandonment": "sum(revenue_lost_cart_abandonment)", "revenue_at_risk": "sum(revenue_at_risk_ex_tax)",
        "product_revenue": "sum(revenue_ex_tax)", "product_units_sold": "sum(units_sold)",
        "product_gross_profit": "sum(gross_profit_ex_tax)", "product_return_lines": "sum(return_lines)",
    },
}
# Derived measures as (measures used, Spark expression over them). try_divide gives NULL on 0.
DERIVED: dict[str, tuple[tuple[str, ...], str]] = {
    "aov": (("net_revenue", "orders"), "try_divide(net_revenue, orders)"),
    "gross_margin": (("gross_profit", "net_revenue"), "try_divide(gross_profit, net_revenue)"),
    "net_margin": (("net_profit", "net_revenue"), "try_divide(net_profit, net_revenue)"),
    "contribution_profit": (("net_profit",), "net_profit"),
    "shipping_cost_pct_of_revenue": (("shipping_cost", "net_revenue"), "try_divide(shipping_cost, net_revenue)"),
    "repeat_purchase_rate": (("repeat_customers", "customers"), "try_divide(repeat_customers, customers)"),
    "ltv_horizon": (("aov", "repeat_purchase_rate"), "aov * (1 + repeat_purchase_rate)"),
    "leakage_total": (
        ("discount_amount", "shipping_cost", "refund_amount", "gateway_fees"), "discount_amount + shipping_cost + refund_amount + gateway_fees",
    ),
    "conversion_rate": (("orders_placed", "product_views"), "try_divide(orders_placed, product_views)"),
    "net_revenue_after_leakage": (
        ("net_revenue", "leakage_total", "revenue_lost_cart_abandonment", "revenue_at_risk"),
        "net_revenue - leakage_total - revenue_lost_cart_abandonment - revenue_at_risk",
    ),
    "return_rate": (("product_return_lines", "product_units_sold"), "try_divide(product_return_lines, product_units_sold)"),
    "refund_pct_of_revenue": (("refund_amount", "net_revenue"), "try_divide(refund_amount, net_revenue)"),
}
_BASE_NAMES = {m for ms in BASE.values() for m in ms}


def _closure(names: Sequence[str]) -> set[str]:
    """The measures asked for and everything they are made from."""
    out: set[str] = set()
    for name in names:
        if name not in DERIVED and name not in _BASE_NAMES:
            raise ValueError(f"unknown measure {name!r}")
        out |= {name} | (_closure(DERIVED[name][0]) if name in DERIVED else set())
    return out


def _with_dimensions(mart: DataFrame, by: Sequence[str], dims: Marts, label: str) -> DataFrame:
    """Join the date or geography dimension when a slice asks for its columns."""
    for dim, key in (("dim_date", "date_id"), ("dim_geo", "geo_id")):
        wanted = [c for c in by if c not in mart.columns and dim in dims and c in dims[dim].columns]
        if wanted and key in mart.columns:
            mart = mart.join(dims[dim].select(key, *wanted), key)
    missing = [c for c in by if c not in mart.columns]
    if missing:
        raise ValueError(f"{label} cannot be sliced by {missing}")
    return mart


def measure(marts: Marts, names: Sequence[str], by: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    """Measures by dimensions: one aggregation per mart involved, brought together by union, so that a NULL slice stays one row."""
    needed = _closure(names)
    by = list(by)
    sides = []
    for mart, defs in BASE.items():
        mine = [b for b in defs if b in needed]
        if mine:
            df = _with_dimensions(marts[mart], by, marts, mart)
            df = df if where is None else df.where(where)
            sides.append(df.groupBy(*by).agg(*[F.expr(defs[b]).cast("double").alias(b) for b in mine]))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    joined = stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in by])
    for name, (_, text) in DERIVED.items():
        if name in needed:
            joined = joined.withColumn(name, F.expr(text))
    return joined.select(*by, *names)


# ------------------------------------------------------------------ time intelligence
def daily_net_revenue(marts: Marts) -> DataFrame:
    """Net revenue on every calendar day of the executive mart, 0 where nothing sold."""
    return marts["mart_exec_daily_kpis"].select("date_id", F.col("kpi_dt").alias("dt"), F.col("revenue_ex_tax").alias("net_revenue"))


def to_date(marts: Marts) -> DataFrame:
    """Month-, quarter- and year-to-date revenue per day; each window holds at most a year of days."""
    d = daily_net_revenue(marts).select("dt", "net_revenue", F.year("dt").alias("y"), F.quarter("dt").alias("q"), F.month("dt").alias("m"))

    def run(*keys: str) -> Column:
        return F.sum("net_revenue").over(Window.partitionBy(*keys).orderBy("dt").rowsBetween(Window.unboundedPreceding, 0))

    return d.select("dt", "net_revenue", run("y", "m").alias("mtd"), run("y", "q").alias("qtd"), run("y").alias("ytd"))


def previous_periods(marts: Marts) -> DataFrame:
    """Revenue a month and a week earlier by date shift (month ends clamp), and growth against each."""
    d = daily_net_revenue(marts).select("dt", "net_revenue")
    out = d.withColumn("_m", F.add_months("dt", -1)).withColumn("_w", F.date_sub("dt", 7))
    for key, name in (("_m", "prev_month"), ("_w", "prev_week")):
        out = out.join(d.select(F.col("dt").alias(key), F.col("net_revenue").alias(name)), key, "left")
    now = F.col("net_revenue")
    return out.select(
        "dt", "net_revenue", "prev_month", divide(now - F.col("prev_month"), "prev_month").alias("growth_mom"),
        "prev_week", divide(now - F.col("prev_week"), "prev_week").alias("growth_wow"),
    )


def anomalies(marts: Marts, threshold: float = 2.0) -> DataFrame:
    """Z-score of each day against the population of days, and a 0/1 flag."""
    d = daily_net_revenue(marts).select("dt", "net_revenue")
    x = F.col("net_revenue").cast("double")
    stats = d.agg(F.avg(x).alias("_mu"), F.stddev_pop(x).alias("_sd"))
    z = divide(x - F.col("_mu"), "_sd")
    return attach(d, stats).select("dt", "net_revenue", z.alias("z"), zero((F.abs(z) >= threshold).cast("int")).alias("flag"))


# ------------------------------------------------------------------ customers and products
def rfm(marts: Marts, as_of: str) -> DataFrame:
    """Recency in days (NULL without orders), order count and revenue per customer."""
    return marts["mart_customer_segments"].select(
        "customer_id", F.date_diff(F.to_date(F.lit(as_of)), "last_order_dt").alias("recency_days"),
        F.col("orders").alias("frequency"), F.col("revenue_ex_tax").alias("monetary"),
    )


def churn_risk(marts: Marts, as_of: str, min_orders: int = 2, days: int = 60) -> DataFrame:
    r = rfm(marts, as_of)
    return r.agg(F.count_if((F.col("frequency") >= min_orders) & (F.col("recency_days") > days)).alias("churn_risk_customers"))


def pareto(marts: Marts) -> DataFrame:
    """Dense revenue rank, cumulative revenue and share (ties counted together) and ABC class per product.

    Ranks and running totals are taken over distinct revenue values, then
    given to every product with that value.
    """
    # Three uses below, so the per-product totals are written down once.
    per = cut(marts["mart_product_performance"].groupBy("product_id").agg(F.sum("revenue_ex_tax").alias("revenue")))
    values = per.groupBy("revenue").agg(F.sum("revenue").alias("tied"))
    ranked = running(values, [("revenue", True)], sums=["tied"]).select("revenue", F.col("row_no").alias("revenue_rank"), F.col("run_tied").alias("cumulative"))
    whole = per.agg(F.sum("revenue").alias("_all"))
    share = divide("cumulative", "_all")
    return attach(per.join(ranked, "revenue"), whole).select(
        "product_id", "revenue", "revenue_rank", "cumulative", share.alias("cumulative_pct"),
        F.when(share <= 0.8, "A").when(share <= 0.95, "B").otherwise("C").alias("abc_class"),
    )


def risk_index(marts: Marts, by: Sequence[str] = (), normalize: bool = False) -> DataFrame:
    """100 * (0.4 SLA + 0.3 refunds + 0.3 payment failures), gaps as 0.

    As published the SLA figure is on a 0-100 scale and the others on 0-1;
    ``normalize=True`` puts it on 0-1 too.
    """
    base = measure(marts, ["sla_breach_pct", "refund_pct_of_revenue", "payment_failure_rate"], by)
    sla = zero("sla_breach_pct") / (100.0 if normalize else 1.0)
    index = 100.0 * (0.40 * sla + 0.30 * zero("refund_pct_of_revenue") + 0.30 * zero("payment_failure_rate"))
    return base.withColumn("risk_index", index)
