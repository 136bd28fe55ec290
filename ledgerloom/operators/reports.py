"""Named result sets for exports and the management report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.expr import page, ratio, rows
from ledgerloom.operators import kpis, marts
from ledgerloom.operators.views import Tables, orders_completed, with_product


def returns_by_reason(t: Tables) -> DataFrame:
    per = t["fact_returns"].groupBy("product_id", "return_reason").agg(rows().alias("lines"), F.sum("refund_amount").alias("refunds"))
    return with_product(per, t, "category_l1").groupBy("category_l1", "return_reason").agg(
        F.sum("lines").alias("return_lines"), F.sum("refunds").alias("refund_amount")
    )


def kpi_exports(t: Tables) -> dict[str, DataFrame]:
    return {
        "monthly_revenue": kpis.monthly_revenue(t),
        "category_profit": kpis.category_margin(t),
        "carrier_sla": kpis.sla_by_carrier(t),
        "returns_by_reason": returns_by_reason(t),
        "payment_failures": kpis.payment_failure(t),
    }


def topline(t: Tables) -> DataFrame:
    sums = orders_completed(t).agg(rows().alias("orders"), F.sum("net_amount").alias("net_revenue"))
    return sums.select("orders", "net_revenue", ratio("net_revenue", "orders", 2).alias("aov"))


def report_tables(t: Tables) -> dict[str, DataFrame]:
    e = kpi_exports(t)
    return {
        "KPI_Summary": topline(t), "Monthly_Trend": e["monthly_revenue"], "Category_Profit": e["category_profit"],
        "Returns": e["returns_by_reason"], "SLA": e["carrier_sla"],
    }


def mart_export(t: Tables, name: str, limit: int | None = None) -> DataFrame:
    """One of the known marts; with a limit its first rows in the order of its columns."""
    key = (name or "").strip().lower()
    if key not in marts.MARTS:
        raise ValueError(f"unknown mart {name!r}; known: {sorted(marts.MARTS)}")
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    mart = marts.MARTS[key](t)
    return mart if limit is None else page(mart, [F.col(c) for c in mart.columns], limit)


