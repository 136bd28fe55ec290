"""Semantic views over the warehouse tables.

No view names a join strategy: the dimensions can outgrow a broadcast, so the
choice is left to the runtime sizes the optimizer sees.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]

# Status vocabularies.
COMPLETED_STATUSES = ("PLACED", "DELIVERED", "COMPLETED", "RETURNED")
FAILED_PAYMENTS = ("FAILED", "DECLINED")

# Column-restricted views, as view -> (table, columns).
PROJECTIONS: dict[str, tuple[str, str]] = {
    "vw_customer_products": ("dim_product", "product_id sku product_name category_l1 category_l2 brand unit_cost list_price"),
    "vw_customer_customers": ("dim_customer", "customer_id geo_id"),
    "vw_customer_geo": ("dim_geo", "geo_id"),
    "vw_customer_fc": ("dim_fc", "fc_id"),
    "vw_customer_orders": ("fact_orders", "order_id customer_id order_ts order_status net_amount"),
    "vw_customer_order_items_core": ("fact_order_items", "order_item_id order_id"),
    "vw_customer_payments": ("fact_payments", "payment_id"),
    "vw_customer_shipments": ("fact_shipments", "shipment_id"),
    "vw_customer_shipments_timeline": ("fact_shipments", "order_id shipped_ts delivered_dt"),
    "vw_customer_order_cancellations": ("order_cancellations", "order_id customer_id reason created_at"),
    "vw_admin_order_summary": ("fact_orders", "order_id customer_id order_ts order_status net_amount channel"),
    "vw_admin_kpis": ("kpi_snapshots", "snapshot_ts label metric_name metric_value"),
    "vw_admin_shipments": ("fact_shipments", "order_id shipped_ts delivered_dt"),
    "vw_admin_order_cancellations": ("order_cancellations", "order_id customer_id reason created_at"),
    "vw_payments_enriched": (
        "fact_payments",
        "payment_id order_id payment_method payment_status payment_provider amount authorized_ts captured_ts "
        "failure_reason refund_amount chargeback_flag gateway_fee_amount",
    ),
}


def projection(t: Tables, view: str) -> DataFrame:
    table, cols = PROJECTIONS[view]
    return t[table].select(*cols.split())


def orders_core(t: Tables) -> DataFrame:
    return t["fact_orders"].select(
        "order_id", "customer_id", "geo_id", "order_ts", F.to_date("order_ts").alias("order_dt"), "order_status",
        "channel", "currency", "gross_amount", "discount_amount", "tax_amount", "net_amount",
    )


def orders_completed(t: Tables, statuses=COMPLETED_STATUSES) -> DataFrame:
    return orders_core(t).where(F.col("order_status").isin(*statuses))


def with_product(facts: DataFrame, t: Tables, *cols: str) -> DataFrame:
    return facts.join(t["dim_product"].select("product_id", *cols), "product_id")


def item_profitability(t: Tables) -> DataFrame:
    cogs = F.col("qty") * F.col("unit_cost")
    lines = t["fact_order_items"].select(
        "order_item_id", "order_id", "product_id", "qty", "unit_sell_price", "unit_cost", "line_discount",
        "line_tax", "line_net_revenue", cogs.alias("line_cogs"), (F.col("line_net_revenue") - cogs).alias("line_gross_profit"),
    )
    return with_product(lines, t, "category_l1", "category_l2", "brand")


def sla(t: Tables) -> DataFrame:
    return (
        t["fact_shipments"]
        .select("shipment_id", "order_id", "fc_id", "carrier", "shipped_ts", "promised_delivery_dt", "delivered_dt", "shipping_cost", "sla_breached_flag")
        .join(t["dim_fc"].select("fc_id", "fc_name"), "fc_id")
    )


def returns_enriched(t: Tables) -> DataFrame:
    lines = t["fact_returns"].select(
        "return_id", "order_id", "order_item_id", "product_id", "return_ts", F.to_date("return_ts").alias("return_dt"),
        "return_reason", "refund_amount", "return_status", "restocked_flag",
    )
    return with_product(lines, t, "category_l1", "category_l2")


def customer_order_items(t: Tables) -> DataFrame:
    return with_product(t["fact_order_items"].select("order_id", "product_id", "qty"), t, "product_name")


def is_failed(status="payment_status"):
    return F.col(status).isin(*FAILED_PAYMENTS)
