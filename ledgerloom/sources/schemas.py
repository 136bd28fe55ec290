"""Declared schemas of the warehouse tables, and their key rules.

Types are written as DDL text; a trailing ``!`` marks NOT NULL. ``varchar(n)``
lengths are checked by the quality rules and stored as plain strings.
"""

from __future__ import annotations

import re

from pyspark.sql.types import StructType

_STAMPS = "created_at timestamp!, updated_at timestamp!"

# Table layouts.
COLUMNS: dict[str, str] = {
    "dim_geo": f"geo_id bigint!, country varchar(60)!, region varchar(60)!, city varchar(80)!, currency varchar(10)!, {_STAMPS}",
    "dim_fc": f"fc_id bigint!, fc_name varchar(80)!, geo_id bigint!, timezone varchar(60)!, {_STAMPS}",
    "dim_customer": f"customer_id bigint!, customer_created_ts timestamp!, geo_id bigint!, acquisition_channel varchar(40)!, {_STAMPS}",
    "dim_product": "product_id bigint!, sku varchar(40)!, product_name varchar(120)!, category_l1 varchar(60)!, category_l2 varchar(60)!, "
    f"brand varchar(60)!, unit_cost decimal(12,2)!, list_price decimal(12,2)!, {_STAMPS}",
    "dim_date": "date_id int!, date_value date!, year int!, quarter int!, month int!, month_name varchar(15)!, week_of_year int!, "
    "day_of_month int!, day_of_week int!, day_name varchar(15)!, is_weekend boolean!",
    "fact_orders": "order_id bigint!, customer_id bigint!, geo_id bigint!, order_ts timestamp!, order_status varchar(30)!, channel varchar(30)!, "
    f"currency varchar(10)!, gross_amount decimal(14,2)!, discount_amount decimal(14,2)!, tax_amount decimal(14,2)!, net_amount decimal(14,2)!, {_STAMPS}",
    "fact_order_items": "order_item_id bigint!, order_id bigint!, product_id bigint!, qty int!, unit_list_price decimal(12,2)!, "
    "unit_sell_price decimal(12,2)!, unit_cost decimal(12,2)!, line_discount decimal(14,2)!, line_tax decimal(14,2)!, "
    f"line_net_revenue decimal(14,2)!, {_STAMPS}",
    "fact_payments": "payment_id bigint!, order_id bigint!, payment_method varchar(40)!, payment_status varchar(30)!, payment_provider varchar(40)!, "
    "amount decimal(14,2)!, gateway_fee_amount decimal(14,2)!, authorized_ts timestamp, captured_ts timestamp, failure_reason varchar(80), "
    "refund_amount decimal(14,2)!, chargeback_flag boolean!, payment_provider_order_id varchar(80), "
    f"payment_provider_payment_id varchar(80), payment_provider_signature varchar(256), {_STAMPS}",
    "fact_shipments": "shipment_id bigint!, order_id bigint!, fc_id bigint!, carrier varchar(40)!, shipped_ts timestamp, promised_delivery_dt date!, "
    f"delivered_dt date, shipping_cost decimal(14,2)!, sla_breached_flag boolean!, {_STAMPS}",
    "fact_returns": "return_id bigint!, order_id bigint!, order_item_id bigint!, product_id bigint!, return_ts timestamp!, return_reason varchar(80)!, "
    f"refund_amount decimal(14,2)!, return_status varchar(30)!, restocked_flag boolean!, {_STAMPS}",
    "fact_funnel_events": "event_id bigint!, event_ts timestamp!, session_id varchar(64)!, customer_id bigint, product_id bigint, order_id bigint, "
    "stage varchar(30)!, channel varchar(30)!, device varchar(30)!, failure_reason varchar(80)",
}

# Load order (parents first), keys, and references as (column, parent, parent key).
LOAD_ORDER = tuple(COLUMNS)
PRIMARY_KEY: dict[str, tuple[str, ...]] = {
    "dim_geo": ("geo_id",), "dim_fc": ("fc_id",), "dim_customer": ("customer_id",), "dim_product": ("product_id",), "dim_date": ("date_id",),
    "fact_orders": ("order_id",), "fact_order_items": ("order_item_id",), "fact_payments": ("payment_id",), "fact_shipments": ("shipment_id",),
    "fact_returns": ("return_id",), "fact_funnel_events": ("event_id",),
    "product_reviews": ("product_id", "customer_id"), "order_inventory_reservations": ("order_id", "product_id"),
}
REFERENCES: dict[str, tuple[tuple[str, str, str], ...]] = {
    "dim_fc": (("geo_id", "dim_geo", "geo_id"),),
    "dim_customer": (("geo_id", "dim_geo", "geo_id"),),
    "fact_orders": (("customer_id", "dim_customer", "customer_id"), ("geo_id", "dim_geo", "geo_id")),
    "fact_order_items": (("order_id", "fact_orders", "order_id"), ("product_id", "dim_product", "product_id")),
    "fact_payments": (("order_id", "fact_orders", "order_id"),),
    "fact_shipments": (("order_id", "fact_orders", "order_id"), ("fc_id", "dim_fc", "fc_id")),
    "fact_returns": (
        ("order_id", "fact_orders", "order_id"), ("order_item_id", "fact_order_items", "order_item_id"), ("product_id", "dim_product", "product_id"),
    ),
    "fact_funnel_events": (
        ("customer_id", "dim_customer", "customer_id"), ("product_id", "dim_product", "product_id"), ("order_id", "fact_orders", "order_id"),
    ),
}
FUNNEL_STAGES = ("VIEW_PRODUCT", "ADD_TO_CART", "VIEW_CART", "CHECKOUT_STARTED", "PAYMENT_ATTEMPTED", "PAYMENT_FAILED", "ORDER_PLACED")
VALUE_RULES: dict[str, str] = {
    "customer_cart_items": "qty between 1 and 20",
    "product_reviews": "rating between 1 and 5",
    "product_inventory": "on_hand_qty >= 0 and reserved_qty >= 0",
    "order_inventory_reservations": "qty >= 1",
    "fact_funnel_events": "stage in ('" + "', '".join(FUNNEL_STAGES) + "')",
}


def _entries(table: str) -> list[tuple[str, str, bool]]:
    out = []
    for part in re.split(r",\s*(?![^()]*\))", COLUMNS[table]):
        name, dtype = part.split(" ", 1)
        out.append((name, dtype.rstrip("!"), dtype.endswith("!")))
    return out


def schema(table: str) -> StructType:
    return StructType.fromDDL(", ".join(f"{n} {re.sub(r'varchar.*', 'string', d)}{' not null' if req else ''}" for n, d, req in _entries(table)))


def required(table: str) -> list[str]:
    return [n for n, _, req in _entries(table) if req]


def max_lengths(table: str) -> dict[str, int]:
    return {n: int(d[8:-1]) for n, d, _ in _entries(table) if d.startswith("varchar")}
