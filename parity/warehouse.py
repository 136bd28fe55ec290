"""The retail warehouse, derived from the given tables.

Every table is one SELECT that Spark and DuckDB both accept, so the library
and the checking SQL start from exactly the same rows. ``{name}`` refers to
another table. Two spellings differ between the engines and are macros:
``[[JSON_K]]`` (read ``$.k`` from a JSON text) and ``[[HEX15(x)]]`` (first 15
hex digits of an md5 as a number).

Nothing here needs a window or a global order: an order item's id is a hash of
its whole row, so one order holding most of the lines costs nothing extra.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions.calendar import date_dimension

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

CALENDAR_START, CALENDAR_END = "1995-01-01", "2024-12-31"

# Fixed values for the webhook signature: key block XOR 0x36 / 0x5c (RFC 2104).
WEBHOOK_SECRET = "whsec_demo"


def _pads(secret: str) -> tuple[str, str]:
    block = secret.encode().ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in block).hex(), bytes(b ^ 0x5C for b in block).hex()


IPAD, OPAD = _pads(WEBHOOK_SECRET)

_STATUS = """case when o_orderstatus = 'O' then 'PLACED'
  when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'CANCELLED'
  when o_orderstatus = 'P' then 'CREATED'
  when o_orderpriority = '1-URGENT' then 'COMPLETED'
  when o_orderpriority = '2-HIGH' then 'RETURNED' else 'DELIVERED' end"""

_ITEM_ID = """[[HEX15(concat_ws('|', cast(l_orderkey as string), cast(l_linenumber as string),
  cast(l_partkey as string), cast(l_suppkey as string), cast(cast(l_quantity as decimal(12,2)) as string),
  cast(cast(l_extendedprice as decimal(14,2)) as string), cast(cast(l_shipdate as date) as string)))]]"""

TABLES: dict[str, str] = {
    "dim_geo": """
select cast(n_nationkey as bigint) as geo_id, n_name as country, r_name as region, n_name || '-CITY' as city,
  case r_regionkey when 0 then 'USD' when 1 then 'EUR' when 2 then 'INR' when 3 then 'GBP' else 'JPY' end as currency,
  timestamp '1995-01-01 00:00:00' as created_at, timestamp '1995-01-01 00:00:00' as updated_at
from {nation} n join {region} r on n_regionkey = r_regionkey""",
    "dim_fc": """
select s_suppkey as fc_id, s_name as fc_name, cast(s_nationkey as bigint) as geo_id, 'UTC' as timezone,
  timestamp '1995-01-01 00:00:00' as created_at, timestamp '1995-01-01 00:00:00' as updated_at
from {supplier}""",
    "dim_customer": """
select c_custkey as customer_id, cast(date '1995-01-01' + cast(c_custkey % 365 as int) as timestamp) as customer_created_ts,
  cast(c_nationkey as bigint) as geo_id, c_mktsegment as acquisition_channel,
  cast(date '1995-01-01' + cast(c_custkey % 365 as int) as timestamp) as created_at,
  cast(date '1995-01-01' + cast(c_custkey % 365 as int) as timestamp) as updated_at
from {customer}""",
    "dim_product": """
select p_partkey as product_id, 'SKU-' || lpad(cast(p_partkey as string), 7, '0') as sku, p_name as product_name,
  p_type as category_l1, split_part(p_name, ' ', 2) as category_l2, p_brand as brand,
  cast(cast(p_retailprice as decimal(12,2)) * cast(0.70 as decimal(3,2)) as decimal(12,2)) as unit_cost,
  cast(p_retailprice as decimal(12,2)) as list_price,
  timestamp '1995-01-01 00:00:00' as created_at, timestamp '1995-01-01 00:00:00' as updated_at
from {part}""",
    "fact_orders": f"""
select order_id, customer_id, geo_id, order_ts, order_status, channel,
  case geo_id % 5 when 0 then 'USD' when 1 then 'EUR' when 2 then 'INR' when 3 then 'GBP' else 'JPY' end as currency,
  cast(net_amount + discount_amount - tax_amount as decimal(14,2)) as gross_amount, discount_amount, tax_amount, net_amount,
  order_ts as created_at, order_ts as updated_at
from (select o_orderkey as order_id, o_custkey as customer_id, o_custkey % 25 as geo_id,
  cast(o_orderdate as timestamp) as order_ts, {_STATUS} as order_status,
  case when o_orderkey % 2 = 0 then 'WEB' else 'APP' end as channel,
  cast(o_totalprice as decimal(14,2)) as net_amount,
  cast(cast(o_totalprice as decimal(14,2)) * cast(0.07 as decimal(3,2)) as decimal(14,2)) as tax_amount,
  cast(cast(o_totalprice as decimal(14,2)) * cast(0.05 as decimal(3,2)) as decimal(14,2)) as discount_amount
  from {{orders}}) o""",
    "fact_order_items": f"""
select order_item_id, order_id, product_id, qty, unit_list_price, unit_sell_price, unit_cost,
  cast((unit_list_price - unit_sell_price) * qty as decimal(14,2)) as line_discount,
  cast(unit_sell_price * qty * tax_rate as decimal(14,2)) as line_tax,
  cast(cast(unit_sell_price * qty as decimal(14,2)) + cast(unit_sell_price * qty * tax_rate as decimal(14,2)) as decimal(14,2)) as line_net_revenue,
  created_at, updated_at
from (select order_item_id, order_id, product_id, qty, unit_list_price, tax_rate, created_at, created_at as updated_at,
    cast(unit_list_price * (cast(1 as decimal(3,2)) - cast(l_discount as decimal(3,2)) * cast(4 as decimal(3,2))) as decimal(12,2)) as unit_sell_price,
    cast(unit_list_price * cast(0.70 as decimal(3,2)) as decimal(12,2)) as unit_cost
  from (select {_ITEM_ID} as order_item_id, l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as int) as qty,
      cast(cast(cast(floor(l_extendedprice * 100 / l_quantity) as bigint) as decimal(14,0)) * cast(0.01 as decimal(3,2)) as decimal(12,2)) as unit_list_price,
      cast(l_tax as decimal(3,2)) as tax_rate, l_discount, cast(l_shipdate as timestamp) as created_at
    from {{lineitem}}) a) b""",
    "fact_payments": """
select order_id * 2 + attempt as payment_id, order_id,
  case order_id % 4 when 0 then 'CARD' when 1 then 'UPI' when 2 then 'WALLET' else 'COD' end as payment_method,
  case when order_status = 'CANCELLED' then case when (order_id + attempt) % 2 = 0 then 'FAILED' else 'DECLINED' end
    when order_status = 'RETURNED' then 'REFUNDED' else 'CAPTURED' end as payment_status,
  case order_id % 5 when 0 then 'VISA' when 1 then 'MASTERCARD' when 2 then 'PAYPAL' when 3 then 'STRIPE' else 'RAZORPAY' end as payment_provider,
  net_amount as amount,
  case when order_status = 'CANCELLED' or order_id % 4 = 3 then cast(0 as decimal(14,2))
    else cast(net_amount * cast(0.02 as decimal(3,2)) as decimal(14,2)) end as gateway_fee_amount,
  case when order_id % 11 = 0 then null else order_ts end as authorized_ts,
  case when order_status = 'CANCELLED' then null else order_ts end as captured_ts,
  case when order_status = 'CANCELLED' then case order_id % 3 when 0 then 'INSUFFICIENT_FUNDS' when 1 then 'NETWORK_ERROR' else 'BANK_DECLINE' end end as failure_reason,
  cast(case when order_status = 'RETURNED' then net_amount else 0 end as decimal(14,2)) as refund_amount,
  order_id % 97 = 0 as chargeback_flag, 'prov_' || cast(order_id as string) as payment_provider_order_id,
  cast(null as string) as payment_provider_payment_id, cast(null as string) as payment_provider_signature,
  order_ts as created_at, order_ts as updated_at
from (select order_id, order_status, net_amount, order_ts, 0 as attempt from {fact_orders}
  union all select order_id, order_status, net_amount, order_ts, 1 as attempt from {fact_orders} where order_status = 'CANCELLED') t""",
    "fact_shipments": """
select order_id as shipment_id, order_id, order_id % 10 as fc_id,
  case order_id % 4 when 0 then 'DHL' when 1 then 'FEDEX' when 2 then 'UPS' else 'LOCAL_XPRESS' end as carrier,
  case when order_id % 13 = 0 then null else order_ts + interval '1' day end as shipped_ts,
  cast(order_ts as date) + 4 as promised_delivery_dt, cast(order_ts as date) + cast(2 + order_id % 5 as int) as delivered_dt,
  cast(5 + order_id % 20 as decimal(14,2)) as shipping_cost, order_id % 5 > 2 as sla_breached_flag,
  order_ts as created_at, order_ts as updated_at
from {fact_orders} where order_status in ('DELIVERED', 'COMPLETED', 'RETURNED')""",
    "fact_returns": f"""
select i.order_item_id as return_id, i.order_id, i.order_item_id, i.product_id,
  cast(cast(o_orderdate as date) + cast(3 * i.line_no as int) as timestamp) as return_ts,
  case i.supplier_no % 6 when 0 then 'DAMAGED' when 1 then 'NOT_AS_DESCRIBED' when 2 then 'SIZE_ISSUE'
    when 3 then 'LATE_DELIVERY' when 4 then 'QUALITY_ISSUE' else 'CHANGED_MIND' end as return_reason,
  cast(i.paid * cast(0.90 as decimal(3,2)) as decimal(14,2)) as refund_amount, 'REFUNDED' as return_status,
  i.supplier_no % 3 > 0 as restocked_flag, cast(o_orderdate as timestamp) as created_at, cast(o_orderdate as timestamp) as updated_at
from (select {_ITEM_ID} as order_item_id, l_orderkey as order_id, l_partkey as product_id, l_linenumber as line_no,
    l_suppkey as supplier_no, cast(l_extendedprice as decimal(14,2)) as paid
  from {{lineitem}} where l_returnflag = 'R') i
join {{orders}} o on i.order_id = o.o_orderkey where o.o_orderstatus = 'F'""",
    "fact_funnel_events": """
select event_id, event_ts, session_id, customer_id, product_id, order_id, stage, channel, device, failure_reason
from (select event_id, cast(ts as timestamp) as event_ts,
    'sess_' || cast(user_id as string) || '_' || cast(cast(floor(extract(day from ts) / 2) as int) as string) as session_id,
    case when user_id % 5 = 0 then null else user_id end as customer_id,
    case when event_type in ('view', 'click') then cast([[JSON_K]] as bigint) end as product_id,
    case when event_type in ('error', 'purchase') then event_id % 1500 end as order_id,
    case event_type when 'view' then 'VIEW_PRODUCT' when 'click' then 'ADD_TO_CART' when 'signup' then 'CHECKOUT_STARTED'
      when 'error' then 'PAYMENT_FAILED' else 'ORDER_PLACED' end as stage,
    case when user_id % 11 = 0 then null when user_id % 2 = 0 then 'WEB' else 'APP' end as channel,
    case event_id % 3 when 0 then 'DESKTOP' when 1 then 'MOBILE' end as device,
    case when event_type = 'error' then case event_id % 4 when 0 then 'INSUFFICIENT_FUNDS' when 1 then 'NETWORK_ERROR'
      when 2 then 'FRAUD_FLAG' else 'BANK_DECLINE' end end as failure_reason
  from {events}) direct
union all
select event_id + 1000000000, cast(ts as timestamp),
  'sess_' || cast(user_id as string) || '_' || cast(cast(floor(extract(day from ts) / 2) as int) as string),
  case when user_id % 5 = 0 then null else user_id end, cast(null as bigint), event_id % 1500, 'PAYMENT_ATTEMPTED',
  case when user_id % 11 = 0 then null when user_id % 2 = 0 then 'WEB' else 'APP' end,
  case event_id % 3 when 0 then 'DESKTOP' when 1 then 'MOBILE' end, cast(null as string)
from {events} where event_type in ('error', 'purchase')""",
    "order_cancellations": """
select order_id as cancellation_id, order_id, customer_id,
  case order_id % 3 when 0 then 'CHANGED_MIND' when 1 then 'FOUND_CHEAPER' else 'ORDERED_BY_MISTAKE' end as reason,
  order_ts + interval '1' day as created_at
from {fact_orders} where order_status = 'CANCELLED'""",
    # Shop tables: each follows from the state an order is in.
    "customer_cart_items": """
select o.customer_id, i.product_id, cast(least(20, sum(i.qty)) as int) as qty, min(o.order_ts) as created_at, max(o.order_ts) as updated_at
from {fact_order_items} i join {fact_orders} o on o.order_id = i.order_id
where o.order_status = 'CREATED' group by o.customer_id, i.product_id""",
    "customer_wishlist": """
select o.customer_id, i.product_id, max(o.order_ts) as created_at
from {fact_order_items} i join {fact_orders} o on o.order_id = i.order_id
where o.order_status = 'CANCELLED' group by o.customer_id, i.product_id""",
    "product_reviews": """
select o.customer_id * 1000000000 + i.product_id as review_id, i.product_id, o.customer_id,
  cast(1 + (max(i.qty) + o.customer_id) % 5 as smallint) as rating, 'Review' as title, cast(null as string) as body,
  max(o.order_ts) + interval '10' day as created_at, max(o.order_ts) + interval '10' day as updated_at
from {fact_order_items} i join {fact_orders} o on o.order_id = i.order_id
where o.order_status in ('COMPLETED', 'DELIVERED') group by o.customer_id, i.product_id""",
    # The two codes every shop starts with, then codes that reach each rejection.
    "promo_codes": """
select code, discount_type, cast(discount_value as decimal(14,2)) as discount_value, cast(max_discount as decimal(14,2)) as max_discount,
  cast(min_order_amount as decimal(14,2)) as min_order_amount, active, expires_at
from (select 'WELCOME10' as code, 'PERCENT' as discount_type, 10 as discount_value, 250 as max_discount, 0 as min_order_amount,
    true as active, cast(null as timestamp) as expires_at
  union all select 'FLAT100', 'FLAT', 100, null, 499, true, cast(null as timestamp)
  union all select 'BIGSPEND', 'PERCENT', 15, null, 250000, true, cast(null as timestamp)
  union all select 'OLDCODE', 'PERCENT', 20, null, null, true, timestamp '1999-01-01 00:00:00'
  union all select 'PAUSED', 'FLAT', 50, null, null, false, cast(null as timestamp)
  union all select 'BROKEN', 'BOGO', 1, null, null, true, cast(null as timestamp)) p""",
    "checkout_requests": """
select order_id, customer_id, net_amount as amount,
  case order_id % 8 when 0 then 'WELCOME10' when 1 then ' flat100 ' when 2 then 'BIGSPEND' when 3 then 'OLDCODE'
    when 4 then 'PAUSED' when 5 then 'BROKEN' when 6 then 'NOSUCH' end as promo_code
from {fact_orders}""",
    "order_promotions": """
select order_id, 'WELCOME10' as promo_code, cast(250 as decimal(14,2)) as discount_amount, order_ts as created_at
from {fact_orders} where order_status = 'COMPLETED'""",
    "app_users": """
select c_custkey * 2 as user_id, c_custkey as customer_id, case when c_custkey % 3 = 0 then '' else c_name end as display_name,
  'user' || cast(c_custkey as string) || '@example.com' as email, timestamp '2000-01-01 00:00:00' as updated_at from {customer}""",
    "user_emails": """
select customer_id, email, updated_at from {app_users}
union all select customer_id, 'new' || cast(customer_id as string) || '@example.com',
  updated_at + interval '1' day from {app_users} where display_name = ''""",
    "email_outbox": """
select order_id as email_id, customer_id, 'user' || cast(customer_id as string) || '@example.com' as to_email,
  'Order ' || cast(order_id as string) as subject, 'ORDER_PLACED' as kind, order_id, 'PENDING' as status, order_ts as created_at
from {fact_orders}""",
    "customer_addresses": """
select c_custkey * 2 as address_id, c_custkey as customer_id, c_name as recipient_name, true as is_default,
  timestamp '1999-01-01 00:00:00' as created_at from {customer}
union all select c_custkey * 2 + 1, c_custkey, c_name, c_custkey % 10 = 0, timestamp '1999-06-01 00:00:00' from {customer}""",
    "product_inventory": """
select product_id, cast(40 + product_id % 25 as int) as on_hand_qty, cast(0 as int) as reserved_qty,
  timestamp '1995-01-01 00:00:00' as updated_at from {dim_product} where category_l1 <> 'ECONOMY'""",
    "order_inventory_reservations": """
select i.order_id, i.product_id, cast(sum(i.qty) as int) as qty,
  case max(o.order_status) when 'PLACED' then 'RESERVED' when 'CANCELLED' then 'RELEASED' when 'CREATED' then 'RESERVED' else 'CONSUMED' end as status,
  max(o.order_ts) as updated_at
from {fact_order_items} i join {fact_orders} o on o.order_id = i.order_id group by i.order_id, i.product_id""",
    "webhook_bodies": """
select body, case when order_id % 7 = 0 then 'deadbeef' when order_id % 9 = 0 then null else [[HMAC]] end as signature, received_at
from (select order_id, order_ts as received_at, case when order_id % 23 = 0 then 'not json ' || cast(order_id as string)
    else '{{"id":"evt_' || cast(order_id - order_id % 3 as string) || '","event":"' ||
      case when order_status = 'CANCELLED' then 'payment.failed' when order_status = 'CREATED' then 'payment.authorized' else 'payment.captured' end ||
      '","payload":{{"payment":{{"entity":{{"id":"pay_' || cast(order_id as string) || '","order_id":"prov_' || cast(order_id as string) || '"' ||
      case when order_status = 'CANCELLED' and order_id % 2 = 0 then ',"error_description":"Card declined by the issuing bank after three attempts; please ask the customer to use another card"' else '' end ||
      '}}}}}}}}' end as body
  from {fact_orders}) w""",
    # Texts that shoppers type: parts of words, wildcards, blanks around, one or two letters, nothing at all.
    "search_terms": """
select distinct q from (
  select substr(category_l2, 2, 4) as q from {dim_product} union all select '  ' || lower(brand) || ' ' from {dim_product}
  union all select substr(category_l1, 1, 3) || '%' || substr(category_l2, 3, 2) from {dim_product}
  union all select substr(product_name, 1, 1) || '_' || substr(product_name, 3, 3) from {dim_product}
  union all select substr(sku, 10, 2) from {dim_product} union all select substr(brand, 7, 1) from {dim_product}
  union all select substr(brand, 1, 0) || '%' from {dim_product}) t""",
    # Events as a browser sends them: loose spelling, missing fields, and a stage nobody knows.
    "raw_event_requests": """
select event_id, event_ts, session_id, case when stage = 'CHECKOUT_STARTED' then 'checkout-begun' else ' ' || lower(stage) || ' ' end as stage,
  lower(channel) as channel, device, customer_id, product_id, order_id, case when failure_reason is null then '' else ' ' || failure_reason || ' ' end as failure_reason
from {fact_funnel_events}""",
    # A delta: every order again, a third stale, a third unchanged in version, a third newer; plus new orders.
    "stg_fact_orders": """
select order_id, customer_id, geo_id, order_ts, case when order_status = 'DELIVERED' then 'COMPLETED' else order_status end as order_status,
  'KIOSK' as channel, currency, gross_amount, discount_amount, tax_amount, cast(net_amount + 1 as decimal(14,2)) as net_amount, created_at,
  cast(cast(updated_at as date) + cast(order_id % 3 - 1 as int) as timestamp) as updated_at from {fact_orders}
union all select order_id + 1000000000, customer_id, geo_id, order_ts, order_status, channel, currency, gross_amount, discount_amount,
  tax_amount, net_amount, created_at, updated_at from {fact_orders} where order_status = 'CREATED'""",
    "stg_fact_order_items": """
select order_item_id, order_id, product_id, qty + 1 as qty, unit_list_price, unit_sell_price, unit_cost, line_discount, line_tax,
  cast(line_net_revenue + 1 as decimal(14,2)) as line_net_revenue, created_at,
  cast(cast(updated_at as date) + cast(order_id % 3 - 1 as int) as timestamp) as updated_at from {fact_order_items}""",
    "stg_fact_payments": """
select payment_id, order_id, payment_method, case when payment_status = 'CAPTURED' then 'REFUNDED' else payment_status end as payment_status,
  payment_provider, amount, gateway_fee_amount, authorized_ts, captured_ts, failure_reason, amount as refund_amount, chargeback_flag,
  payment_provider_order_id, payment_provider_payment_id, payment_provider_signature, created_at,
  cast(cast(updated_at as date) + cast(payment_id % 3 - 1 as int) as timestamp) as updated_at from {fact_payments}""",
    "stg_fact_shipments": """
select shipment_id, order_id, fc_id, 'OTHER' as carrier, shipped_ts, promised_delivery_dt, delivered_dt + 3 as delivered_dt,
  cast(shipping_cost + 1 as decimal(14,2)) as shipping_cost, true as sla_breached_flag, created_at,
  cast(cast(updated_at as date) + cast(shipment_id % 3 - 1 as int) as timestamp) as updated_at from {fact_shipments}""",
    "stg_fact_returns": """
select return_id, order_id, order_item_id, product_id, return_ts, 'CHANGED' as return_reason, refund_amount, 'CLOSED' as return_status,
  restocked_flag, created_at, cast(cast(updated_at as date) + cast(order_id % 3 - 1 as int) as timestamp) as updated_at from {fact_returns}""",
    "stg_dim_customer": """
select customer_id, customer_created_ts, (geo_id + 1) % 25 as geo_id, 'SOCIAL' as acquisition_channel, created_at,
  cast(cast(updated_at as date) + cast(customer_id % 3 - 1 as int) as timestamp) as updated_at from {dim_customer}
union all select customer_id + 1000000000, customer_created_ts, geo_id, 'EMAIL', created_at, updated_at from {dim_customer}""",
    "stg_dim_product": """
select product_id, 'NEW-' || sku as sku, product_name, category_l1, category_l2, brand, unit_cost, cast(list_price + 1 as decimal(12,2)) as list_price,
  created_at, cast(cast(updated_at as date) + cast(product_id % 3 - 1 as int) as timestamp) as updated_at from {dim_product}""",
    "stg_funnel_events": """
select event_id, event_ts, session_id, customer_id, product_id, order_id, stage, 'LATE' as channel, device, failure_reason from {fact_funnel_events}
union all select event_id + 5000000000, event_ts, session_id, customer_id, product_id, order_id, stage, channel, device, failure_reason
from {fact_funnel_events} where stage = 'VIEW_PRODUCT'""",
}

_DUCK_DATE_DIM = f"""
select cast(strftime(d, '%Y%m%d') as int) as date_id, d as date_value, cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
  cast(month(d) as int) as month, monthname(d) as month_name, cast(weekofyear(d) as int) as week_of_year,
  cast(day(d) as int) as day_of_month, cast(isodow(d) as int) as day_of_week, dayname(d) as day_name, isodow(d) >= 6 as is_weekend
from (select cast(unnest(generate_series(date '{CALENDAR_START}', date '{CALENDAR_END}', interval 1 day)) as date) as d) c"""


def _macros(sql: str, engine: str) -> str:
    spark = engine == "spark"
    sql = sql.replace("[[JSON_K]]", "get_json_object(props, '$.k')" if spark else "json_extract_string(props, '$.k')")
    sql = sql.replace(
        "[[HMAC]]",
        f"sha2(concat(unhex('{OPAD}'), unhex(sha2(concat(unhex('{IPAD}'), encode(body, 'UTF-8')), 256))), 256)"
        if spark
        else f"sha256(unhex('{OPAD}') || unhex(sha256(unhex('{IPAD}') || encode(body))))",
    )
    hex15 = r"cast(conv(substring(md5(\1), 1, 15), 16, 10) as bigint)" if spark else r"cast(('0x' || substr(md5(\1), 1, 15)) as bigint)"
    return re.sub(r"\[\[HEX15\((.*?)\)\]\]", hex15, sql, flags=re.S)


def _deps(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql)))


class Warehouse(Mapping):
    """Lazily derived tables; asking for one builds only what it needs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._made = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._build(name)
        return self._made[name]

    def _build(self, name: str) -> DataFrame:
        if name in RAW:
            return self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        if name == "dim_date":
            return date_dimension(self._spark, CALENDAR_START, CALENDAR_END)
        if name not in TABLES:
            raise KeyError(name)
        sql = TABLES[name]
        return self._spark.sql(_macros(sql, "spark"), **{d: self[d] for d in _deps(sql)})

    def stream(self, name: str) -> DataFrame:
        """A table as a stream: its raw sources are read as they arrive, the mapping is the same."""
        if name in RAW:
            schema = self[name].schema
            return self._spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(f"{self._dir}/{name}.par*")
        sql = TABLES[name]
        return self._spark.sql(_macros(sql, "spark"), **{d: self.stream(d) for d in _deps(sql)})

    def __iter__(self):
        return iter([*TABLES, "dim_date"])

    def __len__(self) -> int:
        return len(TABLES) + 1

    def __contains__(self, name) -> bool:
        return name in TABLES or name in RAW or name == "dim_date"


def duckdb_ctes(names: list[str]) -> str:
    """The WITH entries a DuckDB statement needs for ``names``, in order."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in RAW or name in done:
            return
        if name == "dim_date":
            done[name] = _DUCK_DATE_DIM
            return
        sql = TABLES[name]
        deps = _deps(sql)
        for d in deps:
            add(d)
        done[name] = _macros(sql, "duckdb").format(**{d: d for d in deps})

    for n in names:
        add(n)
    return ",\n".join(f"{n} as ({sql})" for n, sql in done.items())
