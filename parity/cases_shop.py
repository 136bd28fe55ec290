"""Shop jobs and payment webhooks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerloom.operators import admin, shop, webhooks
from ledgerloom.plans import buckets, hooks, textindex
from ledgerloom.session import checkpoint_root, cut
from parity.registry import CASES, FRAGMENTS, case
from parity.warehouse import IPAD, OPAD, WEBHOOK_SECRET

# A moment inside the order years, so that some orders are still on their way.
AS_OF = "2001-07-30 12:00:00"

FRAGMENTS["cat"] = """select *, cast(round(list_price * cast(100 - discount_pct as decimal(3,0)) * cast(0.01 as decimal(3,2)), 2) as decimal(14,2)) as sell_price
  from (select *, [5, 8, 10, 12, 15, 18, 20][cast(product_id % 7 + 1 as int)] as discount_pct from dim_product)"""
_P = "product_id:i sku:s product_name:s category_l1:s category_l2:s brand:s unit_cost:m list_price:m"
case("shop_discount_pct", lambda w: w["dim_product"].select("product_id", shop.discount_pct().alias("discount_pct")), "product_id:i discount_pct:i", "from cat")
case("shop_catalog", shop.catalog, _P + " discount_pct:i sell_price:m", "from cat")
case("shop_product_page", lambda w: shop.product_page(w, 24, 48), _P + " discount_pct:i sell_price:m", "from cat order by product_id limit 24 offset 48")
case("shop_product_lookup", lambda w: shop.product_lookup(w, w["fact_returns"]), _P + " discount_pct:i sell_price:m",
     "from cat where product_id in (select product_id from fact_returns)")
FRAGMENTS["units"] = "select product_id, sum(qty) as n from fact_order_items where order_id in (select order_id from done_orders) group by 1"
for _sort, _order in (("default", "product_id"), ("price_asc", "list_price, product_id"), ("price_desc", "list_price desc, product_id"),
                      ("best_sellers", "coalesce(n, 0) desc, product_id")):
    case(f"shop_product_search_{_sort}", lambda w, s=_sort: shop.product_search(w, "GE", min_price=901.5, max_price=1900, sort=s, limit=200, offset=3), _P,
         f"""select dim_product.* from dim_product left join units using (product_id) where list_price between 901.5 and 1900
             and (product_name || '~' || brand || '~' || sku || '~' || category_l1 || '~' || category_l2) ilike '%ge%' order by {_order} limit 200 offset 3""")
case("shop_product_search", lambda w: shop.product_search(w, category_l1="PROMO", category_l2="gear", sort="price_desc", limit=200), _P,
     "from dim_product where category_l1 = 'PROMO' and category_l2 = 'gear' order by list_price desc, product_id limit 200")


def _searched(w):
    """All searches at once on an index that follows the products: loaded under other names first, then as they are."""
    spark = w["fact_orders"].sparkSession
    root = f"{checkpoint_root(spark)}/{uuid.uuid4().hex}"
    products = w["dim_product"]
    buckets.create(products.withColumn("product_name", F.reverse("product_name")), f"{root}/{textindex.TABLE}", textindex.KEY, 4)
    textindex.update(spark, root)
    buckets.append(products, buckets.snapshot(spark, f"{root}/{textindex.TABLE}"))
    textindex.update(spark, root)
    return textindex.search(spark, root, w["search_terms"].select(F.col("q").alias("query_id"), "q")).withColumnRenamed("query_id", "q")


case("shop_product_search_many", _searched, "q:s product_id:i product_name:s list_price:m",
     """select q, product_id, product_name, list_price from search_terms join dim_product
        on (product_name || '~' || brand || '~' || sku || '~' || category_l1 || '~' || category_l2) ilike '%' || trim(q) || '%' and
        greatest(product_name ilike '%' || trim(q) || '%', brand ilike '%' || trim(q) || '%', sku ilike '%' || trim(q) || '%', category_l1 ilike '%' || trim(q) || '%', category_l2 ilike '%' || trim(q) || '%')""")
case("shop_facets", shop.facets, "facet:s value:s",
     "select distinct 'category_l1' as facet, category_l1 as value from dim_product union select 'category_l2', category_l2 from dim_product union select 'brand', brand from dim_product")


def _lines(source: str, keep: str) -> str:
    return f"""select *, line_net + line_tax as line_total from (select {keep}, c.product_id, sku, product_name, category_l1, category_l2, brand, list_price, discount_pct, sell_price, q as qty,
      list_price * q as line_gross, (list_price - sell_price) * q as line_discount, round(sell_price * q * cast(0.07 as decimal(3,2)), 2) as line_tax, sell_price * q as line_net
      from (select * exclude (qty), cast(qty as decimal(10,0)) as q from {source}) s join cat c on c.product_id = s.product_id)"""


_LINE = "product_id:i sku:s product_name:s category_l1:s category_l2:s brand:s list_price:m discount_pct:i sell_price:m qty:i line_gross:m line_discount:m line_tax:m line_total:m"
FRAGMENTS["cart_x"] = _lines("customer_cart_items", "customer_id")
_TOT = "sum(line_gross) as gross_amount, sum(line_discount) as discount_amount, sum(line_tax) as tax_amount, sum(line_total) as net_amount"
_HEAD = "gross_amount:m discount_amount:m tax_amount:m net_amount:m"
case("shop_cart_lines", shop.cart_lines, "customer_id:i " + _LINE, "from cart_x")
case("shop_cart_totals", shop.cart_totals, "customer_id:i " + _HEAD, f"select customer_id, {_TOT} from cart_x group by 1")


def _kept_catalog(w):
    """The warehouse with one category taken off the catalogue, so some carts hold unknown products."""
    return {"customer_cart_items": w["customer_cart_items"], "dim_product": w["dim_product"].where("category_l1 <> 'PROMO'")}


case("shop_cart_rejects", lambda w: shop.cart_rejects(_kept_catalog(w)), "customer_id:i product_id:i qty:i",
     "from customer_cart_items where product_id in (select product_id from dim_product where category_l1 = 'PROMO')")
case("shop_cart_totals_strict", lambda w: shop.cart_totals(_kept_catalog(w)), "customer_id:i " + _HEAD,
     f"""select customer_id, {_TOT} from cart_x where customer_id not in
         (select customer_id from customer_cart_items join dim_product using (product_id) where category_l1 = 'PROMO') group by 1""")
_CART = "customer_id:i product_id:i qty:i created_at:t updated_at:t"


def _moved(w):
    """Wished products go to the cart, two of each."""
    return w["customer_wishlist"].select("customer_id", "product_id", F.lit(2).alias("qty"), F.to_timestamp(F.lit(AS_OF)).alias("updated_at")).unionByName(
        w["customer_cart_items"].select("customer_id", "product_id", F.lit(3).alias("qty"), F.to_timestamp(F.lit(AS_OF)).alias("updated_at")))


for _mode, _old in (("add", "least(20, coalesce(c.qty, 0) + m.qty)"), ("set", "m.top")):
    case("shop_cart_merge" + ("" if _mode == "add" else "_set"), lambda w, m=_mode: shop.cart_merge(w["customer_cart_items"], _moved(w), m), _CART,
         f"""select customer_id, product_id, {_old} as qty, coalesce(c.created_at, timestamp '{AS_OF}') as created_at, timestamp '{AS_OF}' as updated_at
             from customer_cart_items c full join (select customer_id, product_id, sum(q) as qty, max(q) as top from (
               select customer_id, product_id, 2 as q from customer_wishlist union all select customer_id, product_id, 3 from customer_cart_items) group by 1, 2) m using (customer_id, product_id)""")


def _promo_sql(source: str, amount: str) -> str:
    return f"""select *, message = 'Applied' as valid, case when message = 'Applied' then least(raw, max_discount, {amount}) else 0 end as promo_discount from (
      select r.*, upper(trim(coalesce(promo_code, ''))) as code, max_discount, case discount_type when 'PERCENT' then round({amount} * discount_value * cast(0.01 as decimal(3,2)), 2) else discount_value end as raw,
        case when coalesce(promo_code, '') = '' then 'Promo code is required' when p.code is null then 'Invalid code' when not active then 'Code not active'
          when expires_at <= timestamp '{AS_OF}' then 'Code expired' when {amount} < min_order_amount then 'Minimum order amount is ' || cast(cast(min_order_amount as double) as varchar)
          when discount_type not in ('PERCENT', 'FLAT') then 'Invalid configuration' else 'Applied' end as message
      from {source} r left join promo_codes p on p.code = upper(trim(promo_code)))"""


case("shop_promo_apply", lambda w: shop.promo_apply(w["checkout_requests"], w["promo_codes"], AS_OF),
     "order_id:i customer_id:i amount:m code:s valid:b message:s promo_discount:m", _promo_sql("checkout_requests", "amount"))
FRAGMENTS["checkout_x"] = _lines("fact_order_items", "order_id")
FRAGMENTS["checkout_heads"] = f"select t.*, promo_code from (select order_id, {_TOT} from checkout_x group by 1) t left join checkout_requests using (order_id)"
case("shop_order_pricing", lambda w: shop.order_pricing(w, w["fact_order_items"].select("order_id", "product_id", "qty"), w["checkout_requests"], AS_OF),
     "order_id:i " + _HEAD + " promo_discount_amount:m rejected:b",
     f"""select order_id, gross_amount, discount_amount + promo_discount as discount_amount, tax_amount, greatest(0, net_amount - promo_discount) as net_amount,
         promo_discount as promo_discount_amount, code <> '' and not valid as rejected from ({_promo_sql('checkout_heads', 'net_amount')})""")
case("shop_wishlist", shop.wishlist_items, "customer_id:i created_at:t " + _P, "select w.customer_id, w.created_at, p.* exclude (created_at) from customer_wishlist w join dim_product p using (product_id)")
case("shop_wishlist_add", lambda w: shop.wishlist_add(w["customer_wishlist"], w["customer_cart_items"].unionByName(w["customer_cart_items"])), "customer_id:i product_id:i created_at:t",
     """select customer_id, product_id, created_at from customer_wishlist union all select customer_id, product_id, created_at from customer_cart_items
        anti join customer_wishlist using (customer_id, product_id)""")
case("shop_rating_summary", shop.rating_summary, "product_id:i average_rating:m rating_count:i",
     """select product_id, round(cast(coalesce(avg(rating), 0) as decimal(38,8)), 2) as average_rating, count(rating) as rating_count
        from dim_product left join product_reviews using (product_id) group by 1""")
_REV = "review_id:i product_id:i customer_id:i rating:i title:s created_at:t updated_at:t"
case("shop_reviews_latest", lambda w: shop.reviews_latest(w, 3), _REV + " position:i",
     "select *, row_number() over (partition by product_id order by created_at desc, review_id) as position from product_reviews qualify position <= 3")


def _posts(w):
    """Everyone with a cart line posts a two-star review of it."""
    return w["customer_cart_items"].select("product_id", "customer_id", (-F.col("product_id") - 1).alias("review_id"), F.lit(2).cast("short").alias("rating"),
                                           F.lit("Again").alias("title"), F.lit(None).cast("string").alias("body"), F.to_timestamp(F.lit(AS_OF)).alias("updated_at"))


case("shop_review_upsert", lambda w: shop.review_upsert(w["product_reviews"], _posts(w)), _REV,
     f"""select coalesce(r.review_id, -product_id - 1) as review_id, product_id, customer_id, if(c.qty is null, rating, 2) as rating, if(c.qty is null, title, 'Again') as title,
         coalesce(r.created_at, timestamp '{AS_OF}') as created_at, if(c.qty is null, r.updated_at, timestamp '{AS_OF}') as updated_at
         from product_reviews r full join customer_cart_items c using (product_id, customer_id)""")
case("shop_review_eligibility",
     lambda w: shop.review_eligibility(w, w["customer_wishlist"].select("customer_id", "product_id").unionByName(w["customer_cart_items"].select("customer_id", "product_id"))
                                       .unionByName(w["product_reviews"].select("customer_id", "product_id")), AS_OF),
     "customer_id:i product_id:i eligible:b reason:s",
     f"""select *, case when eligible then null when bought then 'NOT_DELIVERED' else 'NOT_PURCHASED' end as reason from (
           select customer_id, product_id, count(o.order_id) > 0 as bought, count(s.order_id) > 0 as eligible
           from (select customer_id, product_id from customer_wishlist union select customer_id, product_id from customer_cart_items union select customer_id, product_id from product_reviews)
           left join (select customer_id, product_id, order_id from fact_orders join fact_order_items using (order_id) where order_status not in ('CANCELLED', 'PAYMENT_FAILED')) o using (customer_id, product_id)
           left join fact_shipments s on s.order_id = o.order_id and delivered_dt <= date '2001-07-30' group by 1, 2)""")
case("shop_order_detail", shop.order_detail,
     "order_id:i customer_id:i order_ts:t order_status:s gross_amount:m discount_amount:m tax_amount:m net_amount:m payment_status:s promo_code:s promo_discount_amount:m order_item_id:i product_id:i product_name:s qty:i",
     """select o.*, payment_status, promo_code, op.discount_amount as promo_discount_amount, order_item_id, product_id, product_name, qty from fact_orders o
        left join (select order_id, arg_max(payment_status, payment_id) as payment_status from fact_payments group by 1) using (order_id)
        left join order_promotions op using (order_id) left join lines_x using (order_id)""")
FRAGMENTS["progress"] = f"""select *, coalesce(shipped_ts <= timestamp '{AS_OF}', false) as s_done, coalesce(delivered_dt <= date '2001-07-30', false) as d_done,
    case when order_status = 'CANCELLED' then 'CANCELLED' when coalesce(delivered_dt <= date '2001-07-30', false) then 'DELIVERED' when coalesce(shipped_ts <= timestamp '{AS_OF}', false) then 'SHIPPED' else 'PLACED' end as current_status
  from (select order_id, customer_id, order_ts, order_status, net_amount from fact_orders)
  left join (select order_id, max(shipped_ts) as shipped_ts, max(delivered_dt) as delivered_dt from fact_shipments group by 1) using (order_id)"""
case("shop_order_timeline", lambda w: shop.order_timeline(w, AS_OF), "order_id:i customer_id:i current_status:s placed_ts:t shipped_ts:t delivered_dt:d cancelled_ts:t cancel_reason:s",
     """select order_id, customer_id, current_status, order_ts as placed_ts, case when current_status <> 'CANCELLED' and s_done then shipped_ts end as shipped_ts,
        case when current_status = 'DELIVERED' then delivered_dt end as delivered_dt, case when current_status = 'CANCELLED' then c.created_at end as cancelled_ts,
        case when current_status = 'CANCELLED' then c.reason end as cancel_reason from progress left join order_cancellations c using (order_id, customer_id)""")
_HIST = "customer_id:i position:i order_id:i order_ts:t order_status:s net_amount:m product_id:i product_name:s qty:i"
for _key, _when, _status in (("shop_order_history", AS_OF, "case when order_status = 'CANCELLED' then order_status else current_status end"), ("shop_order_history_stored", None, "order_status")):
    case(_key, lambda w, a=_when: shop.order_history(w, 5, a), _HIST,
         f"""select o.* exclude (order_status), {_status} as order_status, product_id, product_name, qty from (
             select *, row_number() over (partition by customer_id order by order_ts desc, order_id) as position from progress qualify position <= 5) o left join lines_x using (order_id)""")
case("shop_cancellable", lambda w: shop.cancellable(w, AS_OF), "order_id:i customer_id:i order_ts:t", "from progress where order_status = 'PLACED' and not s_done and not d_done")
case("shop_customer_bucket", lambda w: shop.customer_bucket(w, w["user_emails"].select(F.concat(F.lit(" "), F.upper("email")).alias("email"))), "email:s customer_id:i geo_id:i",
     """select email, customer_id, geo_id from (select distinct lower(email) as email from user_emails),
          (select count(*) as n from dim_customer), (select customer_id, geo_id, row_number() over (order by customer_id) - 1 as pos from dim_customer)
        where pos = ((cast(cast('0x' || substr(md5(email), 1, 16) as ubigint) as hugeint) % n) * (18446744073709551616::hugeint % n)
               + cast(cast('0x' || substr(md5(email), 17, 16) as ubigint) as hugeint)) % n""")
case("shop_latest_email", lambda w: shop.latest_email(w["user_emails"]), "customer_id:i email:s", "select customer_id, arg_max(email, updated_at) as email from user_emails group by 1")
case("shop_outbox", lambda w: shop.outbox_latest(w, 5), "email_id:i customer_id:i to_email:s subject:s kind:s order_id:i status:s created_at:t position:i",
     "select *, row_number() over (partition by customer_id order by created_at desc, email_id) as position from email_outbox qualify position <= 5")
case("shop_address_order", shop.address_order, "address_id:i customer_id:i recipient_name:s is_default:b created_at:t", "from customer_addresses")
case("shop_inventory_seed", lambda w: shop.inventory_seed(w, AS_OF), "product_id:i on_hand_qty:i reserved_qty:i updated_at:t",
     f"from product_inventory union all select product_id, 25 + product_id % 25, 0, timestamp '{AS_OF}' from dim_product where product_id not in (select product_id from product_inventory)")
case("shop_inventory_position", lambda w: shop.inventory_shortages(w, w["fact_order_items"]), "order_id:i product_id:i requested:i available:i problem:s",
     """select order_id, product_id, requested, on_hand_qty - reserved_qty as available, if(on_hand_qty is null, 'MISSING', 'INSUFFICIENT') as problem
        from (select order_id, product_id, sum(qty) as requested from fact_order_items group by 1, 2) left join product_inventory using (product_id)
        where on_hand_qty is null or on_hand_qty - reserved_qty < requested""")
#: Orders one after another: what is left of each product, and whether the order got its pieces. Orders that can never be served are left out first.
FRAGMENTS["served"] = """select n, order_id, fits from (with recursive pieces as (select order_id, product_id, sum(qty)::bigint as q from fact_order_items group by 1, 2),
      shelf as (select product_id, on_hand_qty - reserved_qty as a, row_number() over (order by product_id) as slot from product_inventory),
      possible as (select order_id, list(slot) as slots, list(q) as q from pieces left join shelf using (product_id) group by 1 having bool_and(coalesce(q <= a, false))),
      queue as materialized (select row_number() over (order by order_ts, order_id) as n, order_id, slots, q from possible join fact_orders using (order_id)),
      walk(n, order_id, fits, stock) as (select 0::bigint, null::bigint, false, (select list(a::bigint order by slot) from shelf)
        union all select s.n, s.order_id, s.fits, if(s.fits, list_transform(s.stock, lambda x, i: x - coalesce(s.q[list_position(s.slots, i)], 0)), s.stock)
        from (select o.n, o.order_id, o.slots, o.q, w.stock, list_bool_and(list_transform(range(1, len(o.slots) + 1), lambda i: w.stock[o.slots[i]] >= o.q[i])) as fits
              from walk w join queue o on o.n = w.n + 1) s)
      select n, order_id, fits from walk where n > 0)"""
case("shop_reserve_orders", lambda w: shop.reserve_orders(w, w["fact_order_items"]), "order_id:i n_lines:i qty:i accepted:b reason:s",
     """select o.*, coalesce(fits, false) as accepted, case when coalesce(fits, false) then null when missing then 'MISSING' else 'INSUFFICIENT' end as reason
        from (select order_id, count(*) as n_lines, sum(q) as qty, bool_or(a is null) as missing from
              (select order_id, product_id, sum(qty) as q from fact_order_items group by 1, 2) left join (select product_id, 1 as a from product_inventory) using (product_id) group by 1) o
        left join served using (order_id) where order_id in (select order_id from fact_orders)""")
case("shop_inventory_apply", shop.inventory_apply, "product_id:i on_hand_qty:i reserved_qty:i available_qty:i",
     """select *, on_hand_qty - reserved_qty as available_qty from (select product_id, any_value(i.on_hand_qty) - coalesce(sum(qty) filter (status = 'CONSUMED'), 0) as on_hand_qty,
          greatest(0, any_value(i.reserved_qty) + coalesce(sum(qty) filter (status = 'RESERVED'), 0)) as reserved_qty
        from product_inventory i left join order_inventory_reservations using (product_id) group by 1)""")

# ---------------------------------------------------------------- webhooks
FRAGMENTS["hooks"] = """select body, signature, received_at, e ->> '$.id' as event_id, e ->> '$.event' as event_type, e ->> '$.payload.payment.entity.order_id' as provider_order_id,
    e ->> '$.payload.payment.entity.id' as provider_payment_id, e ->> '$.payload.payment.entity.error_description' as why
  from (select *, case when json_valid(body) then cast(body as json) end as e from webhook_bodies)"""
FRAGMENTS["hook_states"] = """select *, case event_type when 'payment.captured' then 'PAYMENT_SUCCESS' when 'payment.failed' then 'PAYMENT_FAILED' end as new_payment_status,
    case event_type when 'payment.captured' then 'ORDER_CONFIRMED' when 'payment.failed' then 'ORDER_CANCELLED' end as new_order_status,
    case event_type when 'payment.failed' then left(coalesce(why, 'PAYMENT_FAILED'), 80) end as failure_reason from hooks where event_id is not null"""
FRAGMENTS["hook_once"] = "select * from hook_states qualify row_number() over (partition by event_id order by received_at, body) = 1"
_EVT = "event_id:s event_type:s provider_order_id:s provider_payment_id:s new_payment_status:s new_order_status:s failure_reason:s received_at:t"
case("shop_webhook_parse", lambda w: webhooks.accepted(w["webhook_bodies"]), _EVT, "from hook_states")
case("shop_webhook_quarantine", lambda w: webhooks.quarantine(w["webhook_bodies"]), "body:s signature:s received_at:t", "from hooks where event_id is null")
case("shop_webhook_dedupe", lambda w: webhooks.dedupe(webhooks.accepted(w["webhook_bodies"])), _EVT, "from hook_once")
case("shop_webhook_verify", lambda w: webhooks.verify(w["webhook_bodies"], WEBHOOK_SECRET), "body:s signature:s verified:b",
     f"""select body, signature, coalesce(signature = sha256(unhex('{OPAD}') || unhex(sha256(unhex('{IPAD}') || encode(body)))), false) as verified from webhook_bodies""")
FRAGMENTS["hook_hits"] = """select h.*, order_id, payment_id from hook_once h join (select payment_provider_order_id as provider_order_id, max(payment_id) as payment_id,
  arg_max(order_id, payment_id) as order_id from fact_payments group by 1) using (provider_order_id)"""


def _applied(w):
    return webhooks.apply(w, webhooks.dedupe(webhooks.accepted(w["webhook_bodies"])))


case("shop_webhook_apply", lambda w: _applied(w)["fact_payments"],
     "payment_id:i order_id:i payment_status:s payment_provider:s payment_provider_payment_id:s payment_provider_signature:s failure_reason:s captured_ts:t updated_at:t",
     """select p.payment_id, p.order_id, coalesce(new_payment_status, p.payment_status) as payment_status, if(h.payment_id is null, payment_provider, 'RAZORPAY') as payment_provider,
          h.provider_payment_id as payment_provider_payment_id, h.signature as payment_provider_signature, coalesce(h.failure_reason, p.failure_reason) as failure_reason,
          if(new_payment_status = 'PAYMENT_SUCCESS', received_at, captured_ts) as captured_ts, coalesce(received_at, updated_at) as updated_at
        from fact_payments p left join hook_hits h on h.payment_id = p.payment_id""")
case("shop_webhook_apply_orders", lambda w: _applied(w)["fact_orders"], "order_id:i customer_id:i order_status:s updated_at:t",
     """select o.order_id, o.customer_id, coalesce(new_order_status, order_status) as order_status, if(new_order_status is null, updated_at, received_at) as updated_at
        from fact_orders o left join hook_hits h on h.order_id = o.order_id""")


def _merged_hooks(w):
    """All events in three batches on merge-on-read tables, the second one sent twice; the tables at the end."""
    spark = w["fact_orders"].sparkSession
    root = f"{checkpoint_root(spark)}/{uuid.uuid4().hex}"
    for name, key in ((hooks.PAYMENTS, "payment_id"), (hooks.ORDERS, "order_id")):
        buckets.create(w[name], f"{root}/{name}", key, 4)
    # Written down once: each batch reads its part.
    events = cut(webhooks.dedupe(webhooks.accepted(w["webhook_bodies"])).withColumn("_part", F.when(F.col("received_at") < "1994-06-01", 0).when(F.col("received_at") < "1997-01-01", 1).otherwise(2)))
    for part in (0, 1, 1, 2):
        hooks.apply(spark, root, events.where(F.col("_part") == part).drop("_part"), part)
    return {n: buckets.read(spark, f"{root}/{n}") for n in (hooks.PAYMENTS, hooks.ORDERS)}


for _name, _like in ((hooks.PAYMENTS, "shop_webhook_apply"), (hooks.ORDERS, "shop_webhook_apply_orders")):
    case(_like.replace("apply", "merge"), lambda w, n=_name: _merged_hooks(w)[n], CASES[_like].columns, CASES[_like].sql)
case("adm_stock_band", lambda w: admin.stock_band(shop.inventory_apply(w)), "product_id:i stock_qty:i in_stock:b",
     f"select product_id, available_qty as stock_qty, available_qty > 0 as in_stock from ({CASES['shop_inventory_apply'].sql})")
