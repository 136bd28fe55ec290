"""Shop data as whole-table jobs: catalogue, carts, pricing, promotions, reviews, orders.

A request's key (customer, product, order) is a column here, so one plan
answers every request at once. Money is decimal and rounded half-up at each
step. Lists of lines stay one row per line: no order, however large, is
gathered into one value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.expr import attach, check_limit, page, rounded, rows, zero
from ledgerloom.functions.ranking import running
from ledgerloom.operators.incremental import dedupe_latest
from ledgerloom.operators.views import Tables, orders_completed, projection, with_product
from ledgerloom.session import checkpoint_root, cut, scratch

# Discount per product id modulo 7, tax rate, and the largest cart quantity.
DISCOUNT_STEPS = (5, 8, 10, 12, 15, 18, 20)
TAX_RATE = "0.07"
MAX_CART_QTY = 20

MONEY = "decimal(14,2)"


def _money(x: Column) -> Column:
    return F.round(x, 2).cast(MONEY)


# ------------------------------------------------------------------ catalogue
def discount_pct(product_id: str = "product_id") -> Column:
    steps = F.array(*[F.lit(s) for s in DISCOUNT_STEPS])
    return F.element_at(steps, (F.col(product_id) % len(DISCOUNT_STEPS) + 1).cast("int"))


def _sell_price() -> Column:
    keep = (100 - F.col("discount_pct")).cast("decimal(3,0)") * F.lit("0.01").cast("decimal(3,2)")
    return _money(F.col("list_price") * keep)


def catalog(t: Tables) -> DataFrame:
    priced = projection(t, "vw_customer_products").withColumn("discount_pct", discount_pct())
    return priced.withColumn("sell_price", _sell_price())


def product_page(t: Tables, limit: int | None = 24, offset: int = 0) -> DataFrame:
    return page(catalog(t), [F.col("product_id")], limit, offset)


def product_lookup(t: Tables, ids: DataFrame) -> DataFrame:
    """Products for a table of ids (each product once, however often it is asked for)."""
    return catalog(t).join(ids.select("product_id"), "product_id", "left_semi")


def units_sold(t: Tables) -> DataFrame:
    per = t["fact_order_items"].groupBy("order_id", "product_id").agg(F.sum("qty").alias("q"))
    done = orders_completed(t).select("order_id")
    return per.join(done, "order_id", "left_semi").groupBy("product_id").agg(F.sum("q").alias("units_sold"))


def product_search(
    t: Tables, q: str | None = None, category_l1: str | None = None, category_l2: str | None = None,
    min_price: float | None = None, max_price: float | None = None, sort: str = "default", limit: int | None = 24, offset: int = 0,
) -> DataFrame:
    """Case-insensitive text match on five columns, exact categories, price range, four orders."""
    check_limit(limit, 200)
    p = projection(t, "vw_customer_products")
    text = (q or "").strip()
    if text:
        like = f"%{text}%"
        p = p.where(reduce(Column.__or__, [F.col(c).ilike(like) for c in ("product_name", "brand", "sku", "category_l1", "category_l2")]))
    for col, value in (("category_l1", category_l1), ("category_l2", category_l2)):
        if value:
            p = p.where(F.col(col) == value)
    if min_price is not None:
        p = p.where(F.col("list_price") >= min_price)
    if max_price is not None:
        p = p.where(F.col("list_price") <= max_price)
    key = (sort or "default").strip().lower()
    orders = {"default": [], "price_asc": [F.col("list_price").asc()], "price_desc": [F.col("list_price").desc()], "best_sellers": [zero("units_sold").desc()]}
    if key not in orders:
        raise ValueError(f"sort must be one of {sorted(orders)}")
    cols = p.columns
    if key == "best_sellers":
        p = p.join(units_sold(t), "product_id", "left")
    return page(p, [*orders[key], F.col("product_id")], limit, offset).select(*cols)


def facets(t: Tables) -> DataFrame:
    """Distinct filter values as (facet, value)."""
    long = t["dim_product"].select("category_l1", "category_l2", "brand").unpivot([], ["category_l1", "category_l2", "brand"], "facet", "value")
    return long.distinct().orderBy("facet", "value")


# ------------------------------------------------------------------ carts and pricing
def priced_lines(lines: DataFrame, t: Tables, *keep: str) -> DataFrame:
    """Line amounts from catalogue prices, each rounded; lines of unknown products are left out."""
    p = catalog(t).select("product_id", "sku", "product_name", "category_l1", "category_l2", "brand", "list_price", "unit_cost", "discount_pct", "sell_price")
    net = F.col("sell_price") * F.col("qty")
    tax = _money(net * F.lit(TAX_RATE).cast("decimal(3,2)"))
    return lines.join(p, "product_id").select(
        *keep, *p.columns, "qty",
        _money(F.col("list_price") * F.col("qty")).alias("line_gross"),
        _money((F.col("list_price") - F.col("sell_price")) * F.col("qty")).alias("line_discount"),
        tax.alias("line_tax"), _money(net + tax).alias("line_total"),
    )


def cart_lines(t: Tables) -> DataFrame:
    return priced_lines(t["customer_cart_items"], t, "customer_id", "updated_at")


def cart_rejects(t: Tables) -> DataFrame:
    """Cart rows whose product does not exist."""
    return t["customer_cart_items"].join(t["dim_product"].select("product_id"), "product_id", "left_anti")


def _header(lines: DataFrame, key: str) -> DataFrame:
    return lines.groupBy(key).agg(
        F.sum("line_gross").alias("gross_amount"), F.sum("line_discount").alias("discount_amount"),
        F.sum("line_tax").alias("tax_amount"), F.sum("line_total").alias("net_amount"),
    )


def cart_totals(t: Tables) -> DataFrame:
    """Totals per customer; a cart with an unknown product is rejected as a whole."""
    bad = cart_rejects(t).select("customer_id").distinct()
    return _header(cart_lines(t), "customer_id").join(bad, "customer_id", "left_anti")


def cart_merge(cart: DataFrame, changes: DataFrame, mode: str = "add") -> DataFrame:
    """Apply cart changes: ``add`` raises quantities up to 20, ``set`` replaces them.

    Adding is a sum however it is split, so changes of a key are summed first.
    """
    if mode not in ("add", "set"):
        raise ValueError("mode must be 'add' or 'set'")
    key = ["customer_id", "product_id"]
    if mode == "add":
        new = changes.groupBy(*key).agg(F.sum("qty").alias("_qty"), F.max("updated_at").alias("_at"))
    else:
        new = dedupe_latest(changes.select(*key, "qty", "updated_at"), key).withColumnsRenamed({"qty": "_qty", "updated_at": "_at"})
    added = F.least(F.lit(MAX_CART_QTY), zero("qty") + F.col("_qty")) if mode == "add" else F.col("_qty")
    return cart.join(new, key, "full_outer").select(
        *key, F.when(F.col("_qty").isNull(), F.col("qty")).otherwise(added).cast("int").alias("qty"),
        F.coalesce("created_at", "_at").alias("created_at"), F.coalesce("_at", "updated_at").alias("updated_at"),
    )


def promo_apply(requests: DataFrame, promos: DataFrame, now: str, amount: str = "amount") -> DataFrame:
    """Check a promo code per request and compute its discount.

    Adds ``code``, ``valid``, ``message`` and ``promo_discount``. The first
    failing check names the message.
    """
    code = F.upper(F.trim(F.coalesce("promo_code", F.lit(""))))
    p = promos.select(F.col("code").alias("_code"), "discount_type", "discount_value", "max_discount", "min_order_amount", "active", "expires_at")
    j = requests.withColumn("code", code).join(p, F.col("code") == F.col("_code"), "left")
    amt, kind = F.col(amount), F.upper("discount_type")
    problem = (
        F.when(F.col("code") == "", "Promo code is required")
        .when(F.col("_code").isNull(), "Invalid code")
        .when(~F.col("active"), "Code not active")
        .when(F.col("expires_at") <= F.to_timestamp(F.lit(now)), "Code expired")
        .when(amt < F.col("min_order_amount"), F.concat(F.lit("Minimum order amount is "), F.col("min_order_amount").cast("double").cast("string")))
        .when(~kind.isin("PERCENT", "FLAT"), "Invalid configuration")
    )
    raw = F.when(kind == "PERCENT", F.round(amt * F.col("discount_value") * F.lit("0.01").cast("decimal(3,2)"), 2)).otherwise(F.col("discount_value"))
    capped = F.least(raw, F.col("max_discount"), amt)  # NULL caps are skipped
    ok = F.col("message").isNull()
    return j.withColumn("message", problem).select(
        *requests.columns, "code", ok.alias("valid"), F.when(ok, "Applied").otherwise(F.col("message")).alias("message"),
        F.when(ok, capped).otherwise(0).cast(MONEY).alias("promo_discount"),
    )


def order_pricing(t: Tables, lines: DataFrame, codes: DataFrame, now: str) -> DataFrame:
    """Header amounts for checkout lines (order_id, product_id, qty) and optional codes per order.

    A valid code adds to the discount and comes off the net amount, not below
    0. An order with a code that fails its checks is marked rejected.
    """
    head = _header(priced_lines(lines, t, "order_id"), "order_id").join(codes.select("order_id", "promo_code"), "order_id", "left")
    promo = promo_apply(head, t["promo_codes"], now, "net_amount")
    used = F.col("code") != ""
    off = F.when(used, F.col("promo_discount")).otherwise(0)
    return promo.select(
        "order_id", "gross_amount", (F.col("discount_amount") + off).cast(MONEY).alias("discount_amount"), "tax_amount",
        F.greatest(F.lit(0), F.col("net_amount") - off).cast(MONEY).alias("net_amount"),
        off.cast(MONEY).alias("promo_discount_amount"), (used & ~F.col("valid")).alias("rejected"),
    )


# ------------------------------------------------------------------ wishlist and reviews
def wishlist_items(t: Tables) -> DataFrame:
    return t["customer_wishlist"].join(projection(t, "vw_customer_products"), "product_id")


def wishlist_add(wishlist: DataFrame, adds: DataFrame) -> DataFrame:
    """Add (customer, product) pairs that are not there yet; repeats change nothing."""
    key = ["customer_id", "product_id"]
    fresh = adds.groupBy(*key).agg(F.min("created_at").alias("created_at")).join(wishlist.select(*key), key, "left_anti")
    return wishlist.unionByName(fresh.select(*wishlist.columns))


def rating_summary(t: Tables) -> DataFrame:
    """Average rating (0 without reviews) and count for every product."""
    per = t["product_reviews"].groupBy("product_id").agg(F.sum("rating").alias("s"), rows().alias("n"))
    mean = rounded(zero(F.col("s").cast("double") / F.col("n")), 2)
    return t["dim_product"].select("product_id").join(per, "product_id", "left").select(
        "product_id", mean.alias("average_rating"), zero("n").alias("rating_count")
    )


def _newest(df: DataFrame, by: str, key: str, limit: int | None, offset: int) -> DataFrame:
    """Rows offset+1 to offset+limit of every group, newest first; rows beyond are dropped before the shuffle too."""
    if offset < 0:
        raise ValueError("offset must not be negative")
    w = Window.partitionBy(by).orderBy(F.col("created_at").desc(), key)
    placed = df.withColumn("position", F.row_number().over(w))
    if limit is not None:
        placed = placed.where(F.col("position") <= offset + limit)
    return placed.where(F.col("position") > offset) if offset else placed


def reviews_latest(t: Tables, limit: int | None = 20, offset: int = 0) -> DataFrame:
    """A page of every product's reviews, newest first; all of them without a limit."""
    check_limit(limit, 100)
    return _newest(t["product_reviews"], "product_id", "review_id", limit, offset)


def review_upsert(reviews: DataFrame, posted: DataFrame) -> DataFrame:
    """One review per (product, customer): a new post replaces rating and text, and keeps id and creation time."""
    key = ["product_id", "customer_id"]
    new = dedupe_latest(posted.select(*key, "review_id", "rating", "title", "body", "updated_at"), key)
    n = new.withColumnsRenamed({c: f"_{c}" for c in new.columns if c not in key})
    changed = F.col("_updated_at").isNotNull()
    return reviews.join(n, key, "full_outer").select(
        F.coalesce("review_id", "_review_id").alias("review_id"), *key,
        *[F.when(changed, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ("rating", "title", "body")],
        F.coalesce("created_at", "_updated_at").alias("created_at"), F.coalesce("_updated_at", "updated_at").alias("updated_at"),
    )


# Orders that do not count as purchases.
VOID_STATUSES = ("CANCELLED", "PAYMENT_FAILED")


def review_eligibility(t: Tables, pairs: DataFrame, as_of: str) -> DataFrame:
    """For (customer, product) pairs: eligible once delivered, else NOT_DELIVERED or NOT_PURCHASED."""
    live = t["fact_orders"].where(~F.upper(F.coalesce("order_status", F.lit(""))).isin(*VOID_STATUSES)).select("order_id", "customer_id")
    arrived = t["fact_shipments"].where(F.col("delivered_dt") <= F.to_date(F.lit(as_of))).select("order_id").distinct()
    orders = live.join(arrived.withColumn("_here", F.lit(True)), "order_id", "left")
    bought = (
        t["fact_order_items"].select("order_id", "product_id").distinct().join(orders, "order_id")
        .groupBy("customer_id", "product_id").agg(F.bool_or(F.coalesce("_here", F.lit(False))).alias("_delivered"))
    )
    asked = pairs.select("customer_id", "product_id").distinct().join(bought, ["customer_id", "product_id"], "left")
    ok = F.coalesce("_delivered", F.lit(False))
    reason = F.when(F.col("_delivered").isNull(), "NOT_PURCHASED").when(~ok, "NOT_DELIVERED")
    return asked.select("customer_id", "product_id", ok.alias("eligible"), reason.alias("reason"))


# ------------------------------------------------------------------ orders
def _per_line(head: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders with their lines; an order without lines has one row.

    The orders are written down while the plan is built: read back they are exchanged
    for the join like the lines, and so an order with very many lines is split at run
    time. That works for inner joins, hence the second part.
    """
    head = cut(head)
    bare = head.join(lines.groupBy("order_id").agg(rows().alias("_n")), "order_id", "left_anti")
    return lines.join(head, "order_id").select(*head.columns, *[c for c in lines.columns if c != "order_id"]).unionByName(bare, allowMissingColumns=True)


def order_detail(t: Tables) -> DataFrame:
    """Header, payment and promotion of every order, one row per line."""
    head = t["fact_orders"].select("order_id", "customer_id", "order_ts", "order_status", "gross_amount", "discount_amount", "tax_amount", "net_amount")
    pay = t["fact_payments"].groupBy("order_id").agg(F.max_by("payment_status", "payment_id").alias("payment_status"))
    promo = t["order_promotions"].select("order_id", "promo_code", F.col("discount_amount").alias("promo_discount_amount"))
    lines = with_product(t["fact_order_items"].select("order_id", "order_item_id", "product_id", "qty"), t, "product_name")
    return _per_line(head.join(pay, "order_id", "left").join(promo, "order_id", "left"), lines)


def _progress(t: Tables, as_of: str) -> DataFrame:
    """Per order: latest shipping facts and the status they imply at a moment."""
    moment = F.to_timestamp(F.lit(as_of))
    ship = t["fact_shipments"].groupBy("order_id").agg(F.max("shipped_ts").alias("shipped_ts"), F.max("delivered_dt").alias("delivered_dt"))
    j = t["fact_orders"].select("order_id", "customer_id", "order_ts", "order_status", "net_amount").join(ship, "order_id", "left")
    shipped = F.coalesce(F.col("shipped_ts") <= moment, F.lit(False))
    delivered = F.coalesce(F.col("delivered_dt") <= F.to_date(moment), F.lit(False))
    status = (
        F.when(F.upper("order_status") == "CANCELLED", "CANCELLED").when(delivered, "DELIVERED").when(shipped, "SHIPPED").otherwise("PLACED")
    )
    return j.select("*", shipped.alias("is_shipped"), delivered.alias("is_delivered"), status.alias("current_status"))


def order_timeline(t: Tables, as_of: str) -> DataFrame:
    """Derived status and the time each stage was reached."""
    stop = t["order_cancellations"].groupBy("order_id", "customer_id").agg(
        F.max("created_at").alias("_stopped"), F.max_by("reason", "created_at").alias("_why")
    )
    now = F.col("current_status")
    cancelled = now == "CANCELLED"
    return _progress(t, as_of).join(stop, ["order_id", "customer_id"], "left").select(
        "order_id", "customer_id", now, F.col("order_ts").alias("placed_ts"),
        F.when(~cancelled & F.col("is_shipped"), F.col("shipped_ts")).alias("shipped_ts"),
        F.when(now == "DELIVERED", F.col("delivered_dt")).alias("delivered_dt"),
        F.when(cancelled, F.col("_stopped")).alias("cancelled_ts"), F.when(cancelled, F.col("_why")).alias("cancel_reason"),
    )


def newest_orders(t: Tables, limit: int) -> DataFrame:
    """Each customer's newest orders by position. The limit stands straight on the scanned orders, so it cuts before the shuffle."""
    w = Window.partitionBy("customer_id").orderBy(F.col("order_ts").desc(), "order_id")
    return t["fact_orders"].select("order_id", "customer_id", "order_ts").withColumn("position", F.row_number().over(w)).where(F.col("position") <= limit)


def order_history(t: Tables, limit: int = 20, as_of: str | None = None) -> DataFrame:
    """Each customer's newest orders, one row per line.

    With a clock the status is derived from shipping; without one the stored
    status is shown.
    """
    if as_of is None:
        head = t["fact_orders"].select("order_id", "customer_id", "order_ts", "order_status", "net_amount")
    else:
        kept = F.when(F.upper("order_status") == "CANCELLED", F.col("order_status")).otherwise(F.col("current_status"))
        head = _progress(t, as_of).select("order_id", "customer_id", "order_ts", kept.alias("order_status"), "net_amount")
    head = head.join(newest_orders(t, limit).select("order_id", "position"), "order_id")
    lines = with_product(t["fact_order_items"].select("order_id", "product_id", "qty", "order_item_id"), t, "product_name")
    return _per_line(head, lines)


def cancellable(t: Tables, as_of: str) -> DataFrame:
    """Orders still PLACED, neither shipped nor delivered."""
    return _progress(t, as_of).where((F.upper("order_status") == "PLACED") & ~F.col("is_shipped") & ~F.col("is_delivered")).select("order_id", "customer_id", "order_ts")


# ------------------------------------------------------------------ people
def customer_bucket(t: Tables, emails: DataFrame) -> DataFrame:
    """Resolve e-mails to customers: md5(email) modulo n picks a customer in id order.

    The 128-bit hash is folded as two 64-bit halves in exact decimals.
    """
    ranked = running(t["dim_customer"].select("customer_id", "geo_id"), [("customer_id", False)])
    n = t["dim_customer"].agg(rows().cast("decimal(20,0)").alias("_n"))
    clean = emails.select(F.lower(F.trim("email")).alias("email")).where("email <> ''").distinct()
    h = F.md5("email")

    def half(start: int) -> Column:
        return F.conv(F.substring(h, start, 16), 16, 10).cast("decimal(20,0)")

    def mod(x: Column) -> Column:
        return (x % F.col("_n")).cast("decimal(18,0)")

    two64 = F.lit(str(2**64)).cast("decimal(20,0)")
    bucket = mod((mod(half(1)) * mod(two64)).cast("decimal(38,0)") + mod(half(17)).cast("decimal(38,0)"))
    keyed = attach(clean, n).withColumn("row_no", bucket.cast("bigint") + 1)
    return keyed.join(ranked, "row_no").select("email", "customer_id", "geo_id")


def latest_email(users: DataFrame) -> DataFrame:
    return users.groupBy("customer_id").agg(F.max_by("email", F.struct("updated_at", "email")).alias("email"))


def outbox_latest(t: Tables, limit: int | None = 20, offset: int = 0) -> DataFrame:
    return _newest(t["email_outbox"], "customer_id", "email_id", limit, offset)


def address_order(t: Tables) -> DataFrame:
    """Addresses with each customer's in order, the default first; customers are in no order."""
    return t["customer_addresses"].repartition("customer_id").sortWithinPartitions("customer_id", F.col("is_default").desc(), F.col("created_at").desc(), "address_id")


# ------------------------------------------------------------------ inventory
def inventory_seed(t: Tables, now: str) -> DataFrame:
    """Stock rows for products that have none yet: 25 plus the id modulo 25."""
    have = t["product_inventory"]
    fresh = t["dim_product"].select("product_id").join(have.select("product_id"), "product_id", "left_anti").select(
        "product_id", (25 + F.col("product_id") % 25).cast("int").alias("on_hand_qty"), F.lit(0).alias("reserved_qty"), F.to_timestamp(F.lit(now)).alias("updated_at")
    )
    return have.unionByName(fresh)


def inventory_shortages(t: Tables, requests: DataFrame) -> DataFrame:
    """Order lines that current stock cannot serve, each request judged on its own."""
    need = requests.groupBy("order_id", "product_id").agg(F.sum("qty").alias("requested"))
    stock = t["product_inventory"].select("product_id", (F.col("on_hand_qty") - F.col("reserved_qty")).alias("available"))
    j = need.join(stock, "product_id", "left")
    problem = F.when(F.col("available").isNull(), "MISSING").when(F.col("available") < F.col("requested"), "INSUFFICIENT")
    return j.select("order_id", "product_id", "requested", "available", problem.alias("problem")).where("problem is not null")


def reserve_orders(t: Tables, requests: DataFrame) -> DataFrame:
    """Which orders get their stock: order_id, n_lines, qty, accepted and reason of each order of ``requests`` (order_id, product_id, qty).

    Orders come in turn (order_ts, then order_id). One is accepted if every one of its
    products still has what it needs after the accepted orders before it, or else takes
    nothing at all. The result is that of going through them one by one, but found for
    all at once: with the open orders before it all accepted, what fits is accepted; with
    none of them accepted, what does not fit is rejected. Each round settles the first
    open order at least, and mostly all but those that compete for the last pieces of a
    product; settled products leave. Running totals are by ranges, so a product that
    every order wants is not one task.
    """
    line = requests.groupBy("order_id", "product_id").agg(F.sum("qty").cast("long").alias("qty"))
    stock = t["product_inventory"].select("product_id", (F.col("on_hand_qty") - F.col("reserved_qty")).cast("long").alias("available"))
    turn = t["fact_orders"].select("order_id", "order_ts")
    with scratch(requests.sparkSession, checkpoint_root(requests.sparkSession)) as put:
        lines = put(line.join(stock, "product_id", "left").join(turn, "order_id"))
        never = F.coalesce(F.col("qty") > F.col("available"), F.lit(True))
        orders = lines.groupBy("order_id").agg(
            rows().alias("n_lines"), F.sum("qty").alias("qty"), F.bool_or(never).alias("hopeless"), F.bool_or(F.col("available").isNull()).alias("missing")
        )
        live = lines.join(orders.where(~F.col("hopeless")).select("order_id"), "order_id", "left_semi").withColumn("taken", F.lit(False))
        accepted = []
        while True:
            both = live.select("*", F.when(F.col("taken"), F.col("qty")).otherwise(0).alias("sure"))
            sums = running(both, [("order_ts", False), ("order_id", False)], ["product_id"], ["qty", "sure"])
            judged = sums.where(~F.col("taken")).groupBy("order_id").agg(
                F.bool_and(F.col("run_qty") <= F.col("available")).alias("fits"), F.bool_or(F.col("run_sure") + F.col("qty") > F.col("available")).alias("fails")
            )
            settled = put(judged.where("fits or fails"))
            if settled.isEmpty():
                break
            accepted.append(settled.where("fits").select("order_id"))
            now = live.join(settled, "order_id", "left").where(~F.coalesce("fails", F.lit(False))).withColumn("taken", F.col("taken") | F.coalesce("fits", F.lit(False))).drop("fits", "fails")
            # Files have the size they have; a checkpoint keeps the plan's estimate, a product over joins, whose digits triple with every round.
            now = put(now)
            live = now.join(now.where(~F.col("taken")).select("product_id").distinct(), "product_id", "left_semi")
        taken = reduce(DataFrame.unionByName, accepted).withColumn("accepted", F.lit(True)) if accepted else live.select("order_id", F.lit(True).alias("accepted")).limit(0)
        ok = F.coalesce("accepted", F.lit(False))
        reason = F.when(~ok, F.when(F.col("missing"), "MISSING").otherwise("INSUFFICIENT"))
        return cut(orders.join(taken, "order_id", "left").select("order_id", "n_lines", "qty", ok.alias("accepted"), reason.alias("reason")))


def inventory_apply(t: Tables) -> DataFrame:
    """Stock after all reservations: consumed leaves both counts, released only the reserved one (not below 0)."""
    q = F.col("qty")

    def part(status: str) -> Column:
        return F.sum(F.when(F.col("status") == status, q).otherwise(0))

    log = t["order_inventory_reservations"].groupBy("product_id").agg(
        F.sum("qty").alias("_all"), part("CONSUMED").alias("_consumed"), part("RELEASED").alias("_released")
    )
    reserved = F.greatest(F.lit(0), F.col("reserved_qty") + zero("_all") - zero("_consumed") - zero("_released"))
    on_hand = F.col("on_hand_qty") - zero("_consumed")
    return t["product_inventory"].join(log, "product_id", "left").select(
        "product_id", on_hand.alias("on_hand_qty"), reserved.alias("reserved_qty"), (on_hand - reserved).alias("available_qty")
    )
