"""Carts, promotions, orders, inventory and webhooks on small tables."""

from __future__ import annotations

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import shop, webhooks
from ledgerloom.session import configure

CART = "customer_id long, product_id long, qty int, created_at timestamp, updated_at timestamp"


def test_two_adds_make_one_line_and_set_replaces(frame):
    cart = frame([(1, 1, 2, "2024-01-01", "2024-01-01"), (2, 1, 19, "2024-01-01", "2024-01-01")], CART)
    add = frame([(1, 1, 1, "2024-01-02"), (2, 1, 5, "2024-01-02"), (3, 9, 4, "2024-01-02")], "customer_id long, product_id long, qty int, updated_at timestamp")
    assert sorted((r.customer_id, r.qty) for r in shop.cart_merge(cart, add).collect()) == [(1, 3), (2, 20), (3, 4)]
    assert sorted((r.customer_id, r.qty) for r in shop.cart_merge(cart, add, "set").collect()) == [(1, 1), (2, 5), (3, 4)]
    with pytest.raises(ValueError):
        shop.cart_merge(cart, add, "drop")


def test_promo_checks_in_order(spark, house, frame):
    asks = frame([(1, 1000, "welcome10 "), (2, 9000, "WELCOME10"), (3, 400, "FLAT100"), (4, 60, "PAUSED"), (5, 60, "OLDCODE"), (6, 60, "BROKEN"), (7, 60, "X"), (8, 60, None)],
                 "id long, amount decimal(14,2), promo_code string")
    got = {r.id: (r.valid, r.message, float(r.promo_discount)) for r in shop.promo_apply(asks, house["promo_codes"], "2024-01-01 00:00:00").collect()}
    assert got == {
        1: (True, "Applied", 100.0), 2: (True, "Applied", 250.0), 3: (False, "Minimum order amount is 499.0", 0.0), 4: (False, "Code not active", 0.0),
        5: (False, "Code expired", 0.0), 6: (False, "Invalid configuration", 0.0), 7: (False, "Invalid code", 0.0), 8: (False, "Promo code is required", 0.0),
    }


def test_order_rejected_for_a_bad_code_keeps_its_price(house):
    lines = house["fact_order_items"].select("order_id", "product_id", "qty")
    priced = shop.order_pricing(house, lines, house["checkout_requests"], "2024-01-01 00:00:00")
    assert priced.where("rejected and promo_discount_amount > 0").count() == 0
    assert priced.where("net_amount < 0").count() == 0
    assert priced.where("not rejected and promo_discount_amount > 0").count() > 0


def stock(frame, on_hand):
    return frame([(1, on_hand, 0, "2024-01-01")], "product_id long, on_hand_qty int, reserved_qty int, updated_at timestamp")


def log(frame, rows):
    return frame(rows, "order_id long, product_id long, qty int, status string")


def test_inventory_consume_and_release(frame):
    paid = shop.inventory_apply({"product_inventory": stock(frame, 2), "order_inventory_reservations": log(frame, [(1, 1, 2, "CONSUMED")])}).first()
    assert (paid.on_hand_qty, paid.reserved_qty) == (0, 0)
    freed = shop.inventory_apply({"product_inventory": stock(frame, 1), "order_inventory_reservations": log(frame, [(1, 1, 1, "RELEASED")])}).first()
    assert (freed.on_hand_qty, freed.reserved_qty) == (1, 0)


def test_shortages_name_missing_and_insufficient(frame):
    asks = frame([(1, 1, 1), (1, 1, 1), (2, 7, 1), (3, 1, 1)], "order_id long, product_id long, qty int")
    got = {(r.order_id, r.problem) for r in shop.inventory_shortages({"product_inventory": stock(frame, 1)}, asks).collect()}
    assert got == {(1, "INSUFFICIENT"), (2, "MISSING")}


def test_email_bucket_is_md5_modulo_count(house):
    ids = [r[0] for r in house["dim_customer"].orderBy("customer_id").select("customer_id").collect()]
    got = {r.email: r.customer_id for r in shop.customer_bucket(house, house["user_emails"]).collect()}
    for email, cid in got.items():
        assert cid == ids[int(hashlib.md5(email.encode()).hexdigest(), 16) % len(ids)]


@pytest.mark.parametrize("secret", ["k", "whsec_demo", "s" * 100])
def test_hmac_matches_the_standard_library(spark, secret):
    bodies = ["", "{}", "naïve ✓", "x" * 5000]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [r[0] for r in df.select(webhooks.hmac_sha256(F.col("body"), secret)).collect()]
    assert got == [hmac.new(secret.encode(), b.encode(), hashlib.sha256).hexdigest() for b in bodies]


HOOK = "body string, signature string, received_at timestamp"


def test_webhook_bad_json_missing_ids_and_repeats(frame):
    raw = frame([("nope", "s", "2024-01-01"), ('{"event":"payment.captured"}', "s", "2024-01-01"), ('{"id":"e1","event":"payment.failed","payload":{"payment":{"entity":{"order_id":"o"}}}}', "s", "2024-01-01"),
                 ('{"id":"e1","event":"payment.failed"}', "s", "2024-01-02")], HOOK)
    assert webhooks.quarantine(raw).count() == 2
    once = webhooks.dedupe(webhooks.accepted(raw)).collect()
    assert [(r.event_id, r.provider_order_id, r.failure_reason) for r in once] == [("e1", "o", "PAYMENT_FAILED")]
    assert webhooks.dedupe(webhooks.accepted(raw), webhooks.accepted(raw)).count() == 0


def test_unknown_event_type_changes_no_state(house, frame):
    body = '{"id":"e9","event":"refund.created","payload":{"payment":{"entity":{"id":"pay_x","order_id":"prov_2"}}}}'
    events = webhooks.accepted(frame([(body, "s", "2024-01-01")], HOOK))
    out = webhooks.apply(house, events)
    newest = "payment_id = 5"  # order 2 was tried twice
    before = house["fact_payments"].where(newest).first()
    after = out["fact_payments"].where(newest).first()
    assert after.payment_status == before.payment_status and after.payment_provider_payment_id == "pay_x"
    assert out["fact_orders"].where("order_id = 2").first().order_status == house["fact_orders"].where("order_id = 2").first().order_status


def test_review_upsert_keeps_identity(frame):
    ddl = "review_id long, product_id long, customer_id long, rating short, title string, body string, created_at timestamp, updated_at timestamp"
    have = frame([(1, 5, 7, 3, "old", None, "2024-01-01", "2024-01-01")], ddl)
    post = frame([(99, 5, 7, 4, "new", "b", "2024-02-01", "2024-02-01"), (100, 6, 7, 5, "n", None, "2024-02-01", "2024-02-01")], ddl)
    got = sorted((r.review_id, r.product_id, r.rating, str(r.created_at)[:10], str(r.updated_at)[:10]) for r in shop.review_upsert(have, post).collect())
    assert got == [(1, 5, 4, "2024-01-01", "2024-02-01"), (100, 6, 5, "2024-02-01", "2024-02-01")]


def test_search_rejects_unknown_sort(house, spark):
    configure(spark)
    with pytest.raises(ValueError):
        shop.product_search(house, sort="random")


def test_orders_take_their_stock_in_turn_or_not_at_all(frame, spark):
    """Random orders of several lines against going through them one by one; ties in time, one product that every order wants, products without stock."""
    import random

    rng = random.Random(6)
    stock = {p: rng.randrange(0, 60) for p in range(12)} | {0: 150}
    orders = [(k, f"2024-01-{1 + rng.randrange(9):02d}") for k in range(120)]
    lines = [(k, p, rng.randrange(1, 9)) for k, _ in orders for p in {0, *rng.choices(range(13), k=rng.randrange(4))} if k % 3 or p] + [(5, 1, 2), (5, 1, 3), (7, 99, 1)]
    need = {}
    for k, p, q in lines:
        need.setdefault(k, {}).setdefault(p, 0)
        need[k][p] += q
    left, want = dict(stock), {}
    for _, k in sorted((ts, k) for k, ts in orders):
        if k in need:
            own = need[k]
            ok = all(left.get(p, -1) >= q for p, q in own.items())
            want[k] = (len(own), sum(own.values()), ok, None if ok else "MISSING" if any(p not in stock for p in own) else "INSUFFICIENT")
            for p, q in own.items() if ok else ():
                left[p] -= q
    t = {
        "product_inventory": frame([(p, n + 3, 3) for p, n in stock.items()], "product_id long, on_hand_qty int, reserved_qty int"),
        "fact_orders": frame(orders, "order_id long, order_ts timestamp"),
    }
    got = shop.reserve_orders(t, frame(lines, "order_id long, product_id long, qty int"))
    assert {r.order_id: tuple(r)[1:] for r in got.collect()} == want
    assert 10 < sum(ok for _, _, ok, _ in want.values()) < 110
    assert shop.reserve_orders(t, frame([], "order_id long, product_id long, qty int")).count() == 0


def test_a_chain_of_competing_orders_does_not_grow_the_estimates(frame, spark, monkeypatch):
    """Each order wants the piece that the one before it wants too, so every round settles one: later rounds must plan as quickly as the first."""
    n, known = 8, []
    whole = shop.running

    def watched(df, *args):
        known.append(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length())
        return whole(df, *args)

    monkeypatch.setattr(shop, "running", watched)
    t = {
        "product_inventory": frame([(p, 1, 0) for p in range(n + 1)], "product_id long, on_hand_qty int, reserved_qty int"),
        "fact_orders": frame([(k, f"2024-01-{1 + k:02d}") for k in range(n)], "order_id long, order_ts timestamp"),
    }
    got = shop.reserve_orders(t, frame([(k, p, 1) for k in range(n) for p in (k, k + 1)], "order_id long, product_id long, qty int"))
    assert {r.order_id: r.accepted for r in got.collect()} == {k: k % 2 == 0 for k in range(n)}
    assert len(known) >= n // 2 and max(known) < 128  # bits of the estimated size, tripled by each round when estimates are kept
