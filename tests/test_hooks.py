"""Webhook effects by key: what is read and written, repeats, and payments that take another provider id."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import webhooks
from ledgerloom.plans import buckets, hooks

HOOK = "body string, signature string, received_at timestamp"


def event(n, order, kind="payment.captured", at="2024-01-01"):
    return (f'{{"id":"e{n}","event":"{kind}","payload":{{"payment":{{"entity":{{"id":"p{n}","order_id":"{order}"}}}}}}}}', "s", at)


@pytest.fixture()
def root(house, tmp_path):
    for name, key in ((hooks.PAYMENTS, "payment_id"), (hooks.ORDERS, "order_id")):
        buckets.create(house[name], f"{tmp_path}/{name}", key, 8)
    return str(tmp_path)


def some_payments(house, n):
    return house["fact_payments"].where("payment_provider_order_id is not null").orderBy("payment_id").limit(n).collect()


def index(spark, root, order):
    row = buckets.read(spark, f"{root}/{hooks.INDEX}").where(F.col("provider_order_id") == order).first()
    return None if row is None else row["payment_id"]


def test_a_batch_changes_its_own_buckets_once(spark, house, frame, root):
    p = some_payments(house, 1)[0]
    events = webhooks.accepted(frame([event(1, p["payment_provider_order_id"]), event(2, "unknown")], HOOK))
    before = {n: set(buckets.snapshot(spark, f"{root}/{n}").entries) for n in (hooks.PAYMENTS, hooks.ORDERS)}
    assert hooks.apply(spark, root, events, 4) == {hooks.PAYMENTS: 1, hooks.ORDERS: 1}
    for n, old in before.items():
        s = buckets.snapshot(spark, f"{root}/{n}")
        assert old <= set(s.entries) and len(set(s.entries) - old) == 1 and s.marks[hooks.MARK] == 4
    index_of = buckets.snapshot(spark, f"{root}/{hooks.INDEX}")
    read = buckets.lookup(index_of, events.select("provider_order_id")).inputFiles()
    assert len({f.split("bucket=")[1].split("/")[0] for f in read}) <= 2 < index_of.buckets
    assert hooks.apply(spark, root, events, 4) == {hooks.PAYMENTS: 0, hooks.ORDERS: 0}
    whole = webhooks.apply(house, events)
    for n in before:
        assert buckets.read(spark, f"{root}/{n}").exceptAll(whole[n]).isEmpty() and whole[n].exceptAll(buckets.read(spark, f"{root}/{n}")).isEmpty()


def test_a_batch_that_died_between_the_tables_is_finished_as_it_began(spark, house, frame, root, monkeypatch):
    p = some_payments(house, 1)[0]
    events = webhooks.accepted(frame([event(1, p["payment_provider_order_id"])], HOOK))
    whole = hooks._change

    def dies(spark, path, *rest):
        if path.endswith(hooks.ORDERS):
            raise RuntimeError("lost")
        return whole(spark, path, *rest)

    monkeypatch.setattr(hooks, "_change", dies)
    with pytest.raises(RuntimeError):
        hooks.apply(spark, root, events, 0)
    monkeypatch.setattr(hooks, "_change", whole)
    assert hooks.apply(spark, root, events, 0) == {hooks.PAYMENTS: 0, hooks.ORDERS: 1}


def test_the_index_follows_new_payments_and_those_that_move(spark, house, root):
    p = some_payments(house, 1)[0]
    order = p["payment_provider_order_id"]
    hooks.follow(spark, root)
    assert index(spark, root, order) == p["payment_id"] and hooks.follow(spark, root) == 0

    def write(**changed):
        s = buckets.snapshot(spark, f"{root}/{hooks.PAYMENTS}")
        row = house["fact_payments"].where(F.col("payment_id") == p["payment_id"])
        buckets.append(row.select(*[F.lit(changed[c]).cast(row.schema[c].dataType).alias(c) if c in changed else F.col(c) for c in row.columns]), s)
        return hooks.follow(spark, root)

    assert write(payment_id=10**12) == 1 and index(spark, root, order) == 10**12
    # The newer payment takes another id: the older one is the newest again.
    assert write(payment_id=10**12, payment_provider_order_id="other") == 2
    assert index(spark, root, order) == p["payment_id"] and index(spark, root, "other") == 10**12
    # And if no payment is left, there is none.
    assert write(payment_id=10**12, payment_provider_order_id=None) == 1 and index(spark, root, "other") is None


def test_accepted_events_parse_a_body_once_to_filter_and_once_to_read(frame):
    raw = frame([('{"id":" e1 ","event":"payment.failed"}', None, "2024-01-01"), ('{"id":" ","event":"payment.failed"}', None, "2024-01-01"), ("not json", None, "2024-01-01"),
                 (None, None, "2024-01-01"), ('{"id":"e2"}', None, "2024-01-01")], "body string, signature string, received_at timestamp")
    events = webhooks.dedupe(webhooks.accepted(raw))
    assert [(r.event_id, r.new_payment_status) for r in events.collect()] == [("e1", "PAYMENT_FAILED")]
    assert webhooks.quarantine(raw).count() == 4
    assert events._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 2
