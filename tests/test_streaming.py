"""Streams fed in several micro-batches give the batch answer."""

from __future__ import annotations

import hashlib
import hmac
import json

from pyspark.sql import functions as F

from ledgerloom.operators import admin, funnel
from ledgerloom.plans.publish import folders
from ledgerloom.streaming import ids, jobs


def feed(spark, df, path, parts=3):
    """Write ``df`` as files in time order and read it back as a stream of one file per micro-batch."""
    df.orderBy("event_ts").repartitionByRange(parts, "event_ts").write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_daily_funnel_equals_batch_over_micro_batches(spark, house, tmp_path):
    events = house["fact_funnel_events"]
    jobs.daily_flags(feed(spark, events, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = funnel.metrics(jobs.read_daily_flags(spark, str(tmp_path / "out")), "event_dt")
    assert sorted(got.collect()) == sorted(funnel.daily_metrics(house).collect())


def test_journeys_combine_across_batches_and_restarts(spark, house, tmp_path):
    events = house["fact_funnel_events"]
    stream = feed(spark, events, str(tmp_path / "in"))
    jobs.journey_parts(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    jobs.journey_parts(stream, str(tmp_path / "out"), str(tmp_path / "cp"))  # nothing new, nothing counted twice
    got = jobs.read_journeys(spark, str(tmp_path / "out"))
    want = admin.journey_sessions(house, "2024-01-31", 24 * 30 , limit=None)
    first = events.agg(F.min("event_ts")).first()[0]
    assert str(first) >= "2024-01-01"
    assert sorted(got.collect()) == sorted(want.collect())


def test_repeated_events_pass_once(spark, house, tmp_path):
    events = house["fact_funnel_events"]
    jobs.dedupe_events(feed(spark, events.unionByName(events), str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    out = jobs.read_folder(spark, str(tmp_path / "out"))
    assert out.count() == events.count() == out.select("event_id").distinct().count()


def test_repeats_in_state_pass_once(spark, house, tmp_path):
    events = house["fact_funnel_events"]
    once = jobs.drop_repeats(feed(spark, events.unionByName(events), str(tmp_path / "in"), 1))
    jobs.run_available(once, str(tmp_path / "cp"), jobs.to_folder(str(tmp_path / "out")))
    assert jobs.read_folder(spark, str(tmp_path / "out")).count() == events.count()


def moves(spark, frame, tmp_path, steps):
    """One file per movement, so that each is a micro-batch of its own."""
    for i, (qty, action) in enumerate(steps):
        frame([(1, qty, action)], "product_id long, qty long, action string").coalesce(1).write.parquet(str(tmp_path / "in" / f"{i:03d}"))
    ddl = "product_id long, qty long, action string"
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))


def position(spark, frame, tmp_path, on_hand, steps):
    stock = frame([(1, on_hand, 0)], "product_id long, on_hand_qty int, reserved_qty int")
    jobs.inventory_stream(moves(spark, frame, tmp_path, steps), stock, str(tmp_path / "out"), str(tmp_path / "cp"))
    r = jobs.read_inventory(spark, str(tmp_path / "out")).first()
    return r.on_hand, r.reserved, r.accepted, r.rejected


def test_second_reservation_of_the_last_item_is_rejected(spark, frame, tmp_path):
    assert position(spark, frame, tmp_path, 1, [(1, "RESERVED"), (1, "RESERVED")]) == (1, 1, 1, 1)


def test_reserve_then_pay_empties_the_stock(spark, frame, tmp_path):
    assert position(spark, frame, tmp_path, 2, [(2, "RESERVED"), (2, "CONSUMED")]) == (0, 0, 2, 0)


def test_unknown_stage_goes_to_quarantine(spark, frame, tmp_path):
    raw = frame([(1, "2024-01-01", "session1", None, 1, None, " view_product ", None, "", ""), (2, "2024-01-01", "session1", None, 1, None, "hover", None, None, None),
                 (3, "2024-01-01", "s", None, 1, None, "VIEW_CART", None, None, None)],
                "event_id long, event_ts timestamp, session_id string, customer_id long, product_id long, order_id long, stage string, channel string, device string, failure_reason string")
    got = {r.event_id: (r.valid, r.stage, r.channel, r.device, r.failure_reason) for r in jobs.normalise(raw).collect()}
    assert got == {1: (True, "VIEW_PRODUCT", "WEB", "DESKTOP", None), 2: (False, "HOVER", "WEB", "DESKTOP", None), 3: (False, "VIEW_CART", "WEB", "DESKTOP", None)}


EVENTS = "event_id long, event_ts timestamp, session_id string"


def batches(spark, frame, tmp_path, ddl, *parts):
    """A stream with one file, and so one micro-batch, for each list of rows."""
    for i, rows in enumerate(parts):
        frame(rows, ddl).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i:03d}"))
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))


def test_an_id_passes_once_whatever_day_a_repeat_carries(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(ids, "MERGE_EVERY", 2)
    stream = batches(spark, frame, tmp_path, EVENTS, [(1, "2024-01-02", "a"), (1, "2024-01-01", "b")], [(1, "2024-01-03", "c"), (2, "2024-01-03", "c")],
                     [(2, "2024-02-01", "d"), (3, None, "d")], [(3, "2024-01-01", "e")], [(4, "2024-01-01", "e"), (1, "2024-01-09", "e")], [(4, "2024-01-02", "f")])
    out = str(tmp_path / "out")
    jobs.dedupe_events(stream, out, str(tmp_path / "cp"))
    got = sorted((r.event_id, r.session_id) for r in jobs.read_folder(spark, out).collect())
    assert got == [(1, "b"), (2, "c"), (3, "d"), (4, "e")]
    assert folders(spark, f"{out}/_ids/merged")
    stored = ids.stored(spark, f"{out}/_ids", 99)
    assert sorted(r.event_id for r in stored.collect()) == [1, 2, 3, 4]


def test_a_replayed_batch_does_not_meet_its_own_ids(spark, frame, tmp_path):
    store = str(tmp_path / "ids")
    one, two = frame([(1, None, "a")], EVENTS), frame([(1, None, "a"), (2, None, "b")], EVENTS)
    ids.remember(one, ["event_id"], store, 0)
    for _ in range(2):
        fresh = ids.unseen(two, ["event_id"], store, 1)
        assert [r.event_id for r in fresh.collect()] == [2]
        ids.remember(fresh, ["event_id"], store, 1)


def test_every_webhook_delivery_is_an_event_a_repeat_or_in_quarantine(spark, frame, tmp_path):
    secret = "s3"
    body = lambda n: json.dumps({"id": f"e{n}", "event": "payment.failed", "payload": {"payment": {"entity": {"id": "p", "order_id": "o", "error_description": "x" * 200}}}})
    sign = lambda b: hmac.new(secret.encode(), b.encode(), hashlib.sha256).hexdigest()
    ddl = "body string, signature string, received_at timestamp"
    good = [(body(n), sign(body(n)), "2024-01-01") for n in range(3)]
    stream = batches(spark, frame, tmp_path, ddl, [good[0], (body(7), "bad", "2024-01-01")], [good[0], good[1], ("{", sign("{"), "2024-01-01")], [good[1], good[2], (body(8), None, "2024-01-01")])
    jobs.webhook_stream(stream, secret, str(tmp_path / "ev"), str(tmp_path / "bad"), str(tmp_path / "cp"))
    events = jobs.read_folder(spark, str(tmp_path / "ev")).collect()
    assert sorted(r.event_id for r in events) == ["e0", "e1", "e2"]
    assert all(len(r.failure_reason) == 80 and len(r.failure_text) == 200 for r in events)
    assert sorted(r.body for r in jobs.read_folder(spark, str(tmp_path / "bad")).collect()) == sorted([body(7), body(8), "{"])


def test_movements_of_unknown_products_are_kept(spark, frame, tmp_path):
    ddl = "product_id long, qty long, action string"
    stock = frame([(1, 5, 0)], "product_id long, on_hand_qty int, reserved_qty int")
    stream = batches(spark, frame, tmp_path, ddl, [(1, 1, "RESERVED"), (2, 1, "RESERVED")], [(None, 3, "CONSUMED")], [(1, 1, "CONSUMED")])
    jobs.unknown_products(stream, stock, str(tmp_path / "bad"), str(tmp_path / "cp"))
    got = {(r.product_id, r.qty) for r in jobs.read_folder(spark, str(tmp_path / "bad")).collect()}
    assert got == {(2, 1), (None, 3)}


def test_ingest_keeps_every_request_on_one_side(spark, frame, tmp_path):
    ddl = "event_id long, event_ts timestamp, session_id string, customer_id long, product_id long, order_id long, stage string, channel string, device string, failure_reason string"
    row = lambda n, stage: (n, "2024-01-01", "session1", None, 1, None, stage, None, None, None)
    stream = batches(spark, frame, tmp_path, ddl, [row(1, "VIEW_CART"), row(2, "hover")], [row(3, "VIEW_CART")], [row(4, None)])
    jobs.ingest_events(stream, str(tmp_path / "ev"), str(tmp_path / "cp"))
    read = lambda valid: sorted(r.event_id for r in jobs.read_events(spark, str(tmp_path / "ev"), valid).collect())
    assert (read(True), read(False)) == ([1, 3], [2, 4])


def test_inventory_goes_on_from_earlier_batches(spark, frame, tmp_path):
    from ledgerloom.streaming import jobs

    ddl = "product_id long, qty long, action string"
    stock = frame([(1, 5, 0), (2, 1, 0), (3, 9, 0)], "product_id long, on_hand_qty long, reserved_qty long")
    stream = batches(spark, frame, tmp_path, ddl, [(1, 3, "RESERVED"), (2, 1, "RESERVED"), (4, 1, "RESERVED")], [(1, 3, "RESERVED"), (2, 1, "CONSUMED")], [(1, 2, "RESERVED"), (1, 1, "RESERVED")])
    jobs.inventory_stream(stream, stock, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {tuple(r) for r in jobs.read_inventory(spark, str(tmp_path / "out")).collect()}
    assert got == {(1, 5, 5, 2, 2), (2, 0, 0, 2, 0)}
    last = spark.read.parquet(str(tmp_path / "out" / "batch=2"))
    assert [r.product_id for r in last.collect()] == [1]


def test_a_large_made_stream_is_many_files(spark, frame, tmp_path, monkeypatch):
    from parity import cases_stream

    monkeypatch.setattr(cases_stream, "FILE_ROWS", 10)
    table = frame([(i,) for i in range(100)], "id long")
    cases_stream._fed({"t": table, "orders": table}, str(tmp_path), "t")
    assert len(list((tmp_path / "in" / "t").glob("*.parquet"))) == 12
