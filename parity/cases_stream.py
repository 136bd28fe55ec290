"""Streaming jobs, run to the end of what is available and compared with batch SQL."""

from __future__ import annotations

import uuid
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import funnel, incremental, webhooks
from ledgerloom.plans import batch, monthly
from ledgerloom.session import checkpoint_root
from ledgerloom.streaming import jobs
from parity.registry import CASES, FRAGMENTS, case
from parity.warehouse import WEBHOOK_SECRET, Warehouse


def _room(w: Warehouse) -> tuple:
    """The session and a fresh folder below the shared checkpoint folder."""
    spark = w["orders"].sparkSession
    return spark, f"{checkpoint_root(spark)}/{uuid.uuid4().hex}"


#: Rows of a file of a made stream.
FILE_ROWS = 2_000_000


def _fed(w: Warehouse, d: str, name: str) -> DataFrame:
    """A table as a stream of three micro-batches: its rows are written first, as three files or, if there are many rows, three times as many as a batch takes."""
    files = max(1, ceil(w[name].count() / 3 / FILE_ROWS))
    w[name].repartition(3 * files).write.parquet(f"{d}/in/{name}")
    return w["orders"].sparkSession.readStream.schema(w[name].schema).option("maxFilesPerTrigger", files).parquet(f"{d}/in/{name}")


def _ingest(w: Warehouse, part: str) -> DataFrame:
    spark, d = _room(w)
    jobs.ingest_events(_fed(w, d, "raw_event_requests"), f"{d}/events", f"{d}/cp")
    return jobs.read_events(spark, f"{d}/events", part == "accepted")


_REQ = "event_id:i event_ts:t session_id:s customer_id:i product_id:i order_id:i stage:s channel:s device:s failure_reason:s"
_CLEAN = """select * replace (coalesce(channel, 'WEB') as channel, coalesce(device, 'DESKTOP') as device, {stage} as stage) from fact_funnel_events where stage {op} 'CHECKOUT_STARTED'"""
case("st_ingest_events", lambda w: _ingest(w, "accepted"), _REQ, _CLEAN.format(stage="stage", op="<>"))
case("st_ingest_quarantine", lambda w: _ingest(w, "quarantine"), _REQ, _CLEAN.format(stage="'CHECKOUT-BEGUN'", op="="))


def _dedupe(w: Warehouse) -> DataFrame:
    spark, d = _room(w)
    once = _fed(w, d, "fact_funnel_events")
    twice = once.unionByName(once)
    jobs.dedupe_events(twice, f"{d}/out", f"{d}/cp")
    return jobs.read_folder(spark, f"{d}/out")


case("st_dedupe_events", _dedupe, _REQ, "from fact_funnel_events")


def _daily(w: Warehouse) -> DataFrame:
    spark, d = _room(w)
    jobs.daily_flags(_fed(w, d, "fact_funnel_events"), f"{d}/out", f"{d}/cp")
    return funnel.metrics(jobs.read_daily_flags(spark, f"{d}/out"), "event_dt")


case("st_daily_funnel", _daily, CASES["fn_daily_metrics"].columns, "from day_funnel")


def _journeys(w: Warehouse) -> DataFrame:
    spark, d = _room(w)
    jobs.journey_parts(_fed(w, d, "fact_funnel_events"), f"{d}/out", f"{d}/cp")
    return jobs.read_journeys(spark, f"{d}/out")


case("st_journey_sessions", _journeys, CASES["adm_journey_sessions"].columns,
     """select session_id, max(customer_id) as customer_id, min(event_ts) as first_event_ts, max(event_ts) as last_event_ts, count(*) as event_count, max(channel) as channel,
        max(device) as device from fact_funnel_events group by 1""")


def _merge_orders(w: Warehouse) -> DataFrame:
    spark, d = _room(w)
    rule = incremental.RULES["fact_orders"]
    batch.init_table(w["fact_orders"], f"{d}/table", rule)
    jobs.merge_stream(_fed(w, d, "stg_fact_orders"), f"{d}/table", rule, f"{d}/audit", f"{d}/cp")
    return monthly.read(spark, f"{d}/table").drop("month")


case("st_merge_facts", _merge_orders, CASES["inc_merge_orders"].columns, CASES["inc_merge_orders"].sql)


def _late_returns(w: Warehouse) -> DataFrame:
    """Start without damaged goods; the stream then brings every return, whatever its date."""
    spark, d = _room(w)
    rule = incremental.RULES["fact_returns"]
    batch.init_table(w["fact_returns"].where("return_reason <> 'DAMAGED'"), f"{d}/table", rule)
    w["stg_fact_returns"].write.parquet(f"{d}/in")
    stream = spark.readStream.schema(w["stg_fact_returns"].schema).option("maxFilesPerTrigger", 4).parquet(f"{d}/in")
    jobs.merge_stream(stream, f"{d}/table", rule, f"{d}/audit", f"{d}/cp")
    return monthly.read(spark, f"{d}/table").drop("month")


case("st_late_data", _late_returns, "return_id:i order_id:i return_reason:s refund_amount:m return_status:s updated_at:t",
     """select f.* replace (greatest(s.updated_at, f.updated_at) as updated_at, if(s.updated_at > f.updated_at, s.return_status, f.return_status) as return_status)
        from fact_returns f join stg_fact_returns s using (return_id) where f.return_reason <> 'DAMAGED'
        union all by name select * from stg_fact_returns where return_id in (select return_id from fact_returns where return_reason = 'DAMAGED')""")


def _webhooks(w: Warehouse) -> DataFrame:
    spark, d = _room(w)
    jobs.webhook_stream(w.stream("webhook_bodies"), WEBHOOK_SECRET, f"{d}/events", f"{d}/bad", f"{d}/cp")
    events = jobs.read_folder(spark, f"{d}/events").drop("batch")
    return webhooks.apply(w, events)["fact_payments"]


FRAGMENTS["good_hooks"] = """select * from hook_states where signature is not null and signature <> 'deadbeef'
  qualify row_number() over (partition by event_id order by received_at, body) = 1"""
case("st_webhooks", _webhooks, "payment_id:i order_id:i payment_status:s payment_provider_payment_id:s failure_reason:s",
     """select p.payment_id, p.order_id, coalesce(new_payment_status, p.payment_status) as payment_status, h.provider_payment_id as payment_provider_payment_id,
          coalesce(h.failure_reason, p.failure_reason) as failure_reason
        from fact_payments p left join (select g.*, (select max(payment_id) from fact_payments f where f.payment_provider_order_id = g.provider_order_id) as payment_id from good_hooks g) h
          on h.payment_id = p.payment_id""")


def _inventory(w: Warehouse) -> DataFrame:
    spark, d = _room(w)
    moves = _fed(w, d, "lineitem").select(F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("long").alias("qty"), F.lit("RESERVED").alias("action"))
    jobs.inventory_stream(moves, w["product_inventory"], f"{d}/out", f"{d}/cp")
    return jobs.read_inventory(spark, f"{d}/out")


case("st_inventory", _inventory, "product_id:i on_hand:i reserved:i accepted:i rejected:i")
