"""Structured Streaming jobs over the same operators as the batch side.

Sinks are folders with one sub-folder per micro-batch that a replayed batch
replaces, so every job is exactly-once given a replayable source. Micro-batches
leave results that combine on read; the inventory job goes on from the positions it left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.expr import rows
from ledgerloom.operators import funnel, incremental, webhooks
from ledgerloom.operators.marts import DEFAULT_CHANNEL, DEFAULT_DEVICE
from ledgerloom.plans import batch
from ledgerloom.session import configure
from ledgerloom.sources.schemas import FUNNEL_STAGES
from ledgerloom.streaming import ids

SESSION_LENGTH = (6, 64)
REASON_LENGTH = 80


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process everything available now and stop; a later call goes on where this one ended."""
    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
    )
    query.awaitTermination()


def to_folder(path: str) -> Callable[[DataFrame, int], None]:
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


# ------------------------------------------------------------------ events
def normalise(requests: DataFrame) -> DataFrame:
    """Clean incoming events and mark the acceptable ones with ``valid``."""
    stage = F.upper(F.trim("stage"))
    reason = F.nullif(F.trim("failure_reason"), F.lit(""))
    valid = (
        stage.isin(*FUNNEL_STAGES) & F.length("session_id").between(*SESSION_LENGTH) & (F.coalesce(F.length(reason), F.lit(0)) <= REASON_LENGTH)
    )
    return requests.select(
        "event_id", "event_ts", "session_id", "customer_id", "product_id", "order_id", stage.alias("stage"),
        F.upper(F.coalesce(F.nullif("channel", F.lit("")), F.lit(DEFAULT_CHANNEL))).alias("channel"),
        F.upper(F.coalesce(F.nullif("device", F.lit("")), F.lit(DEFAULT_DEVICE))).alias("device"),
        reason.alias("failure_reason"), F.coalesce(valid, F.lit(False)).alias("valid"),
    )


def ingest_events(requests: DataFrame, path: str, checkpoint: str) -> None:
    """Accepted and refused requests in one write, side by side in folders by ``valid``."""

    def split(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("valid").parquet(f"{path}/batch={batch_id}")

    run_available(normalise(requests), checkpoint, split)


def read_events(spark: SparkSession, path: str, valid: bool = True) -> DataFrame:
    return read_folder(spark, path).where(F.col("valid") == valid).drop("valid")


def drop_repeats(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Streaming de-duplication in state: ids are remembered for the delay.

    Events later than the delay are lost, so this suits sources with a known
    bound on lateness; :func:`dedupe_events` has no such limit.
    """
    return events.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def dedupe_events(events: DataFrame, path: str, checkpoint: str) -> None:
    """Each event id once, however late a repeat comes and whatever time it carries.

    Of the deliveries in one micro-batch the earliest stays. Ids are looked up in a
    store beside the events; nothing is kept in state and nothing is dropped for
    being late.
    """

    def each(df: DataFrame, batch_id: int) -> None:
        spark, store = df.sparkSession, f"{path}/_ids"
        rest = ["event_ts", *[c for c in df.columns if c not in ("event_id", "event_ts")]]
        first = df.groupBy("event_id").agg(F.min(F.struct(*rest)).alias("_f")).select("event_id", "_f.*").select(*df.columns)
        fresh = ids.unseen(first, ["event_id"], store, batch_id).withColumn("event_dt", F.to_date("event_ts"))
        out = f"{path}/batch={batch_id}"
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("event_dt").parquet(out)
        ids.remember(spark.read.schema(fresh.schema).parquet(out), ["event_id"], store, batch_id)

    run_available(events, checkpoint, each)


def daily_flags(events: DataFrame, path: str, checkpoint: str) -> None:
    """Per micro-batch stage flags by day and session.

    Flags only ever turn on, so batches combine by OR on read: no window has
    to stay open and a late event still counts.
    """

    def each(df: DataFrame, batch_id: int) -> None:
        flags = funnel.session_flags(df, F.to_date("event_ts").alias("event_dt"), "session_id")
        to_folder(path)(flags, batch_id)

    run_available(events, checkpoint, each)


def read_daily_flags(spark: SparkSession, path: str) -> DataFrame:
    parts = read_folder(spark, path)
    return parts.groupBy("event_dt", "session_id").agg(*[F.bool_or(f).alias(f) for f in funnel.STAGE_FLAGS])


def journey_parts(events: DataFrame, path: str, checkpoint: str) -> None:
    """Per micro-batch session summaries; they combine on read, so no session stays in memory."""

    def summarise(df: DataFrame, batch_id: int) -> None:
        part = df.groupBy("session_id").agg(
            F.max("customer_id").alias("customer_id"), F.min("event_ts").alias("first_event_ts"), F.max("event_ts").alias("last_event_ts"),
            rows().alias("event_count"), F.max("channel").alias("channel"), F.max("device").alias("device"),
        )
        to_folder(path)(part, batch_id)

    run_available(events, checkpoint, summarise)


def read_journeys(spark: SparkSession, path: str) -> DataFrame:
    return read_folder(spark, path).groupBy("session_id").agg(
        F.max("customer_id").alias("customer_id"), F.min("first_event_ts").alias("first_event_ts"), F.max("last_event_ts").alias("last_event_ts"),
        F.sum("event_count").alias("event_count"), F.max("channel").alias("channel"), F.max("device").alias("device"),
    )


# ------------------------------------------------------------------ facts
def merge_stream(deltas: DataFrame, table_path: str, rule: incremental.MergeRule, audit_path: str, checkpoint: str) -> None:
    """Merge each micro-batch of changes into a monthly table.

    There is no event-time cut-off: a change is judged by its version alone,
    so a return that shows up weeks later still lands. Replaying a batch finds
    nothing newer and changes nothing.
    """

    def each(df: DataFrame, batch_id: int) -> None:
        batch.merge_into(df.sparkSession, table_path, df, rule, audit_path, f"{batch_id:012d}")

    run_available(deltas, checkpoint, each)


def webhook_stream(raw: DataFrame, secret: str, events_path: str, quarantine_path: str, checkpoint: str) -> None:
    """Verified, parsed, first-time webhook events, one folder per micro-batch.

    Broken bodies and wrong signatures go to the quarantine, so every delivery that is
    no repeat is in one of the two folders.
    """
    key = ["provider", "event_id"]

    def each(df: DataFrame, batch_id: int) -> None:
        spark, store = df.sparkSession, f"{events_path}/_ids"
        fresh = ids.unseen(webhooks.dedupe(webhooks.accepted(df, secret)), key, store, batch_id)
        to_folder(events_path)(fresh, batch_id)
        ids.remember(spark.read.schema(fresh.schema).parquet(f"{events_path}/batch={batch_id}"), key, store, batch_id)
        to_folder(quarantine_path)(webhooks.quarantine(df, secret), batch_id)

    run_available(raw, checkpoint, each)


# ------------------------------------------------------------------ inventory
_STATE = "on_hand long, reserved long, accepted long, rejected long"
_POSITION = f"product_id long, {_STATE}"


def _book(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Go through rows sorted by product and turn; a reservation beyond the stock is rejected.

    A product's first row may be the position it had (no action). Positions come out of
    products that moved.
    """
    product, moved, on_hand, reserved, accepted, rejected = None, False, 0, 0, 0, 0
    for chunk in chunks:
        done = []
        for p, action, qty, h, r, a, x in zip(*[chunk[c].tolist() for c in ("product_id", "action", "qty", "on_hand", "reserved", "accepted", "rejected")]):
            if p != product:
                if moved:
                    done.append((product, on_hand, reserved, accepted, rejected))
                product, moved, on_hand, reserved, accepted, rejected = p, False, int(h), int(r), int(a), int(x)
            if action is None:
                continue
            moved = True
            if action == "RESERVED":
                if on_hand - reserved < qty:
                    rejected += 1
                    continue
                reserved += qty
            elif action == "CONSUMED":
                if reserved < qty or on_hand < qty:
                    rejected += 1
                    continue
                on_hand, reserved = on_hand - qty, reserved - qty
            else:
                reserved = max(0, reserved - qty)
            accepted += 1
        if done:
            yield pd.DataFrame(done, columns=["product_id", "on_hand", "reserved", "accepted", "rejected"])
    if moved:
        yield pd.DataFrame([(product, on_hand, reserved, accepted, rejected)], columns=["product_id", "on_hand", "reserved", "accepted", "rejected"])


def inventory_stream(movements: DataFrame, stock: DataFrame, path: str, checkpoint: str) -> None:
    """Stock position per product over single-line movements (product_id, qty, action).

    Movements of one product must be taken in turn: those of a micro-batch are dealt by
    product, sorted by arrival behind the position that earlier batches left, and pass
    through a task row by row, however many a product has. Nothing is called for each
    product, and no product stays in memory. Movements of a product without stock are no
    part of a position: see :func:`unknown_products`.
    """

    def each(df: DataFrame, batch_id: int) -> None:
        spark = configure(df.sparkSession)
        first = stock.select("product_id", F.col("on_hand_qty").cast("long").alias("on_hand"), F.col("reserved_qty").cast("long").alias("reserved"))
        zero = F.lit(0).cast("long")
        rows_of = df.withColumn("_turn", F.monotonically_increasing_id()).join(first, "product_id").select("*", zero.alias("accepted"), zero.alias("rejected"))
        if batch_id:
            before = spark.read.schema(f"{_POSITION}, batch int").option("basePath", path).parquet(path).where(F.col("batch") < batch_id)
            rows_of = rows_of.unionByName(_last(before).select("*", F.lit(-1).cast("long").alias("_turn"), F.lit(None).cast("string").alias("action"), zero.alias("qty")))
        booked = rows_of.repartition("product_id").sortWithinPartitions("product_id", "_turn").mapInPandas(_book, _POSITION)
        to_folder(path)(booked, batch_id)

    run_available(movements.select("product_id", "qty", "action").where(F.col("product_id").isNotNull()), checkpoint, each)


def unknown_products(movements: DataFrame, stock: DataFrame, quarantine_path: str, checkpoint: str) -> None:
    """Put movements of products that have no stock row, or no product at all, into the quarantine."""
    strange = movements.join(stock.select("product_id"), "product_id", "left_anti")
    run_available(strange, checkpoint, to_folder(quarantine_path))


def _last(emitted: DataFrame) -> DataFrame:
    cols = ("on_hand", "reserved", "accepted", "rejected")
    return emitted.groupBy("product_id").agg(F.max_by(F.struct(*cols), "batch").alias("s")).select("product_id", *[f"s.{c}" for c in cols])


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """The last emitted position per product."""
    return _last(read_folder(spark, path))
