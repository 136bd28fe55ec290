"""Payment webhooks: signature check, parsing, idempotency, and effects on payments and orders.

Every step is a built-in expression; the keyed hash is two SHA-256 calls over
the body with the key's padded blocks in front (RFC 2104).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.views import Tables

# Provider code, event types with the states they lead to, and the reason length.
PROVIDER = "RAZORPAY"
PAID, FAILED = "payment.captured", "payment.failed"
PAYMENT_STATES = {PAID: "PAYMENT_SUCCESS", FAILED: "PAYMENT_FAILED"}
ORDER_STATES = {PAID: "ORDER_CONFIRMED", FAILED: "ORDER_CANCELLED"}
REASON_LENGTH = 80

BODY_SCHEMA = (
    "id string, event string, payload struct<payment: struct<entity: struct<"
    "id: string, order_id: string, error_description: string, error_reason: string>>>"
)
_BLOCK = 64


def hmac_sha256(body: Column, secret: str) -> Column:
    """Hex HMAC-SHA256 of a text column."""
    key = secret.encode()
    key = hashlib.sha256(key).digest() if len(key) > _BLOCK else key
    key = key.ljust(_BLOCK, b"\0")
    inner = F.lit(bytearray(b ^ 0x36 for b in key))
    outer = F.lit(bytearray(b ^ 0x5C for b in key))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(body, "UTF-8")), 256))), 256)


def verify(raw: DataFrame, secret: str) -> DataFrame:
    """Adds ``verified``: the given signature equals ours; a missing one never does."""
    return raw.withColumn("verified", F.coalesce(F.col("signature") == hmac_sha256(F.col("body"), secret), F.lit(False)))


def _text(c: str) -> Column:
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def parse(raw: DataFrame) -> DataFrame:
    """Body text to event columns; ``ok`` is false for broken JSON or a missing id or type."""
    j = raw.withColumn("_j", F.from_json("body", BODY_SCHEMA))
    entity = "_j.payload.payment.entity"
    kind = _text("_j.event")
    why = F.coalesce(F.nullif(F.col(f"{entity}.error_description"), F.lit("")), F.nullif(F.col(f"{entity}.error_reason"), F.lit("")), F.lit("PAYMENT_FAILED"))

    def state(states: dict[str, str]) -> Column:
        return F.when(kind == PAID, states[PAID]).when(kind == FAILED, states[FAILED])

    # The parsed body appears once: a filter that is moved below this step parses for each mention.
    ok = F.exists(F.array("_j"), lambda e: F.nullif(F.trim(e["id"]), F.lit("")).isNotNull() & F.nullif(F.trim(e["event"]), F.lit("")).isNotNull())
    return j.select(
        *raw.columns, F.lit(PROVIDER).alias("provider"), _text("_j.id").alias("event_id"), kind.alias("event_type"),
        _text(f"{entity}.order_id").alias("provider_order_id"), _text(f"{entity}.id").alias("provider_payment_id"),
        state(PAYMENT_STATES).alias("new_payment_status"), state(ORDER_STATES).alias("new_order_status"),
        F.when(kind == FAILED, F.substring(why, 1, REASON_LENGTH)).alias("failure_reason"), F.when(kind == FAILED, why).alias("failure_text"),
        ok.alias("ok"),
    )


def quarantine(raw: DataFrame, secret: str | None = None) -> DataFrame:
    """Deliveries that :func:`accepted` leaves out: broken ones and, with a secret, those not signed with it."""
    if secret is None:
        return parse(raw).where(~F.col("ok")).select(*raw.columns)
    return parse(verify(raw, secret)).where(~F.col("ok") | ~F.col("verified")).select(*raw.columns)


def accepted(raw: DataFrame, secret: str | None = None) -> DataFrame:
    """Parsed, well-formed events; with a secret, only those signed with it."""
    signed = raw if secret is None else verify(raw, secret).where("verified").drop("verified")
    return parse(signed).where("ok").drop("ok")


def dedupe(events: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """The first delivery per (provider, event id), leaving out those already seen."""
    key = ["provider", "event_id"]
    rest = [c for c in events.columns if c not in key]
    order = ["received_at", "body"]
    first = F.min(F.struct(*order, *[c for c in rest if c not in order]))
    out = events.groupBy(*key).agg(first.alias("_f")).select(*[F.col(c) if c in key else F.col(f"_f.{c}").alias(c) for c in events.columns])
    return out if seen is None else out.join(seen.select(*key), key, "left_anti")


def link(events: DataFrame, payments: DataFrame) -> DataFrame:
    """Attach our order and payment: the newest payment with the provider's order id."""
    newest = payments.where(F.col("payment_provider_order_id").isNotNull()).groupBy(
        F.col("payment_provider_order_id").alias("provider_order_id")
    ).agg(F.max_by(F.struct("order_id", "payment_id"), "payment_id").alias("_p"))
    return events.join(newest, "provider_order_id", "left").select(
        *events.columns, F.col("_p.order_id").alias("order_id"), F.col("_p.payment_id").alias("payment_id")
    )


def _last(c: str) -> Column:
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct("received_at", "event_id")))


def payment_effects(linked: DataFrame) -> DataFrame:
    """What linked events say of each payment, later deliveries winning."""
    return linked.groupBy("payment_id").agg(
        _last("new_payment_status").alias("_status"), _last("provider_payment_id").alias("_pid"), _last("signature").alias("_sig"),
        _last("failure_reason").alias("_reason"), F.max(F.when(F.col("new_payment_status") == "PAYMENT_SUCCESS", F.col("received_at"))).alias("_paid"),
        F.max("received_at").alias("_at"),
    )


def order_effects(linked: DataFrame) -> DataFrame:
    """The state that linked events lead each order to."""
    return linked.where(F.col("new_order_status").isNotNull()).groupBy("order_id").agg(
        F.max_by("new_order_status", F.struct("received_at", "event_id")).alias("_status"), F.max("received_at").alias("_at")
    )


def _after(rows: DataFrame, effect: DataFrame, key: str, new: dict[str, Column]) -> DataFrame:
    return rows.join(effect, key, "left").select(*[F.coalesce(new[c], F.col(c)).alias(c) if c in new else F.col(c) for c in rows.columns])


def payments_after(rows: DataFrame, effect: DataFrame) -> DataFrame:
    """Payments with :func:`payment_effects` applied."""
    return _after(rows, effect, "payment_id", {
        "payment_status": F.col("_status"), "payment_provider": F.when(F.col("_at").isNotNull(), PROVIDER), "payment_provider_payment_id": F.col("_pid"),
        "payment_provider_signature": F.col("_sig"), "failure_reason": F.col("_reason"), "captured_ts": F.col("_paid"), "updated_at": F.col("_at"),
    })


def orders_after(rows: DataFrame, effect: DataFrame) -> DataFrame:
    """Orders with :func:`order_effects` applied."""
    return _after(rows, effect, "order_id", {"order_status": F.col("_status"), "updated_at": F.col("_at")})


def apply(t: Tables, events: DataFrame) -> dict[str, DataFrame]:
    """Payments and orders after a batch of distinct events, later deliveries winning.

    An event type without a state change still records the provider's ids. This is the
    whole-table form; ``plans.hooks`` changes the rows of merge-on-read tables by key.
    """
    linked = link(events, t["fact_payments"]).where(F.col("payment_id").isNotNull())
    return {"fact_payments": payments_after(t["fact_payments"], payment_effects(linked)), "fact_orders": orders_after(t["fact_orders"], order_effects(linked))}
