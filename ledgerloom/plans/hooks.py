"""Webhook effects on merge-on-read tables: what a batch of events changes, found by keys.

An index names for each of the provider's order ids the newest payment that carries it.
It is a merge-on-read table (``buckets``) that follows ``fact_payments`` through its log,
so a batch reads the buckets of its own ids in the index, then those of its payments and
orders, and leaves deltas there. No table is scanned but for ids whose newest payment
took another id; those are looked for again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import webhooks
from ledgerloom.plans import buckets
from ledgerloom.plans.maintained import _SIGN, signed
from ledgerloom.plans.publish import is_published, publish
from ledgerloom.session import configure, cut

PAYMENTS, ORDERS, INDEX, LINKS = "fact_payments", "fact_orders", "_payment_of_provider_order", "_webhook_links"
MARK = "webhook_batch"
_KEY = "provider_order_id"


def _newest(rows: DataFrame) -> DataFrame:
    return rows.groupBy(_KEY).agg(F.max(F.struct("payment_id", "order_id")).alias("_p")).select(_KEY, "_p.payment_id", "_p.order_id")


def follow(spark: SparkSession, root: str, width: int | None = None) -> int:
    """Bring the index up to the newest version of the payments; ids written. ``width``: buckets of a new index."""
    configure(spark)
    path, source = f"{root}/{INDEX}", f"{root}/{PAYMENTS}"
    if not buckets._versions(spark, path):
        buckets.create(spark.createDataFrame([], f"{_KEY} string, payment_id bigint, order_id bigint"), path, _KEY, width or buckets.snapshot(spark, source).buckets)
    s, until = buckets.snapshot(spark, path), buckets.snapshot(spark, source).version
    since = s.marks.get(PAYMENTS, 0)
    if since == until:
        return 0
    of = F.col("payment_provider_order_id").alias(_KEY)
    rows = cut(signed(spark, source, since, until).where(F.col("payment_provider_order_id").isNotNull()).select(of, "payment_id", "order_id", _SIGN))
    new, old = rows.where(F.col(_SIGN) == 1).drop(_SIGN), rows.where(F.col(_SIGN) == -1).select(_KEY, "payment_id")
    current = cut(buckets.lookup(s, rows.select(_KEY).distinct()))
    left = current.join(old.join(new, [_KEY, "payment_id"], "left_anti"), [_KEY, "payment_id"], "left_semi").select(_KEY).distinct()
    fresh = _newest(new.unionByName(current.join(left, _KEY, "left_anti").where("payment_id is not null").join(new.select(_KEY, "payment_id"), [_KEY, "payment_id"], "left_anti")))
    if not left.isEmpty():
        # Their newest payment has another id now: the newest of the rest, or none.
        left = cut(left)
        at = buckets.snapshot(spark, source, until)
        again = _newest(buckets._live(spark, at, at.entries).select(of, "payment_id", "order_id").join(left, _KEY, "left_semi"))
        fresh = fresh.join(left, _KEY, "left_anti").unionByName(left.join(again, _KEY, "left").select(*fresh.columns))
    fresh = cut(fresh)
    written = fresh.count()
    buckets.append(fresh, s, {PAYMENTS: until})
    return written


def _change(spark: SparkSession, path: str, batch: int, effect: DataFrame, changed: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
    """Apply ``effect`` to the rows it names, once for a batch; rows written."""
    while True:
        s = buckets.snapshot(spark, path)
        if s.marks.get(MARK, -1) >= batch:
            return 0
        rows = cut(changed(buckets.lookup(s, effect), effect))
        try:
            buckets.append(rows, s, s.marks | {MARK: batch})
            return rows.count()
        except buckets.Conflict:  # another writer was first: its rows are the ones to change
            continue


def apply(spark: SparkSession, root: str, events: DataFrame, batch: int) -> dict[str, int]:
    """Apply a batch of distinct events; rows changed of each table.

    ``batch`` rises from batch to batch, as a stream's do. A batch that died anywhere is
    simply repeated: it is linked as in its first attempt and changes each table once.
    """
    configure(spark)
    follow(spark, root)
    if not is_published(spark, root, LINKS, str(batch)):
        once = cut(events)
        targets = buckets.lookup(buckets.snapshot(spark, f"{root}/{INDEX}"), once.where(F.col(_KEY).isNotNull()).select(_KEY).distinct())
        linked = once.join(targets.where("payment_id is not null"), _KEY).select(*once.columns, "order_id", "payment_id")
        publish(linked, root, LINKS, str(batch))
    linked = spark.read.parquet(f"{root}/{LINKS}/{batch}")
    effects = {
        PAYMENTS: (webhooks.payment_effects(linked), webhooks.payments_after),
        ORDERS: (webhooks.order_effects(linked), webhooks.orders_after),
    }
    return {name: _change(spark, f"{root}/{name}", batch, cut(effect), changed) for name, (effect, changed) in effects.items()}
