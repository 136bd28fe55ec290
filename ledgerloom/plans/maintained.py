"""Marts that follow their tables: sums are changed by what changed, never rebuilt.

Each state table is a merge-on-read table (``buckets``) of sums by a key. It follows the
tables below it through their logs: the rows that changed since the version it has
followed are subtracted as they were and added as they are, and only the keys they
touch are written. How far it has followed is put down in the same log entry as the
sums, so a job that dies anywhere is simply run again. What does not add up by itself
is kept as counts that do: a customer is active on a day while their orders of that day
number more than none, a session has reached a stage while its events there do.

``follow`` brings everything up to date; ``exec_daily`` and ``finance_profitability``
then read a row a day or a row an order, without a shuffle of any fact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.expr import attach
from ledgerloom.operators import finance, funnel, marts
from ledgerloom.operators.views import Tables, orders_completed
from ledgerloom.plans import buckets
from ledgerloom.session import configure, cut, release, scratch

_MONEY, _SIGN = "decimal(38,4)", "_sign"
ORDER_SUMS, DAY_CUSTOMERS, DAY_SESSIONS, DAYS = "_order_sums", "_day_customers", "_day_sessions", "_days"
_STAGES = tuple(funnel.STAGE_FLAGS)
_FUNNEL = (*funnel.STAGE_COUNTS, "payment_failed")
_FLAG_OF = {**funnel.STAGE_COUNTS, "payment_failed": "pay_failed"}
_HEAD = ("order_id", "customer_id", "geo_id", "order_ts", "order_dt", "order_status", "channel", "currency")


#: Writes rows down for as long as a state is brought up to date, and reads them back.
Put = Callable[[DataFrame], DataFrame]


class Follower(NamedTuple):
    """A state table: its key, its sums with their types, and what it adds up from which tables below it."""

    name: str
    key: str
    key_type: str
    sums: dict[str, str]
    below: tuple[str, ...]
    changes: Callable[[SparkSession, str, dict[str, int], dict[str, int], Put], DataFrame]  # signed rows between two sets of versions


def signed(spark: SparkSession, path: str, since: int, until: int, put: Put = cut) -> DataFrame:
    """Rows that changed between two versions, as they were (``_sign`` -1) and as they are (1)."""
    if since == until:
        return buckets._live(spark, buckets.snapshot(spark, path, until), []).withColumn(_SIGN, F.lit(1))
    new = buckets.snapshot(spark, path, until)
    if not since:
        return buckets._live(spark, new, new.entries).withColumn(_SIGN, F.lit(1))
    keys = put(buckets.changed_keys(spark, path, since, until))
    old = buckets.lookup(buckets.snapshot(spark, path, since), keys)
    return old.withColumn(_SIGN, F.lit(-1)).unionByName(buckets.lookup(new, keys).withColumn(_SIGN, F.lit(1)))


def _times(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c) * F.col(_SIGN)


def _union(parts: list[DataFrame], f: Follower) -> DataFrame:
    """Parts with some of the sums each, summed by key."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    missing = [F.lit(None).cast(t).alias(c) for c, t in f.sums.items() if c not in whole.columns]
    return whole.select("*", *missing).groupBy(f.key).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(t).alias(c) for c, t in f.sums.items()])


# ------------------------------------------------------------------ sums of each order
def _order_changes(spark: SparkSession, root: str, since: dict[str, int], until: dict[str, int], put: Put) -> DataFrame:
    rows = {n: signed(spark, f"{root}/{n}", since.get(n, 0), until[n], put) for n in _ORDERS.below}
    revenue, cost = F.col("qty") * F.col("unit_sell_price"), F.col("qty") * F.col("unit_cost")
    return _union([
        rows["fact_order_items"].select("order_id", _times(revenue).alias("_revenue"), _times(cost).alias("_cogs"), _times("line_discount").alias("_discount"), _times("line_tax").alias("_tax")),
        rows["fact_shipments"].select("order_id", _times("shipping_cost").alias("_ship"), _times(F.coalesce(F.col("sla_breached_flag").cast("int"), F.lit(0))).alias("_lates")),
        rows["fact_payments"].select("order_id", _times(finance.fee()).alias("_fee")),
        rows["fact_returns"].select("order_id", _times("refund_amount").alias("_refund")),
    ], _ORDERS)


_ORDERS = Follower(
    ORDER_SUMS, "order_id", "bigint", {**dict.fromkeys(("_revenue", "_cogs", "_discount", "_tax", "_ship", "_fee", "_refund"), _MONEY), "_lates": "bigint"},
    ("fact_order_items", "fact_shipments", "fact_payments", "fact_returns"), _order_changes,
)


def _pnl(orders: DataFrame, sums: DataFrame) -> DataFrame:
    head = orders_completed({"fact_orders": orders}).select(*_HEAD)
    joined = head.join(sums.withColumn("_late", F.col("_lates") > 0), "order_id", "left")
    return finance.pnl_of(joined, list(_HEAD))


def _pnl_changes(spark: SparkSession, root: str, since: dict[str, int], until: dict[str, int], put: Put) -> DataFrame:
    """P&L rows of the orders whose head or sums changed, as they were and as they are."""
    paths = [f"{root}/fact_orders", f"{root}/{ORDER_SUMS}"]
    new = [buckets.snapshot(spark, p, until[n]) for p, n in zip(paths, ("fact_orders", ORDER_SUMS), strict=True)]
    if not since:
        return _pnl(*[buckets._live(spark, s, s.entries) for s in new]).withColumn(_SIGN, F.lit(1))
    keys = [buckets.changed_keys(spark, p, since[n], until[n]) for p, n in zip(paths, ("fact_orders", ORDER_SUMS), strict=True)]
    touched = put(keys[0].union(keys[1]).distinct())
    old = [buckets.snapshot(spark, p, since[n]) for p, n in zip(paths, ("fact_orders", ORDER_SUMS), strict=True)]
    before, after = (_pnl(*[buckets.lookup(s, touched) for s in side]) for side in (old, new))
    return before.withColumn(_SIGN, F.lit(-1)).unionByName(after.withColumn(_SIGN, F.lit(1)))


# ------------------------------------------------------------------ who and which sessions a day has
def _customer_changes(spark: SparkSession, root: str, since: dict[str, int], until: dict[str, int], put: Put) -> DataFrame:
    pnl = _pnl_changes(spark, root, since, until, put)
    key = F.concat_ws("|", F.col("order_dt").cast("string"), F.col("customer_id").cast("string"))
    return _union([pnl.select(key.alias("day_customer"), F.col(_SIGN).alias("orders"))], _CUSTOMERS)


_CUSTOMERS = Follower(DAY_CUSTOMERS, "day_customer", "string", {"orders": "bigint"}, ("fact_orders", ORDER_SUMS), _customer_changes)


def _session_changes(spark: SparkSession, root: str, since: dict[str, int], until: dict[str, int], put: Put) -> DataFrame:
    events = signed(spark, f"{root}/fact_funnel_events", since.get("fact_funnel_events", 0), until["fact_funnel_events"], put)
    key = F.concat_ws("|", F.to_date("event_ts").cast("string"), F.col("session_id"))
    reached = [_times((F.coalesce(F.col("stage") == stage, F.lit(False))).cast("int")).alias(flag) for flag, stage in funnel.STAGE_FLAGS.items()]
    return _union([events.where("event_ts is not null").select(key.alias("day_session"), *reached)], _SESSIONS)


_SESSIONS = Follower(DAY_SESSIONS, "day_session", "string", dict.fromkeys(_STAGES, "bigint"), ("fact_funnel_events",), _session_changes)


# ------------------------------------------------------------------ days
def _day_changes(spark: SparkSession, root: str, since: dict[str, int], until: dict[str, int], put: Put) -> DataFrame:
    rows = lambda n: signed(spark, f"{root}/{n}", since.get(n, 0), until[n], put)
    own = {n: v for n, v in since.items() if n in ("fact_orders", ORDER_SUMS)}
    pnl = _pnl_changes(spark, root, own, until, put)
    day_of = lambda c: F.to_date(F.split_part(c, F.lit("|"), F.lit(1))).alias("d")
    customers, sessions = rows(DAY_CUSTOMERS), rows(DAY_SESSIONS)
    orders, events, back, ship = (rows(n) for n in ("fact_orders", "fact_funnel_events", "fact_returns", "fact_shipments"))
    active = F.col(_SIGN).alias("activity")
    shipped = F.to_date(F.coalesce("shipped_ts", "created_at")).alias("d")
    return _union([
        pnl.select(F.col("order_dt").alias("d"), F.col(_SIGN).alias("orders"), *[_times(c).alias(c) for c in marts.DAILY_MONEY]),
        customers.select(day_of(F.col("day_customer")), _times((F.col("orders") > 0).cast("int")).alias("active_customers")),
        sessions.select(day_of(F.col("day_session")), *[_times((F.col(_FLAG_OF[c]) > 0).cast("int")).alias(c) for c in _FUNNEL]),
        orders.select(F.to_date("order_ts").alias("d"), active),
        events.select(F.to_date("event_ts").alias("d"), active),
        back.select(F.to_date("return_ts").alias("d"), active, F.col(_SIGN).alias("return_lines"), _times("refund_amount").alias("refund_amount_return_dt")),
        ship.select(shipped, active, F.col(_SIGN).alias("shipments"), _times(F.coalesce(F.col("sla_breached_flag").cast("int"), F.lit(0))).alias("breaches")),
    ], _DAYS).where("d is not null")


_DAYS = Follower(
    DAYS, "d", "date",
    {"orders": "bigint", "active_customers": "bigint", **dict.fromkeys(marts.DAILY_MONEY, _MONEY), **dict.fromkeys(_FUNNEL, "bigint"), "activity": "bigint",
     "return_lines": "bigint", "refund_amount_return_dt": _MONEY, "shipments": "bigint", "breaches": "bigint"},
    ("fact_orders", ORDER_SUMS, DAY_CUSTOMERS, DAY_SESSIONS, "fact_funnel_events", "fact_returns", "fact_shipments"), _day_changes,
)

#: Each after those it follows.
FOLLOWERS = (_ORDERS, _CUSTOMERS, _SESSIONS, _DAYS)


# ------------------------------------------------------------------ following
def follow(spark: SparkSession, root: str, width: int | None = None) -> dict[str, int]:
    """Bring every state table up to the newest versions of those below it; rows written by each.

    ``width``: the fewest buckets of a state table that does not exist yet; a large one gets as many as any table of its size.
    """
    configure(spark)
    written = {}
    for f in FOLLOWERS:
        path = f"{root}/{f.name}"
        s = buckets.snapshot(spark, path) if buckets._versions(spark, path) else None
        since = s.marks if s else {}
        until = {n: buckets.snapshot(spark, f"{root}/{n}").version for n in f.below}
        if since == until:
            written[f.name] = 0
            continue
        with scratch(spark, f"{path}/_scratch") as put:
            now = put(f.changes(spark, root, since, until, put).where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in f.sums])))
            release(spark)
            if s is None:
                # Nothing to add to: the sums are the table.
                written[f.name] = now.count()
                buckets.create(now, path, f.key, width, until)
            else:
                old = buckets.lookup(s, now).withColumnsRenamed({c: f"old_{c}" for c in f.sums})
                sums = [(F.col(c) + F.coalesce(f"old_{c}", F.lit(0))).cast(t).alias(c) for c, t in f.sums.items()]
                now = put(now.join(old, f.key, "left").select(f.key, *sums))
                written[f.name] = now.count()
                buckets.append(now, s, until)
        release(spark)
    return written


def compact(spark: SparkSession, root: str, deltas: int = 4) -> None:
    for f in FOLLOWERS:
        buckets.compact(spark, f"{root}/{f.name}", deltas)


# ------------------------------------------------------------------ marts
def exec_daily(spark: SparkSession, root: str, dims: Tables) -> DataFrame:
    """The daily mart from its state: a row for each calendar day between the first and last activity."""
    days = buckets.read(spark, f"{root}/{DAYS}")
    bounds = days.where("activity > 0").agg(F.min("d").alias("first_dt"), F.max("d").alias("last_dt"))
    spine = attach(dims["dim_date"].select("date_id", F.col("date_value").alias("d")), bounds)
    spine = spine.where(F.col("d").between(F.col("first_dt"), F.col("last_dt"))).select("date_id", "d")
    return marts.daily_rows(spine.join(days.select("*", *funnel.rates()), "d", "left"))


def finance_profitability(spark: SparkSession, root: str, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The order mart from order heads and their sums, both by order."""
    pnl = _pnl(buckets.read(spark, f"{root}/fact_orders"), buckets.read(spark, f"{root}/{ORDER_SUMS}"))
    return marts.finance_profitability({"dim_date": dims["dim_date"]}, pnl)
