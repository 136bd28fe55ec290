"""Versioned upserts: delta preparation, merge, audit pre-images and counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.expr import attach, rows
from ledgerloom.functions.ranking import running
from ledgerloom.operators.views import Tables


@dataclass(frozen=True)
class MergeRule:
    """How one table is merged: its key, the columns an update may change, and whether old rows are kept."""

    table: str
    key: str
    updates: tuple[str, ...]
    audit: bool = False
    version: str = "updated_at"
    partition_source: str = "created_at"
    inserts_only: bool = False


# Per table, the columns an update may change (everything else keeps its first value).
RULES = {
    r.table: r
    for r in (
        MergeRule("dim_customer", "customer_id", ("geo_id", "acquisition_channel")),
        MergeRule("dim_product", "product_id", ("product_name", "category_l1", "category_l2", "brand", "unit_cost", "list_price")),
        MergeRule("fact_orders", "order_id", ("order_status", "gross_amount", "discount_amount", "tax_amount", "net_amount"), True),
        MergeRule("fact_order_items", "order_item_id", ("qty", "unit_sell_price", "line_discount", "line_tax", "line_net_revenue")),
        MergeRule(
            "fact_payments", "payment_id",
            ("payment_status", "captured_ts", "failure_reason", "refund_amount", "chargeback_flag", "gateway_fee_amount"), True,
        ),
        MergeRule("fact_shipments", "shipment_id", ("delivered_dt", "shipping_cost", "sla_breached_flag"), True),
        MergeRule("fact_returns", "return_id", ("return_status", "refund_amount", "restocked_flag"), True),
    )
}


#: Events are only ever added.
EVENTS = MergeRule("fact_funnel_events", "event_id", (), inserts_only=True)


@dataclass(frozen=True)
class MergeResult:
    merged: DataFrame | None
    audit: DataFrame | None
    counts: DataFrame
    changed: DataFrame  # inserted and updated rows as they are now


# ------------------------------------------------------------------ deltas
def extract(source: DataFrame, watermark: str, run_ts: str, version: str = "updated_at") -> DataFrame:
    """Rows changed after the watermark, up to and including the start of this run."""
    v = F.col(version)
    return source.where((v > F.to_timestamp(F.lit(watermark))) & (v <= F.to_timestamp(F.lit(run_ts))))


def concat_delta(*parts: DataFrame) -> DataFrame:
    """Union of delta parts; ``_seq`` remembers their order so that later parts win ties."""
    tagged = [p.withColumn("_seq", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def dedupe_latest(delta: DataFrame, key: Sequence[str], version: str = "updated_at") -> DataFrame:
    """The newest row per key.

    Equal versions are decided by part order and then by row content, so the
    outcome never depends on task order. The maximum is taken map-side: a key
    with very many versions needs no sort and no large group.
    """
    key = list(key)
    rest = [c for c in delta.columns if c not in key]
    ordering = [c for c in (version, "_seq") if c in rest]
    newest = F.max(F.struct(*ordering, *[c for c in rest if c not in ordering]))
    kept = [c for c in delta.columns if c != "_seq"]
    return delta.groupBy(*key).agg(newest.alias("_r")).select(*[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in kept])


# ------------------------------------------------------------------ merge
def _matched(target: DataFrame, delta: DataFrame, rule: MergeRule) -> DataFrame:
    old = target.select(F.struct(*target.columns).alias("o"), F.col(rule.key).alias("_k"))
    new = delta.select(F.struct(*[c for c in target.columns if c in delta.columns]).alias("n"), F.col(rule.key).alias("_k"))
    newer = F.lit(False) if rule.inserts_only else F.col(f"n.{rule.version}") > F.col(f"o.{rule.version}")
    action = (
        F.when(F.col("n").isNull(), "keep").when(F.col("o").isNull(), "insert").when(newer, "update").otherwise("stale")
    )
    return old.join(new, "_k", "full_outer").withColumn("_action", action)


def merge(
    target: DataFrame, delta: DataFrame, rule: MergeRule, audit_ts: str | None = None, settle: Callable[[DataFrame], DataFrame] = lambda df: df
) -> MergeResult:
    """Insert unseen keys, update known keys when strictly newer, ignore stale rows.

    Audit rows carry ``audit_ts``, or the incoming version when none is given.
    A job that will use several outputs passes ``settle`` to write the joined
    rows down once instead of joining again for each.

    One full outer join on the key serves all three outputs.
    """
    matched = settle(_matched(target, delta, rule))
    changes = set() if rule.inserts_only else {*rule.updates, rule.version}

    def value(c: str) -> Column:
        old, new = F.col(f"o.{c}"), F.col(f"n.{c}") if c in delta.columns else F.lit(None)
        taken = F.when(F.col("_action") == "insert", new)
        if c in changes:
            taken = taken.when(F.col("_action") == "update", new)
        return taken.otherwise(old).alias(c)

    merged = matched.select(*[value(c) for c in target.columns])
    changed = matched.where(F.col("_action").isin("insert", "update")).select(*[value(c) for c in target.columns])
    audit = matched.where(F.col("_action") == "update").select(
        (F.to_timestamp(F.lit(audit_ts)) if audit_ts else F.col(f"n.{rule.version}") if rule.version in delta.columns else F.lit(None).cast("timestamp")).alias("audit_ts"),
        F.lit("UPDATE").alias("audit_action"), *[F.col(f"o.{c}").alias(c) for c in target.columns],
    )
    counts = matched.agg(
        F.count_if(F.col("_action") == "insert").alias("inserted_count"), F.count_if(F.col("_action") == "update").alias("updated_count")
    )
    return MergeResult(merged, audit, counts, changed)


def merge_changes(target: DataFrame, delta: DataFrame, rule: MergeRule) -> DataFrame:
    """What :func:`merge` inserts and updates: ``_action``, the rows as they are now, and ``_was`` with what an audited update replaces.

    For a target whose other rows stay where they are; its keys outside the delta are left out of the join. Stale rows are not returned.
    """
    old = target.select(F.struct(*target.columns).alias("o"), F.col(rule.key).alias("_k"))
    new = delta.select(F.struct(*[c for c in target.columns if c in delta.columns]).alias("n"), F.col(rule.key).alias("_k"))
    newer = F.lit(False) if rule.inserts_only else F.col(f"n.{rule.version}") > F.col(f"o.{rule.version}")
    matched = new.join(old, "_k", "left").withColumn("_action", F.when(F.col("o").isNull(), "insert").when(newer, "update")).where("_action is not null")
    changes = [] if rule.inserts_only else list(dict.fromkeys((*rule.updates, rule.version)))

    def value(c: str) -> Column:
        taken = ("insert", "update") if c in changes else ("insert",)
        return F.when(F.col("_action").isin(*taken), F.col(f"n.{c}") if c in delta.columns else F.lit(None)).otherwise(F.col(f"o.{c}")).alias(c)

    was = [F.when(F.col("_action") == "update", F.struct(*[F.col(f"o.{c}") for c in changes])).alias("_was")] if rule.audit else []
    return matched.select("_action", *[value(c) for c in target.columns], *was)


def of_changes(changes: DataFrame, rule: MergeRule, audit_ts: str | None = None) -> MergeResult:
    """Audit rows, counts and changed rows of :func:`merge` from what :func:`merge_changes` returns; there is no merged table."""
    changed = changes.drop("_action", "_was")
    counts = changes.agg(F.count_if(F.col("_action") == "insert").alias("inserted_count"), F.count_if(F.col("_action") == "update").alias("updated_count"))
    audit = None
    if rule.audit:
        replaced = {*rule.updates, rule.version}
        audit = changes.where(F.col("_action") == "update").select(
            (F.to_timestamp(F.lit(audit_ts)) if audit_ts else F.col(rule.version)).alias("audit_ts"),
            F.lit("UPDATE").alias("audit_action"), *[F.col(f"_was.{c}").alias(c) if c in replaced else F.col(c) for c in changed.columns],
        )
    return MergeResult(None, audit, counts, changed)


def append_new(target: DataFrame, delta: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Append rows whose key is unseen; returns (all rows, counts)."""
    fresh = delta.dropDuplicates([key]).join(target.select(key), key, "left_anti").select(*target.columns)
    counts = fresh.agg(rows().alias("inserted_count"), F.lit(0).cast("long").alias("updated_count"))
    return target.unionByName(fresh), counts


def merge_table(t: Tables, name: str, audit_ts: str | None = None) -> MergeResult:
    """Merge the staged delta ``stg_<name>`` into a table, newest row per key first."""
    rule = RULES[name]
    return merge(t[name], dedupe_latest(t[f"stg_{name}"], [rule.key], rule.version), rule, audit_ts)


def merge_counts(t: Tables) -> DataFrame:
    """Inserted and updated rows for every merge of a refresh, events included.

    A count needs the delta's keys and versions only: a left join from the delta, of two columns of the table.
    """
    parts = []
    for rule in (*RULES.values(), EVENTS):
        staged_as = "stg_funnel_events" if rule is EVENTS else f"stg_{rule.table}"
        old = t[rule.table].select(rule.key, (F.lit(None) if rule.inserts_only else F.col(rule.version)).alias("_old"), F.lit(True).alias("_known"))
        new = t[staged_as].select(rule.key).distinct() if rule.inserts_only else t[staged_as].groupBy(rule.key).agg(F.max(rule.version).alias("_new"))
        newer = F.lit(False) if rule.inserts_only else F.col("_new") > F.col("_old")
        counts = new.join(old, rule.key, "left").agg(F.count_if(F.col("_known").isNull()).alias("inserted_count"), F.count_if(newer).alias("updated_count"))
        parts.append(counts.select(F.lit(rule.table).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ control tables
def watermark_get(control: DataFrame, source: str) -> DataFrame:
    return control.where(F.col("source_name") == source).select("last_processed_ts")


def watermark_set(control: DataFrame, source: str, ts: Column) -> DataFrame:
    """The control table with one source's mark inserted or replaced."""
    new = control.sparkSession.range(1).select(F.lit(source).alias("source_name"), ts.cast("timestamp").alias("last_processed_ts"))
    return control.where(F.col("source_name") != source).unionByName(new)


def watermark_or_default(control: DataFrame, source: str, now: Column, minutes: int = 30) -> DataFrame:
    """The stored mark, or ``now`` minus half an hour when the source is new (one row)."""
    default = now.cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return watermark_get(control, source).agg(F.coalesce(F.max("last_processed_ts"), default).alias("last_processed_ts"))


# ------------------------------------------------------------------ what a delta changes
def value_changes(t: Tables, name: str, column: str) -> DataFrame:
    """Rows whose ``column`` the staged delta changes: the key, the old and the new value, and the new version."""
    rule = RULES[name]
    new = dedupe_latest(t[f"stg_{name}"], [rule.key], rule.version).select(rule.key, F.col(column).alias("new_value"), F.col(rule.version).alias("changed_at"))
    old = t[name].select(rule.key, F.col(column).alias("old_value"), F.col(rule.version).alias("_old"))
    # From the delta: the table is only looked up.
    moved = new.join(old, rule.key).where((F.col("changed_at") > F.col("_old")) & ~F.col("new_value").eqNullSafe(F.col("old_value")))
    return moved.select(rule.key, "old_value", "new_value", "changed_at")


def recompute_sla(shipments: DataFrame) -> DataFrame:
    """The breach flag from its rule: delivered after the promised day."""
    return shipments.withColumn("sla_breached_flag", F.coalesce(F.col("delivered_dt") > F.col("promised_delivery_dt"), F.lit(False)))


def arrived_returns(t: Tables) -> dict[str, DataFrame]:
    """Staged returns that the table does not know, and what they change: payments of their orders, refunded by all returns of the order, and their orders as RETURNED."""
    rule = RULES["fact_returns"]
    staged_rows = dedupe_latest(t["stg_fact_returns"], [rule.key], rule.version)
    fresh = staged_rows.join(t["fact_returns"].select(rule.key), rule.key, "left_anti")
    touched = fresh.select("order_id").distinct()
    narrowed = lambda df: df.join(touched, "order_id", "left_semi")
    known = narrowed(t["fact_returns"]).select("order_id", "refund_amount")
    payments = propagate_refunds(narrowed(t["fact_payments"]), known.unionByName(fresh.select("order_id", "refund_amount")))
    orders = narrowed(t["fact_orders"]).withColumn("order_status", F.lit("RETURNED"))
    return {"fact_returns": fresh, "fact_payments": payments, "fact_orders": orders}


def propagate_refunds(payments: DataFrame, returns: DataFrame) -> DataFrame:
    """Captured payments of orders with returns become REFUNDED by the order's total refund."""
    per = returns.groupBy("order_id").agg(F.sum("refund_amount").alias("_refund"))
    hit = (F.col("payment_status") == "CAPTURED") & F.col("_refund").isNotNull()
    joined = payments.join(per, "order_id", "left")
    return joined.select(
        *[
            F.when(hit, "REFUNDED").otherwise(F.col(c)).alias(c) if c == "payment_status"
            else F.when(hit, F.col("_refund")).otherwise(F.col(c)).cast("decimal(14,2)").alias(c) if c == "refund_amount"
            else F.col(c)
            for c in payments.columns
        ]
    )


def assign_ids(df: DataFrame, order: str, offset: DataFrame, name: str = "new_id") -> DataFrame:
    """Number rows offset+1, offset+2, ... in ``order``; ``offset`` is a one-row DataFrame with ``max_id``."""
    numbered = running(df, [(order, False)])
    return attach(numbered, offset.select("max_id")).select(*df.columns, (F.col("row_no") + F.col("max_id")).alias(name))


def staged(t: Mapping[str, DataFrame]) -> list[str]:
    return [name for name in RULES if f"stg_{name}" in t]
