"""Whole-run jobs: mart refresh, analytics outputs, incremental refresh."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import finance, forecast, incremental, kpis, marts, segments
from ledgerloom.operators.views import Tables
from ledgerloom.plans import buckets as store
from ledgerloom.plans import monthly
from ledgerloom.plans.publish import current, is_published, newest, publish
from ledgerloom.session import configure, release, scratch

# Marts that start from the order P&L.
_FROM_PNL = ("mart_exec_daily_kpis", "mart_finance_profitability", "mart_customer_segments")


def refresh_marts(t: Tables, root: str, version: str, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Rebuild the five marts, or those named. The order P&L is written once and read by the three marts that need it."""
    wanted = {n: build for n, build in marts.MARTS.items() if names is None or n in names}
    pnl = publish(finance.order_pnl(t), root, "order_pnl", version) if any(n in _FROM_PNL for n in wanted) else None
    if pnl is not None:
        release(pnl.sparkSession)
    out = {}
    for name, build in wanted.items():
        df = build(t, pnl) if name in _FROM_PNL else build(t)
        out[name] = publish(df, root, name, version)
        # The next mart needs nothing of this one's shuffles.
        del df
        release(out[name].sparkSession)
    return out


def analytics_outputs(t: Tables, as_of: str, cohort_months: list[int]) -> dict[str, DataFrame]:
    """The analytics result sets that a batch run leaves behind."""
    return {
        "rfm_segments": segments.rfm_segments(t, duplicates="keep"),
        "churned_customers_90d": segments.churn_list(t, as_of),
        "cohort_retention_long": kpis.cohort_retention(t),
        "cohort_retention_matrix": segments.cohort_matrix(t, cohort_months),
        "outlier_customers": segments.outlier_flags(t),
        "revenue_forecast": forecast.linear(t),
    }


# ------------------------------------------------------------------ incremental refresh
def init_table(df: DataFrame, path: str, rule: incremental.MergeRule) -> None:
    """First load of a table that merges maintain; a repeated one replaces all of it."""
    monthly.create(df, path, rule.partition_source)


def init_tables(tables: Tables, root: str, names: Sequence[str] | None = None, buckets: int | None = None) -> None:
    """First load of the tables that a refresh maintains (merge-on-read), one at a time: each fills the cluster, and its shuffle files go before the next. ``buckets``: the fewest of each."""
    for name in names or [*incremental.RULES, incremental.EVENTS.table]:
        store.create(tables[name], f"{root}/{name}", _rule(name).key, buckets)
    release(next(iter(tables.values())).sparkSession)


def _rule(name: str) -> incremental.MergeRule:
    return incremental.EVENTS if name == incremental.EVENTS.table else incremental.RULES[name]


def _near(target: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Target rows whose key lies between the delta's smallest and largest: two values that reach the scan."""
    low, high = delta.agg(F.min(key), F.max(key)).first()
    return target.where(F.col(key).between(low, high))


def merge_into(spark: SparkSession, path: str, delta: DataFrame, rule: incremental.MergeRule, audit_path: str, run_id: str) -> DataFrame:
    """Merge a delta into a monthly table, rewriting only the months it touches.

    Touched months are those of the delta's rows plus those where its keys
    already live; their list is as short as the calendar. The search for keys
    reads one column, and only row groups within the delta's key range. Audit
    rows are complete before the table changes, the changed months become
    visible together, and versions are compared, so a run that died anywhere
    can simply be repeated.
    """
    configure(spark)
    with scratch(spark, f"{audit_path}/_scratch") as put:
        # Written down once: it is read for its bounds, its months, the search and the merge.
        clean = put(incremental.dedupe_latest(delta, [rule.key], rule.version))
        homes = _near(monthly.read(spark, path), clean, rule.key).join(clean.select(rule.key), rule.key, "left_semi").select("month")
        fresh = clean.select(monthly.month_of(rule.partition_source).alias("month"))
        touched = [r[0] for r in homes.union(fresh).distinct().collect()]
        part = monthly.read(spark, path, touched).drop("month")
        result = incremental.merge(part, clean, rule, settle=put)
        # A run id stands for one delta. What its first attempt recorded, before the table changed, is kept by a rerun.
        if not is_published(spark, f"{audit_path}/counts", rule.table, run_id):
            publish(result.counts, f"{audit_path}/counts", rule.table, run_id)
        if rule.audit and not is_published(spark, audit_path, rule.table, f"run={run_id}"):
            publish(result.audit, audit_path, rule.table, f"run={run_id}")
        if touched:
            monthly.replace(result.merged, path, rule.partition_source, touched)
    return spark.read.parquet(f"{audit_path}/counts/{rule.table}/{run_id}")


# Merge order. Tables in one group do not refer to each other.
MERGE_GROUPS = (
    ("dim_customer", "dim_product"),
    ("fact_orders",),
    ("fact_order_items", "fact_payments", "fact_shipments", "fact_funnel_events"),
    ("fact_returns",),
)


def incremental_refresh(
    spark: SparkSession, root: str, deltas: Mapping[str, DataFrame], source: str, run_ts: str, run_id: str
) -> dict[str, DataFrame]:
    """Dimensions first, then facts after the tables they refer to, watermark last.

    The watermark moves only after every merge has committed, so a failed run
    is picked up again from the same point. Long chains of deltas are folded at the end.
    """

    counts: dict[str, DataFrame] = {}
    for name in [name for group in MERGE_GROUPS for name in group if name in deltas]:
        # One at a time: a large merge fills the cluster, and only one has its rows and shuffle files on disk.
        counts[name] = store.merge(spark, f"{root}/{name}", deltas[name], _rule(name), f"{root}/_audit", run_id)
    marks = f"{root}/_control"
    mark = spark.range(1).select(F.lit(source).alias("source_name"), F.to_timestamp(F.lit(run_ts)).alias("last_processed_ts"))
    if newest(spark, marks, "watermarks") is not None:
        mark = incremental.watermark_set(current(spark, marks, "watermarks"), source, F.lit(run_ts))
    publish(mark, marks, "watermarks", run_id)
    for name in deltas:
        store.compact(spark, f"{root}/{name}")
    return counts
