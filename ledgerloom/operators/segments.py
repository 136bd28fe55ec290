"""Customer analytics: RFM, churn, cohorts and spend outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import selection
from ledgerloom.functions.expr import attach, divide, listed, rows, since, zero
from ledgerloom.functions.ranking import bin_by_edges, rank_bin, running
from ledgerloom.operators import kpis
from ledgerloom.operators.views import Tables, orders_completed
from ledgerloom.session import cut

FIFTHS = (0.2, 0.4, 0.6, 0.8)


def rfm_base(t: Tables) -> DataFrame:
    """Recency in whole days before (latest order + 1 day), order count, and spend."""
    orders = orders_completed(t)
    clock = orders.agg((F.max("order_ts") + F.expr("interval 1 day")).alias("as_of"))
    per = orders.groupBy("customer_id").agg(F.max("order_ts").alias("last_ts"), rows().alias("frequency"), F.sum("net_amount").alias("monetary"))
    seconds = F.unix_timestamp("as_of") - F.unix_timestamp("last_ts")
    return attach(per, clock).select(
        "customer_id", F.floor(seconds / 86400).cast("int").alias("recency_days"), "frequency", "monetary"
    )


def _scored(base: DataFrame, duplicates: str) -> DataFrame:
    base = cut(base)  # used for two sets of edges and the ranking
    measures = {"recency_days": "r", "monetary": "m"}
    edges = selection.side_by_side(selection.quantiles(base, list(measures), FIFTHS), list(measures))
    edges = edges.withColumnsRenamed({f"{m}_q{i}": f"{p}{i}" for m, p in measures.items() for i in range(4)})
    distinct_edges = [F.size(F.array_distinct(F.array(*[F.col(f"{p}{i}") for i in range(4)]))) == 4 for p in "rm"]
    guard = F.when(distinct_edges[0] & distinct_edges[1], F.lit(True)).otherwise(F.raise_error(F.lit("quantile edges are not distinct")).cast("boolean"))
    if duplicates == "raise":
        edges = edges.where(guard)
    elif duplicates != "keep":
        raise ValueError("duplicates must be 'raise' or 'keep'")
    ranked = running(base, [("frequency", False), ("customer_id", False)])
    return attach(ranked, edges).select(
        "customer_id", "recency_days", "frequency", "monetary",
        (6 - bin_by_edges(F.col("recency_days").cast("double"), [F.col(f"r{i}") for i in range(4)])).alias("r_score"),
        rank_bin(F.col("row_no"), F.col("group_n"), 5).alias("f_score"),
        bin_by_edges(F.col("monetary").cast("double"), [F.col(f"m{i}") for i in range(4)]).alias("m_score"),
    )


def rfm_scores(t: Tables, duplicates: str = "raise") -> DataFrame:
    """Quintile scores. Recency and spend are cut at exact quantiles, frequency by rank.

    Repeated quantile edges are an error, or with ``duplicates="keep"`` leave
    the bins between them empty.
    """
    return _scored(rfm_base(t), duplicates)


def rfm_segments(t: Tables, duplicates: str = "raise") -> DataFrame:
    r, f = F.col("r_score"), F.col("f_score")
    segment = (
        F.when((r >= 4) & (f >= 4), "Champions")
        .when((r >= 4) & (f <= 2), "New Customers")
        .when((r <= 2) & (f >= 4), "At Risk Loyal")
        .when((r <= 2) & (f <= 2), "Lost")
        .otherwise("Potential Loyalist")
    )
    scored = rfm_scores(t, duplicates)
    return scored.select("*", segment.alias("segment"), (r * 100 + f * 10 + F.col("m_score")).alias("rfm_score"))


def churn_list(t: Tables, as_of: str, days: int = 90) -> DataFrame:
    return kpis.last_orders(t).where(~since("last_order_ts", as_of, days))


def cohort_matrix(t: Tables, months: list[int]) -> DataFrame:
    """Cohorts as rows, months since first purchase as columns; 0 where nobody bought.

    The columns are given, so the plan needs no extra pass to find them; a month
    outside them is an error. ``kpis.cohort_retention`` is the long form.
    """
    long = kpis.cohort_retention(t).withColumn("months_since_cohort", listed("months_since_cohort", months))
    wide = long.groupBy("cohort_month").pivot("months_since_cohort", months).agg(F.sum("customers"))
    return wide.na.fill(0).select("cohort_month", *[F.col(str(m)).alias(f"m{m}") for m in months])


def order_discount(t: Tables) -> DataFrame:
    lines = t["fact_order_items"].groupBy("order_id").agg(
        F.sum("line_discount").alias("discount_amount"), F.sum("line_net_revenue").alias("net_revenue")
    )
    gross = F.col("net_revenue") + F.col("discount_amount")
    return lines.join(orders_completed(t).select("order_id", "customer_id"), "order_id").select(
        "customer_id", "order_id", "discount_amount", gross.alias("gross_before_discount"), "net_revenue",
        F.when(gross == 0, F.lit(0.0)).otherwise(F.lit(100.0) * divide("discount_amount", gross)).alias("discount_pct"),
    )


def return_totals(t: Tables) -> DataFrame:
    per_order = t["fact_returns"].groupBy("order_id").agg(rows().alias("lines"), F.sum("refund_amount").alias("refunds"))
    return per_order.join(t["fact_orders"].select("order_id", "customer_id"), "order_id").groupBy("customer_id").agg(
        F.sum("lines").alias("return_lines"), F.sum("refunds").alias("refund_amount")
    )


def customer_discount(t: Tables, p: float = 0.95) -> DataFrame:
    """Per customer: orders, mean and p95 discount, spend, and returns (0 if none)."""
    per_order = order_discount(t)
    mean = F.avg(F.col("discount_pct").cast("decimal(18,12)"))
    per = per_order.groupBy("customer_id").agg(
        rows().alias("orders"), mean.cast("double").alias("avg_discount_pct"), F.sum("net_revenue").alias("net_revenue")
    )
    high = selection.quantiles(per_order, ["discount_pct"], (p,), group=["customer_id"])
    return (
        per.join(high.select("customer_id", F.col("q0").alias("p95_discount_pct")), "customer_id")
        .join(return_totals(t), "customer_id", "left")
        .select(
            "customer_id", "orders", "avg_discount_pct", "p95_discount_pct", "net_revenue",
            zero("return_lines").alias("return_lines"), zero("refund_amount").alias("refund_amount"),
        )
    )


def iqr_bounds(df: DataFrame, measures: Sequence[str], k: float = 1.5, approximate: bool = False) -> DataFrame:
    """(measure, lo, hi): quartiles widened by k times the interquartile range."""
    if approximate:
        each = df.select(*[F.col(m).cast("double").alias(m) for m in measures]).unpivot([], list(measures), "measure", "value")
        q = F.percentile_approx("value", [0.25, 0.75], 10000)
        edges = each.groupBy("measure").agg(q.alias("q")).select("measure", F.col("q")[0].alias("q0"), F.col("q")[1].alias("q1"))
    else:
        edges = selection.quantiles(df, measures, (0.25, 0.75))
    spread = F.col("q1") - F.col("q0")
    return edges.select("measure", (F.col("q0") - k * spread).alias("lo"), (F.col("q1") + k * spread).alias("hi"))


OUTLIER_MEASURES = ("avg_discount_pct", "refund_amount")


def outlier_bounds(t: Tables, k: float = 1.5) -> DataFrame:
    return iqr_bounds(customer_discount(t), OUTLIER_MEASURES, k)


def outlier_flags(t: Tables, k: float = 1.5) -> DataFrame:
    """Flags for customers above the upper bound for mean discount or for refunds. Runs jobs while the plan is built."""
    cust = cut(customer_discount(t))
    bounds = iqr_bounds(cust, OUTLIER_MEASURES, k)
    over = bounds.agg(*[F.max(F.when(F.col("measure") == m, F.col("hi"))).alias(f"hi_{short}") for m, short in zip(OUTLIER_MEASURES, ("discount", "refund"), strict=True)])
    by_disc = F.col("avg_discount_pct") > F.col("hi_discount")
    by_ref = F.col("refund_amount").cast("double") > F.col("hi_refund")
    return attach(cust, over).select(
        *cust.columns, by_disc.alias("flag_discount_abuse"), by_ref.alias("flag_refund_abuse"), (by_disc | by_ref).alias("flag_any")
    )
