"""Exact ranks, running totals, quantiles and n-tiles without a one-task sort.

A window with no PARTITION BY puts all rows in one task, and a window over a
hot key puts that key's rows in one task. Here rows are range-partitioned on
(group, order, unique tie-break), every range is numbered on its own, and small
per-range totals supply what came before. The range layout is cut to the
checkpoint folder so that totals and rows agree even if tasks are rerun.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut


def _flip(sort: tuple[str, bool]) -> Column:
    name, descending = sort
    return F.col(name).desc() if descending else F.col(name).asc()


def running(
    df: DataFrame,
    order: Sequence[tuple[str, bool]],
    group: Sequence[str] = (),
    sums: Sequence[str] = (),
) -> DataFrame:
    """Add ``row_no`` (1..n within the group), ``group_n`` and ``run_<c>`` totals.

    ``order`` lists (column, descending) pairs and must end in a unique column.
    """
    group = list(group)
    sort = [_flip(o) for o in order]
    # No partition count: the session sets it and AQE merges ranges that turn out small.
    ranged = cut(df.repartitionByRange(*[F.col(g) for g in group], *sort).withColumn("_range", F.spark_partition_id()))

    totals = ranged.groupBy("_range", *group).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in sums]
    )
    # At most one row per range and group, so this window is small whatever the data.
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = totals.select(
        "_range",
        *group,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("group_n"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
    )
    within = Window.partitionBy("_range", *group).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select(
        "*",
        F.row_number().over(Window.partitionBy("_range", *group).orderBy(*sort)).alias("_local"),
        *[F.sum(c).over(within).alias(f"_run_{c}") for c in sums],
    )
    if group:
        cond = [local["_range"] == offsets["_range"], *[local[g].eqNullSafe(offsets[g]) for g in group]]
        joined = local.join(offsets, cond, "left")
    else:
        # No group: one offset row per range, at most the session's number of shuffle partitions.
        joined = local.join(F.broadcast(offsets), local["_range"] == offsets["_range"], "left")
    return joined.select(
        *[local[c] for c in df.columns],
        (F.col("_local") + F.col("_before")).cast("long").alias("row_no"),
        F.col("group_n"),
        *[(F.col(f"_run_{c}") + F.col(f"_before_{c}")).alias(f"run_{c}") for c in sums],
    )


def tile_of(row_no: Column, n: Column, tiles: int) -> Column:
    """NTILE bucket from a row number: the first ``n % tiles`` buckets get one row more."""
    size, extra = F.floor(n / tiles), n % tiles
    edge = extra * (size + 1)
    return (
        F.when(row_no <= edge, F.floor((row_no - 1) / (size + 1)))
        .otherwise(extra + F.floor((row_no - 1 - edge) / F.greatest(size, F.lit(1))))
        .cast("int")
        + 1
    )


def rank_bin(row_no: Column, n: Column, bins: int) -> Column:
    """Bin (1..bins) of the ranks 1..n cut at evenly spaced, right-closed quantile edges."""
    scaled = (row_no - 1) * bins
    return F.greatest(F.lit(1), F.ceil(scaled / F.greatest(n - 1, F.lit(1)))).cast("int")


def quantiles(
    df: DataFrame, value: str, key: str, at: Sequence[float], group: Sequence[str] = (), prefix: str = "q"
) -> DataFrame:
    """Exact quantiles with linear interpolation: columns q0, q1, ... per group.

    Only the rows next to a wanted position survive the numbering, so no task
    ever holds a whole group.
    """
    group = list(group)
    num = running(df.where(F.col(value).isNotNull()).select(*group, key, value), [(value, False), (key, False)], group)
    wanted = F.lit(False)
    aggs = []
    last = (F.col("group_n") - 1).cast("double")
    v = F.col(value).cast("double")
    for i, p in enumerate(at):
        pos = F.lit(float(p)) * last
        low, high = F.floor(pos), F.ceil(pos)
        wanted = wanted | (F.col("row_no") - 1 == low) | (F.col("row_no") - 1 == high)
        lo_v = F.max(F.when(F.col("row_no") - 1 == low, v))
        hi_v = F.max(F.when(F.col("row_no") - 1 == high, v))
        frac = F.max(pos - low)
        aggs.append((lo_v + (hi_v - lo_v) * frac).alias(f"{prefix}{i}"))
    kept = num.where(wanted)
    return kept.groupBy(*group).agg(*aggs) if group else kept.agg(*aggs)


def bin_by_edges(value: Column, edges: Sequence[Column]) -> Column:
    """Right-closed bins: 1 up to the first edge, 2 up to the next, and so on."""
    out = F.lit(1)
    for e in edges:
        out = out + F.when(value > e, 1).otherwise(0)
    return out
