"""Exact quantiles by narrowing histograms: no sort, no range exchange, all measures in the same passes.

A wanted rank starts in the interval from its group's smallest to its largest value. Each
pass counts the interval's values in ``BINS`` bins and keeps of every bin its number of
values, the least and the greatest; the bin with the rank is the next interval. Bin numbers
never fall as values rise, so rounding cannot put a value on the wrong side, and the
greatest value has a bin of its own, so every pass narrows. The first pass has bins on a
logarithmic scale, for long tails; the others on a linear one. Intervals of at most
``FEW`` values are numbered as they are.

What is broadcast is one row a measure and rank; with groups, those of groups of over
``FEW`` values, whose number is checked (``MOST_GROUPS``; beyond it ``ranking`` does the
work). Smaller groups are numbered in windows of their own.

Null and NaN are left out. Without a group the result is one row, nulls for no values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import ranking
from ledgerloom.session import cut

BINS = 1024
FEW = 10_000
MOST_GROUPS = 10_000
_SPAN = ("_lo", "_hi")


def _scaled(v: Column, log: bool) -> Column:
    return F.signum(v) * F.log1p(F.abs(v)) if log else v


def _bin(log: bool) -> Column:
    v, lo, hi = (_scaled(F.col(c), log) for c in ("_v", *_SPAN))
    place = F.floor(F.nanvl(F.coalesce(F.try_divide(v - lo, hi - lo), F.lit(0.0)), F.lit(0.0)) * BINS)
    return F.when(F.col("_v") == F.col("_hi"), BINS - 1).otherwise(F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 2))).cast("int")


def _open(few: int) -> Column:
    return (F.col("_lo") < F.col("_hi")) & (F.col("_in") > few)


def _inside(values: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Values within the targets' intervals; an interval wanted twice is looked at once."""
    spans = targets.select(*keys, *_SPAN).distinct()
    return values.join(F.broadcast(spans), keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _narrow(values: DataFrame, targets: DataFrame, keys: list[str], log: bool) -> DataFrame:
    """The targets' next intervals."""
    span = [*keys, *_SPAN]
    counted = _inside(values, targets, keys).groupBy(*span, _bin(log).alias("_bin")).agg(F.count("*").alias("_bn"), F.min("_v").alias("_bl"), F.max("_v").alias("_bh"))
    # At most BINS rows an interval.
    before = Window.partitionBy(*span).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = counted.withColumn("_below", F.coalesce(F.sum("_bn").over(before), F.lit(0)))
    at = F.col("_rank") - F.col("_before")
    found = targets.join(bins, span).where((at >= F.col("_below")) & (at < F.col("_below") + F.col("_bn")))
    return found.select(*keys, "_rank", F.col("_bl").alias("_lo"), F.col("_bh").alias("_hi"), (F.col("_before") + F.col("_below")).alias("_before"), F.col("_bn").alias("_in"))


def _ranked(values: DataFrame, stats: DataFrame, keys: list[str], at: Sequence[float], few: int) -> DataFrame:
    """keys, _rank and _value of the ranks next to every wanted position. ``stats`` has few rows: keys, _n, _lo, _hi."""
    targets = cut(stats.select(*keys, F.explode(_ranks(at)).alias("_rank"), *_SPAN, F.lit(0).cast("long").alias("_before"), F.col("_n").alias("_in")))
    log = True
    while not targets.where(_open(few)).isEmpty():
        targets = cut(targets.where(~_open(few)).unionByName(_narrow(values, targets.where(_open(few)), keys, log)))
        log = False
    same = F.col("_lo") == F.col("_hi")
    rest, span = targets.where(~same), [*keys, *_SPAN]
    row = F.row_number().over(Window.partitionBy(*span).orderBy("_v")) - 1
    numbered = _inside(values, rest, keys).withColumn("_at", row)
    found = rest.join(numbered, span).where(F.col("_at") == F.col("_rank") - F.col("_before"))
    return targets.where(same).select(*keys, "_rank", F.col("_lo").alias("_value")).unionByName(found.select(*keys, "_rank", F.col("_v").alias("_value")))


def _position(p: float) -> Column:
    return F.lit(float(p)) * (F.col("_n") - 1).cast("double")


def _ranks(at: Sequence[float]) -> Column:
    return F.array_distinct(F.array(*[f(_position(p)) for p in at for f in (F.floor, F.ceil)]))


def _between(at: Sequence[float]) -> list[Column]:
    """Values at the wanted positions, from the ranks on either side (columns _rank, _value, _n)."""
    out = []
    for i, p in enumerate(at):
        low, high = (F.max(F.when(F.col("_rank") == f(_position(p)), F.col("_value"))) for f in (F.floor, F.ceil))
        out.append((low + (high - low) * F.max(_position(p) - F.floor(_position(p)))).alias(f"q{i}"))
    return out


def quantiles(df: DataFrame, measures: Sequence[str], at: Sequence[float], group: Sequence[str] = (), few: int = FEW, most_groups: int = MOST_GROUPS) -> DataFrame:
    """Exact quantiles with linear interpolation: a row for each group and measure with ``measure``, q0, q1, ... (as doubles).

    Runs jobs while the plan is built. A group's measure without values has no row.
    """
    group = list(group)
    keys = [*group, "measure"]
    long = df.select(*group, *[F.col(m).cast("double").alias(m) for m in measures]).unpivot(group, list(measures), "measure", "_v")
    # 0.0 and -0.0 are one value to a comparison.
    values = cut(long.where(F.col("_v").isNotNull() & ~F.isnan("_v")).withColumn("_v", F.col("_v") + F.lit(0.0)))
    if group:  # a null group is a group
        values = reduce(lambda d, g: d.withColumn(g, F.struct(F.col(g).alias("of"))), group, values)
    stats = cut(values.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")))
    if not group:
        found = _ranked(values, stats, keys, at, few)
    else:
        large = stats.where(F.col("_n") > few)
        if large.count() > most_groups:
            parts = [ranking.quantiles(values.where(F.col("measure") == m).withColumn("_id", F.monotonically_increasing_id()), "_v", "_id", at, keys) for m in measures]
            return _named(reduce(DataFrame.unionByName, parts), group)
        window = Window.partitionBy(*keys)
        rows = values.join(F.broadcast(large.select(*keys)), keys, "left_anti")
        rows = rows.select(*keys, F.col("_v").alias("_value"), (F.row_number().over(window.orderBy("_v")) - 1).cast("long").alias("_rank"), F.count("*").over(window).alias("_n"))
        small = rows.where(F.array_contains(_ranks(at), F.col("_rank"))).groupBy(*keys).agg(*_between(at))
        if large.isEmpty():
            return _named(small, group)
        found = _ranked(values, large, keys, at, few)
    out = found.join(stats.select(*keys, "_n"), keys).groupBy(*keys).agg(*_between(at))
    return _named(out.unionByName(small), group) if group else out


def _named(df: DataFrame, group: list[str]) -> DataFrame:
    return reduce(lambda d, g: d.withColumn(g, F.col(f"{g}.of")), group, df)


def side_by_side(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The rows of :func:`quantiles` without a group as one row: <measure>_q0, <measure>_q1, ...; nulls where a measure had no value."""
    found = [c for c in df.columns if c.startswith("q")]
    return df.agg(*[F.max(F.when(F.col("measure") == m, F.col(q))).alias(f"{m}_{q}") for m in measures for q in found])
