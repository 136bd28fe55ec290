"""Column helpers shared by the operators. All of them are built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDE = "decimal(38,12)"


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def rows() -> Column:
    """Row count (aggregate)."""
    return F.count(F.lit(1))


def zero(x) -> Column:
    """NULL as 0."""
    return F.coalesce(_col(x), F.lit(0))


def divide(num, den) -> Column:
    """Quotient as a double, NULL when the denominator is 0 or NULL."""
    d = _col(den).cast("double")
    return _col(num).cast("double") / F.nullif(d, F.lit(0.0))


def rounded(x, scale: int) -> Column:
    """Half-up decimal rounding of a double.

    Six digits beyond the wanted scale are kept first: enough to tell values
    apart, few enough to absorb the binary error that would turn a tie down.
    """
    return F.round(_col(x).cast(f"decimal(38,{scale + 6})"), scale)


def ratio(num, den, scale: int, factor: float = 1.0) -> Column:
    """factor * num / den, rounded half-up; NULL when there is nothing to divide by."""
    return rounded(F.lit(factor) * _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0)), scale)


def ratio0(num, den, scale: int, factor: float = 1.0) -> Column:
    """Like :func:`ratio`, but 0 unless the denominator is positive."""
    return F.when(_col(den) > 0, ratio(num, den, scale, factor)).otherwise(F.lit(0))


def pct(num, den, scale: int) -> Column:
    return ratio(num, den, scale, 100.0)


def pct0(num, den, scale: int) -> Column:
    return ratio0(num, den, scale, 100.0)


def share_if(cond: Column, scale: int) -> Column:
    """Percentage of rows that meet a condition (aggregate); a NULL condition counts as not met."""
    return pct(F.count_if(cond), F.count(F.lit(1)), scale)


def total(x) -> Column:
    """SUM with 0 for no rows (aggregate)."""
    return F.coalesce(F.sum(_col(x)), F.lit(0))


def surrogate_key(*parts) -> Column:
    """md5 of the natural key, its parts joined by ``|``."""
    return F.md5(F.concat_ws("|", *[_col(p).cast("string") for p in parts]))


def since(ts, as_of: str, days: int = 0, hours: int = 0) -> Column:
    """ts falls in the last ``days``/``hours`` before the explicit clock."""
    start = F.to_timestamp(F.lit(as_of)) - F.make_dt_interval(F.lit(days), F.lit(hours))
    return _col(ts) >= start


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add a one-row result's columns to every row, as a single scalar subquery (no join)."""
    packed = one_row.select(F.struct(*one_row.columns).alias("_one")).scalar()
    return df.withColumn("_one", packed).select(*df.columns, *[F.col(f"_one.{c}").alias(c) for c in one_row.columns])


def side_by_side(*parts: DataFrame) -> DataFrame:
    """One row from several one-row results, by union and a final maximum (no join)."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def page(df: DataFrame, order: Iterable[Column], limit: int | None, offset: int = 0) -> DataFrame:
    """Ordered paging; with a limit Spark keeps only limit+offset rows per task.

    Without a limit and offset it is the whole result, in no order: nothing is gained by sorting a whole table.
    """
    if limit is None and not offset:
        return df
    out = df.orderBy(*order)
    if offset:
        out = out.offset(offset)
    return out if limit is None else out.limit(limit)


def listed(col: str, values: Iterable) -> Column:
    """The column, or an error for a value (or NULL) outside the list: nothing is left out in silence."""
    message = F.concat(F.lit(f"{col}: value outside the given list: "), F.coalesce(F.col(col).cast("string"), F.lit("NULL")))
    return F.when(F.col(col).isin(list(values)), F.col(col)).otherwise(F.raise_error(message))


def check_limit(limit: int | None, high: int) -> None:
    """A page size between 1 and ``high``; None asks for everything."""
    if limit is not None:
        check_bounds("limit", limit, 1, high)


def check_bounds(name: str, value: int, low: int, high: int) -> int:
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}, got {value}")
    return value
