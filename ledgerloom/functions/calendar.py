"""Calendars: the date dimension and gap-free date spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_DAYS = "explode(sequence(first_dt, last_dt, interval 1 day)) as date_value"


def spine(bounds: DataFrame, first: str, last: str, keys: list[str] | None = None) -> DataFrame:
    """One row per day between two date columns, per row of ``bounds``.

    The bounds stay a DataFrame, so nothing travels through the driver. A NULL
    bound (an empty source) gives no days.
    """
    keys = keys or []
    return (
        bounds.where(F.col(first).isNotNull() & F.col(last).isNotNull())
        .select(*keys, F.col(first).cast("date").alias("first_dt"), F.col(last).cast("date").alias("last_dt"))
        .selectExpr(*keys, _DAYS)
    )


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar attributes for a ``date_value`` column; weeks and days are ISO (Monday = 1)."""
    d = F.col("date_value")
    iso_day = F.weekday(d) + 1
    return days.select(
        date_key(d).alias("date_id"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_day.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (iso_day >= 6).alias("is_weekend"),
    )


def date_dimension(spark: SparkSession, start: str, end: str) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("a"), F.lit(end).cast("date").alias("b"))
    return describe_days(spine(bounds, "a", "b"))


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def day_of(ts: str | Column) -> Column:
    return F.to_date(ts)


def month_of(ts: str | Column) -> Column:
    return F.trunc(F.to_date(ts), "month")
