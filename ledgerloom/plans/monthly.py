"""Tables kept in one folder per month, of which a pointer names the valid ones.

Every write goes to a run folder of its own; the pointer (a small published table of
month and run, with the table's schema) is written last. Readers follow the newest
pointer, so they see all months of a write or none, and a writer that dies leaves
nothing that counts. A table has one writer at a time. The list of months is as
short as the calendar; rows without a date live in month ``0000-00``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.plans.publish import folders, newest, publish

NO_DATE = "0000-00"


def month_of(source: str) -> Column:
    return F.coalesce(F.date_format(source, "yyyy-MM"), F.lit(NO_DATE))


def _pointer(spark: SparkSession, path: str) -> tuple[int, dict[str, str], StructType]:
    version = newest(spark, path, "_pointer")
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    rows = spark.read.parquet(f"{path}/_pointer/{version}").collect()
    return int(version), {r.month: r.run for r in rows if r.month is not None}, StructType.fromJson(json.loads(rows[0].table_schema))


def _point(spark: SparkSession, path: str, version: int, months: dict[str, str], schema: StructType) -> None:
    rows = [(m, r, schema.json()) for m, r in sorted(months.items())] or [(None, None, schema.json())]
    publish(spark.createDataFrame(rows, "month string, run string, table_schema string").coalesce(1), path, "_pointer", f"{version:012d}")


def _write_run(df: DataFrame, path: str, source: str) -> dict[str, str]:
    """Write the rows to a new run folder, each month in as many files as its size needs; the months it has."""
    run = uuid.uuid4().hex
    rows = df.withColumn("month", month_of(source)).hint("rebalance", "month")
    rows.write.option("partitionOverwriteMode", "static").partitionBy("month").parquet(f"{path}/run={run}")
    return {f.removeprefix("month="): run for f in folders(df.sparkSession, f"{path}/run={run}") if f.startswith("month=")}


def create(df: DataFrame, path: str, source: str) -> None:
    """First load, or a new one: the pointer then names this run's months alone."""
    spark = df.sparkSession
    version = int(newest(spark, path, "_pointer") or 0) + 1
    _point(spark, path, version, _write_run(df, path, source), df.schema)


def read(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """The table with its ``month``; only folders of the wanted months are listed and read."""
    _, live, schema = _pointer(spark, path)
    wanted = [f"{path}/run={run}/month={m}" for m, run in sorted(live.items()) if months is None or m in months]
    full = StructType(schema.fields).add("month", "string")
    if not wanted:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*wanted).select(*full.names)


def replace(df: DataFrame, path: str, source: str, months: list[str]) -> None:
    """Put ``df`` in the place of ``months``, all at once."""
    spark = df.sparkSession
    written = _write_run(df, path, source)
    version, live, schema = _pointer(spark, path)
    _point(spark, path, version + 1, {m: r for m, r in live.items() if m not in months} | written, schema)


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete run folders that the newest pointer does not name; call it when no reader is left on an older one."""
    _, live, _ = _pointer(spark, path)
    old = [f for f in folders(spark, path) if f.startswith("run=") and f.removeprefix("run=") not in live.values()]
    for name in old:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return old
