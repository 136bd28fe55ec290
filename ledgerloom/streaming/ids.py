"""Ids that a stream has already passed on, kept apart from the events.

Each micro-batch adds the ids it passed on, in folders by hash bucket, and looks up
its own ids in the buckets it touches: nothing but ids is read, and of those only the
buckets in question. A replayed batch does not meet what its first attempt wrote.
Every ``MERGE_EVERY`` batches the folders of earlier ones are merged into one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans.publish import folders, is_published, newest

BUCKETS = 256
MERGE_EVERY = 50


def _bucket(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")


def stored(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """Ids of all complete batches before ``batch_id``, with their bucket."""
    merged = newest(spark, path, "merged")
    upto = -1 if merged is None else int(merged)
    parts = [f"{path}/batch/{b}" for b in folders(spark, f"{path}/batch") if upto < int(b) < batch_id and is_published(spark, path, "batch", b)]
    parts += [] if merged is None else [f"{path}/merged/{merged}"]
    out = None
    for p in parts:
        if not folders(spark, p):  # a batch without ids
            continue
        one = spark.read.parquet(p)
        out = one if out is None else out.unionByName(one)
    return out


def _write(ids: DataFrame, path: str) -> None:
    ids.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(path)


def unseen(df: DataFrame, key: list[str], path: str, batch_id: int) -> DataFrame:
    """Rows whose id no earlier batch has passed on."""
    old = stored(df.sparkSession, path, batch_id)
    if old is None:
        return df
    touched = [r[0] for r in df.select(_bucket(key)).distinct().collect()]  # BUCKETS at most
    return df.join(old.where(F.col("bucket").isin(touched)).select(*key), key, "left_anti")


def remember(df: DataFrame, key: list[str], path: str, batch_id: int) -> None:
    """Add the ids of a batch; repeating it replaces them."""
    spark = df.sparkSession
    _write(df.select(*key, _bucket(key).alias("bucket")).distinct(), f"{path}/batch/{batch_id:012d}")
    if batch_id and batch_id % MERGE_EVERY == 0:
        old = stored(spark, path, batch_id)
        if old is not None:
            _write(old.select(*key, "bucket"), f"{path}/merged/{batch_id - 1:012d}")
