"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Results depend on the first; the others let the runtime size and split shuffles.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: Shuffles start in so many parts, which the runtime joins up to the size below: a task's rows then stay as many, however large a table is.
PARTS_KEY, PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", 1000
SIZE_KEY, SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    # What a session has set itself is left as it is.
    for key, value in ((PARTS_KEY, str(max(PARTS, int(spark.conf.get("spark.sql.shuffle.partitions"))))), (SIZE_KEY, SIZE)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local master without that setting (tests) gets a fresh folder; anywhere
    else a missing setting is an error, because a machine-local folder would
    not survive the loss of its executor.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if root is None and current.isDefined():
        return current.get()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if current.isEmpty():
        sc.setCheckpointDir(root)
    return root


def cut(df):
    """Write ``df`` to the shared checkpoint folder and read it back.

    Used where a later step must see the very same row placement twice.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


@contextmanager
def scratch(spark: SparkSession, path: str) -> Iterator[Callable[..., DataFrame]]:
    """A way to write rows down for as long as a step lasts: Parquet files in a folder of its own below ``path``, deleted at the end.

    Columns that a later step does not need are not read again, and the files are a
    fraction of a checkpoint's, which keeps whole rows uncompressed.
    """
    folder = f"{path}/{uuid.uuid4().hex}"

    def put(df: DataFrame, *by: str) -> DataFrame:
        """``by``: columns by whose values the files are laid out, so that later filters on them read only theirs."""
        at = f"{folder}/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").partitionBy(*by).parquet(at)
        return spark.read.schema(df.schema).parquet(at)

    try:
        yield put
    finally:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Have the driver collect its garbage, so that shuffle files of ended jobs are deleted; nobody else would for half an hour.

    Spark's event queues hold the last query's plan, and with it its shuffle files, until the next event: a query without any job comes first.
    """
    spark.sql("select 1").collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
