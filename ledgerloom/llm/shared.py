"""Tables written to the shared folder, and Arrow batches cut to a bounded size."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import checkpoint_root

#: Bytes of text that one numpy pass works on; a longer text is a pass of its own.
PASS_BYTES = 1 << 20


def folder(spark: SparkSession, name: str) -> str:
    """A new path under the folder that all executors share."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read again; and its path."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete tables that :func:`kept` wrote."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it no prefix of any column of ``df``."""
    while any(c.lower().startswith(name) for c in df.columns):
        name = f"_{name}"
    return name


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts together and the offset of each; null is empty."""
    arr = texts.fill_null("").cast(pa.large_string())
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    data = arr.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def passes(batch: pa.RecordBatch, text: str = "text", limit: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts have at most ``limit`` bytes, or one row."""
    _, off = text_bytes(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def mapped(df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str, text: str | None = "text") -> DataFrame:
    """``work`` over slices of ``df``; it returns a column of values for each name of ``schema``.

    ``schema`` is DDL in the order of the columns. Without a column of texts a slice is a thousand rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = StructType.fromDDL(schema)
    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch, text) if text else (batch.slice(k, 1000) for k in range(0, batch.num_rows, 1000)):
                out = work(part)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) if not isinstance(out[f.name], pa.Array) else out[f.name].cast(f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, target)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are over; it does so once the driver's garbage is collected.

    The last query's plan, and with it its shuffle files, is held by Spark's event queues until the next
    event, so a query without any job comes first.
    """
    spark.sql("select 1").collect()
    gc.collect()
    spark._jvm.System.gc()
