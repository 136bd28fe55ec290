"""Publishing whole tables so that readers never see half of one.

A table is written to a new version folder. Spark leaves a ``_SUCCESS`` marker
only when the whole write has committed, and readers take the newest version
that has one, so a failed or running job changes nothing for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, hadoop


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, in order; none if it does not exist."""
    fs, p, _ = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def is_published(spark: SparkSession, root: str, name: str, version: str) -> bool:
    """One look at the version's own marker."""
    fs, _, hadoop = _fs(spark, root)
    return fs.exists(hadoop.Path(f"{root}/{name}/{version}/_SUCCESS"))


def versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """Complete versions of a table, oldest first."""
    return [v for v in folders(spark, f"{root}/{name}") if is_published(spark, root, name, v)]


def newest(spark: SparkSession, root: str, name: str) -> str | None:
    """The newest complete version: markers are looked at from the end only as far as needed."""
    return next((v for v in reversed(folders(spark, f"{root}/{name}")) if is_published(spark, root, name, v)), None)


def publish(df: DataFrame, root: str, name: str, version: str) -> DataFrame:
    """Write a version (names must sort in publishing order) and return it as read back."""
    path = f"{root}/{name}/{version}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = newest(spark, root, name)
    if version is None:
        raise FileNotFoundError(f"no complete version of {name} under {root}")
    return spark.read.parquet(f"{root}/{name}/{version}")
