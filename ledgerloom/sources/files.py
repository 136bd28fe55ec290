"""Reading and writing files: typed CSV loads, bulk table loads, exports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.sources import schemas


def load_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Read a CSV with a header in any column order into a declared schema.

    Columns are matched by header name and cast strictly: a value that does not
    fit its type fails the job. Unknown or missing columns and a file without a
    header are errors; columns the schema allows to be NULL may be absent.
    Files are read in splits; one with line breaks inside quotes needs
    ``multi_line`` (and is then read by one task), or its load fails.
    """
    raw = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=multi_line, nullValue="", mode="FAILFAST")
    if not raw.columns:
        raise ValueError(f"empty file: {path}")
    unknown = [c for c in raw.columns if c not in schema.names]
    missing = [f.name for f in schema if f.name not in raw.columns and not f.nullable]
    if unknown or missing:
        raise ValueError(f"{path}: unknown columns {unknown}, missing columns {missing}")
    return raw.select(
        *[(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def load_checked(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV that fit the table's declaration, and the rejected ones as (row, reasons).

    A row is rejected for every value that is no value of its type (``TYPE column``), is
    missing where one is required (``NULL column``) or too long (``LENGTH column``), and
    if another row has its key (``REPEATED key``), so that no row is chosen by chance.
    Types, nulls and lengths are judged where a row is read; keys are counted once.
    """
    declared, limits = schemas.schema(table), schemas.max_lengths(table)
    raw = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=multi_line, nullValue="")
    unknown = [c for c in raw.columns if c not in declared.names]
    if unknown:
        raise ValueError(f"{path}: unknown columns {unknown}")
    text = {f.name: F.col(f.name) if f.name in raw.columns else F.lit(None).cast("string") for f in declared}
    faults = []
    for f in declared:
        value = text[f.name].try_cast(f.dataType)
        faults.append(F.when(text[f.name].isNotNull() & value.isNull(), f"TYPE {f.name}").when(text[f.name].isNull() & F.lit(not f.nullable), f"NULL {f.name}"))
        if f.name in limits:
            faults.append(F.when(F.length(text[f.name]) > limits[f.name], f"LENGTH {f.name}"))
    keys = list(schemas.PRIMARY_KEY[table])
    read = raw.select(F.to_json(F.struct(*raw.columns)).alias("_row"), F.array_compact(F.array(*faults)).alias("_faults"), *[text[f.name].try_cast(f.dataType).alias(f.name) for f in declared])
    again = read.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").where(" and ".join(f"{k} is not null" for k in keys)).drop("_n")
    judged = read.join(again.withColumn("_again", F.lit(True)), keys, "left").withColumn(
        "_faults", F.when(F.col("_again"), F.array_append("_faults", F.lit("REPEATED " + ", ".join(keys)))).otherwise(F.col("_faults"))
    )
    return judged.where(F.size("_faults") == 0).select(*declared.names), judged.where(F.size("_faults") > 0).select(F.col("_row").alias("row"), F.col("_faults").alias("reasons"))


def load_all(
    spark: SparkSession, raw_dir: str, warehouse_dir: str, tables: Iterable[str] = schemas.LOAD_ORDER, truncate: bool = True, consume: bool = False
) -> list[str]:
    """Load every table's CSV into Parquet, parents first. A missing file stops the load. With ``consume`` a table's CSV is deleted once its load has committed."""
    done = []
    for name in tables:
        raw = f"{raw_dir}/{name}.csv"
        df = load_csv(spark, raw, schemas.schema(name))
        df.write.mode("overwrite" if truncate else "append").option("compression", "zstd").parquet(f"{warehouse_dir}/{name}")
        if consume:
            p = spark._jvm.org.apache.hadoop.fs.Path(raw)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        done.append(name)
    return done


#: Rows of a compressed CSV file, which one task reads as a whole.
ZIPPED_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, single_file: bool = False, compression: str | None = None) -> None:
    """CSV with a header; quotes doubled, NULL and empty text left empty.

    Writing stays parallel unless one file is asked for, which is meant for
    small result sets only. ``compression`` (``gzip``): large sets then are in several files.
    """
    out = df.coalesce(1) if single_file else df
    rows = ZIPPED_ROWS if compression and not single_file else 0
    out.write.mode("overwrite").option("maxRecordsPerFile", rows).csv(path, header=True, quote='"', escape='"', nullValue="", emptyValue="", compression=compression)


def write_named(results: Mapping[str, DataFrame], out_dir: str) -> list[str]:
    """Write a set of named result sets, one CSV folder each."""
    for name, df in results.items():
        write_csv(df, f"{out_dir}/{name}")
    return list(results)


def read_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame], names: Iterable[str], args: dict | None = None) -> DataFrame:
    """Run a SELECT over named tables, with ``:name`` parameters bound, not pasted."""
    for n in names:
        tables[n].createOrReplaceTempView(n)
    return spark.sql(text, args=args or {})


def scalar(df: DataFrame):
    """First cell of the first row of a small result, or None."""
    row = df.first()
    return None if row is None else row[0]


def table_or_empty(tables: Mapping[str, DataFrame], name: str, spark: SparkSession) -> DataFrame:
    """An optional table, or an empty one of its declared shape."""
    if name in tables:
        return tables[name]
    return spark.createDataFrame([], schemas.schema(name))
