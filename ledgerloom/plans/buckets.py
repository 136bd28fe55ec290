"""Merge-on-read tables: hash buckets of the key, each a base file set and the deltas since.

A merge looks its keys up in their buckets only and leaves the new versions of changed
rows in a delta folder beside the base; nothing is rewritten. Readers take the newest
version of a key: buckets without deltas are scanned as they are, in the others base
rows that a delta replaces are left out. ``compact`` folds long chains of deltas into a
new base, beside running readers and writers. Files carry Parquet Bloom filters on the
key, so that a lookup of a few keys skips row groups as well as buckets.

The table is what the newest log entry names: a small JSON file that comes into being by
a rename without overwriting, as the logs of streaming queries do. Two writers that
start from one version cannot both commit; the later one gets :class:`Conflict` and
starts again. A writer that dies before its log entry leaves nothing that counts. The
log needs a file system with an atomic rename (HDFS, a local disk).

Keys are never null: rows without one are left out of a merge.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ledgerloom.operators import incremental
from ledgerloom.plans.publish import _fs, folders, is_published, publish
from ledgerloom.session import configure, release, scratch

#: Rows of a bucket at the first load; a bucket is written by one task.
ROWS_A_BUCKET = 250_000
#: Buckets that a merge or a fold works on at a time, so that its shuffle files are a part of the table's size.
BUCKETS_A_PASS = 64
#: Keys that a lookup hands to the scan as values; Spark pushes longer lists down as a range only.
FEW_KEYS = 10
_LOG, _SEQ, _SCRATCH, _PASS = "_log", "_seq", "_scratch", "_pass"


class Conflict(RuntimeError):
    """Another writer has committed since this one read the table."""


class Entry(NamedTuple):
    bucket: int
    seq: int  # version in which it was written; later ones win
    run: str
    base: bool


class Snapshot(NamedTuple):
    path: str
    version: int
    key: str
    buckets: int
    entries: list[Entry]
    schema: StructType
    marks: dict[str, int] = {}  # for a table that follows others: how far it has followed each

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")


# ------------------------------------------------------------------ log
def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, p, _ = _fs(spark, f"{path}/{_LOG}")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The table as its newest version has it, or an older one that is not vacuumed."""
    found = _versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no table at {path}")
    version = found[-1] if version is None else version
    fs, p, _ = _fs(spark, f"{path}/{_LOG}/{version:012d}.json")
    stream = fs.open(p)
    try:
        told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Snapshot(path, version, told["key"], told["buckets"], [Entry(*e) for e in told["entries"]], StructType.fromJson(told["schema"]), told["marks"])


def _commit(spark: SparkSession, s: Snapshot) -> Snapshot:
    """Make ``s`` the table's next version, if no one else has made one."""
    text = json.dumps({"key": s.key, "buckets": s.buckets, "entries": sorted(s.entries), "schema": s.schema.jsonValue(), "marks": s.marks})
    final, draft = f"{s.path}/{_LOG}/{s.version:012d}.json", f"{s.path}/{_LOG}/.{uuid.uuid4().hex}"
    fs, p, hadoop = _fs(spark, draft)
    stream = fs.create(p, False)
    stream.write(text.encode())
    stream.close()
    context = hadoop.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(p), fs.makeQualified(hadoop.Path(final)), spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
    except Exception as failed:
        fs.delete(p, False)
        if fs.exists(hadoop.Path(final)):
            raise Conflict(f"version {s.version} of {s.path} is another writer's") from failed
        raise
    return s


# ------------------------------------------------------------------ files
def _write(df: DataFrame, s: Snapshot, run: str) -> list[int]:
    """Write rows to their buckets in a new run folder; the buckets it has."""
    rows = df.withColumn("bucket", s.bucket_of()).repartition("bucket").sortWithinPartitions("bucket", s.key)
    root = f"{s.path}/data/run={run}"
    bloom = {f"parquet.bloom.filter.enabled#{s.key}": "true", f"parquet.bloom.filter.expected.ndv#{s.key}": str(ROWS_A_BUCKET)}
    rows.write.mode("append").options(**bloom).option("compression", "zstd").partitionBy("bucket").parquet(root)
    return [int(f.removeprefix("bucket=")) for f in folders(df.sparkSession, root) if f.startswith("bucket=")]


def _scan(spark: SparkSession, s: Snapshot, entries: list[Entry], within: Callable[[DataFrame], DataFrame]) -> DataFrame:
    schema = StructType([*s.schema.fields]).add(_SEQ, LongType())
    if not entries:
        return spark.createDataFrame([], schema)
    paths = [f"{s.path}/data/run={e.run}/bucket={e.bucket}" for e in entries]
    return within(spark.read.schema(schema).parquet(*paths))


def _live(spark: SparkSession, s: Snapshot, entries: list[Entry], within: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The newest version of every key in ``entries``; ``within`` narrows each scan by key."""
    names = s.schema.names
    changed = {e.bucket for e in entries if not e.base}
    scan = lambda keep: _scan(spark, s, [e for e in entries if keep(e)], within)
    out = scan(lambda e: e.base and e.bucket not in changed).select(*names)
    if changed:
        row = F.max_by(F.struct(*[c for c in names if c != s.key]), _SEQ).alias("row")
        new = scan(lambda e: not e.base).groupBy(s.key).agg(row).select(*[F.col(c) if c == s.key else F.col(f"row.{c}").alias(c) for c in names])
        old = scan(lambda e: e.base and e.bucket in changed).join(scan(lambda e: not e.base).select(s.key), s.key, "left_anti").select(*names)
        out = out.unionByName(old).unionByName(new)
    return out


# ------------------------------------------------------------------ tables
def create(df: DataFrame, path: str, key: str, buckets: int | None = None, marks: dict[str, int] | None = None) -> Snapshot:
    """First load, or a new one that takes the place of all rows. ``buckets``: the fewest; large tables get one for every ``ROWS_A_BUCKET``."""
    spark = df.sparkSession
    found, run = _versions(spark, path), uuid.uuid4().hex
    s = Snapshot(path, (found[-1] if found else 0) + 1, key, max(buckets or 1, ceil(df.count() / ROWS_A_BUCKET)), [], df.schema, marks or {})
    written = _write(df.withColumn(_SEQ, F.lit(0).cast("long")), s, run)
    return _commit(spark, s._replace(entries=[Entry(b, s.version, run, True) for b in written]))


def read(spark: SparkSession, path: str) -> DataFrame:
    s = snapshot(spark, path)
    return _live(spark, s, s.entries)


def lookup(s: Snapshot, keys: DataFrame) -> DataFrame:
    """The table's rows with one of ``keys`` (a column of that name). Only the keys' buckets are looked at."""
    spark = keys.sparkSession
    wanted = keys.select(s.key)
    touched = {r[0] for r in wanted.select(s.bucket_of()).distinct().collect()}
    few = [r[0] for r in wanted.limit(FEW_KEYS + 1).collect()]

    def within(df: DataFrame) -> DataFrame:
        return df.where(F.col(s.key).isin(few)) if len(few) <= FEW_KEYS else df.join(wanted, s.key, "left_semi")

    return _live(spark, s, [e for e in s.entries if e.bucket in touched], within)


def append(df: DataFrame, s: Snapshot, marks: dict[str, int] | None = None) -> Snapshot:
    """Add new versions of rows (one a key) as a delta after ``s``, and put down ``marks`` with them."""
    run, seq = uuid.uuid4().hex, s.version + 1
    written = _write(df.select(*s.schema.names).withColumn(_SEQ, F.lit(seq).cast("long")), s, run)
    return _commit(df.sparkSession, s._replace(version=seq, entries=[*s.entries, *[Entry(b, seq, run, False) for b in written]], marks=s.marks if marks is None else marks))


def changed_keys(spark: SparkSession, path: str, since: int, until: int) -> DataFrame:
    """Keys with a new version after version ``since``, up to ``until``; the log names the deltas, also those that were folded meanwhile."""
    s, fresh = snapshot(spark, path, until), set()
    for v in [v for v in _versions(spark, path) if since < v <= until]:
        entries = snapshot(spark, path, v).entries
        fresh |= {e for e in entries if not e.base and e.seq > since}
        if since and any(e.base and e.seq == v for e in entries):
            raise Conflict(f"{path} was loaded anew in version {v}")
    return _scan(spark, s, sorted(fresh), lambda df: df).select(s.key).distinct()


def passes(buckets: Iterable[int]) -> list[set[int]]:
    """Buckets in sets of ``BUCKETS_A_PASS`` at most."""
    ordered = sorted(buckets)
    return [set(ordered[k : k + BUCKETS_A_PASS]) for k in range(0, len(ordered), BUCKETS_A_PASS)]


def compact(spark: SparkSession, path: str, deltas: int = 4) -> list[int]:
    """Fold the deltas of every bucket that has so many of them into a new base; the buckets folded.

    What others commit meanwhile stays: their deltas are newer than the new base.
    """
    s = snapshot(spark, path)
    chains: dict[int, int] = {}
    for e in s.entries:
        chains[e.bucket] = chains.get(e.bucket, 0) + (not e.base)
    due = {b for b, n in chains.items() if n >= deltas}
    if not due:
        return []
    folded, run, written = [e for e in s.entries if e.bucket in due], uuid.uuid4().hex, []
    for some in passes(due):
        written = _write(_live(spark, s, [e for e in folded if e.bucket in some]).withColumn(_SEQ, F.lit(0).cast("long")), s, run)
        release(spark)
    while True:
        now = snapshot(spark, path)
        if not set(folded) <= set(now.entries):
            raise Conflict(f"{path} was compacted or loaded anew by another writer")
        entries = [e for e in now.entries if e not in folded] + [Entry(b, s.version, run, True) for b in written]
        try:
            _commit(spark, now._replace(version=now.version + 1, entries=entries))
            return sorted(due)
        except Conflict:
            continue


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete run folders and log entries that the newest version does not need; call it when no reader or writer is left on an older one."""
    s = snapshot(spark, path)
    live = {e.run for e in s.entries}
    old = [f"data/{f}" for f in folders(spark, f"{path}/data") if f.removeprefix("run=") not in live]
    for name in [*old, *[f"{_LOG}/{v:012d}.json" for v in _versions(spark, path)[:-1]]]:
        fs, p, _ = _fs(spark, f"{path}/{name}")
        fs.delete(p, True)
    return old


def merge(spark: SparkSession, path: str, delta: DataFrame, rule: incremental.MergeRule, audit_path: str, run_id: str) -> DataFrame:
    """Merge a delta; inserted and updated rows of the run's first attempt.

    Audit rows and counts are complete before the table changes, and versions are
    compared, so a run that died or met another writer can simply be repeated.
    """
    configure(spark)
    s = snapshot(spark, path)
    with scratch(spark, f"{path}/{_SCRATCH}") as put:
        # Written down once: it is read for its buckets, the lookup and the merge. Each pass reads its own files.
        clean = incremental.dedupe_latest(delta.where(F.col(rule.key).isNotNull()), [rule.key], rule.version)
        count = ceil(s.buckets / BUCKETS_A_PASS)
        clean = put(clean.withColumn(_PASS, (s.bucket_of() / BUCKETS_A_PASS).cast("int")), _PASS) if count > 1 else put(clean)
        release(spark)
        done = []
        for k in range(count):
            part = clean.where(F.col(_PASS) == k).drop(_PASS) if count > 1 else clean
            done.append(put(incremental.merge_changes(lookup(s, part), part, rule)))
            release(spark)
        result = incremental.of_changes(reduce(DataFrame.unionByName, done), rule)
        if not is_published(spark, f"{audit_path}/counts", rule.table, run_id):
            publish(result.counts, f"{audit_path}/counts", rule.table, run_id)
        if rule.audit and not is_published(spark, audit_path, rule.table, f"run={run_id}"):
            publish(result.audit, audit_path, rule.table, f"run={run_id}")
        if not result.changed.isEmpty():
            append(result.changed, s)
    release(spark)
    return spark.read.parquet(f"{audit_path}/counts/{rule.table}/{run_id}")
