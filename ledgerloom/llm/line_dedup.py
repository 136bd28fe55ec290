"""Line dedup against levelled sorted runs of line hashes; DataFrame functions only.

A run is a bucketed table of 128-bit line hashes, sorted inside its buckets, that no
earlier run holds. A batch of documents is reduced to its distinct hashes, written
in the same buckets, and merge-anti-joined with one run after another: neither side
is shuffled for that. What remains is the batch's own run of level 0. Once a level
holds ``fanout`` runs they are compacted into one run of the next level, so a batch
meets at most fanout - 1 runs a level.

Batches come in ascending order of doc_id: a line stays in the smallest doc_id that
holds it. A line's key is the line without blanks at its ends, A-Z lower-cased; keys
under ``min_chars`` code points are never dropped.

Defined cases: a null or empty text is one empty line; rows without doc_id keep all
their lines and stop no other line; rows that share a doc_id are one document that
never drops its own lines; an empty batch adds an empty run. Other columns are
ignored.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.shared import drop, folder, kept

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, text hash, position and key hash of every line that may be dropped."""
    rows = docs.filter("doc_id is not null").select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    key = rows.select("doc_id", "th", "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    return key.select("doc_id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.reverse("key")).alias("h2"))


def without(lines: Column, gone: Column) -> Column:
    """``lines`` without the positions in the sorted array ``gone``: the slices between them, so that the work is linear."""
    edges = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    pieces = F.transform(F.sequence(F.lit(1), F.size(gone) + 1), lambda i: F.slice(lines, F.get(edges, i - 1) + 2, F.get(edges, i) - F.get(edges, i - 1) - 1))
    return F.when(F.size(gone) == 0, lines).otherwise(F.flatten(pieces))


class LineStore:
    """Runs under ``root`` in the shared folder, listed in a numbered manifest that is written last.

    A batch that is added again under its name replaces its own run, which is
    compacted only when a later batch comes.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, fanout: int = 4, buckets: int | None = None):
        self.spark, self.root, self.fanout = spark, root or folder(spark, "lines"), fanout
        self._path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())
        state = self._read()
        self.buckets = state.get("buckets") or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[dict] = state.get("runs", [])
        self.version: int = state.get("version", 0)
        for run in self.runs:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {run['table']} (h1 BIGINT, h2 BIGINT) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{run['path']}'")

    def _read(self) -> dict:
        if not self._fs.exists(self._path):
            return {}
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path)]
        numbers = sorted(int(n[9:]) for n in names if n.startswith("manifest-"))
        if not numbers:
            return {}
        return json.loads(self.spark.read.text(f"{self.root}/manifest-{numbers[-1]}").first()[0])

    def _commit(self) -> None:
        self.version += 1
        state = json.dumps({"version": self.version, "buckets": self.buckets, "runs": self.runs})
        self.spark.createDataFrame([(state,)], "value string").coalesce(1).write.text(f"{self.root}/manifest-{self.version}")

    def _bucketed(self, df: DataFrame) -> dict:
        name = f"lines_{uuid.uuid4().hex}"
        path = f"{self.root}/{name}"
        df.repartition(self.buckets, *_HASH).write.bucketBy(self.buckets, *_HASH).sortBy(*_HASH).option("path", path).saveAsTable(name)
        return {"table": name, "path": path}

    def _remove(self, *runs: dict) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run['table']}")
            drop(self.spark, run["path"])

    def _compact(self) -> None:
        level = 0
        while len(full := [r for r in self.runs if r["level"] == level]) >= self.fanout:
            merged = self.spark.table(full[0]["table"])
            for run in full[1:]:
                merged = merged.unionByName(self.spark.table(run["table"]))
            new = self._bucketed(merged.select(*_HASH)) | {"level": level + 1, "batch": None}
            self.runs = [r for r in self.runs if r not in full] + [new]
            self._commit()
            self._remove(*full)
            level += 1

    def add(self, batch: str, docs: DataFrame, min_chars: int = 10) -> DataFrame:
        """Add the batch's run; doc_id, text hash and the sorted positions of the lines each document loses."""
        self._compact()
        own = [r for r in self.runs if r["batch"] == batch]
        self.runs = [r for r in self.runs if r["batch"] != batch]
        lines = hashed_lines(docs.select("doc_id", "text"), min_chars)
        # One row a key: hot lines are reduced in each task before the shuffle.
        keys = self._bucketed(lines.groupBy(*_HASH).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")))
        fresh = self.spark.table(keys["table"])
        for run in self.runs:
            fresh = fresh.join(self.spark.table(run["table"]).hint("merge"), _HASH, "left_anti")
        new = self._bucketed(fresh.select(*_HASH)) | {"level": 0, "batch": batch}
        mine = self.spark.table(new["table"]).select(*_HASH, F.lit(True).alias("is_new")).hint("merge")
        status = self.spark.table(keys["table"]).join(mine, _HASH, "left")
        # Where a line may stay: nowhere in this batch if an earlier run holds it, else in the first document.
        repeated = status.filter("is_new is null or last > first").select(*_HASH, F.when(F.col("is_new"), F.col("first")).alias("stays"))
        repeated, _ = kept(repeated, "repeated")
        self.runs.append(new)
        self._commit()
        self._remove(keys, *own)
        # Both sides are dealt anew here, so that a line that is in very many documents is split at run time.
        hit = lines.join(repeated, _HASH).filter("stays is null or doc_id > stays")
        return hit.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def apply(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text and kept_sha256 of every row of ``docs``."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    joined = rows.join(gone, ["doc_id", "th"], "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>"))).withColumn("lines", lines_of(F.col("text")))
    text = F.array_join(without(F.col("lines"), F.col("gone")), "\n")
    sized = joined.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"), text.alias("kept_text"))
    return sized.withColumn("kept_sha256", F.sha2(F.col("kept_text").cast("binary"), 256))


def dedup(docs: DataFrame, batches: int = 4, fanout: int = 3, min_chars: int = 10, store: LineStore | None = None) -> DataFrame:
    """All documents in ``batches`` ranges of doc_id, one after another."""
    store = store or LineStore(docs.sparkSession, fanout=fanout)
    at = [i / batches for i in range(1, batches)]
    cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, at)))).first()[0] or [])) if at else []
    doc_id, parts = F.col("doc_id"), []
    for n, (low, high) in enumerate(zip([None, *cuts], [*cuts, None], strict=True)):
        part = docs.filter("doc_id is not null")
        part = part.filter(doc_id > low) if low is not None else part
        part = part.filter(doc_id <= high) if high is not None else part
        parts.append(apply(part, store.add(f"range-{n}", part)))
    out = apply(docs.filter("doc_id is null"), docs.sparkSession.createDataFrame([], "doc_id long, th long, gone array<int>"))
    for part in parts:
        out = out.unionByName(part)
    return out
