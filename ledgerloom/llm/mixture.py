"""Mixing sources to target weights.

Every document gets a hash-random key. Rows are range-sorted by (source, key), so
one source may fill many tasks; the sizes before a document are the sum inside its
range plus the totals of earlier ranges. A source's target is met by whole epochs
of the source and one last epoch that is cut where its budget ends, inside a
document if need be.

Defined cases: a null or empty text has size 0 and is never taken; a null source
is a source of its own, last in order; rows without doc_id and rows that share one
are mixed like any other (equal rows change places only with each other); an empty
table gives an empty mix. Other columns stay out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import kept, unused

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: tuple[int, int], epochs: int) -> DataFrame:
    """``sizes`` (source, source_size) with each source's target.

    A target is min(epochs x size, level x weight): the level at which all targets
    add up to the share of all sizes. Sources are few against documents (one row
    each), so the windows over them are unpartitioned. All sums are exact; there is
    one division per source.
    """
    num, den = share
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    # Those that reach their cap first come first; a source is capped if the level reached without it would pass its cap.
    by_cap = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    rows = (
        sizes.withColumn("w", weight.cast("long")).withColumn("total", F.sum("source_size").over(everything))
        .withColumn("capped_before", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * epochs)
        .withColumn("w_onward", F.sum("w").over(onward))
        .withColumn("left", wide("total") * num - wide("capped_before") * den)
        .withColumn("capped", F.col("left") * wide("w") > wide("source_size") * epochs * den * wide("w_onward"))
    )
    level = F.max(F.when(~F.col("capped"), F.struct("w_onward", "left"))).over(everything)
    share_of = (F.col("w") * F.col("level.left")).cast("double") / (F.col("level.w_onward") * den).cast("double")
    return rows.withColumn("level", level).select(
        "source", "source_size", F.when(F.col("capped"), (F.col("source_size") * epochs).cast("double")).otherwise(share_of).alias("target")
    )


def _keys(seed: int) -> list[Column]:
    """Two keys of a row, never null and equal for rows of the same doc_id and text: hash-random by id, then by text."""
    by_id = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return [by_id.alias("key1"), F.xxhash64(F.isnull("text"), "text").alias("key2")]


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: tuple[int, int] = (3, 2), epochs: int = 2, seed: int = 17) -> DataFrame:
    """doc_id, source, key1, key2, size, source_size, target and taken (words the mix takes of the document, repeats counted).

    ``share``: words of the mix as a fraction of all words; ``epochs``: how often a
    source may be used at most.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *_keys(seed))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written once, so that every later step and a retry after a lost executor see the same ranges.
    ranged = rows.repartitionByRange(parts, F.col("source").asc_nulls_last(), "key1", "key2").withColumn("part", F.spark_partition_id())
    ranged, _ = kept(ranged, "mixture")
    per_part = ranged.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    goal = targets(per_part.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, share, epochs)
    goal = goal.withColumn("goal", F.floor("target").cast("long"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per source and range: small against the rows, which are dealt by range and source only.
    offsets = per_part.withColumn("offset", F.coalesce(F.sum("part_size").over(earlier), F.lit(0))).alias("o").join(
        goal.alias("g"), F.col("o.source").eqNullSafe(F.col("g.source"))
    ).select("part", F.coalesce(F.concat(F.lit("="), "o.source"), F.lit("")).alias("name"), "offset", "source_size", "target", "goal")
    inside = Window.partitionBy("part", "name").orderBy("key1", "key2").rowsBetween(Window.unboundedPreceding, -1)
    named = ranged.withColumn("name", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    placed = named.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["part", "name"])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("goal") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("goal") - whole * F.col("source_size") - F.col("within") - F.col("offset")
    taken = whole * F.col("size") + F.least(F.greatest(rest, F.lit(0)), F.col("size"))
    return placed.select("doc_id", "source", "key1", "key2", "size", "source_size", "target", taken.cast("long").alias("taken"))


def materialise(docs: DataFrame, mixed: DataFrame, seed: int = 17) -> DataFrame:
    """The documents of a mix with all their columns: a row for each use, the last one cut to the words that remain.

    Rows of one doc_id and text count as one document that is used more often. A
    cut text keeps its blanks between words.
    """
    columns, x = docs.columns, unused(docs, "mix")
    uses = mixed.groupBy("key1", "key2").agg(F.sum("taken").alias("taken"), F.max("size").alias("size")).filter("taken > 0")
    uses = uses.select(*[F.col(c).alias(f"{x}_{c}") for c in uses.columns])
    keys = [f"{x}_key1", f"{x}_key2"]
    size, taken, copy = F.col(f"{x}_size"), F.col(f"{x}_taken"), F.col(f"{x}_copy")
    keyed = docs.select("*", *[k.alias(n) for k, n in zip(_keys(seed), keys, strict=True)])
    one = keyed.withColumn(f"{x}_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))).filter(F.col(f"{x}_n") == 1)
    copies = one.join(uses, keys).withColumn(f"{x}_copy", F.explode(F.sequence(F.lit(0), F.ceil(taken / size).cast("int") - 1)))
    left = taken - copy * size
    pieces = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.when(left >= size, F.col("text")).otherwise(F.array_join(F.slice(pieces, 1, left.cast("int")), ""))
    return copies.select(*[cut.alias(c) if c == "text" else c for c in columns])
