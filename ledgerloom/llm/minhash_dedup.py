"""MinHash near-dedup by an inverted join of signature coordinates.

A document is posted under each of its (coordinate, value) pairs. Two documents of
the wanted similarity agree in at least ``min_matches`` coordinates (but for a chance
of ``miss``), so it is enough to merge the rarest k - min_matches + 1 lists of each
document (the prefix) and to skip its long lists; agreements in the skipped lists are
counted by comparing the two signatures. Pairs over the match threshold are confirmed
on the full shingle sets. Documents with one shingle set are one class from the start.

Defined cases: texts without words have an empty set and are linked with nothing;
rows without doc_id have no component and are kept; rows that share a doc_id are one
document with the links of all of them; an empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.linking import components, link, masked, unshared, within_masks, within_reach
from ledgerloom.llm.shared import drop, kept, mapped, release, text_bytes, unused
from ledgerloom.llm.words import mix, shingles, words

_U = np.uint64


def min_matches(k: int, similarity: float, miss: float) -> int:
    """The largest t for which fewer than t of k coordinates agree with a chance of at most ``miss``."""
    below, t = 0.0, 0
    while t < k and (below := below + comb(k, t) * similarity**t * (1 - similarity) ** (k - t)) <= miss:
        t += 1
    return max(t, 1)


def distinct_shingles(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, and the offset of each document."""
    w = words(raw, offsets, lower=True)
    sh, at = shingles(w.hashes, w.offsets, width)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((sh, doc))
    sh, doc = sh[order], doc[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])
    return sh[new], np.searchsorted(doc[new], np.arange(len(at)))


def coordinate_keys(sh: np.ndarray, at: np.ndarray, k: int, seed: int) -> np.ndarray:
    """(documents, k): coordinate << 32 | least hash; 0 for documents without shingles."""
    out = np.zeros((len(at) - 1, k), np.int64)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        rng = np.random.default_rng(seed)
        with np.errstate(over="ignore"):
            for i in range(k):
                a, b = (_U(x) for x in rng.integers(1, 1 << 63, 2))
                least = np.minimum.reduceat((sh * (a | _U(1)) + b) >> _U(32), at[full])
                out[full, i] = (least | _U(i << 32)).astype(np.int64)
    return out


def digests(sh: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name a set."""
    out = np.zeros((2, len(at) - 1), _U)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        with np.errstate(over="ignore"):
            for i in range(2):
                out[i, full] = np.add.reduceat(mix(sh ^ _U(0xA5A5A5A55A5A5A5A * (i + 1) & (1 << 64) - 1)), at[full])
    return out[0].view(np.int64), out[1].view(np.int64)


def list_column(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.view(np.int64) if values.dtype == _U else values))


def signatures(docs: DataFrame, k: int, width: int, seed: int = 5) -> DataFrame:
    """doc_id, n_shingles, d1, d2 (names of the set) and keys of every row."""

    def work(part: pa.RecordBatch) -> dict:
        sh, at = distinct_shingles(*text_bytes(part.column(1)), width)
        d1, d2 = digests(sh, at)
        keys = coordinate_keys(sh, at, k, seed)
        return {"doc_id": part.column(0), "n_shingles": np.diff(at), "d1": d1, "d2": d2, "keys": list_column(keys.ravel(), np.arange(len(keys) + 1) * k)}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return mapped(rows, work, "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """id and its distinct shingles."""

    def work(part: pa.RecordBatch) -> dict:
        return {"id": part.column(0), "shingles": list_column(*distinct_shingles(*text_bytes(part.column(1)), width))}

    return mapped(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), work, "id long, shingles array<long>")


def prefix_postings(classes: DataFrame, k: int, need: int) -> DataFrame:
    """key, id, rank: each class under the rarest k - need + 1 of its keys, as far as they are shared.

    The rank is the sum of the lengths of a class's lists: the text from which a
    group of copies was made has the most common coordinates.
    """
    lists = classes.select("id", F.explode("keys").alias("key"))
    shared = lists.groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    own = Window.partitionBy("id")
    rows = (
        lists.join(shared, "key").withColumn("m", F.count("*").over(own)).withColumn("rank", F.sum("df").over(own))
        .withColumn("place", F.row_number().over(own.orderBy("df", "key")))
    )
    # Keys that nobody shares are the rarest of all and come first in the prefix.
    return rows.filter(F.col("place") <= k - need + 1 - (k - F.col("m"))).select("key", "id", "rank")


def confirm_with(classes: DataFrame, sets: DataFrame, need: int, percent: int):
    """Confirms pairs by size, matching coordinates and then the full sets."""
    sig = classes.select("id", "n_shingles", "keys")
    side = lambda df, c: df.select(*[F.col(x).alias(f"{x}_{c}" if x != "id" else c) for x in df.columns])

    def confirm(pairs: DataFrame) -> DataFrame:
        sized = pairs.join(side(sig, "a"), "a").join(side(sig, "b"), "b")
        near = sized.filter((100 * F.least("n_shingles_a", "n_shingles_b") >= percent * F.greatest("n_shingles_a", "n_shingles_b")) & (F.size(F.array_intersect("keys_a", "keys_b")) >= need))
        full = near.select("a", "b").join(side(sets, "b"), "b").join(side(sets, "a"), "a")
        common = F.size(F.array_intersect("shingles_a", "shingles_b"))
        union = F.size("shingles_a") + F.size("shingles_b") - common
        return full.filter(100 * common >= percent * union).select("a", "b").distinct()

    return confirm


def near_duplicates(docs: DataFrame, percent: int = 75, k: int = 40, width: int = 5, miss: float = 1e-6) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept, for every row.

    ``percent``: shared part of the union of two shingle sets, from which on two
    documents are linked.
    """
    spark, need, made = docs.sparkSession, min_matches(k, percent / 100, miss), []
    rows, path = kept(signatures(docs, k, width), "signatures")
    made.append(path)
    filled = rows.filter("n_shingles > 0 and doc_id is not null")
    name = ["d1", "d2", "n_shingles"]
    # All rows of a class have the same keys; tasks reduce a hot class before the shuffle.
    classes, path = kept(filled.groupBy(*name).agg(F.min("doc_id").alias("id"), F.first("keys").alias("keys")), "classes")
    postings, path_p = kept(prefix_postings(classes, k, need).distinct(), "postings")
    made += [path_p]
    wanted = postings.select(F.col("id").alias("doc_id")).distinct()
    sets, path_s = kept(shingle_sets(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), width), "sets")
    made += [path_s]
    # What a set shares with no other one cannot be part of a link: that bound spares most pairs of a group of loose copies.
    reach = within_reach(percent)
    bounded, path_b = kept(postings.join(unshared(sets).filter(100 * (F.col("n") - F.col("u")) >= percent * F.col("n")), "id"), "postings")
    made += [path_b]
    release(spark)
    linked = link(bounded, confirm_with(classes, sets, need, percent), reach, closer=(masked(sets), within_masks(percent)))
    release(spark)
    placed = filled.select("doc_id", *name).join(classes.select("id", *name), name)
    # Rows that share a doc_id may be in several classes.
    several = placed.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b")
    twice = placed.join(several.select("doc_id", "a"), "doc_id").filter("id > a").select("a", F.col("id").alias("b"))
    twice, path_t = kept(twice.distinct(), "links")
    if not twice.isEmpty():
        linked, _ = kept(components(twice.unionByName(linked.select(F.col("component").alias("a"), F.col("id").alias("b")))), "linked")
    labels = classes.select("id", *name).join(linked, "id", "left").select(*[F.col(c).alias(f"c_{c}") for c in name], F.coalesce("component", "id").alias("component"))
    labels, _ = kept(labels, "labels")
    out = rows.select("doc_id", *name).join(labels, (F.col("d1") == F.col("c_d1")) & (F.col("d2") == F.col("c_d2")) & (F.col("n_shingles") == F.col("c_n_shingles")), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    drop(spark, *made[1:], path, path_t)
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def dedup(docs: DataFrame, **options) -> DataFrame:
    """One document of each component, with all columns: rows whose doc_id is the component's."""
    name = unused(docs, "gone")
    gone = near_duplicates(docs.select("doc_id", "text"), **options).filter("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
