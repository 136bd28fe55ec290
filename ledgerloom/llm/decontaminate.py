"""Benchmark decontamination with SimHash windows.

Items are found by windows sized to them. If a passage of a document has a
similarity of at least ``percent`` with an item of n words, the edits leave a run of
the item's words untouched; from its least length follow a window size (the largest
of a short ladder that fits into the run) and a stride at which windows of the item
must be taken so that one of them lies inside the run. Documents are read at every
word. Both sides' windows become 64-bit SimHashes of their five-word shingles; a
multi-index over four blocks of 16 bits finds every pair of fingerprints at most
``radius`` = 3 bits apart. For each of these the item-sized windows of the document
around the place are compared exactly: the weights of a shingle (how often it
occurs) give sum(min) / sum(max).

Items are taken in blocks of bounded size: documents are scanned once for each block,
nothing that grows with the items is broadcast at once.

Defined cases: a null or empty text or item matches nothing; items of fewer than five
words match only as a whole; items without item_id are reported with a null id; rows
without doc_id are searched and reported with a null id; repeated rows are searched
one by one; without items or documents the result is empty. Other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import mapped, passes, text_bytes
from ledgerloom.llm.words import shingles, windows, words

_U = np.uint64
WIDTH = 5
#: Window sizes; a shingle run of the largest must stay under 256 for the sums of simhashes().
LADDER = (1, 2, 3, 4, 5, 8, 13)
BLOCKS, BLOCK_BITS = 4, 16


def clean_run(n: int, percent: int) -> int:
    """Words of an item of ``n`` words that lie together untouched in any passage of the wanted similarity.

    With m shingles, e edits inside cost width - 1 shingles each at least and bring
    as many new ones, so at least s (m + (width - 1) e) shingles are left, in e + 1 runs.
    """
    m, each = n - WIDTH + 1, WIDTH - 1
    if m <= 1:
        return n
    most = m * (100 - percent) // (each * (100 + percent))
    return min(-(-percent * (m + each * e) // (100 * (e + 1))) for e in range(most + 1)) + WIDTH - 1


class Index(NamedTuple):
    """Fingerprints of item windows of one size, and where each block value is found."""

    size: int
    prints: np.ndarray
    item: np.ndarray
    place: np.ndarray
    order: list  # by block: fingerprints sorted by the block's value
    starts: list  # by block: first of each value


class Items(NamedTuple):
    ids: list
    shingles: list  # of each item, as a Counter
    lengths: list
    indexes: list


def simhashes(sh: np.ndarray, at: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """SimHash of each run of ``count`` shingles inside a document, and the index of its first shingle."""
    n = len(sh) - count + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    sums = np.zeros((len(sh) + 1, 64), np.uint8)  # differences stay right modulo 256
    np.cumsum(np.unpackbits(sh.view(np.uint8).reshape(-1, 8), axis=1), axis=0, dtype=np.uint8, out=sums[1:])
    first = np.flatnonzero(np.arange(n) + count <= np.repeat(at[1:], np.diff(at))[:n])
    ones = sums[count:] - sums[:-count]
    return np.packbits(ones > count // 2, axis=1).view(_U).ravel()[first], first


def fingerprints(hashes: np.ndarray, at: np.ndarray, sh: np.ndarray, sh_at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, document and first word of each window of ``size`` words."""
    if size < WIDTH:
        prints, word = windows(hashes, at, size)
        doc = np.searchsorted(at, word, "right") - 1
        return prints, doc, word - at[doc]
    prints, first = simhashes(sh, sh_at, size - WIDTH + 1)
    doc = np.searchsorted(sh_at, first, "right") - 1
    whole = np.diff(at)[doc] >= size  # a short document has one shingle of fewer words
    prints, first, doc = prints[whole], first[whole], doc[whole]
    return prints, doc, first - sh_at[doc]


def index_items(rows: list[tuple], percent: int) -> Items:
    """Index of (item_id, text) rows."""
    rows = [r for r in rows if r[1] and r[1].encode().split()]
    raw, off = text_bytes(pa.array([r[1] for r in rows], pa.string()))
    w = words(raw, off, lower=True)
    sh, at = shingles(w.hashes, w.offsets, WIDTH)
    lengths = np.diff(w.offsets)
    sizes, strides = np.zeros(len(rows), np.int64), np.ones(len(rows), np.int64)
    for i, n in enumerate(lengths.tolist()):
        run = clean_run(n, percent)
        sizes[i] = n if n < WIDTH else max(x for x in LADDER if x <= run)
        strides[i] = run - sizes[i] + 1
    out = []
    for size in sorted(set(sizes.tolist())):
        prints, doc, place = fingerprints(w.hashes, w.offsets, sh, at, size)
        own = sizes[doc] == size
        prints, doc, place = prints[own], doc[own], place[own]
        last = lengths[doc] - size
        taken = (place % strides[doc] == 0) | (place == last)
        prints, doc, place = prints[taken], doc[taken], place[taken]
        order, starts = [], []
        for b in range(BLOCKS):
            value = (prints >> _U(b * BLOCK_BITS)) & _U((1 << BLOCK_BITS) - 1)
            order.append(np.argsort(value, kind="stable"))
            starts.append(np.searchsorted(value[order[-1]], np.arange((1 << BLOCK_BITS) + 1, dtype=_U)))
        out.append(Index(size, prints, doc, place, order, starts))
    return Items([r[0] for r in rows], [Counter(sh[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)], lengths.tolist(), out)


def within_radius(index: Index, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All (query, fingerprint) pairs at most ``radius`` bits apart, for radius < BLOCKS: one block of such a pair is equal."""
    queries, found = [], []
    for b in range(BLOCKS):
        value = ((prints >> _U(b * BLOCK_BITS)) & _U((1 << BLOCK_BITS) - 1)).astype(np.int64)
        begin = index.starts[b][value]
        count = index.starts[b][value + 1] - begin
        hit = np.flatnonzero(count)
        count = count[hit]
        query = np.repeat(hit, count)
        step = np.arange(len(query)) - np.repeat(np.cumsum(count) - count, count)
        other = index.order[b][np.repeat(begin[hit], count) + step]
        near = np.bitwise_count(prints[query] ^ index.prints[other]) <= radius
        queries.append(query[near])
        found.append(other[near])
    pairs = np.unique(np.stack([np.concatenate(queries), np.concatenate(found)], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def reach_of(count: int) -> int:
    """Places before and after the expected one at which a run of ``count`` shingles may begin."""
    return max(1, count // 4)


def best_similarity(item: Counter, doc: list[int], start: int, count: int) -> float:
    """The largest weighted similarity of ``item`` with runs of ``count`` shingles of ``doc`` that begin near ``start``."""
    reach, best = reach_of(count), 0.0
    total = sum(item.values())
    for a in range(start - reach, start + reach + 1):
        part = doc[max(a, 0) : max(a + count, 0)]
        if part:
            own = Counter(part)
            both = sum(min(n, item[s]) for s, n in own.items() if s in item)
            best = max(best, both / (total + len(part) - both))
    return best


def search(items: Items, texts: pa.Array, percent: int, radius: int) -> list[tuple[int, int, float]]:
    """(document, item, similarity) of every passage found in the texts; the best of each pair."""
    raw, off = text_bytes(texts)
    w = words(raw, off, lower=True)
    sh, at = shingles(w.hashes, w.offsets, WIDTH)
    tried, best = set(), {}
    for index in items.indexes:
        prints, doc, place = fingerprints(w.hashes, w.offsets, sh, at, index.size)
        query, other = within_radius(index, prints, radius)
        for d, i, start in zip(doc[query].tolist(), index.item[other].tolist(), (place[query] - index.place[other]).tolist(), strict=True):
            if (d, i, start) in tried:
                continue
            tried.add((d, i, start))
            if index.size < WIDTH:
                similarity = 1.0  # the window is the whole item
            else:
                count = items.lengths[i] - WIDTH + 1
                # Only what the runs can cover, not the whole document for each place.
                low, high = max(start - reach_of(count), 0), min(at[d] + start + reach_of(count) + count, at[d + 1])
                similarity = best_similarity(items.shingles[i], sh[at[d] + low : high].tolist(), start - low, count)
            if similarity * 100 >= percent:
                best[d, i] = max(best.get((d, i), 0.0), similarity)
    return [(d, i, s) for (d, i), s in sorted(best.items())]


def matches(docs: DataFrame, items: DataFrame, percent: int = 75, radius: int = 3, block_items: int = 2000) -> DataFrame:
    """doc_id, item_id and similarity of every document and item that share a passage."""
    if radius >= BLOCKS:
        raise ValueError(f"radius must be below {BLOCKS}")
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.length("text") > 0)
    listed = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.length("text") > 0)
    blocks = -(-listed.count() // block_items)
    out = spark.createDataFrame([], "doc_id long, item_id long, similarity double")
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    for n in range(blocks):
        part = listed.filter(block_of == n) if blocks > 1 else listed
        index = index_items([(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()], percent)

        def work(batch: pa.RecordBatch, index: Items = index) -> dict:
            found = search(index, batch.column(1), percent, radius)
            return {
                "doc_id": batch.column(0).take(pa.array([d for d, _, _ in found], pa.int64())),
                "item_id": pa.array([index.ids[i] for _, i, _ in found], pa.int64()),
                "similarity": pa.array([s for _, _, s in found], pa.float64()),
            }

        if index.indexes:
            out = out.unionByName(mapped(rows, work, "doc_id long, item_id long, similarity double"))
    return out


def contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """A row for each document that shares a passage with an item: doc_id, n_items, items, similarity (the largest) and kept (false)."""
    return matches(docs, items, **options).groupBy("doc_id").agg(
        F.countDistinct("item_id").alias("n_items"), F.sort_array(F.collect_set("item_id")).alias("items"), F.max("similarity").alias("similarity")
    ).withColumn("kept", F.lit(False))


def remove(docs: DataFrame, items: DataFrame, percent: int = 75, radius: int = 3, block_items: int = 2000) -> DataFrame:
    """The rows of ``docs`` whose text shares no passage with an item, with all their columns."""
    listed = items.select("item_id", "text").filter(F.length("text") > 0)
    blocks = -(-listed.count() // block_items)
    at = docs.columns.index("text")
    for n in range(blocks):
        part = listed.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == n)
        index = index_items([(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()], percent)

        def work(batches, index: Items = index):
            for batch in batches:
                for some in passes(batch):
                    clean = np.ones(some.num_rows, bool)
                    clean[[d for d, _, _ in search(index, some.column(at), percent, radius)]] = False
                    yield some.filter(pa.array(clean))

        if index.indexes:
            docs = docs.mapInArrow(work, docs.schema)
    return docs
