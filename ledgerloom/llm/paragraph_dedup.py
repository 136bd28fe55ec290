"""Substring dedup by MinHash banding of paragraphs.

Paragraphs are lines, and lines of fewer than ``min_words`` words that follow one
another are one (verse, lists, addresses). One of twice ``min_words`` words or more is
divided where its content says so (before a word whose hash, with the next word's, is
the least of ``reach`` words on either side), so that a passage is divided alike
wherever it stands. A paragraph's set holds its
five-word shingles. Bands of ``rows`` MinHash values are as many as a recall of
``recall`` at the wanted similarity takes. Paragraphs that collide in a band are
compared by exact Jaccard similarity, links are joined to components, and a
component over several documents keeps its first paragraph. Paragraphs count only
in runs of neighbours, all of them repeated, that hold ``min_run`` words, so a common
short line is left alone. Copies with the same set are one class from the start.

With ``whole_lines`` every line of ``min_words`` words or more is compared as a whole
as well, so that lines with a few changed words are found though the changes spoil
their paragraphs. Lines are linked with lines only, under the same rules; what either
division removes is removed. Both keep the first by document and place, so no text
loses its last copy.

Defined cases: null and empty texts have no paragraph; paragraphs of fewer than
``min_words`` words are never compared, but go with their neighbours in a run; rows
without doc_id are ignored; rows that share a doc_id are told apart by their text
and count as one document; repeated rows give repeated results; an empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.linking import link, masked, unshared, within_masks, within_reach
from ledgerloom.llm.minhash_dedup import coordinate_keys, digests, list_column
from ledgerloom.llm.shared import drop, kept, mapped, release, text_bytes
from ledgerloom.llm.words import Words, mix, shingles, windows, words

_U = np.uint64
WIDTH = 5


class Settings(NamedTuple):
    percent: int = 75  # shared part of the union of two sets
    rows: int = 1  # MinHash values in a band
    recall: float = 0.99  # chance that two paragraphs of that similarity collide
    reach: int = 5
    min_words: int = 6
    min_run: int = 24
    whole_lines: bool = False  # compare whole lines beside the paragraphs

    @property
    def bands(self) -> int:
        return ceil(log(1 - self.recall) / log(1 - (self.percent / 100) ** self.rows))


def line_starts(raw: np.ndarray, w: Words) -> np.ndarray:
    """Whether a line or a document begins with each word."""
    begins = np.zeros(len(w.starts), bool)
    newlines = np.concatenate([[0], np.cumsum(raw == 10)])
    begins[1:] = newlines[w.starts[1:]] > newlines[w.ends[:-1]]
    begins[w.offsets[:-1][w.offsets[:-1] < len(begins)]] = True
    return begins


def paragraphs(raw: np.ndarray, offsets: np.ndarray, reach: int, min_words: int = 6) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, the first word of each paragraph (and the number of words at the end), and the paragraphs before each document."""
    w = words(raw, offsets, lower=True)
    n = len(w.starts)
    if not n:
        return w, np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    begins = line_starts(raw, w)
    line = np.flatnonzero(begins)
    short = np.diff(np.append(line, n)) < min_words
    # A newline between two short lines is no border.
    begins[line[1:][short[1:] & short[:-1]]] = False
    begins[w.offsets[:-1][w.offsets[:-1] < n]] = True
    block = np.flatnonzero(begins)
    size = np.diff(np.append(block, n))
    pair, at = windows(w.hashes, w.offsets, 2)
    # Room between documents, so that no word's neighbours are another document's.
    place = np.arange(n) + np.repeat(np.arange(len(offsets) - 1) * reach, np.diff(w.offsets))
    most = np.iinfo(np.uint64).max
    value = np.full(n + len(offsets) * reach, most, _U)
    value[place[at]] = pair
    before, after = np.full(len(value), most, _U), np.full(len(value), most, _U)
    for k in range(1, reach + 1):
        np.minimum(before[k:], value[:-k], out=before[k:])
        np.minimum(after[:-k], value[k:], out=after[:-k])
    # A line that cannot give two paragraphs of min_words words stays whole: its parts could all be too short.
    begins |= ((value < before) & (value <= after))[place] & np.repeat(size >= 2 * min_words, size)
    first = np.flatnonzero(begins)
    return w, np.append(first, n), np.searchsorted(first, w.offsets)


def band_keys(sh: np.ndarray, at: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(paragraphs, bands): hash of the band's number and values."""
    values = coordinate_keys(sh, at, bands * rows, seed=11).view(_U).reshape(-1, bands, rows)
    with np.errstate(over="ignore"):
        out = np.zeros(values.shape[:2], _U)
        for r in range(rows):
            out = mix(out * _U(0x9E3779B97F4A7C15) + values[:, :, r])
    return out.view(np.int64)


def sets_of(w: Words, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of the words from ``begin`` to ``end``, and the offset of each."""
    count = end - begin
    at = np.concatenate([[0], np.cumsum(count)])
    index = np.arange(at[-1]) + np.repeat(begin - at[:-1], count)
    sh, sh_at = shingles(w.hashes[index], at, WIDTH)
    doc = np.repeat(np.arange(len(begin)), np.diff(sh_at))
    # One number for a shingle and its unit: few units have any number twice, and only those are sorted.
    with np.errstate(over="ignore"):
        both = mix(sh + mix(doc.astype(_U)))
    ranked = np.sort(both)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return sh, sh_at
    again = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, both), len(twice) - 1)] == both)
    again = again[np.lexsort((sh[again], doc[again]))]
    more = np.flatnonzero((sh[again[1:]] == sh[again[:-1]]) & (doc[again[1:]] == doc[again[:-1]])) + 1
    new = np.ones(len(sh), bool)
    new[again[more]] = False
    return sh[new], np.searchsorted(doc[new], np.arange(len(begin) + 1))


def divisions(raw: np.ndarray, offsets: np.ndarray, s: Settings) -> tuple[Words, list[np.ndarray]]:
    """Words, and the first word of each unit (and the number of words) by paragraphs and, if wanted, by lines."""
    w, first, _ = paragraphs(raw, offsets, s.reach, s.min_words)
    if not s.whole_lines:
        return w, [first]
    return w, [first, np.append(np.flatnonzero(line_starts(raw, w)), len(w.starts))]


class Units(NamedTuple):
    words: Words
    begin: np.ndarray  # first word of each compared paragraph or line
    end: np.ndarray
    doc: np.ndarray
    kind: np.ndarray  # 0: paragraph, 1: line

    @property
    def pos(self) -> np.ndarray:
        """Place in the document: twice the words before, plus the kind."""
        return 2 * (self.begin - self.words.offsets[self.doc]) + self.kind


def compared(raw: np.ndarray, offsets: np.ndarray, s: Settings) -> Units:
    w, firsts = divisions(raw, offsets, s)
    long = [np.flatnonzero(np.diff(first) >= s.min_words) for first in firsts]
    begin = np.concatenate([first[x] for first, x in zip(firsts, long, strict=True)])
    end = np.concatenate([first[x + 1] for first, x in zip(firsts, long, strict=True)])
    return Units(w, begin, end, np.searchsorted(w.offsets, begin, "right") - 1, np.repeat(np.arange(len(long)), list(map(len, long))))


def names(sh: np.ndarray, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers that name a set; other ones for a line than for a paragraph."""
    d1, d2 = digests(sh, at)
    return np.where(kind > 0, ~d1, d1), d2


def described(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, th (text hash), pos, d1 and d2 (names of the set), n and keys of every paragraph and line that is compared.

    The first of the copies that stand in one slice of the texts has their number ``n`` and the keys of the set's bands, the others 0 and none.
    """

    def work(part: pa.RecordBatch) -> dict:
        u = compared(*text_bytes(part.column(2)), s)
        sh, at = sets_of(u.words, u.begin, u.end)
        d1, d2 = names(sh, at, u.kind)
        keys = band_keys(sh, at, s.bands, s.rows)
        keys = np.where(u.kind[:, None] > 0, ~keys, keys)
        _, first, copies = np.unique(d1, return_index=True, return_counts=True)
        n = np.zeros(len(d1), np.int32)
        n[first] = copies
        listed = list_column(keys[n > 0].ravel(), np.concatenate([[0], np.cumsum(n > 0)]) * s.bands)
        return {"doc_id": part.column(0).take(pa.array(u.doc)), "th": part.column(1).take(pa.array(u.doc)), "pos": u.pos, "d1": d1, "d2": d2, "n": n, "keys": listed}

    return mapped(docs.select("doc_id", "th", "text"), work, "doc_id long, th long, pos long, d1 long, d2 long, n int, keys array<long>")


#: Band keys that one group of :func:`met` has, as a mean; and those that a task gathers before it hands them on.
GROUP_KEYS = 1 << 20


def met(units: DataFrame, s: Settings) -> DataFrame:
    """key, d1, rank (copies) of the sets in every band where different sets meet; and, without key, d1 of every other set that has copies.

    One of the two numbers that name a set is enough here: sets that share it both become members of the band.
    Keys travel in lists by a hash of the key: a row for each would cost more than all that is done with it.
    """
    groups = max(1, ceil(units.count() * s.bands / GROUP_KEYS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def dealt() -> pa.RecordBatch:
            key, d1, n = (np.concatenate(x) for x in zip(*held, strict=True))
            home = (mix(key.view(_U) + _U(1)) % _U(groups)).astype(np.int32)
            order = np.argsort(home, kind="stable")
            own, at = np.unique(home[order], return_index=True)
            at = np.append(at, len(order))
            return pa.RecordBatch.from_arrays([pa.array(own), *[list_column(x[order], at) for x in (key, d1, n)]], names=["home", "key", "d1", "n"])

        for batch in batches:
            n = batch.column("n").to_numpy()
            full = n > 0
            key = batch.column("keys").flatten().to_numpy()
            held.append((key, np.repeat(batch.column("d1").to_numpy()[full], s.bands), np.repeat(n[full], s.bands)))
            size += len(key)
            if size >= GROUP_KEYS:
                yield dealt()
                held, size = [], 0
        if size:
            yield dealt()

    def meet(table: pa.Table) -> pa.Table:
        key, d1, n = (table.column(c).combine_chunks().flatten().to_numpy() for c in ("key", "d1", "n"))
        return pa.table(dict(zip(("key", "d1", "rank"), meetings(key, d1, n), strict=True)))

    lists = units.select("d1", "n", "keys").filter("n > 0").mapInArrow(deal, "home int, key array<long>, d1 array<long>, n array<int>")
    return lists.groupBy("home").applyInArrow(meet, "key long, d1 long, rank long").distinct()


def meetings(key: np.ndarray, d1: np.ndarray, n: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Rows of :func:`met` for all members of some bands; a set without key has rank 0."""
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    several = np.zeros(len(key), bool)
    several[order[1:][same]] = several[order[:-1][same]] = True
    alone = d1[~several & (n > 1)]
    key, d1, n = key[several], d1[several], n[several]
    order = np.lexsort((d1, key))
    key, d1, n = key[order], d1[order], n[order]
    band = np.ones(len(key), bool)
    band[1:] = key[1:] != key[:-1]
    member = band.copy()
    member[1:] |= d1[1:] != d1[:-1]
    at = np.flatnonzero(member)
    rank = np.add.reduceat(n.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    key, d1, band = key[at], d1[at], np.cumsum(band[at])
    mixed = np.bincount(band)[band] > 1
    alone = np.unique(np.concatenate([alone, d1[~mixed]]))
    none = pa.nulls(len(alone), pa.int64())
    return pa.concat_arrays([pa.array(key[mixed]), none]), np.concatenate([d1[mixed], alone]), np.concatenate([rank[mixed], np.zeros(len(alone), np.int64)])


def chosen_sets(docs: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """id and shingles of the paragraphs and lines ``wanted`` (id, doc_id, th, pos)."""
    places = wanted.groupBy("doc_id", "th").agg(F.collect_list(F.struct("pos", "id")).alias("places"))
    texts = docs.select("doc_id", "th", "text").join(places, ["doc_id", "th"]).select("text", F.col("places.pos").alias("pos"), F.col("places.id").alias("id"))

    def work(part: pa.RecordBatch) -> dict:
        w, firsts = divisions(*text_bytes(part.column(0)), s)
        pos = part.column(1)
        doc = np.repeat(np.arange(part.num_rows), pos.value_lengths().to_numpy())
        at = pos.flatten().to_numpy()
        begin = w.offsets[doc] + (at >> 1)
        end = np.zeros(len(begin), np.int64)
        for kind, first in enumerate(firsts):
            own = (at & 1) == kind
            end[own] = first[np.searchsorted(first, begin[own], "right")]
        sh, at = sets_of(w, begin, end)
        return {"id": part.column(2).flatten(), "shingles": list_column(sh, at)}

    # Rows may repeat, and with them what is wanted of their text.
    return mapped(texts, work, "id long, shingles array<long>").dropDuplicates(["id"])


def confirm_with(sets: DataFrame, percent: int):
    side = lambda c: sets.select(F.col("id").alias(c), F.col("shingles").alias(f"shingles_{c}"))

    def confirm(pairs: DataFrame) -> DataFrame:
        full = pairs.join(side("a"), "a").join(side("b"), "b")
        common = F.size(F.array_intersect("shingles_a", "shingles_b"))
        return full.filter(100 * common >= percent * (F.size("shingles_a") + F.size("shingles_b") - common)).select("a", "b").distinct()

    return confirm


def repeated_paragraphs(rows: DataFrame, s: Settings) -> DataFrame:
    """doc_id, th, pos and stays (true for the first of a component) of every paragraph and line that is repeated in another document."""
    spark, made = rows.sparkSession, []

    def keep(df: DataFrame, name: str) -> DataFrame:
        # Shuffle files of the step before go now: those of all steps would be several times the texts.
        df, path = kept(df, name)
        made.append(path)
        release(spark)
        return df

    place = F.struct("doc_id", "th", "pos")
    every = keep(described(rows, s), "paragraphs")
    members = keep(met(every, s), "members")
    # Copies of a set share all its bands, so whatever is in no shared band is repeated nowhere.
    shared = members.select("d1").distinct().hint("shuffle_hash")
    units = keep(every.select("doc_id", "th", "pos", "d1", "d2").join(shared, "d1", "left_semi"), "paragraphs")
    drop(spark, made[0])
    # Only bands in which different sets meet say anything that the sets' names do not.
    postings = members.filter("key is not null")
    stats = [F.min(place).alias("first"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")]
    # A class has one number from here on, which aggregates and joins take faster than its two names.
    classes = keep(units.groupBy("d1", "d2").agg(*stats).withColumn("id", F.monotonically_increasing_id()), "classes")
    mixed = classes.join(postings.select("d1").distinct(), "d1", "left_semi")
    sets = keep(chosen_sets(rows, mixed.select("id", F.col("first.doc_id").alias("doc_id"), F.col("first.th").alias("th"), F.col("first.pos").alias("pos")), s), "sets")
    near_enough = unshared(sets).filter(100 * (F.col("n") - F.col("u")) >= s.percent * F.col("n")).join(classes.select("id", "d1"), "id")
    # The class with the most copies leads: variants of a passage come from it.
    bounded = keep(postings.join(near_enough, "d1").select("id", "key", "rank", "n", "u"), "postings")
    linked = link(bounded, confirm_with(sets, s.percent), within_reach(s.percent), closer=(masked(sets), within_masks(s.percent)))
    both = keep(classes.join(linked, "id", "left").filter("component is not null or low < high").withColumn("group", F.coalesce("component", "id")), "classes")
    whole = both.groupBy("group").agg(F.min("first").alias("stays_at"), F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("group", "stays_at")
    named = keep(both.select("d1", "d2", "group").join(whole, "group").select("d1", "d2", "stays_at"), "named")
    out, _ = kept(units.join(named, ["d1", "d2"]).select("doc_id", "th", "pos", (place == F.col("stays_at")).alias("stays")), "repeated")
    drop(spark, *made)
    return out


def dedup(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A row for each document with a repeated passage: doc_id, n_paragraphs, n_repeated and n_removed (paragraphs), removed_words, kept_text and kept_sha256.

    A paragraph inside repeated lines is a repeated one, and a removed one if all its words go.
    """
    s = settings
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text").filter(F.col("doc_id").isNotNull() & (F.length("text") > 0))
    hits = repeated_paragraphs(rows, s).groupBy("doc_id", "th").agg(F.collect_set(F.struct("pos", "stays")).alias("hits"))
    texts = rows.join(hits, ["doc_id", "th"]).select("doc_id", "text", F.col("hits.pos").alias("pos"), F.col("hits.stays").alias("stays"))

    def work(part: pa.RecordBatch) -> dict:
        raw, off = text_bytes(part.column(1))
        w, firsts = divisions(raw, off, s)
        pos = part.column(2)
        at, home = pos.flatten().to_numpy(), part.column(3).flatten().to_numpy(zero_copy_only=False)
        word = w.offsets[np.repeat(np.arange(part.num_rows), pos.value_lengths().to_numpy())] + (at >> 1)
        inside, gone, lost = np.zeros(len(w.starts), bool), np.zeros(len(w.starts), bool), np.zeros(len(raw) + 1, np.int64)
        for kind, first in enumerate(firsts):
            size = np.diff(first)
            own = (at & 1) == kind
            doc = np.searchsorted(w.offsets, first[:-1], "right") - 1
            within, goes = removable(np.searchsorted(first, word[own]), home[own], size, s, doc)
            inside |= np.repeat(within, size)
            gone |= np.repeat(goes, size)
            # Bytes from the first word of what goes to the last one's end.
            lost[w.starts[first[:-1][goes]]] += 1
            lost[w.ends[first[1:][goes] - 1]] -= 1
        stays = np.cumsum(lost[:-1]) == 0
        before = lambda marks, places: np.concatenate([[0], np.cumsum(marks)])[places]
        parts = np.searchsorted(firsts[0], w.offsets)
        all_of = lambda marks: np.logical_and.reduceat(marks, firsts[0][:-1]) if len(marks) else marks
        chosen = np.flatnonzero(np.diff(before(inside, w.offsets)))
        kept_raw, ends = raw[stays], before(stays, off)
        texts = [kept_raw[ends[d] : ends[d + 1]].tobytes() for d in chosen]
        return {
            "doc_id": part.column(0).take(pa.array(chosen)),
            "n_paragraphs": np.diff(parts)[chosen],
            "n_repeated": np.diff(before(all_of(inside), parts))[chosen],
            "n_removed": np.diff(before(all_of(gone), parts))[chosen],
            "removed_words": np.diff(before(gone, w.offsets))[chosen],
            "kept_text": [x.decode() for x in texts],
            "kept_sha256": [hashlib.sha256(x).hexdigest() for x in texts],
        }

    return mapped(texts, work, "doc_id long, n_paragraphs long, n_repeated long, n_removed long, removed_words long, kept_text string, kept_sha256 string")


def removable(which: np.ndarray, home: np.ndarray, size: np.ndarray, s: Settings, doc: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Units in runs of repeated ones, and those of them that go, for the repeated units numbered ``which`` (``home``: it stays).

    ``doc``: the document of each unit, if they are those of several.
    """
    hit, stays = np.zeros(len(size), bool), np.zeros(len(size), bool)
    hit[which] = True
    stays[which] = home
    inside = runs(hit, size, s, doc)
    gone = inside & hit & ~stays
    # A short unit between two goes if both of them go.
    at = np.flatnonzero(hit)
    short = np.flatnonzero(inside & ~hit)
    after = np.searchsorted(at, short)
    gone[short] = gone[at[after - 1]] & gone[at[np.minimum(after, len(at) - 1)]]
    return inside, gone


def runs(hit: np.ndarray, size: np.ndarray, s: Settings, doc: np.ndarray | None = None) -> np.ndarray:
    """Paragraphs in runs of repeated ones with ``min_run`` words; short ones between two repeated ones of a document belong to the run."""
    at = np.flatnonzero(hit)
    if not len(at):
        return np.zeros(len(hit), bool)
    long = np.concatenate([[0], np.cumsum(size >= s.min_words)])
    ends = long[at[1:]] > long[at[:-1] + 1]
    if doc is not None:
        ends |= doc[at[1:]] != doc[at[:-1]]
    a, b = at[np.append(True, ends)], at[np.append(ends, True)] + 1
    total = np.concatenate([[0], np.cumsum(size)])
    full = total[b] - total[a] >= s.min_run
    mark = np.zeros(len(hit) + 1, np.int64)
    mark[a[full]] += 1
    mark[b[full]] -= 1
    return np.cumsum(mark[:-1]) > 0
