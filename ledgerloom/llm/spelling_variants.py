"""Spelling variants: words one edit apart, found in k-d trees over letter counts.

A word is a point: how often it has each letter (``a`` to ``z``, and six counts that
the other letters share). Replacing a letter takes one count down and another up,
inserting one takes one count up, so words one edit apart lie at most two apart (L1).
Words of each length have a tree of their own. A shared tree, shaped by a bounded
sample of the vocabulary, deals *all* words to leaves; each word then visits the
leaves of its own length and of the next one whose boxes lie within one edit. Within
a leaf a second tree narrows the search, and what remains is compared by counts and
then letter by letter. The sample decides how even the leaves are, never what is found. A
leaf of more than ``part`` words is dealt to several tasks, each of which sees all
visitors, so nothing is left out.

Defined cases: null and empty texts have no words; a null doc_id is written as the
empty string; rows that share a doc_id and repeated rows all count; runs may be of any
length; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import PASS_BYTES, drop, kept, mapped, passes, release, text_bytes
from ledgerloom.llm.words import prefix_sums, spans_hash, word_spans

#: Counts of a point; they end at 127, which moves no two points further apart.
DIMS = 32
#: Bytes of letters that one comparison works on.
BLOCK = 1 << 24


class Settings(NamedTuple):
    min_length: int = 5  # code points of a word
    min_count: int = 3  # occurrences of a word
    ratio: int = 2  # times as frequent as the word its form is
    damage: int = 97  # one letter is deleted where this divides the checksum; 0: nowhere
    sample: int = 1 << 18  # words that shape the shared tree, about
    leaf: int = 1024  # sampled words of a leaf
    part: int = 1 << 16  # words of a leaf that one task searches


def letters_of(raw: np.ndarray) -> np.ndarray:
    """Which UTF-8 bytes belong to A-Z, a-z or U+00C0 to U+00FF; the last are the characters that begin with 0xC3."""
    t = np.zeros(256, bool)
    t[65:91] = t[97:123] = t[0xC3] = True
    out = t[raw]
    out[1:] |= raw[:-1] == 0xC3
    return out


def checksums(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, continued from ``begun``: one byte of all runs at a time, long runs by themselves."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    crc, size = ~begun, ends - starts
    order = np.argsort(-size, kind="stable")
    size_down = -size[order]
    for k in range(min(int(size.max(initial=0)), 64)):
        at = order[: np.searchsorted(size_down, -k)]
        crc[at] = step[(crc[at] ^ raw[starts[at] + k]) & 255] ^ (crc[at] >> 8)
    for w in order[: np.searchsorted(size_down, -64)]:
        crc[w] = ~np.uint32(zlib.crc32(raw[starts[w] + 64 : ends[w]].tobytes(), int(~crc[w])))
    return ~crc


def counted(docs: DataFrame, s: Settings) -> DataFrame:
    """word and n: the words of some documents at a time, lower-cased, with one letter deleted where the checksum of document and word says so."""

    def count(ids: list[str | None], raw: np.ndarray, off: np.ndarray) -> pa.RecordBatch:
        raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
        starts, ends, at = word_spans(raw, off, gaps=~letters_of(raw), by_byte=True)
        long = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        size = long[ends] - long[starts]
        whole, damaged = np.ones(len(starts), bool), []
        if s.damage and len(starts):
            begun = np.fromiter((zlib.crc32(f"{'' if d is None else d}:".encode()) for d in ids), np.uint32, len(ids))
            h = checksums(raw, starts, ends, np.repeat(begun, np.diff(at)))
            whole = h % s.damage != 0
            for w in np.flatnonzero(~whole & (size > s.min_length)):
                word = raw[starts[w] : ends[w]].tobytes().decode()
                k = int(h[w]) % len(word)
                damaged.append(word[:k] + word[k + 1 :])
        use = np.flatnonzero(whole & (size >= s.min_length))
        _, first, n = np.unique(spans_hash(prefix_sums(raw), starts[use], ends[use]), return_index=True, return_counts=True)
        use = use[first]
        length = ends[use] - starts[use]
        to = np.concatenate([[0], np.cumsum(length)])
        data = raw[np.arange(to[-1]) + np.repeat(starts[use] - to[:-1], length)]
        text = pa.StringArray.from_buffers(len(use), pa.py_buffer(to.astype(np.int32)), pa.py_buffer(data))
        return pa.RecordBatch.from_arrays([pa.concat_arrays([text, pa.array(damaged, pa.string())]), pa.array(np.append(n, np.ones(len(damaged), np.int64)))], ["word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch, limit=8 * PASS_BYTES):
                yield count(part.column(0).to_pylist(), *text_bytes(part.column(1)))

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(work, "word string, n long")


def vocabulary(docs: DataFrame, s: Settings) -> DataFrame:
    """word and n, its occurrences; documents and then tasks add up before the shuffle."""
    return counted(docs, s).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= s.min_count)


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """One byte for each letter of all words, and the offset of each word."""
    raw = [w.encode("latin-1") for w in words]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))]).astype(np.int64)


def points(letters: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(words, DIMS): letter counts."""
    fold = np.full(256, 0, np.int64)
    fold[97:123] = np.arange(26)
    fold[192:] = 26 + np.arange(64) % 6
    n = len(offsets) - 1
    word = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(word * DIMS + fold[letters], minlength=n * DIMS).reshape(n, DIMS)
    return np.minimum(counts, 127).astype(np.int16)


class Tree(NamedTuple):
    """A k-d tree: for each node the count it splits at, the value, its children (a leaf: -1 and the leaf's number) and the sides of its box at that count."""

    dim: np.ndarray
    value: np.ndarray  # left: counts up to this
    left: np.ndarray
    right: np.ndarray
    low: np.ndarray
    high: np.ndarray
    members: list[np.ndarray]  # rows of each leaf


def grow(p: np.ndarray, leaf: int) -> Tree:
    """A tree over points with leaves of ``leaf`` points, or of more that are all equal."""
    dim, value, left, right, lows, highs, members = [], [], [], [], [], [], []
    todo = [(np.arange(len(p)), np.zeros(DIMS, np.int16), np.full(DIMS, 127, np.int16), -1, 0)]
    while todo:
        rows, low, high, parent, side = todo.pop()
        at = len(dim)
        if parent >= 0:
            (left, right)[side][parent] = at
        d, v = best_split(p[rows]) if len(rows) > leaf else (-1, 0)
        for x, y in ((dim, d), (value, v), (left, -1), (right, len(members)), (lows, low[d]), (highs, high[d])):
            x.append(y)
        if d < 0:
            members.append(rows)
            continue
        below = p[rows, d] <= v
        high_l, low_r = high.copy(), low.copy()
        high_l[d], low_r[d] = v, v + 1
        todo += [(rows[below], low, high_l, at, 0), (rows[~below], low_r, high, at, 1)]
    return Tree(*map(np.array, (dim, value, left, right, lows, highs)), members)


def best_split(own: np.ndarray) -> tuple[int, int]:
    """The count and value that divide the points most evenly; -1 if all are equal."""
    best, found = 0, (-1, 0)
    for d in np.flatnonzero(own.max(0) > own.min(0)):
        below = np.cumsum(np.bincount(own[:, d]))[:-1]
        v = int(np.argmin(np.abs(2 * below - len(own))))
        small = min(below[v], len(own) - below[v])
        if small > best:
            best, found = small, (int(d), v)
    return found


def reached(t: Tree, q: np.ndarray, down: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, queries that reach its box by taking at most ``down`` off their counts and adding one at most); other boxes are not entered.

    A split moves one side of the box, so only what that count lies outside is added anew.
    """
    zero = np.zeros(len(q), np.int16)
    todo = [(0, np.arange(len(q)), zero, zero)]
    while todo:
        node, rows, off, on = todo.pop()
        if t.dim[node] < 0:
            yield int(t.right[node]), rows
            continue
        at, v = q[rows, t.dim[node]], t.value[node]
        less = off + np.maximum(at - v, 0) - np.maximum(at - t.high[node], 0)
        more = on + np.maximum(v + 1 - at, 0) - np.maximum(t.low[node] - at, 0)
        for child, ok, off_, on_ in ((t.left[node], less <= down, less, on), (t.right[node], more <= 1, off, more)):
            if ok.any():
                todo.append((child, rows[ok], off_[ok], on_[ok]))


def leaf_of(t: Tree, q: np.ndarray) -> np.ndarray:
    """The leaf in which each point lies."""
    node = np.zeros(len(q), np.int64)
    while (inner := t.dim[node] >= 0).any():
        at = node[inner]
        node[inner] = np.where(q[inner, t.dim[at]] <= t.value[at], t.left[at], t.right[at])
    return t.right[node]


def forest(words: list[str], leaf: int) -> dict[int, Tree]:
    """A tree without members for each length among the sampled words."""
    letters, offsets = codes(words)
    p, length = points(letters, offsets), np.diff(offsets)
    return {int(n): grow(p[length == n], leaf)._replace(members=[]) for n in np.unique(length)}


def place(length: int, leaf: np.ndarray | int) -> np.ndarray | int:
    """One number for a leaf of the tree of a length; a length that the sample lacks has the leaf 0 only."""
    return length << 24 | leaf


def dealt(vocab: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """word, n, length and places: first the leaf it lies in, then all leaves it visits."""

    def work(part: pa.RecordBatch) -> dict:
        words = part.column(0).to_pylist()
        letters, offsets = codes(words)
        p, length = points(letters, offsets), np.diff(offsets)
        home, who, where = np.zeros(len(words), np.int64), [], []
        for n in np.unique(length):
            own = np.flatnonzero(length == n)
            q = p[own]
            home[own] = place(int(n), leaf_of(trees[n], q) if n in trees else 0)
            for longer in (0, 1):
                t = trees.get(int(n) + longer)
                for leaf, rows in reached(t, q, 1 - longer) if t else [(0, np.arange(len(own)))]:
                    who.append(own[rows])
                    where.append(np.full(len(rows), place(int(n) + longer, leaf), np.int64))
        word = np.concatenate([np.arange(len(words)), *who])
        to = np.concatenate([home, *where])
        order = np.argsort(word, kind="stable")
        at = np.searchsorted(word[order], np.arange(len(words) + 1))
        return {"word": part.column(0), "n": part.column(1), "length": length, "places": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(to[order]))}

    return mapped(vocab.select("word", "n"), work, "word string, n long, length int, places array<long>", text="word")


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether rows of letters are one replaced letter apart, or one inserted into ``short``."""
    n = short.shape[1]
    if long.shape[1] == n:
        return (short != long).sum(1) == 1
    lead = np.logical_and.accumulate(short == long[:, :n], axis=1).sum(1)
    trail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return lead + trail >= n


class Members:
    """Words of one leaf, of one length, ready to be searched."""

    def __init__(self, words: list[str], n: list[int]):
        self.words, self.n = np.array(words, object), np.array(n, np.int64)
        letters, offsets = codes(words)
        self.letters, self.points = letters.reshape(len(words), -1), points(letters, offsets)
        self.tree = grow(self.points, 256)
        self.flat = self.points.astype(np.float32)
        self.norm = (self.flat**2).sum(1)

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(visitor, member) for all that are one edit apart; the visitors have the members' length or one letter less."""
        letters, offsets = codes(words)
        q, length = points(letters, offsets), np.diff(offsets)
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for n in np.unique(length):
            own = np.flatnonzero(length == n)
            rows = letters[np.repeat(length == n, length)].reshape(len(own), n)
            longer = self.letters.shape[1] - n
            for leaf, mine in reached(self.tree, q[own], 1 - longer):
                theirs = self.tree.members[leaf]
                step = max(1, BLOCK // (len(theirs) * 8))
                for k in range(0, len(mine), step):
                    some = mine[k : k + step]
                    flat = q[own[some]].astype(np.float32)
                    # Counts one apart in at most two places: the squared distance is at most two as well, and exact here.
                    square = (flat**2).sum(1)[:, None] + self.norm[theirs] - 2 * (flat @ self.flat[theirs].T)
                    a, b = np.nonzero(square <= 2 - longer)
                    out += self.compared(rows, own, some[a], theirs[b])
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def compared(self, rows: np.ndarray, own: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, BLOCK // (4 * self.letters.shape[1]))
        for k in range(0, len(a), step):
            x, y = a[k : k + step], b[k : k + step]
            ok = one_edit(rows[x], self.letters[y])
            yield own[x[ok]], y[ok]


def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, near_n) from rows (place, part, visits, word, n) ordered by the first three: a leaf's words, then its visitors."""
    current, words, n, members = None, [], [], None
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            at, which, visits = (part.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (which[1:] != which[:-1]) | (visits[1:] != visits[:-1])]))
            for a, b in zip(new, np.append(new[1:], len(at)), strict=True):
                if (at[a], which[a]) != current:
                    current, words, n, members = (at[a], which[a]), [], [], None
                own, count = part.column(3).slice(a, b - a).to_pylist(), part.column(4).slice(a, b - a).to_pylist()
                if not visits[a]:
                    words += own
                    n += count
                elif words:
                    members = members or Members(words, n)
                    x, y = members.near(own)
                    own, count = np.array(own, object), np.array(count, np.int64)
                    # A pair of one length is met from both sides, one of two lengths from the shorter word only.
                    back = np.fromiter(map(len, own[x]), np.int64, len(x)) < members.letters.shape[1]
                    columns = (np.concatenate([own[x], members.words[y[back]]]), np.concatenate([members.words[y], own[x[back]]]), np.concatenate([members.n[y], count[x[back]]]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], ["word", "near", "near_n"])


def neighbours(vocab: DataFrame, s: Settings) -> DataFrame:
    """word, near and near_n for every ordered pair of words one edit apart. ``vocab`` (word, n) is written down already."""
    total = vocab.count()
    share = int(min(1.0, s.sample / max(total, 1)) * (1 << 30))
    sample = [r.word for r in vocab.filter(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < share).select("word").limit(2 * s.sample).collect()]
    placed = dealt(vocab, forest(sample, s.leaf)).select("word", "n", F.posexplode("places").alias("k", "place"))
    homes = placed.filter("k = 0").groupBy("place").agg(F.count("*").alias("size"))
    full = homes.filter(F.col("size") > s.part).select("place", F.ceil(F.col("size") / s.part).cast("int").alias("parts"))
    visits: Column = F.col("k") > 0
    parts = F.coalesce("parts", F.lit(1))
    shown = F.when(visits, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("word"), parts).cast("int")))
    rows = placed.join(full, "place", "left").select("place", F.explode(shown).alias("part"), visits.alias("visits"), "word", "n")
    rows = rows.repartition("place", "part").sortWithinPartitions("place", "part", "visits")
    return rows.mapInArrow(searched, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word and root for every word of ``forms`` (word, form) with a form: forms are followed to the last, twice as far each time."""
    state, path = kept(forms.filter("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not state.filter("moved").isEmpty():
        further = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = state.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        new, new_path = kept(step, "roots")
        drop(state.sparkSession, path)
        state, path = new, new_path
    return state.select("word", "root")


def variants(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """word, form (its near word of largest n, if that is at least ``ratio`` times its own), root, n, n_near and form_n.

    Each step doubles n at least, so chains of forms are short and have no circles.
    """
    s, spark = settings, docs.sparkSession
    vocab, path = kept(vocabulary(docs, s), "words")
    release(spark)
    # The largest n, then the first in code-point order.
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")
    near = neighbours(vocab, s).groupBy("word").agg(F.count("*").alias("n_near"), best)
    large = -F.col("best.minus") >= s.ratio * F.col("n")
    found, path_f = kept(
        vocab.join(near, "word", "left").select(
            "word", F.when(large, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(large, -F.col("best.minus")).alias("form_n"),
        ),
        "forms",
    )
    out, _ = kept(found.join(roots(found), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "variants")
    drop(spark, path, path_f)
    return out
