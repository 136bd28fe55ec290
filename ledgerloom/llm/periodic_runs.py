"""Periodic runs of words, found by minimizers at many scales.

A run is a stretch of words with smallest period q that holds two periods at least and
that no neighbour extends. Periods below ``2 * FIRST`` are found by comparing each word
with the one that many places on. For longer ones a scale W looks for periods from 2W to
4W: of the W-word pieces that begin in a window of W places the one with the least hash
is chosen, so that a run, whose windows repeat after one period, has a chosen piece
twice at that distance. Equal pieces at such distances are seeds, extended both ways as
long as words one period apart agree.

Pieces that are themselves periodic (at most W / 2) lie in a run that a smaller scale
has found and are never chosen, or such a run would give seeds without end. A longer run
whose period holds such pieces only has two runs of the shorter period that meet; their
meeting places are seeds as well, one for each period that fits. So no run is lost, and
seeds are few.

Pieces are named by 64-bit hashes; what a seed gives is compared word by word before it
counts. A text is one row: memory grows with the longest text. Defined cases: null and
empty texts have no words and no run; rows may repeat or share a doc_id, each is a text
of its own; a null doc_id is kept; an empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import mapped, text_bytes
from ledgerloom.llm.words import _BASE, _ROOT, mix, powers, words

_U = np.uint64
#: The first scale. Shorter periods than twice this are compared directly.
FIRST = 8
_MOST = np.iinfo(np.uint64).max

#: Gives for a document's id and number of words the words' places in the order in which they are read, or None for their own order.
Reorder = Callable[[int | None, int], np.ndarray | None]


class Runs(NamedTuple):
    doc: np.ndarray  # number of the text
    start: np.ndarray  # first word, from the text's first
    length: np.ndarray
    period: np.ndarray

    @staticmethod
    def of(*columns: np.ndarray) -> Runs:
        """Runs without repeats, by text, start and length; of several periods of one stretch the smallest stays."""
        doc, start, length, period = (np.asarray(c, np.int64) for c in columns)
        order = np.lexsort((period, length, start, doc))
        r = Runs(doc[order], start[order], length[order], period[order])
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(r.doc) != 0) | (np.diff(r.start) != 0) | (np.diff(r.length) != 0)
        return Runs(*(c[new] for c in r))

    def join(self, other: Runs) -> Runs:
        return Runs.of(*(np.concatenate(x) for x in zip(self, other, strict=True)))


def stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true values."""
    edge = np.flatnonzero(np.diff(same.astype(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


class Texts:
    """Word ids of texts one after another, with prefix sums that name any piece."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray):
        self.ids, self.offsets, n = ids, offsets, len(ids)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        self.end = offsets[1:][self.doc]
        with np.errstate(over="ignore"):
            self.powers, self.roots = powers(_BASE, n + 1), powers(_ROOT, n + 1)
            self.sums = np.zeros(n + 1, _U)
            np.cumsum(mix(ids) * self.powers[:n], out=self.sums[1:])

    def piece(self, at: np.ndarray, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[at + size] - self.sums[at]) * self.roots[at])

    def agree(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words from i (before j) and j on have one name."""
        with np.errstate(over="ignore"):
            return (self.sums[i + size] - self.sums[i]) * self.powers[j - i] == self.sums[j + size] - self.sums[j]

    def reach(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words before and from i on that agree with those at j, by halving."""
        out = []
        for back in (True, False):
            low, high = np.zeros(len(i), np.int64), (i - self.offsets[self.doc[i]]) if back else self.end[j] - j
            while (todo := low < high).any():
                size = np.where(todo, (low + high + 1) // 2, low)
                ok = self.agree(i - size * back, j - size * back, size)
                low, high = np.where(ok, size, low), np.where(ok, high, size - 1)
            out.append(low)
        return out[0], out[1]

    def runs(self, begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> Runs:
        """Stretches of words that agree with those a period on, as runs; too short ones are left out."""
        length = end - begin + period
        ok = (length >= 2 * period) & (length >= FIRST)
        begin = begin[ok]
        return Runs.of(self.doc[begin], begin - self.offsets[self.doc[begin]], length[ok], period[ok])


def short_periods(t: Texts) -> Runs:
    """Runs with periods below 2 * FIRST."""
    found = Runs.of([], [], [], [])
    for q in range(1, min(2 * FIRST, len(t.ids))):
        same = (t.ids[q:] == t.ids[:-q]) & (t.end[:-q] > np.arange(q, len(t.ids)))
        begin, end = stretches(same)
        long = end - begin >= max(q, FIRST - q)
        found = found.join(t.runs(begin[long], end[long], np.full(long.sum(), q)))
    return found


def least_of(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each window of ``size`` (a power of two) values, for windows that begin inside and may end outside."""
    out, have = values.copy(), 1
    while have < size:
        np.minimum(out[:-have], out[have:], out=out[:-have])
        have *= 2
    return out


def chosen(t: Texts, scale: int, inner: np.ndarray) -> np.ndarray:
    """Places of pieces that are the least of any window; ``inner`` marks periodic pieces."""
    n = len(t.ids)
    value = np.full(n + scale, _MOST, _U)
    at = np.flatnonzero((np.arange(n) + scale <= t.end) & ~inner)
    value[at] = t.piece(at, scale)
    least = least_of(value, scale)
    # A piece is chosen if the greatest among the minima of the windows that hold it is its own value.
    greatest = ~least_of(~least[::-1], scale)[::-1]
    return at[greatest[at] == value[at]]


def pairs(t: Texts, scale: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of equal pieces 2 to 4 scales apart. A piece that is not periodic recurs after half a scale at the earliest, so a few steps do."""
    name = t.piece(at, scale)
    order = np.lexsort((at, name))
    at, name = at[order], name[order]
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for step in range(1, len(at)):
        gap = at[step:] - at[:-step]
        near = (name[step:] == name[:-step]) & (gap < 4 * scale)
        if not near.any():
            break
        hit = np.flatnonzero(near & (gap >= 2 * scale))
        out.append((at[hit], gap[hit]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def meetings(t: Texts, scale: int, found: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Seeds where two runs of one period up to scale / 2 meet, for each longer period that brings one onto the other."""
    long = np.flatnonzero((found.period <= scale // 2) & (found.length >= 2 * scale))
    long = long[np.lexsort((found.start[long], found.period[long], found.doc[long]))]
    a, b = long[:-1], long[1:]
    meet = (found.doc[a] == found.doc[b]) & (found.period[a] == found.period[b]) & (found.start[b] <= found.start[a] + found.length[a])
    places, gaps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x, y in zip(a[meet], b[meet], strict=True):
        p, first = found.period[x], t.offsets[found.doc[x]]
        one, two = first + found.start[x], first + found.start[y]
        phase = np.flatnonzero(t.piece(one + np.arange(p), p) == t.piece(np.array([two]), p))
        if len(phase):
            least = (two - one - phase[0]) % p
            q = np.arange(least + (2 * scale - least + p - 1) // p * p, min(4 * scale, two - one + 1), p)
            places.append(two - q)
            gaps.append(q)
    return np.concatenate(places), np.concatenate(gaps)


def verified(t: Texts, begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> Runs:
    """The stretches, compared word by word; where names misled, the text's whole comparison at that distance."""
    out = t.runs(begin, end, period)
    for d, start, length, q in zip(*out, strict=True):
        i, j = t.offsets[d] + start, t.offsets[d] + start + length
        if not np.array_equal(t.ids[i : j - q], t.ids[i + q : j]):
            x, y = t.offsets[d], t.offsets[d + 1]
            a, b = stretches(t.ids[x : y - q] == t.ids[x + q : y])
            out = out.join(t.runs(a + x, b + x, np.full(len(a), q)))
            wrong = (out.doc == d) & (out.start == start) & (out.length == length) & (out.period == q)
            out = Runs(*(c[~wrong] for c in out))
    return out


def periodic_runs(ids: np.ndarray, offsets: np.ndarray, min_words: int) -> Runs:
    """All runs of ``min_words`` words or more."""
    t = Texts(ids, offsets)
    found, number, scale = short_periods(t), np.arange(len(offsets) - 1), FIRST
    while True:
        # Only texts that can hold two periods of this scale go on.
        far = np.diff(t.offsets) >= 4 * scale
        if not far.any():
            break
        if not far.all():
            t = Texts(t.ids[far[t.doc]], np.concatenate([[0], np.cumsum(np.diff(t.offsets)[far])]))
            number = number[far]
        here = np.isin(found.doc, number)
        own = Runs(np.searchsorted(number, found.doc[here]), *(c[here] for c in found[1:]))
        inside = (own.period <= scale // 2) & (own.length >= scale)
        mark = np.zeros(len(t.ids) + 1, np.int64)
        first = t.offsets[own.doc[inside]] + own.start[inside]
        np.add.at(mark, first, 1)
        np.add.at(mark, first + own.length[inside] - scale + 1, -1)
        seeds = [np.concatenate(x) for x in zip(pairs(t, scale, chosen(t, scale, np.cumsum(mark)[:-1] > 0)), meetings(t, scale, own), strict=True)]
        same = t.doc[seeds[0]] == t.doc[seeds[0] + seeds[1]]
        at, gap = seeds[0][same], seeds[1][same]
        if len(at):
            back, on = t.reach(at, at + gap)
            seen = np.unique(np.stack([at - back, at + on, gap]), axis=1)
            new = verified(t, *seen)
            found = found.join(Runs(number[new.doc], *new[1:]))
        scale *= 2
    long = found.length >= min_words
    return Runs(*(c[long] for c in found))


def find(docs: DataFrame, min_words: int = 12, reorder: Reorder | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length and period by start, then period) and collapsed (the words without repeats of a period, joined by blanks) of every row.

    ``reorder`` may put a text's words in another order before they are looked at.
    """

    def work(part: pa.RecordBatch) -> dict:
        ids = part.column(0).to_pylist()
        raw, offsets = text_bytes(part.column(1))
        w = words(raw, offsets)
        places = np.arange(len(w.starts))
        for d, doc_id in enumerate(ids):
            a, b = w.offsets[d], w.offsets[d + 1]
            order = reorder(doc_id, int(b - a)) if reorder else None
            if order is not None:
                places[a:b] = a + order
        found = periodic_runs(w.hashes[places], w.offsets, min_words)
        drops = np.zeros(len(places) + 1, np.int64)
        first = w.offsets[found.doc] + found.start
        np.add.at(drops, first + found.period, 1)
        np.add.at(drops, first + found.length, -1)
        stays = np.cumsum(drops)[:-1] == 0
        data, texts = raw.tobytes(), []
        for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True):
            own = places[a:b][stays[a:b]]
            texts.append(b" ".join([data[x:y] for x, y in zip(w.starts[own].tolist(), w.ends[own].tolist(), strict=True)]).decode())
        order = np.lexsort((found.period, found.start, found.doc))
        rows = pa.StructArray.from_arrays([pa.array(c[order]) for c in (found.start, found.length, found.period)], ["start", "length", "period"])
        at = np.searchsorted(found.doc[order], np.arange(len(ids) + 1))
        return {"doc_id": part.column(0), "n_words": np.diff(w.offsets), "runs": pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows), "collapsed": texts}

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def summary(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (then the first, then the smallest period) and digests of all runs and of the collapsed text."""
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
