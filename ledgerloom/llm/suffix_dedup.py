"""Removal of byte strings that occur twice, by suffix sorting of anchored contexts.

Every window of ``length`` bytes has an anchor: the q-gram in it with the least hash.
Equal windows have equal anchors at equal offsets, so windows are compared only
within groups of one anchor, and an anchor that occurs once settles all its windows.
The bytes that the windows of an anchor cover are its context. Contexts that are
equal are one class; a class of two or more is repeated throughout. What is left are
groups of different contexts of one anchor, the edges of repeated passages. Their
parts from the anchor on are suffixes, put in order by deep-shallow sorting: multikey
quicksort down to a shallow depth, then blind tries for what still agrees. The nodes
of that order (sets of suffixes with a common prefix) are combined with the order of
the reversed bytes before the anchor: a window reaching j bytes back is repeated if
two members of a node agree on j bytes before and length - j bytes after the anchor.

A group of more than ``group_rows`` contexts is halved by window offset, again and
again: all windows of a half share bytes on both sides of the anchor, and the group
falls apart by them. A half with one offset needs no sorting. So no task ever holds
more than ``group_rows`` contexts of a group.

Defined cases: null is an empty text; texts shorter than ``length`` lose nothing; rows
without doc_id are texts like any other; repeated rows are texts of their own, so they
repeat each other; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import drop, kept, mapped, release, text_bytes
from ledgerloom.llm.words import _ROOT, mix, powers, prefix_sums, spans_hash

_U = np.uint64


class Settings(NamedTuple):
    length: int = 400
    gram: int = 128
    group_rows: int = 2000

    @property
    def offsets(self) -> int:
        """Offsets that an anchor can have in a window."""
        return self.length - self.gram + 1


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from minima up to and from block borders."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(raw: np.ndarray, offsets: np.ndarray, s: Settings) -> dict[str, np.ndarray]:
    """Anchors of all windows: doc, anchor (hash), context (hash), s_lo and s_hi (first and last window, from the text's start), j_lo (offset in the last)."""
    empty = np.zeros(0, np.int64)
    if len(raw) < s.length:
        return dict.fromkeys(("doc", "anchor", "context", "s_lo", "s_hi", "j_lo"), empty)
    sums, roots = prefix_sums(raw), powers(_ROOT, len(raw) + 1)
    with np.errstate(over="ignore"):
        gram = mix((sums[s.gram :] - sums[: -s.gram]) * roots[: len(raw) - s.gram + 1])
    bits = _U(int(len(raw)).bit_length())
    least = sliding_min((gram >> bits << bits) | np.arange(len(gram), dtype=_U), s.offsets)
    start = np.flatnonzero(np.arange(len(least)) + s.length <= np.repeat(offsets[1:], np.diff(offsets))[: len(least)])
    place = (least[start] & _U((1 << int(bits)) - 1)).astype(np.int64)
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    at, lo, hi = place[first], start[first], start[last]
    doc = np.searchsorted(offsets, at, "right") - 1
    with np.errstate(over="ignore"):
        context = mix(spans_hash(sums, lo, hi + s.length, roots) + (at - hi).astype(_U) * _U(0x9E3779B97F4A7C15))
    base = offsets[doc]
    return {"doc": doc, "anchor": gram[at].view(np.int64), "context": context.view(np.int64), "s_lo": lo - base, "s_hi": hi - base, "j_lo": at - hi}


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of the spans, as maximal runs in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    return start[first], reach[np.append(first[1:], len(start)) - 1]


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8


def blind_trie(strings: list[bytes], members: list[int]) -> list[int]:
    """Order of strings by a trie that stores branching depths only.

    A string first goes down by the bytes at branching depths alone; the leaf it
    reaches tells its true common prefix and with it the place of its branch.
    """

    def byte(i: int, depth: int) -> int:
        return strings[i][depth] if depth < len(strings[i]) else -1

    root: list = [members[0]]  # a leaf is a list of equal strings; a branch is (depth, {byte: node})
    for i in members[1:]:
        node = root
        while isinstance(node, tuple):
            depth, children = node
            node = children.get(byte(i, depth)) or next(iter(children.values()))
        agree = common(strings[i], strings[node[0]])
        if agree == len(strings[i]) == len(strings[node[0]]):
            node.append(i)
            continue
        other, above, node = node[0], None, root
        while isinstance(node, tuple) and node[0] < agree:
            above, node = node, node[1][byte(i, node[0])]
        if isinstance(node, tuple) and node[0] == agree:
            node[1][byte(i, agree)] = [i]
            continue
        branch = (agree, {byte(other, agree): node, byte(i, agree): [i]})
        if above is None:
            root = branch
        else:
            above[1][byte(i, above[0])] = branch
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack.extend(child for _, child in sorted(node[1].items(), key=lambda x: -x[0]))
        else:
            out += node
    return out


def deep_shallow(strings: list[bytes], known: int = 0, shallow: int = 8) -> list[int]:
    """Order of ``strings``, which agree on ``known`` bytes: multikey quicksort for ``shallow`` bytes, then blind tries."""
    out: list[int] = []
    stack: list = [(list(range(len(strings))), known)]
    while stack:
        members, depth = stack.pop()
        if len(members) < 2:
            out += members
        elif depth >= known + shallow:
            out += blind_trie(strings, members)
        else:
            keys = [strings[i][depth] if depth < len(strings[i]) else -1 for i in members]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            less = [i for i, k in zip(members, keys, strict=True) if k < pivot]
            same = [i for i, k in zip(members, keys, strict=True) if k == pivot]
            more = [i for i, k in zip(members, keys, strict=True) if k > pivot]
            stack.append((more, depth))
            # Strings that end here are equal: one by one they need no further order.
            stack.extend([(same, depth + 1)] if pivot >= 0 else [([i], depth) for i in same])
            stack.append((less, depth))
    return out


def repeated_offsets(left: list[bytes], right: list[bytes], s: Settings, known: int) -> list[list[tuple[int, int]]]:
    """For each context the offsets j (as ranges, both ends included) whose windows another context of the group has too.

    ``left`` ends and ``right`` begins at the anchor.
    """
    back = [x[::-1] for x in left]
    order = deep_shallow(right, known)
    rank = np.empty(len(back), np.int64)
    rank[deep_shallow(back)] = np.arange(len(back))
    agree = [common(right[a], right[b]) for a, b in zip(order, order[1:], strict=False)]
    out: list[list[tuple[int, int]]] = [[] for _ in left]
    stack = [(0, len(order))]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        depth = min(agree[a : b - 1])
        if depth + max(len(left[i]) for i in order[a:b]) >= s.length:
            members = sorted(order[a:b], key=rank.__getitem__)
            behind = [common(back[x], back[y]) for x, y in zip(members, members[1:], strict=False)]
            for k, i in enumerate(members):
                far = max(behind[k - 1] if k else 0, behind[k] if k < len(behind) else 0)
                if far >= s.length - depth:
                    out[i].append((s.length - depth, far))
        cuts = [a, *(k + 1 for k in range(a, b - 1) if agree[k] == depth), b]
        stack.extend(zip(cuts, cuts[1:], strict=False))
    return out


_CONTEXT = "anchor long, context long, done boolean, j_lo int, j_hi int, before binary, after binary"
_KEYED = _CONTEXT + ", j_from int, j_to int, part binary, whole binary"


def sort_groups(keyed: DataFrame, s: Settings) -> DataFrame:
    """anchor, context and repeated offsets (j1 to j2) of groups (anchor, j_from, part) of bounded size."""

    def solve(rows: list[tuple]) -> list[tuple]:
        j_from, j_to = rows[0][7], rows[0][8]
        # Only windows of the group's offsets are asked for; they agree on length - j_to bytes from the anchor on.
        left = [r[5][-min(j_to, len(r[5])) :] if min(j_to, len(r[5])) else b"" for r in rows]
        right = [r[6][: s.length - j_from] for r in rows]
        found = repeated_offsets(left, right, s, s.length - j_to)
        return [
            (r[0], r[1], max(j1, r[3], j_from), min(j2, r[4], j_to))
            for r, ranges in zip(rows, found, strict=True) if not r[2]
            for j1, j2 in ranges if max(j1, r[3], j_from) <= min(j2, r[4], j_to)
        ]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            a, c, j1, j2 = zip(*rows, strict=True) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(j1, pa.int32()), pa.array(j2, pa.int32())], names=["anchor", "context", "j1", "j2"])

        group, name = [], None
        for batch in batches:
            solved = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = (row[0], row[7], row[9])
                if own != name and group:
                    solved += solve(group)
                    group = []
                name = own
                group.append(row)
            yield out(solved)
        if group:
            yield out(solve(group))

    key = ["anchor", "j_from", "part"]
    columns = [x.split()[0] for x in _KEYED.split(", ")][:10]
    return keyed.select(*columns).repartition(*key).sortWithinPartitions(*key).mapInArrow(work, "anchor long, context long, j1 int, j2 int")


def halve(keyed: DataFrame, s: Settings) -> DataFrame:
    """Each context in the two halves of its group's offsets, as far as it has windows there.

    ``part`` names the bytes that all windows of the half share, ``whole`` all bytes of
    the context's windows in it.
    """

    def digest(*x: bytes) -> bytes:
        return hashlib.blake2b(b"".join(x), digest_size=16).digest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                middle = (row["j_from"] + row["j_to"]) // 2
                for j_from, j_to in ((row["j_from"], middle), (middle + 1, row["j_to"])):
                    low, high = max(j_from, row["j_lo"]), min(j_to, row["j_hi"])
                    if j_from <= j_to and low <= high:
                        before, after = row["before"], row["after"]
                        part = digest(before[len(before) - j_from :], after[: s.length - j_to])
                        whole = digest(b"%d %d " % (low, high), before[len(before) - high :], after[: s.length - low])
                        rows.append(row | {"j_from": j_from, "j_to": j_to, "part": part, "whole": whole})
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    return keyed.mapInArrow(work, _KEYED)


def contexts(rows: DataFrame, places: DataFrame, s: Settings) -> DataFrame:
    """Bytes around the anchors ``places`` (id, th, anchor, context, done, s_lo, s_hi, j_lo)."""
    fields = ("anchor", "context", "done", "s_lo", "s_hi", "j_lo")
    by_text = places.groupBy("id", "th").agg(F.collect_list(F.struct(*fields)).alias("p"))
    texts = rows.join(by_text, ["id", "th"]).select("text", *[F.col(f"p.{f}").alias(f) for f in fields])

    def work(part: pa.RecordBatch) -> dict:
        count = part.column(1).value_lengths().to_numpy()
        doc = np.repeat(np.arange(part.num_rows), count)
        raw, off = text_bytes(part.column(0))
        data = raw.tobytes()
        flat = {f: part.column(k + 1).flatten() for k, f in enumerate(fields)}
        lo, hi, j_lo = (flat[f].to_numpy().astype(np.int64) for f in ("s_lo", "s_hi", "j_lo"))
        at = hi + j_lo
        base = off[doc]
        return {
            "anchor": flat["anchor"], "context": flat["context"], "done": flat["done"], "j_lo": j_lo, "j_hi": at - lo,
            "before": pa.array([data[b + x : b + y] for b, x, y in zip(base.tolist(), lo.tolist(), at.tolist(), strict=True)], pa.binary()),
            "after": pa.array([data[b + x : b + y + s.length] for b, x, y in zip(base.tolist(), at.tolist(), hi.tolist(), strict=True)], pa.binary()),
        }

    return mapped(texts, work, _CONTEXT).dropDuplicates(["anchor", "context"])


def all_anchors(rows: DataFrame, s: Settings) -> DataFrame:
    """id, th and each distinct (anchor, context) of every text with its number n in it.

    Rows with n = 0 are spans of window starts that the text repeats by itself.
    """

    def work(part: pa.RecordBatch) -> dict:
        a = anchors(*text_bytes(part.column(2)), s)
        order = np.lexsort((a["s_lo"], a["context"], a["anchor"], a["doc"]))
        a = {k: v[order] for k, v in a.items()}
        new = np.ones(len(order), bool)
        new[1:] = (a["doc"][1:] != a["doc"][:-1]) | (a["anchor"][1:] != a["anchor"][:-1]) | (a["context"][1:] != a["context"][:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(order)))
        again = np.repeat(count > 1, count)
        doc, lo, hi = [a["doc"][first]], [a["s_lo"][first]], [a["s_hi"][first]]
        for d in np.unique(a["doc"][again]):
            own = again & (a["doc"] == d)
            x, y = merged(a["s_lo"][own], a["s_hi"][own] + 1)
            doc.append(np.full(len(x), d))
            lo.append(x)
            hi.append(y - 1)
        doc, spans = np.concatenate(doc), sum(map(len, doc)) - len(first)
        fill = lambda x: np.concatenate([x, np.zeros(spans, x.dtype)])
        return {
            "id": part.column(0).take(pa.array(doc)), "th": part.column(1).take(pa.array(doc)),
            "anchor": fill(a["anchor"][first]), "context": fill(a["context"][first]),
            "s_lo": np.concatenate(lo), "s_hi": np.concatenate(hi), "j_lo": fill(a["j_lo"][first]), "n": fill(count),
        }

    return mapped(rows.select("id", "th", "text"), work, "id long, th long, anchor long, context long, s_lo int, s_hi int, j_lo int, n int")


def repeated_spans(rows: DataFrame, s: Settings) -> DataFrame:
    """id, th, start and end (bytes) of strings of ``length`` bytes or more that occur elsewhere; they may overlap."""
    spark, made = rows.sparkSession, []

    def keep(df: DataFrame, name: str) -> DataFrame:
        df, path = kept(df, name)
        made.append(path)
        return df

    found = keep(all_anchors(rows, s), "anchors")
    single = found.filter("n > 0")
    again = keep(single.groupBy("anchor").agg(F.sum("n").alias("total")).filter("total > 1").select("anchor"), "again")
    members = keep(single.join(again, "anchor"), "members")
    release(spark)
    place = F.struct("id", "th", "s_lo", "s_hi", "j_lo")
    classes = keep(members.groupBy("anchor", "context").agg(F.sum("n").alias("n"), F.min(place).alias("at")), "classes")
    groups = classes.groupBy("anchor").agg(F.count("*").alias("size"), F.max((F.col("n") == 1)).alias("open")).filter("size > 1 and open").select("anchor", "size")
    groups = keep(groups, "groups")
    j_hi = F.col("at.j_lo") + F.col("at.s_hi") - F.col("at.s_lo")
    settled = [classes.filter("n > 1").select("anchor", "context", F.col("at.j_lo").alias("j1"), j_hi.alias("j2"))]
    places = classes.join(groups.select("anchor"), "anchor").select("anchor", "context", (F.col("n") > 1).alias("done"), "at.*")
    around = keep(contexts(rows, places, s), "contexts")
    release(spark)
    start = around.withColumns({"j_from": F.lit(0), "j_to": F.lit(s.offsets - 1), "part": F.lit(b""), "whole": F.lit(b"")})
    sized = start.join(groups, "anchor")
    settled.append(keep(sort_groups(sized.filter(F.col("size") <= s.group_rows), s), "sorted"))
    large = keep(sized.filter(F.col("size") > s.group_rows).drop("size"), "large")
    while not large.isEmpty():
        halves = keep(halve(large, s), "halves")
        key = ["anchor", "j_from", "j_to", "part"]
        wholes = keep(halves.groupBy(*key, "whole").agg(F.count("*").alias("n"), F.max("done").alias("known"), F.min("context").alias("context")), "wholes")
        parts = wholes.groupBy(*key).agg(F.count("*").alias("size"), F.max((F.col("n") == 1) & ~F.col("known")).alias("open")).filter("size > 1 and open").drop("open")
        both = halves.join(wholes.filter("n > 1").select(*key, "whole"), [*key, "whole"]).filter("not done")
        settled.append(keep(both.select("anchor", "context", F.greatest("j_lo", "j_from").alias("j1"), F.least("j_hi", "j_to").alias("j2")), "settled"))
        # One context stands for all with the same bytes; if it is one of several its windows are settled.
        left = wholes.join(parts, key).select(*key, "whole", "context", "size", (F.col("n") > 1).alias("several"))
        next_ = keep(halves.join(left, [*key, "whole", "context"]).withColumn("done", F.col("done") | F.col("several")).drop("several"), "parts")
        settled.append(keep(sort_groups(next_.filter(F.col("size") <= s.group_rows), s), "sorted"))
        large = keep(next_.filter(F.col("size") > s.group_rows).drop("size").select(*[x.split()[0] for x in _KEYED.split(", ")]), "large")
    ranges = settled[0]
    for more in settled[1:]:
        ranges = ranges.unionByName(more)
    at = F.col("s_hi") + F.col("j_lo")
    spans = members.join(ranges, ["anchor", "context"]).select("id", "th", (at - F.col("j2")).alias("start"), (at - F.col("j1") + s.length).alias("end"))
    local = found.filter("n = 0").select("id", "th", F.col("s_lo").alias("start"), (F.col("s_hi") + s.length).alias("end"))
    out, _ = kept(spans.unionByName(local), "spans")
    drop(spark, *made)
    release(spark)
    return out


def dedup(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_bytes and kept_sha256 of every row."""
    s = settings
    # A row is named by its id and text: rows that agree in both have the same spans.
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").alias("th"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = repeated_spans(rows.filter(F.octet_length("text") >= s.length), s).groupBy("id", "th").agg(F.collect_list("start").alias("start"), F.collect_list("end").alias("end"))
    joined = rows.join(spans, ["id", "th"], "left").select("doc_id", "text", "start", "end")

    def work(part: pa.RecordBatch) -> dict:
        raw, off = text_bytes(part.column(1))
        data = raw.tobytes()
        kept_bytes, removed, n_spans = [], [], []
        for i, (start, end) in enumerate(zip(part.column(2), part.column(3), strict=True)):
            a = np.asarray(start.values, np.int64) if start.is_valid else np.zeros(0, np.int64)
            b = np.asarray(end.values, np.int64) if end.is_valid else a
            a, b = merged(a, b)
            text = data[off[i] : off[i + 1]]
            edges = [0, *np.stack([a, b], 1).ravel().tolist(), len(text)]
            kept_bytes.append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
            removed.append(int((b - a).sum()))
            n_spans.append(len(a))
        return {
            "doc_id": part.column(0), "n_bytes": np.diff(off), "n_removed": removed, "n_spans": n_spans,
            "kept_bytes": pa.array(kept_bytes, pa.binary()), "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept_bytes],
        }

    return mapped(joined, work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary, kept_sha256 string")
