"""Linking items that share postings, without emitting all pairs of a posting.

Items come as postings (key, id, rank): a key lists items that may be alike. In each
round the highest-ranked item of every key that was not yet a leader is compared with
the members that are still in other components; confirmed links join components and
whole groups of copies collapse after a round or two. What then remains (members of
one key in different components, neither of them a former leader) is compared
pair by pair, with the largest component of a key on one side only. So every pair of
one key is either compared, already connected or out of reach by an exact bound: no
link between components is lost. Loose copies of one text are nearly all told apart by
such a bound (``within_masks``) inside the join, before they are pairs.

Nothing of this is collected; each step writes a table to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import drop, kept, mapped

#: Takes pairs (a, b) of ids, a < b, and returns those that are links.
Confirm = Callable[[DataFrame], DataFrame]
#: Whether two items, given by their columns, can be a link at all.
Possible = Callable[[dict[str, Column], dict[str, Column]], Column]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of ``edges`` (a, b); component is the smallest id reachable.

    Alternates large-star and small-star steps until the edges are stars. A step
    takes a minimum per id, which tasks reduce before the shuffle, and one join.
    """
    spark = edges.sparkSession
    edges, path = kept(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.join(least, "u")
        new = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return new.filter("u > v").distinct()

    def are_stars(e: DataFrame) -> bool:
        """Every id has one smaller neighbour at most, and that one has none."""
        several = e.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1")
        return several.isEmpty() and e.select("v").join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()

    while not are_stars(edges):
        new, new_path = kept(star(star(edges, True), False), "edges")
        drop(spark, path)
        edges, path = new, new_path
    pairs = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return pairs.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def unshared(sets: DataFrame) -> DataFrame:
    """id, n (elements of its set) and u (those in no other set) of every set (id, shingles). One row an element is shuffled."""
    each = sets.select("id", F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("c"), F.min("id").alias("id"))
    lone = each.filter("c = 1").groupBy("id").agg(F.count("*").alias("u"))
    return sets.select("id", F.size("shingles").alias("n")).join(lone, "id", "left").select("id", "n", F.coalesce("u", F.lit(0)).alias("u"))


def within_reach(percent: int) -> Possible:
    """Two sets can be that similar only if what either shares with any set at all would be enough."""

    def possible(a: dict[str, Column], b: dict[str, Column]) -> Column:
        most = F.least(a["n"] - a["u"], b["n"] - b["u"])
        return 100 * most >= percent * (a["n"] + b["n"] - most)

    return possible


MASK_WORDS = 8
_MASK = [f"mask{i}" for i in range(MASK_WORDS)]


def masked(sets: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Adds to rows with an id the columns ``mask0`` ...: 64 * MASK_WORDS bits, one set by each element of its set (id, shingles)."""

    def work(part: pa.RecordBatch) -> dict:
        n = part.num_rows
        lists = part.column(1)
        row = np.repeat(np.arange(n), lists.value_lengths().to_numpy())
        bit = lists.flatten().to_numpy().view(np.uint64) % np.uint64(64 * MASK_WORDS)
        bits = np.zeros((n, 64 * MASK_WORDS), np.uint8)
        bits[row, bit.astype(np.int64)] = 1
        words = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
        return {"id": part.column(0)} | {c: words[:, i] for i, c in enumerate(_MASK)}

    def add(rows: DataFrame) -> DataFrame:
        some = sets.join(rows.select("id").distinct(), "id", "left_semi").select("id", "shingles")
        return rows.join(mapped(some, work, ", ".join(["id long", *[f"{c} long" for c in _MASK]]), text=None), "id")

    return add


def within_masks(percent: int) -> Possible:
    """Two sets can be that similar only if the bits that one has and the other lacks, each an element not shared, leave enough."""

    def possible(a: dict[str, Column], b: dict[str, Column]) -> Column:
        lacks = lambda x, y: sum(F.bit_count(x[c].bitwiseAND(F.bitwise_not(y[c]))) for c in _MASK)
        most, enough = (a["n"] - lacks(a, b), b["n"] - lacks(b, a)), percent * (a["n"] + b["n"])
        # Of p per cent of the union, I shared elements: 100 I >= p (n + n' - I).
        return ((100 + percent) * most[0] >= enough) & ((100 + percent) * most[1] >= enough)

    return possible


def link(postings: DataFrame, confirm: Confirm, possible: Possible | None = None, rounds: int = 4, closer: tuple[Callable[[DataFrame], DataFrame], Possible] | None = None) -> DataFrame:
    """(id, component) of all items that are linked with any other.

    ``postings``: key, id, rank and what ``possible`` looks at (the same for an id
    everywhere); one row a key and id, written down already. Pairs that are not
    ``possible`` are no links and are never made. ``closer`` adds columns to the rows
    that remain after the rounds, and tells from them which pairs are possible.
    """
    spark = postings.sparkSession
    more = [c for c in postings.columns if c not in ("key", "id", "rank")]
    fits = possible or (lambda a, b: F.lit(True))
    side = lambda mark: {c: F.col(f"{c}{mark}") for c in more}
    state, made = postings.withColumn("component", F.col("id")).withColumn("led", F.lit(False)), []
    columns, total = state.columns, None
    for _ in range(rounds):
        open_keys = state.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.max(F.when(~F.col("led"), F.struct("rank", "id", "component", *more))).alias("top"),
        ).filter("low < high and top is not null").select("key", F.col("top.id").alias("leader"), F.col("top.component").alias("leads"), *[F.col(f"top.{c}").alias(f"{c}_of") for c in more])
        state, path = kept(state.join(open_keys, "key"), "postings")
        made.append(path)
        if state.isEmpty():
            break
        pairs = state.filter("component != leads").filter(fits(side(""), side("_of"))).select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()
        found, path = kept(confirm(pairs), "links")
        made.append(path)
        state = state.withColumn("led", F.col("led") | (F.col("id") == F.col("leader"))).select(*columns)
        if found.isEmpty():
            # No member is like its leader: further leaders would do no better than the pairs themselves.
            break
        total = found if total is None else total.unionByName(found)
        labels, path = kept(components(total), "components")
        made.append(path)
        state = state.drop("component").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")).select(*columns)
    # A former leader has been compared with all members of its key, or shares their component.
    rest = state.filter("not led")
    sizes = rest.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("k")).filter("k > 1").select("key", F.col("top.component").alias("big"))
    rest = rest.join(largest, "key")
    # An id has a bounded number of keys. A pair is made under the first key that both still have, and nowhere else.
    rest, path = kept(rest.join(rest.groupBy("id").agg(F.collect_set("key").alias("keys")), "id"), "postings")
    made.append(path)
    if rest.isEmpty():
        out, _ = kept(components(total if total is not None else rest.select(F.col("id").alias("a"), F.col("id").alias("b"))), "linked")
        drop(spark, *made)
        return out
    if closer:
        rest = closer[0](rest)
        more, first = [*more, *[c for c in rest.columns if c not in (*columns, "big", "keys")]], fits
        fits = lambda a, b: first(a, b) & closer[1](a, b)
    few = rest.filter("component != big").select("key", F.col("id").alias("x"), F.col("component").alias("cx"), F.col("keys").alias("keys_of_x"), *[F.col(c).alias(f"{c}_x") for c in more])
    all_ = rest.select("key", F.col("id").alias("y"), F.col("component").alias("cy"), F.col("keys").alias("keys_of_y"), "big", *[F.col(c).alias(f"{c}_y") for c in more])
    meet = few.join(all_, "key").filter("cx != cy and (cy = big or x < y)").filter(fits(side("_x"), side("_y")))
    meet = meet.filter(F.col("key") == F.array_min(F.array_intersect("keys_of_x", "keys_of_y")))
    pairs = meet.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    found, path = kept(confirm(pairs), "links")
    made.append(path)
    out, _ = kept(components(found if total is None else total.unionByName(found)), "linked")
    drop(spark, *made)
    return out
