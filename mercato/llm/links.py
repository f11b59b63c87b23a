"""Links between the members of posting lists, without all pairs of a list.

``postings`` has (token, id, ...): two ids are candidates if they share a token
and ``pair_filter`` allows it; ``verify`` keeps the candidates that are links.
Lists of up to ``LONG_LIST`` ids are compared within. A list may be of any length
(a third of all ids may share a token), so of the longer ones:

1. every id of a list is compared with one centre of the list only;
2. links found so far make components; a list whose ids lie in one component
   needs no more pairs (they are connected already), and one row per (token,
   component) stands for all of them; in two rounds these rows are compared with
   one of the list's largest component, another one in each list;
3. only lists with several components go on: the ids of different components
   are compared, whatever their number; the join makes only the pairs that pass
   the filters.

Step 3 makes the result exact: the components are those of all links."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import gives_back, stored

#: A list of up to this many ids is compared at once.
LONG_LIST = 48
#: Different links that one task solves; some 100 MB.
MOST_EDGES = 1_000_000
#: Rounds in which components are compared by one member of each.
ROUNDS = 2

Verify = Callable[[DataFrame], DataFrame]
Narrow = tuple[Callable[[str, str], Column], Callable[[Column, Column, Column], Column], str]


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all ids of ``links`` (a, b long): component is the
    smallest id reachable. Up to ``MOST_EDGES`` different links, counted before,
    are solved by one task; more by rounds over all of them."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = stored(links.where("a <> b").select(low.alias("a"), high.alias("b")).distinct())
    if edges.count() <= MOST_EDGES:
        return stored(edges.coalesce(1).mapInArrow(_solved, "id long, component long"))
    return _by_rounds(edges)


@gives_back
def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of the links of one task: labels go down along the links and jump
    to their label's label until nothing moves."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not held:
        return
    a, b = (np.concatenate(side) for side in zip(*held))
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        for ends in (x, y, label[x], label[y]):
            np.minimum.at(new, ends, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    for lo in range(0, len(ids), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(ids[lo : lo + 50_000]), pa.array(ids[label[lo : lo + 50_000]])], names=["id", "component"])


def _by_rounds(edges: DataFrame) -> DataFrame:
    """Labels travel along links and jump to their label's label, twice a round;
    each round is a partial minimum by id, so a hub is no hot task. The joins are
    merged: a broadcast in every round would pass through the driver."""
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        heard = both.join(labels.hint("merge"), both.b == labels.id).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("heard"))
        merged = labels.join(heard.hint("merge"), "id").select("id", F.least("component", "heard").alias("component"), F.col("component").alias("old"))
        for _ in range(2):
            up = labels.select(F.col("id").alias("up_id"), F.col("component").alias("up"))
            jumped = merged.join(up.hint("merge"), F.col("component") == F.col("up_id"), "left")
            merged = jumped.select("id", F.least("component", F.coalesce("up", "component")).alias("component"), "old")
        new = stored(merged.select("id", "component", (F.col("component") != F.col("old")).alias("changed")))
        labels = new.select("id", "component")
        if new.where("changed").isEmpty():
            return labels


def _sides(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])


def list_links(postings: DataFrame, pair_filter: Callable[[str, str], Column], verify: Verify, first: str, known: DataFrame | None = None, attributes: DataFrame | None = None, bound: Callable[[str, str], Column] | None = None, narrow: Narrow | None = None, ready: Callable[[DataFrame], None] | None = None, refine: Callable[[DataFrame], tuple[DataFrame, DataFrame | None]] | None = None) -> DataFrame:
    """Links (a, b) whose components are those of all links among ``postings``.

    ``pair_filter(x, y)`` is a condition on the columns x_... and y_... of two
    postings of a token, true for at least one order of a pair that may be a
    link; ``first`` is an SQL condition that picks the postings for the centres;
    ``known`` are links found before; ``bound(x, y)`` is one more condition, on
    ``attributes`` (id, ...), that step 3 asks of a pair before it is made.
    ``narrow`` is for postings that hold all tokens of which a link shares a
    least number: a condition on two postings that leaves every token of a
    possible pair, one on (number of common tokens, size, size), and the name of
    the size; tokens of long lists, which are not scanned for it, count as common.
    ``ready`` is called once, before the first pairs are verified, with the ids
    that pairs may have (ends of the pairs of short lists, ids of long ones).
    ``refine`` takes the postings of lists that step 3 has left and gives links (a, b) of
    those that it has compared itself, enough for their components, and the other
    postings (None: none are left) dealt into smaller lists, in one of which every
    possible pair meets."""
    every = stored(postings)
    none = every.select(F.col("id").alias("a"), F.col("id").alias("b")).where("false")
    found = known if known is not None else none
    long = stored(every.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LONG_LIST).select("token"))
    has_long = not long.isEmpty()
    short = every.join(long, "token", "left_anti") if has_long else every
    postings = stored(every.join(long, "token", "left_semi")) if has_long else every

    def candidates(x: DataFrame, y: DataFrame, on: Column, more: Column | None = None) -> DataFrame:
        both = pair_filter("x", "y") | pair_filter("y", "x")
        on = on & (F.col("x_id") != F.col("y_id")) & both
        pair = x.join(y, on if more is None else on & more)
        return pair.select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")).distinct()

    def star(members: DataFrame) -> DataFrame:
        """Each member of a list against the list's centre: one of the largest
        component (``weight``), the least by a hash of the id among equals."""
        order = F.struct(-F.col("weight"), F.xxhash64("id").alias("h"), *own)
        centres = members.groupBy("token").agg(F.min(order).alias("c"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi")
        centres = centres.select("token", *[F.col(f"c.{c}").alias(c) for c in own])
        return candidates(_sides(members, "x"), _sides(centres, "y"), F.col("x_token") == F.col("y_token"))

    def several(found: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The postings with their components, and the (token, component) of the
        lists that have several, each with one of its postings."""
        placed = postings.join(components(found), "id", "left").withColumn("component", F.coalesce("component", "id"))
        order = F.struct(F.xxhash64("id", "token").alias("h"), *own)
        mixed = placed.groupBy("token", "component").agg(F.min(order).alias("m"), F.count(F.lit(1)).alias("weight"))
        lists = mixed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
        return placed, stored(mixed.join(lists, "token", "left_semi"))

    def add(found: DataFrame, pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs)
        if pairs.isEmpty():
            return found
        return found.select("a", "b").unionByName(stored(verify(pairs).select("a", "b")))

    def counted() -> DataFrame:
        meet, enough, size = narrow
        x, y = _sides(short, "x"), _sides(short, "y")
        pair = x.join(y, (F.col("x_token") == F.col("y_token")) & (F.col("x_id") < F.col("y_id")) & meet("x", "y"))
        pair = pair.groupBy(F.col("x_id").alias("a"), F.col("y_id").alias("b")).agg(F.count(F.lit(1)).alias("c"), F.min(f"x_{size}").alias("n"), F.min(f"y_{size}").alias("m"))
        if not has_long:
            return pair.where(enough(F.col("c"), F.col("n"), F.col("m"))).select("a", "b", "c")
        unseen = postings.groupBy("id").agg(F.count(F.lit(1)).alias("k"))
        p, q = (unseen.select(F.col("id").alias(side), F.col("k").alias(f"k{side}")) for side in "ab")
        pair = pair.join(p, "a", "left").join(q, "b", "left")
        c = F.col("c") + F.least(F.coalesce("ka", F.lit(0)), F.coalesce("kb", F.lit(0)))
        return pair.where(enough(c, F.col("n"), F.col("m"))).select("a", "b", "c")

    def best_first(found: DataFrame, pairs: DataFrame) -> DataFrame:
        """Verify for each id its pair with the most common tokens, which joins
        the copies of one text to it; then the pairs that still cross."""
        ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("o")), F.struct(F.col("b").alias("id"), F.col("a").alias("o")))).alias("e"), "c")
        best = ends.groupBy("e.id").agg(F.max(F.struct("c", (-F.col("e.o")).alias("o"))).alias("m"))
        other = -F.col("m.o")
        tried = stored(best.select(F.least("id", other).alias("a"), F.greatest("id", other).alias("b")).distinct())
        found = add(found, tried)
        labels = components(found)
        ca, cb = (labels.select(F.col("id").alias(side), F.col("component").alias(f"c{side}")) for side in "ab")
        placed = pairs.join(tried, ["a", "b"], "left_anti").join(ca, "a", "left").join(cb, "b", "left")
        return add(found, placed.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))

    pairs = stored(candidates(_sides(short, "x"), _sides(short, "y"), F.col("x_token") == F.col("y_token")) if narrow is None else counted())
    if ready is not None:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
        ready(ids.unionByName(postings.select("id")) if has_long else ids)
    found = add(found, pairs) if narrow is None else best_first(found, pairs)
    if not has_long:
        return found
    own = [c for c in postings.columns if c != "token"]
    found = add(found, star(postings.where(first).withColumn("weight", F.lit(1))))
    for _ in range(ROUNDS):
        groups = several(found)[1]
        if groups.isEmpty():
            return found
        found = add(found, star(groups.select("token", "weight", *[F.col(f"m.{c}").alias(c) for c in own])))
    placed, groups = several(found)
    if groups.isEmpty():
        return found
    groups = groups.select("token", "component")
    placed = placed.join(groups, ["token", "component"], "left_semi")
    if refine is not None:
        links, placed = refine(placed)
        found = found.select("a", "b").unionByName(links)
        if placed is None:
            return found
    placed = stored(placed if attributes is None else placed.join(attributes, "id"))
    x, y = _sides(placed, "x"), _sides(placed, "y")
    apart = (F.col("x_token") == F.col("y_token")) & (F.col("x_component") < F.col("y_component"))
    return add(found, candidates(x, y, apart, None if bound is None else bound("x", "y")))


# -- fixed-size filters ------------------------------------------------------
class Bloom:
    """A filter of a fixed number of bits, whatever the number of keys: keys
    that were added always pass, others rarely. Bounded to be shipped to tasks."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(len(words) * 64 - 1)

    def __contains__(self, key: int) -> bool:
        return bool(self.has(np.array([key], dtype=np.int64))[0])

    def has(self, keys: np.ndarray) -> np.ndarray:
        k = keys.astype(np.uint64)
        out = np.ones(len(k), dtype=bool)
        for shift in (0, 32):
            bit = (k >> np.uint64(shift)) & self.mask if shift else k & self.mask
            out &= ((self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)
        return out


#: At most 2^26 bits: 8 MB.
MOST_BITS = 26


def bits_for(keys: int) -> int:
    """Bits of a filter for about so many keys: 16 each."""
    return min(MOST_BITS, max(16, (16 * max(keys, 1)).bit_length()))


def bloom(keys: DataFrame, column: str, bits: int) -> Bloom:
    """The filter of the 64-bit hashes in ``column``, of 2^bits bits; only its words
    (8 MB at most) reach the driver. With far more keys than it has room for it
    lets most others pass as well, which costs time but loses nothing."""
    mask = (1 << bits) - 1
    k = F.col(column)
    places = F.array(k.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(k, 32).bitwiseAND(F.lit(mask)))
    bit = keys.select(F.explode(places).alias("p")).select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b"))
    table = bit.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[table.column("w").to_numpy()] = table.column("b").to_numpy().view(np.uint64)
    return Bloom(words)
