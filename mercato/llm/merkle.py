"""Operator 13: Merkle manifest of a dataset.

The rows of a group (a language) are the leaves of a tree, in order; every
``FANOUT`` neighbouring nodes of a level hash to one node of the next, and the tops
of the groups' trees, in order of the groups, make one more tree with the root.

* Places come from one range sort by group, key, leaf (rows that are equal in all
  of them go by their number, so a key that a third of all rows share is cut like
  any other). Only the number of rows of each range partition is summed up in order;
  a row's place is its place within the partition plus what stands before.
* Per level, ``lag`` and ``lead`` columns of all fixed offsets up to ``FANOUT - 1``,
  masked by the slot of a node in its run and the length of the run, supply its
  siblings, and the row in the first slot hashes the run to the parent. A window
  holds one run, so a group with a third of all rows is no hot task, and each level
  is an eighth of the one below.
* The way up is put together from the top down: a node's way is its own siblings
  and then its parent's way. The leaves are joined once, with the nodes of the first
  level, on the run by which they stand together already.

Digests travel as 32 bytes and are hashed as lower-case hex text.

Defined results: null groups and null keys come first; groups go by their bytes;
repeated rows are leaves of their own; a run of one node is hashed like any other; a
lone leaf is its tree's top; a tree of one group has that top as its root; other
columns of the leaves are kept whatever their names; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import shared_path

FANOUT = 8
PART_BITS = 33  # of monotonically_increasing_id: the partition stands above


# -- hashes -----------------------------------------------------------------------
def framed(column: Column) -> Column:
    """A value as hash input: ``-`` if null, else its length in bytes, ``:`` and itself."""
    text = column.cast("string")
    return F.when(column.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*inputs: Column) -> Column:
    """SHA-256 of the inputs one after the other, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*inputs), 256))


def hex_text(column: Column) -> Column:
    return F.lower(F.hex(column))


def leaf_digest(columns: list[Column]) -> Column:
    return digest(*[framed(c) for c in columns])


def folded(leaf: Column, way: Column) -> Column:
    """The root that a leaf (32 bytes) and the siblings on its way up give."""
    return F.aggregate(way, leaf, lambda own, step: F.unhex(F.sha2(F.concat(hex_text(step["before"]), hex_text(own), hex_text(step["after"])), 256)))


def proof_text(way: Column) -> Column:
    """The siblings on a way up, left to right and level by level, as hex text."""
    return F.array_join(F.transform(way, lambda step: F.concat(hex_text(step["before"]), hex_text(step["after"]))), "")


# -- places -----------------------------------------------------------------------
def _placed(leaves: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(leaves with tree, at, size; one row per tree). ``tree`` numbers the groups
    in order from 0, ``at`` the leaves of a group; both are long."""
    spark = leaves.sparkSession
    leaves.withColumn("m_tie", F.monotonically_increasing_id()).write.parquet(f"{path}/leaves")
    order = ["m_group", "m_key", "m_leaf", "m_tie"]
    by_range = spark.read.parquet(f"{path}/leaves").repartitionByRange(*order).sortWithinPartitions(*order)
    by_range.drop("m_tie").withColumn("m_row", F.monotonically_increasing_id()).write.parquet(f"{path}/sorted")
    rows = spark.read.parquet(f"{path}/sorted").withColumn("m_part", F.shiftright("m_row", PART_BITS))
    within = F.col("m_row").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    # one row per range partition and group in it: groups have one piece in most partitions
    pieces = rows.groupBy("m_part", "m_group").agg(F.min(within).alias("first"), F.count(F.lit(1)).alias("n"))
    pieces.write.parquet(f"{path}/pieces")
    pieces = spark.read.parquet(f"{path}/pieces")
    # rows before a partition: one row per range partition, whose number is set
    before = Window.orderBy("m_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.groupBy("m_part").agg(F.sum("n").alias("n")).select("m_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    pieces = pieces.join(starts, "m_part").withColumn("place", F.col("start") + F.col("first"))
    groups = pieces.groupBy("m_group").agg(F.min("place").alias("begin"), F.sum("n").alias("size"), F.min("m_part").alias("m_part"))
    # groups are numbered like rows: those that begin in earlier partitions, then within
    begun = groups.groupBy("m_part").agg(F.count(F.lit(1)).alias("n")).select("m_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("trees"))
    number = F.row_number().over(Window.partitionBy("m_part").orderBy("begin")) - 1
    groups = groups.join(begun, "m_part").select("m_group", (F.col("trees") + number).alias("tree"), "begin", "size")
    groups.write.parquet(f"{path}/groups")
    groups = spark.read.parquet(f"{path}/groups")
    g, s = (groups.withColumnRenamed("m_group", "of"), starts)
    pieces = spark.read.parquet(f"{path}/pieces").join(s, "m_part").join(g, F.col("m_group").eqNullSafe(F.col("of")))
    shifts = pieces.select(F.col("m_part").alias("p"), "of", "tree", "size", (F.col("start") - F.col("begin")).alias("shift"))
    placed = rows.join(shifts, (F.col("m_part") == F.col("p")) & F.col("m_group").eqNullSafe(F.col("of")))
    placed = placed.withColumn("at", within + F.col("shift")).drop("p", "of", "shift", "m_row", "m_part")
    return placed, groups.select("tree", "size")


# -- levels -----------------------------------------------------------------------
def _with_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, at, size, digest, ...) with run, before, after: the
    siblings of a node in its run, as bytes one after the other."""
    nodes = nodes.withColumn("run", F.floor(F.col("at") / FANOUT).cast("long"))
    slot = F.col("at") % FANOUT
    length = F.least(F.lit(FANOUT), F.col("size") - F.col("run") * FANOUT)
    w = Window.partitionBy("tree", "run").orderBy("at")
    none = F.lit(b"")
    before = [F.when(slot >= k, F.lag("digest", k).over(w)).otherwise(none) for k in range(FANOUT - 1, 0, -1)]
    after = [F.when(slot + k < length, F.lead("digest", k).over(w)).otherwise(none) for k in range(1, FANOUT)]
    return nodes.withColumns({"before": F.concat(*before), "after": F.concat(*after)})


def _parents(nodes: DataFrame) -> DataFrame:
    """The nodes of the next level, hashed by the rows in the first slot."""
    first = _with_siblings(nodes).where(F.col("at") % FANOUT == 0)
    return first.select("tree", F.col("run").alias("at"), F.ceil(F.col("size") / FANOUT).cast("long").alias("size"), digest(hex_text(F.col("digest")), hex_text(F.col("after"))).alias("digest"))


def _grow(nodes: DataFrame, largest: int, path: str) -> list[DataFrame]:
    """The levels of a forest: ``nodes``, then each written; a tree ends in the
    level where it has one node."""
    spark = nodes.sparkSession
    levels = [nodes]
    while largest > 1:
        _parents(levels[-1].where("size > 1")).write.parquet(f"{path}/level{len(levels)}")
        levels.append(spark.read.parquet(f"{path}/level{len(levels)}"))
        largest = -(-largest // FANOUT)
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the top of each tree."""
    out = levels[0].where("size = 1").select("tree", "digest")
    for level in levels[1:]:
        out = out.unionByName(level.where("size = 1").select("tree", "digest"))
    return out


def _climbed(nodes: DataFrame, above: DataFrame, more: list[str]) -> DataFrame:
    """``nodes`` with their way up; ``above`` has (of_tree, of_run, way, ...): the
    ways of the parents, and of tops in place of their own."""
    joined = _with_siblings(nodes).join(above, (F.col("tree") == F.col("of_tree")) & (F.col("run") == F.col("of_run")))
    own = F.array(F.struct("before", "after"))
    way = F.when(F.col("size") > 1, F.concat(own, F.col("up"))).otherwise(F.col("up"))
    return joined.withColumn("way", way).drop("of_tree", "of_run", "up", "run", "before", "after").select(*nodes.columns, "way", *more)


def _ways(levels: list[DataFrame], tops: DataFrame, more: list[str], path: str) -> DataFrame:
    """The nodes of the lowest level with their ways; ``tops`` has (tree, size,
    way, ...), a size being that of the tree's lowest level."""
    spark = tops.sparkSession
    top = tops.select(F.col("tree").alias("of_tree"), F.lit(0).cast("long").alias("of_run"), F.col("way").alias("up"), *more, "size")
    above: DataFrame | None = None
    for i in range(len(levels) - 1, -1, -1):
        # trees that have one node here and had several below
        here = top.where((F.col("size") <= FANOUT**i) & (F.col("size") > (FANOUT ** (i - 1) if i else 0))).drop("size")
        above = here if above is None else above.unionByName(here)
        found = _climbed(levels[i], above, more)
        if i == 0:
            return found
        found.select("tree", "at", "way", *more).write.parquet(f"{path}/ways{i}")
        above = spark.read.parquet(f"{path}/ways{i}").select(F.col("tree").alias("of_tree"), F.col("at").alias("of_run"), F.col("way").alias("up"), *more)
    raise AssertionError("a forest has a lowest level")


def merkle_ways(leaves: DataFrame, group_col: str, key_col: str, leaf_col: str) -> DataFrame:
    """``leaves`` with all its columns (``leaf_col`` holds 32 bytes) and, as
    m_subroot, m_root and m_way, the top of the group's tree, the root and the
    siblings on the way from the leaf to the root: a list of (before, after)."""
    spark = leaves.sparkSession
    path = shared_path(spark, "merkle")
    plain = leaves.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(leaves.columns)], F.col(group_col).alias("m_group"), F.col(key_col).alias("m_key"), F.col(leaf_col).alias("m_leaf"))
    placed, trees = _placed(plain, path)
    placed = placed.drop("m_group", "m_key").withColumnRenamed("m_leaf", "digest")
    sizes = trees.agg(F.max("size").alias("most"), F.min("size").alias("least"), F.count(F.lit(1)).alias("n")).first()
    levels = _grow(placed, sizes["most"] or 0, f"{path}/rows")
    tops = _tops([x.select("tree", "size", "digest") for x in (levels if sizes["least"] == 1 else levels[1:] or levels)])
    crown = tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(sizes["n"]).cast("long").alias("size"), "digest")
    crown.write.parquet(f"{path}/crown/level0")
    crown_levels = _grow(spark.read.parquet(f"{path}/crown/level0"), sizes["n"], f"{path}/crown")
    root = _tops(crown_levels).select("tree", F.lit(sizes["n"]).cast("long").alias("size"), F.array().cast("array<struct<before:binary,after:binary>>").alias("way"), F.col("digest").alias("m_root"))
    subroots = _ways(crown_levels, root, ["m_root"], f"{path}/crown")
    subroots = subroots.select(F.col("at").alias("tree"), "way", F.col("digest").alias("m_subroot"), "m_root")
    subroots.join(trees, "tree").write.parquet(f"{path}/subroots")
    out = _ways(levels, spark.read.parquet(f"{path}/subroots"), ["m_subroot", "m_root"], f"{path}/rows")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(leaves.columns)], "m_subroot", "m_root", F.col("way").alias("m_way"))
