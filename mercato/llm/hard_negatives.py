"""Operator 12: hard-negative mining with Kronecker-packed products.

Components are whole numbers (``floor(scale * x)``). For one component the values
of all candidates of a block, biased so that none is negative, stand in separated
fields of one wide integer; an anchor multiplies each of these integers once, by
its own biased component, and adds them up. No field overflows into the next (its
width follows from the number of components and the largest values), so the sum
holds all inner products, and the biases are taken off when it is unpacked. Scores
are exact. Fields have 32 bits for usual vectors, 64 for larger ones, and any
width beyond that.

Anchors meet all rows in blocks: rows are dealt by their number, not by label or
id, into groups of about ``ROWS_A_GROUP``, anchors into groups of about
``ANCHORS_A_GROUP``, and each pair of groups is one task's cell. A hot label or a
vector that comes a thousand times is no hot task, and a cell's memory is bounded.
Cells return the few best rows of each anchor only. Two passes:

1. an anchor with the rows of its own label gives its positives (the ``n_positives``
   with the highest scores);
2. with the rows of other labels it gives, for each positive, the first
   ``n_negatives`` whose score lies between ``low`` and ``high`` hundredths of the
   positive's score.

Higher scores come first, ties go by the smaller id.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; a shorter vector counts as filled up with
zeros; of several rows with the id of an anchor the least by label, then vector is
the anchor, and rows with the anchor's id are not among its partners; other
repeated rows count each; scores beyond a long stand at its end; without enough
rows all there are come; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_A_GROUP = 1024
ANCHORS_A_GROUP = 4096

#: Components of candidates are packed together if they are of one of these sizes.
SIZES = (1 << 12, 1 << 27)
MOST_LONG = (1 << 63) - 1


# -- packed products ------------------------------------------------------------
def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``: as 64-bit integers if all fit, else as Python's."""
    with np.errstate(over="ignore"):
        found = np.floor(values.astype(np.float64) * scale)
    if not len(found) or np.abs(found).max() < 2.0**62:
        return found.astype(np.int64)
    exact = [int(f) if np.isfinite(f) else int(v) * scale for f, v in zip(found.tolist(), values.tolist())]
    return np.array(exact, dtype=object)


def field_bytes(dims: int, anchor: int, candidate: int) -> int:
    """Bytes of a field for the sum of ``dims`` products of biased components."""
    bits = (max(dims, 1) * 2 * anchor * 2 * candidate).bit_length()
    return 4 if bits <= 32 else 8 if bits <= 64 else -(-bits // 8)


class Packed:
    """Candidates (one a row of whole numbers) as one wide integer a component."""

    def __init__(self, rows: np.ndarray):
        self.n, self.dims = rows.shape
        self.bias = int(max(np.abs(rows).max(initial=0), 1)) if rows.size else 1
        self.rows = rows = rows.astype(object) if self.bias >= 1 << 32 else rows
        self.sums = rows.sum(axis=1) if rows.size else np.zeros(self.n, dtype=np.int64)
        self.words: dict[int, list[int]] = {}

    def packed(self, width: int) -> list[int]:
        if width not in self.words:
            biased = self.rows + self.bias
            if width <= 8:
                columns = np.ascontiguousarray(biased.T.astype(f"<u{width}"))
                self.words[width] = [int.from_bytes(c.tobytes(), "little") for c in columns]
            else:
                self.words[width] = [int.from_bytes(b"".join(int(v).to_bytes(width, "little") for v in c), "little") for c in biased.T]
        return self.words[width]

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Inner products of all candidates with an anchor of as many components."""
        own = max(1, *map(abs, anchor)) if anchor else 1
        width = field_bytes(self.dims, own, self.bias)
        total = sum(map(mul, [a + own for a in anchor], self.packed(width)))
        data = total.to_bytes(self.n * width, "little")
        off = self.bias * sum(anchor) + self.dims * own * self.bias
        if width == 4:
            return np.frombuffer(data, dtype="<u4").astype(np.int64) - own * self.sums - off
        if width == 8:  # differences modulo 2^64 are exact: the result is below 2^62
            fields = np.frombuffer(data, dtype="<u8") - np.uint64(off % (1 << 64))
            return (fields - (self.sums.astype(np.int64) * np.int64(own)).view(np.uint64)).view(np.int64)
        fields = [int.from_bytes(data[i : i + width], "little") for i in range(0, len(data), width)]
        return np.array([f - own * int(s) - off for f, s in zip(fields, self.sums)], dtype=object)


class Block:
    """Candidates with ids, in order of their ids; those with large components
    are packed by themselves, so that they do not widen the fields of the others."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        most = np.array([int(np.abs(r).max(initial=0)) for r in rows[order]], dtype=object) if rows.dtype == object else np.abs(rows[order]).max(axis=1, initial=0)
        kind = sum((most > s).astype(np.int64) for s in SIZES) if len(ids) else np.zeros(0, dtype=np.int64)
        parts = [order[kind == k] for k in range(len(SIZES) + 1)]
        self.ids = np.concatenate([ids[p] for p in parts])
        self.at = np.concatenate(parts)
        self.parts = [Packed(_narrow(rows[p])) for p in parts if len(p)]

    def scores(self, anchor: list[int]) -> np.ndarray:
        found = [p.scores(anchor) for p in self.parts]
        return found[0] if len(found) == 1 else np.concatenate([f.astype(object) for f in found]) if any(f.dtype == object for f in found) else np.concatenate(found or [np.zeros(0, dtype=np.int64)])


def _narrow(rows: np.ndarray) -> np.ndarray:
    if rows.dtype == object and rows.size and max(map(abs, rows.ravel().tolist())) < 1 << 62:
        return rows.astype(np.int64)
    return rows


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` by higher score, then smaller id."""
    if len(scores) > 4 * n and scores.dtype != object:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return np.array(sorted(some.tolist(), key=lambda i: (-int(scores[i]), int(ids[i])))[:n], dtype=np.int64)


def score_window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest negative score: low * p <= 100 * s <= high * p."""
    return -(-low * positive // 100), high * positive // 100


def _long(score) -> int:
    return max(-MOST_LONG - 1, min(MOST_LONG, int(score)))


# -- cells ------------------------------------------------------------------------
def _matrix(lists: pa.ChunkedArray, dims: int, scale: int) -> np.ndarray:
    """Whole components, one vector a row, short ones filled up."""
    column = lists.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, dtype=np.int64)
    flat = whole(column.flatten().to_numpy(zero_copy_only=False), scale)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), dtype=flat.dtype)
    if flat.dtype == object:
        out[:] = 0
    at = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[at, within] = flat
    return out


def _dims(*columns: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.combine_chunks().offsets.to_numpy()).max(initial=0)) for c in columns if len(c)), default=0)


POSITIVES = "anchor_id long, positive_id long, score long"
NEGATIVES = "anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long"


def _positives(scale: int, n: int):
    """Of a cell: each anchor's best rows of its own label."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if rows.num_rows and anchors.num_rows:
            dims = _dims(rows.column("vector"), anchors.column("vector"))
            ids, labels, made = rows.column("id").to_numpy(), rows.column("label").to_numpy(), _matrix(rows.column("vector"), dims, scale)
            blocks = {int(x): Block(ids[labels == x], made[labels == x]) for x in np.unique(labels)}
            wanted = _matrix(anchors.column("vector"), dims, scale)
            for own, label, vector in zip(anchors.column("id").to_pylist(), anchors.column("label").to_pylist(), wanted):
                if (block := blocks.get(label)) is not None:
                    other = np.flatnonzero(block.ids != own)
                    scores, found = block.scores([int(v) for v in vector])[other], block.ids[other]
                    out += [(own, int(found[i]), _long(scores[i])) for i in best(scores, found, n)]
        return _table(out, POSITIVES)

    return run


def _negatives(scale: int, n: int, low: int, high: int):
    """Of a cell: for each anchor and positive the first rows of other labels
    within the scores."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple[int, ...]] = []
        if rows.num_rows and anchors.num_rows:
            dims = _dims(rows.column("vector"), anchors.column("vector"))
            block = Block(rows.column("id").to_numpy(), _matrix(rows.column("vector"), dims, scale))
            labels = rows.column("label").to_numpy()[block.at]
            wanted = _matrix(anchors.column("vector"), dims, scale)
            for own, label, vector, positives in zip(anchors.column("id").to_pylist(), anchors.column("label").to_pylist(), wanted, anchors.column("positives").to_pylist()):
                scores = block.scores([int(v) for v in vector])
                windows = [score_window(p["score"], low, high) for p in positives]
                most, least = max(w[1] for w in windows), min(w[0] for w in windows)
                may = np.flatnonzero((labels != label) & (block.ids != own) & (scores >= least) & (scores <= most))
                if not len(may):
                    continue
                scores, found = scores[may], block.ids[may]
                for place, (p, (lo, hi)) in enumerate(zip(positives, windows)):
                    some = np.flatnonzero((scores >= lo) & (scores <= hi))
                    out += [(own, place, p["id"], p["score"], int(found[some[i]]), _long(scores[some[i]])) for i in best(scores[some], found[some], n)]
        return _table(out, NEGATIVES)

    return run


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.table([pa.array(c, pa.int32() if k == "int" else pa.int64()) for c, k in zip(columns, kinds)], names=list(names))


# -- the operator --------------------------------------------------------------------
def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vector) of the rows that take part."""
    finite = F.expr(f"NOT exists(`{vector_col}`, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))")
    known = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()
    return rows.where(known & finite).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"))


def _dealt(rows: DataFrame, groups: int) -> Column:
    """The group of a row by its number, so that equal rows are spread as well."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("long")


def _first(rows: DataFrame, by: list[str], score: str, own_id: str, n: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(own_id))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine_hard_negatives(
    rows: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score); ``anchor`` is a condition on the column ``id``."""
    plain = usable(rows, id_col, vector_col, label_col)
    anchors = plain.where(anchor).groupBy(F.col("id").alias("own")).agg(F.min(F.struct("label", "vector")).alias("m")).select(F.col("own").alias("id"), "m.label", "m.vector")
    n = plain.agg(F.count(F.lit(1)).alias("n"), F.count_if(anchor).alias("a")).first()
    row_groups, anchor_groups = -(-n["n"] // ROWS_A_GROUP) or 1, -(-n["a"] // ANCHORS_A_GROUP) or 1
    cells = row_groups * anchor_groups
    candidates = plain.withColumn("r", _dealt(plain, row_groups)).withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(anchor_groups - 1).cast("long"))))

    def meet(wanted: DataFrame, fn, schema: str) -> DataFrame:
        placed = wanted.withColumn("c", F.pmod(F.xxhash64("id"), F.lit(anchor_groups)).cast("long")).withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_groups - 1).cast("long"))))
        sides = [x.withColumn("cell", F.col("r") * anchor_groups + F.col("c")).drop("r", "c").repartition(cells, "cell").groupBy("cell") for x in (candidates, placed)]
        return sides[0].cogroup(sides[1]).applyInArrow(fn, schema)

    found = _first(meet(anchors, _positives(scale, n_positives), POSITIVES), ["anchor_id"], "score", "positive_id", n_positives)
    positives = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("positive_id").alias("id"), "score"))).alias("positives"))
    known = anchors.join(positives, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    negatives = _first(meet(known, _negatives(scale, n_negatives, low, high), NEGATIVES), ["anchor_id", "place"], "negative_score", "negative_id", n_negatives)
    return negatives.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
