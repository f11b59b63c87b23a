"""Operator 8: n-gram Jaccard join of whole documents, size-aware.

A document's set holds the hashes of its distinct five-word shingles. Two
documents link when 100 |A and B| >= 80 |A or B|. Equal sets are one class; the
join runs over classes, so copies cost one row each.

* Light sets (few shingles) enumerate all their subsets of the sizes at which a
  partner of an admissible size must overlap. Two sets of sizes a and b with an
  overlap of c = ceil(4 (a + b) / 9) link, so sets that share such a subset need
  no check, and linking each to the smallest set of the subset keeps all
  components.
* Heavy sets are found through inverted lists of the first shingles of each set
  in one global order (a set that shares none of them with another cannot reach
  the threshold). The order puts shingles of long lists last, so a passage that
  many documents share is no candidate maker. Scanning the lists counts the
  first shingles that two sets have in common; the count and the sizes bound
  the overlap from above. Candidates pass this bound, one by sketches of the sets
  (counts of their hashes, a twentieth of a set; both lose no link) and are checked
  on their whole sets.

The boundary between light and heavy is chosen by cost from the counts of sizes.
Sets near the boundary do both, so that light and heavy partners meet.

The texts are read once: their sets are written (five bytes a shingle) and every
later pass reads these. Sets are compared by hashes of 40 bits, so two different
shingles of sets of n fall together with a probability of about n^2 / 2^40.

Nothing grows in one place: a posting whose shingle is in one class only never
leaves its task (a filter of fixed size, built from partial minima and maxima,
tells), long lists are compared with a centre and then by component (links.py),
and the whole sets of candidates only are shuffled.

Defined results: null and empty texts and texts of white space have no shingles
and link with nothing; shorter texts than five words are one shingle; texts of
any length are read whole; rows without id are left out of the join and give
their n_shingles with a null component; rows of one id count as one document if
their sets are equal, else each set links under that id; other columns are
ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from itertools import combinations
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import Memo, forget, gives_back, id_and_text, kept_in_stage, shared_path, stored
from mercato.llm.links import Bloom, bits_for, bloom, components, list_links

SHINGLE = 5
#: Similarity as a fraction; 4/9 = (4/5) / (1 + 4/5).
NUM, DEN = 4, 5
#: A shingle with more postings than this (counted within tasks) goes last.
LONG_LIST = 64
#: Largest size that may be light, and the cost of checking a posting against
#: that of making one.
MOST_LIGHT = 16
CHECK_COST = 4.0
#: Shingles that are counted at once in a task.
COUNT_AT_ONCE = 1_500_000


def least_overlap(a: int, b: int) -> int:
    return -(-NUM * (a + b) // (NUM + DEN))


def least_partner(n: int) -> int:
    return -(-NUM * n // DEN)


def most_partner(n: int) -> int:
    return DEN * n // NUM


def subset_sizes(n: int) -> list[int]:
    """Sizes of subsets that a set of ``n`` enumerates."""
    return sorted({least_overlap(n, b) for b in range(max(1, least_partner(n)), most_partner(n) + 1)})


def prefix_length(n):
    """Shingles of a set of ``n`` that can meet an equal or smaller partner."""
    return n - -(-NUM * n // DEN) + 1


def index_length(n):
    """Shingles that can meet an equal or larger partner."""
    return n - -(-2 * NUM * n // (NUM + DEN)) + 1


_word_hash = Memo(lambda w: xxhash.xxh3_64_intdigest(w), 100_000)
kept_in_stage(_word_hash.clear)
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def spread(short: np.ndarray) -> np.ndarray:
    """Filter keys of shortened hashes; the same in SQL: short * 2^24 + short."""
    return ((short << np.uint64(SHORT)) | (short & np.uint64((1 << SHORT) - 1))).view(np.int64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M[1]
    h = (h ^ (h >> np.uint64(29))) * _M[2]
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(_word_hash.__getitem__, words), dtype=np.uint64, count=n)
    take = min(SHINGLE, n)
    out = np.full(n - take + 1, np.uint64(take), dtype=np.uint64)
    for i in range(take):
        out = _mix(out * _M[0] + h[i : n - take + 1 + i])
    return np.unique(out)


def set_id(s: np.ndarray) -> int:
    """Identity of a set as a signed 64-bit integer."""
    return xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s)) - (1 << 63)


def ordered(s: np.ndarray, late: Bloom | None) -> np.ndarray:
    """The set in the global order: long lists last, else by hash."""
    if late is None or not len(s):
        return s
    is_late = late.has(spread(s >> np.uint64(SHORT)))
    return np.concatenate([s[~is_late], s[is_late]])


# -- the sets, written once ----------------------------------------------------
SETS = "doc_id long, id long, n long, s binary"
WIDTH = 5


def pack_set(s: np.ndarray) -> bytes:
    """The highest 40 bits of each hash."""
    return s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes()


def unpack_set(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // WIDTH, 8), dtype=np.uint8)
    out[:, :WIDTH] = np.frombuffer(data, dtype=np.uint8).reshape(-1, WIDTH)
    return out.view(">u8").ravel().astype(np.uint64)


def _sets(docs: DataFrame) -> DataFrame:
    """One row per document: id and size of its set, and the set itself unless
    the batch has had it."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: set[int] = set()
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                ids, sizes, packed = [], [], []
                for value in part.column(1):
                    s = shingle_set(value.as_py())
                    own = set_id(s)
                    ids.append(own)
                    sizes.append(len(s))
                    packed.append(None if own in seen or not len(s) else pack_set(s))
                    seen.add(own)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())], names=["doc_id", "id", "n", "s"])

    return id_and_text(docs).mapInArrow(run, SETS)


def _filled(sets: DataFrame) -> DataFrame:
    return sets.where("s IS NOT NULL").select("id", "s")


def _each(b: pa.RecordBatch, lo: int, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(id, set) of the rows of a slice, each set once."""
    seen: set[int] = set()
    part = b.slice(lo, size)
    for own, data in zip(part.column(0).to_pylist(), part.column(1)):
        if own not in seen:
            seen.add(own)
            yield own, unpack_set(data.as_py())


def _counts(sets: DataFrame) -> DataFrame:
    """(key, n): the filter key of a shingle and how often a part of a task has seen it in
    different sets, twice at least."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def counted() -> pa.RecordBatch:
            nonlocal held, size, seen
            every = np.sort(np.concatenate(held)) if held else np.empty(0, dtype=np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, dtype=np.int64)
            n = np.diff(np.append(starts, len(every)))
            keep = n > 1
            held, seen, size = [], set(), 0
            return pa.RecordBatch.from_arrays([pa.array(spread(every[starts[keep]] >> np.uint64(SHORT))), pa.array(n[keep], pa.int64())], names=["key", "n"])

        for b in batches:
            for own, s in _each(b, 0, b.num_rows):
                if own not in seen:
                    seen.add(own)
                    held.append(s)
                    size += len(s)
                if size > COUNT_AT_ONCE:
                    yield counted()
        yield counted()

    return _filled(sets).mapInArrow(run, "key long, n long")


def _first_shingles(sets: DataFrame, late: Bloom, light: int) -> DataFrame:
    """(token, id) of the first shingles of every heavy set, each set once a
    batch; the hashes are cut short, as only a filter is made of them."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens, ids = [], []
            for own, s in _each(b, 0, b.num_rows):
                if most_partner(len(s)) > light:
                    first = ordered(s, late)[: prefix_length(len(s))]
                    tokens.append(first)
                    ids.append(np.full(len(first), own & 0x7FFFFFFF, dtype=np.int64))
            if tokens:
                every = np.concatenate(tokens) >> np.uint64(SHORT)
                yield pa.RecordBatch.from_arrays([pa.array(every.view(np.int64), pa.int64()), pa.array(np.concatenate(ids), pa.int64())], names=["token", "id"])

    return _filled(sets).mapInArrow(run, "token long, id long")


#: Bits dropped of a shingle for the filter of shared shingles (the lowest 24
#: bits of an unpacked one are zero).
SHORT = 24

FOUND = "kind int, token long, id long, n int, pos int, histogram array<smallint>, sketch binary"

#: Shingles of a set by the highest seven bits of their hashes. The sum of the
#: smaller counts of two sets bounds their overlap from above; larger sets than
#: this have no histogram (a count might pass its type) and go to the whole check.
MOST_HISTOGRAM = 1_000_000


def histogram(s: np.ndarray) -> np.ndarray | None:
    return np.bincount((s >> np.uint64(57)).astype(np.int64), minlength=128).astype(np.int16) if len(s) <= MOST_HISTOGRAM else None


def sketch(s: np.ndarray) -> bytes | None:
    """Counts of the shingles of a set by the highest bits of their hashes, a byte each, as
    many that 2 to 4 shingles share one (and sets of over 512 shingles can be told
    apart); None if a count passes its byte."""
    bits = max(5, (len(s) // 4).bit_length())
    counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def most_common(x: bytes, y: bytes) -> tuple[int, int]:
    """The most shingles that sets of these sketches can have in common, and the sum
    of their sizes. The longer sketch is added up to the counts of the shorter."""
    p, q = (np.frombuffer(z, dtype=np.uint8).astype(np.int64) for z in (x, y))
    width = min(len(p), len(q))
    p, q = p.reshape(width, -1).sum(axis=1), q.reshape(width, -1).sum(axis=1)
    return int(np.minimum(p, q).sum()), int(p.sum() + q.sum())


def _postings(sets: DataFrame, late: Bloom, shared: Bloom, light: int) -> DataFrame:
    """kind 0: postings of heavy sets that another set may share; kind 1: the
    subsets of light sets (pos = their size); kind 2: histograms and sketches of the
    sets of kind 0. Each set comes once a batch."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FOUND.split(", ")]
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                kind, token, ids, size, pos, hists, sketches = [], [], [], [], [], [], []

                def rows(k: int, t: list[int], i: int, n: int, p: list[int]) -> None:
                    kind.extend([k] * len(t))
                    token.extend(t)
                    ids.extend([i] * len(t))
                    size.extend([n] * len(t))
                    pos.extend(p)
                    hists.extend([None] * len(t))
                    sketches.extend([None] * len(t))

                for own, s in _each(b, lo, 1000):
                    n = len(s)
                    if n <= light:
                        for c in subset_sizes(n):
                            keys = [xxhash.xxh3_64_intdigest(np.array(x, dtype=np.uint64).tobytes(), seed=c) - (1 << 63) for x in combinations(s.tolist(), c)]
                            rows(1, keys, own, n, [c] * len(keys))
                    if most_partner(n) > light:
                        first = ordered(s, late)[: prefix_length(n)]
                        may = np.flatnonzero(shared.has(spread(first >> np.uint64(SHORT))))
                        if len(may):
                            rows(0, first[may].view(np.int64).tolist(), own, n, may.tolist())
                            rows(2, [0], own, n, [0])
                            hists[-1], sketches[-1] = histogram(s), sketch(s)
                if kind:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((kind, token, ids, size, pos, hists, sketches), FOUND_KINDS)], names=names)

    return _filled(sets).mapInArrow(run, FOUND)


FOUND_KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int16()), pa.binary()]


def _wanted(own: DataFrame, wanted: Bloom) -> DataFrame:
    """The rows (id, s) that pass the filter, before anything is shuffled."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(wanted.has(b.column(0).to_numpy(zero_copy_only=False))))

    return own.mapInArrow(run, "id long, s binary")


def _may_pairs(both: DataFrame) -> DataFrame:
    """The (a, b) of rows (a, b, sa, sb) whose sketches, if there are both, allow the
    similarity."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                common, both = most_common(x, y) if x and y else (1, 0)
                keep.append((NUM + DEN) * common >= NUM * both)
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _with_both(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """(a, b, sa, sb): the pairs with what ``own`` (id, s) has of both."""
    a, b = (own.select(F.col("id").alias(side), F.col("s").alias(f"s{side}")) for side in "ab")
    return pairs.join(a, "a").join(b, "b")


def _similar_pairs(both: DataFrame) -> DataFrame:
    """The (a, b) of rows (a, b, sa, sb) whose sets have the similarity."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                p, q = unpack_set(x.as_py()), unpack_set(y.as_py())
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(DEN * common >= NUM * (len(p) + len(q) - common))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


# -- boundary ----------------------------------------------------------------
def light_boundary(counts: dict[int, int], most: int = MOST_LIGHT, check_cost: float = CHECK_COST) -> int:
    """The largest light size by cost: a light set of n costs its subsets; a
    heavy one its first shingles, each made and looked up, and its check."""
    best, best_cost = 0, None
    for light in range(0, most + 1):
        cost = 0.0
        for n in range(1, most_partner(most) + 1):
            each = 0.0
            if n <= light:
                each += sum(comb(n, c) for c in subset_sizes(n))
            if most_partner(n) > light:
                each += prefix_length(n) * (1 + check_cost)
            cost += counts.get(n, 0) * each
        if best_cost is None or cost <= best_cost:
            best, best_cost = light, cost
    return best


# -- the join ----------------------------------------------------------------
def light_links(rows: DataFrame) -> DataFrame:
    """Links of light sets: each set of a subset with the smallest set of it, if
    the subset is as large as the overlap that the two sizes ask for."""
    keys = rows.where("kind = 1").select("token", "id", "n", F.col("pos").alias("c"))
    first = keys.groupBy("token").agg(F.min(F.struct("n", "id")).alias("m"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi")
    first = first.select(F.col("token").alias("of"), F.col("m.n").alias("first_n"), F.col("m.id").alias("first_id"))
    pair = keys.join(first, F.col("token") == F.col("of")).where("id <> first_id")
    enough = (NUM + DEN) * F.col("c") >= NUM * (F.col("n") + F.col("first_n"))
    return pair.where(enough).select(F.least("id", "first_id").alias("a"), F.greatest("id", "first_id").alias("b")).distinct()


def _pair_filter(x: str, y: str):
    """x is the smaller set: the shingle lies among its index shingles, the
    sizes allow the similarity, and so do the shingles left behind this one."""
    nx, ny = F.col(f"{x}_n"), F.col(f"{y}_n")
    px, py = F.col(f"{x}_pos"), F.col(f"{y}_pos")
    index = px < nx - F.ceil(2 * NUM * nx / (NUM + DEN)) + 1
    rest = 1 + F.least(nx - px - 1, ny - py - 1)
    return (nx <= ny) & (NUM * ny <= DEN * nx) & index & ((NUM + DEN) * rest >= NUM * (nx + ny))


def _could_overlap(c, n, m):
    """Whether sets of n and m shingles with c first shingles in common can link:
    those behind the first ones of either set are all that can come on top."""
    behind = F.ceil(NUM * F.greatest(n, m) / DEN) - 1
    return (NUM + DEN) * (c + behind) >= NUM * (n + m)


def set_classes(docs: DataFrame, light: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, classes): (doc_id, set_id, n) of all rows, and (id, component) of
    the sets that link with others; component is a set's id."""
    spark = docs.sparkSession
    path = shared_path(spark, "shingles")
    _sets(docs).write.parquet(f"{path}/sets")
    sets = spark.read.parquet(f"{path}/sets")
    rows = sets.select("doc_id", F.col("id").alias("set_id"), "n")
    # postings by which two sets may meet: some for each document
    bits = bits_for(8 * sets.count())
    late = bloom(_counts(sets).groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > LONG_LIST).select("key"), "key", bits)
    if light is None:
        counted = rows.where(F.col("n") <= most_partner(MOST_LIGHT)).groupBy("n").agg(F.countDistinct("set_id").alias("sets")).collect()
        light = light_boundary({r["n"]: r["sets"] for r in counted})
    # shingles that two sets have among their first ones; partial minima and maxima
    twice = _first_shingles(sets, late, light).groupBy("token").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi")
    shared = bloom(twice.select(F.expr(f"shiftleft(token, {SHORT}) | (token & {(1 << SHORT) - 1}L)").alias("key")), "key", bits)
    _postings(sets, late, shared, light).write.parquet(f"{path}/found")
    found = spark.read.parquet(f"{path}/found")
    postings = found.where("kind = 0").groupBy("token", "id").agg(F.min("n").alias("n"), F.min("pos").alias("pos"))
    known = stored(found.where("kind = 2").groupBy("id").agg(F.min("n").alias("m"), F.first("histogram").alias("h"), F.first("sketch").alias("s")))
    hists = known.select("id", "m", "h")
    light_found = stored(light_links(found))

    def ready(ids: DataFrame) -> None:
        forget(spark, f"{path}/found")  # the postings are stored by now

    def ends(pairs: DataFrame) -> Bloom:
        return bloom(pairs.select(F.explode(F.array("a", "b")).alias("used")), "used", bits)

    def verify(pairs: DataFrame) -> DataFrame:
        sketches = _wanted(known.select("id", "s"), ends(pairs))
        pairs = stored(_may_pairs(_with_both(pairs, sketches)))
        own = _wanted(_filled(sets), ends(pairs)).groupBy("id").agg(F.first("s").alias("s"))
        return _similar_pairs(_with_both(pairs, own))

    narrow = (lambda x, y: NUM * F.greatest(F.col(f"{x}_n"), F.col(f"{y}_n")) <= DEN * F.least(F.col(f"{x}_n"), F.col(f"{y}_n")), _could_overlap, "n")
    links = list_links(postings, _pair_filter, verify, "pos < 4", light_found, hists, _may_overlap, narrow, ready)
    return rows, components(links)


def _may_overlap(x: str, y: str):
    """Whether the histograms of two sets (h, of m shingles) allow the overlap."""
    most = F.expr(f"aggregate(zip_with({x}_h, {y}_h, (p, q) -> least(p, q)), 0, (s, v) -> s + v)")
    enough = (NUM + DEN) * most >= NUM * (F.col(f"{x}_m") + F.col(f"{y}_m"))
    return F.col(f"{x}_h").isNull() | F.col(f"{y}_h").isNull() | enough


def _placed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, set_id, c) of the different (doc_id, set) pairs that have shingles,
    with their class."""
    pairs = rows.where("n > 0").select("doc_id", "set_id").distinct()
    named = pairs.join(labels, F.col("set_id") == F.col("id"), "left")
    return stored(named.select("doc_id", "set_id", F.coalesce("component", "set_id").alias("c")))


def jaccard_components(docs: DataFrame, light: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document: the smallest doc_id
    reachable by links, its own if there are none."""
    rows, labels = set_classes(docs, light)
    named = _placed(rows, labels).where("doc_id IS NOT NULL")
    least = named.groupBy("c").agg(F.min("doc_id").alias("component"))
    classes = named.select("set_id", "c").distinct().join(least, "c").select(F.col("set_id").alias("of"), "component")
    out = rows.join(classes, F.col("set_id") == F.col("of"), "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _own_sets(plain: DataFrame, text: str) -> DataFrame:
    """``plain`` with the id of the row's own set as ``own`` and its size as ``own_n``."""
    with_text = plain.withColumn("own_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in plain.schema.fields], T.StructField("own", T.LongType()), T.StructField("own_n", T.LongType())])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py()) for t in b.columns[-1]]
            own, n = pa.array([set_id(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], own, n], names=schema.names)

    return with_text.mapInArrow(run, schema)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, of each class of near copies one row: one with
    the smallest doc_id (rows without id only if the class has no other), of several
    texts of that id the one with the smallest set id, of equal ones any. Rows
    without shingles stay. Ids that one row has are decided by the id; rows of
    repeated ids and rows without id are told by their sets, built again for them."""
    rows, labels = set_classes(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    placed = _placed(rows, labels)
    first = placed.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "set_id")).alias("m"))
    first = first.select("c", F.col("m.doc_id").alias("first_id"), F.col("m.set_id").alias("first_set"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("set_id") == F.col("first_set"))
    marked = placed.join(first, "c").select("doc_id", "set_id", is_first.alias("first"))
    ids = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    several = stored(ids.where("rows > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("several")))
    gone = marked.where("NOT first AND doc_id IS NOT NULL").select(F.col("doc_id").alias("gone"))
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)], F.col(id_col).cast("long").alias("of"))
    names = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    leaving = stored(gone.unionByName(several.where("several IS NOT NULL").select(F.col("several").alias("gone"))).distinct())
    kept = plain.where("of IS NOT NULL").join(leaving, F.col("of") == F.col("gone"), "left_anti")
    if several.isEmpty():
        return kept.select(*names)
    own = _own_sets(plain.join(several, F.col("of").eqNullSafe(F.col("several")), "left_semi"), f"c{docs.columns.index(text_col)}")
    chosen = marked.where("first").select(F.col("doc_id").alias("first_id"), F.col("set_id").alias("first_set"))
    copies = own.where("own_n > 0").join(chosen, F.col("of").eqNullSafe(F.col("first_id")) & (F.col("own") == F.col("first_set")), "left_semi")
    one = Window.partitionBy("of", "own").orderBy(F.lit(0))
    copies = copies.withColumn("nth", F.row_number().over(one)).where("nth = 1").drop("nth")
    return kept.select(*names).union(copies.select(*names)).union(own.where("own_n = 0").select(*names))
