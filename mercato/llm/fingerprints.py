"""Operator 7: document fingerprints by consistent weighted sampling.

DataFrame functions only. The terms of a text are its words, weighted by their
number. For sample k a term of weight S draws, from hashes of the term and k
alone, r and c from Gamma(2, 1) and b from [0, 1); with t = floor(ln S / r + b)
and ln y = r (t - b) its rank is ln a = ln c - ln y - r, and the sample is the
(term, t) of least rank. Two texts share a sample with the probability of their
generalised Jaccard similarity, the sum of the smaller over the sum of the
larger weights.

A rank and the hash of (term, t) are packed into one long (rank above), so that
a sample is a plain minimum of longs: one row per distinct term is made inside
the task that holds the text, its partial minimum leaves the task as one row per
text, and long texts or common words weigh no more than their terms.

The query also compares each document with an edited text that takes its second
half from the next document (descending ids, the last one followed by the
first). For that the documents are dealt by ranges of ids into many small
buckets, sorted in each, and the first document of the next bucket is added to
each as a guest; only ids (to find the ranges) and one copy of the texts are
shuffled.

Defined results: null text is empty; texts of any length are read whole; an
empty text has the empty fingerprint, alike (1.0) to another empty one and
unlike (0.0) to all others; documents without id come last; repeated ids follow
one another, ordered by the hash of the text; each row gives one row; other
columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import WORD_BREAK, shared_path

SAMPLES = 32
#: Samples drawn from one row; SAMPLES is a multiple.
EACH = 8
#: Buckets of ids for each shuffle partition, and at most.
BUCKETS_PER_PARTITION = 8
MOST_BUCKETS = 4096
#: Bits of a uniform number, and the scale that makes a rank a positive integer.
BITS = 25
RANK_OFFSET, RANK_SCALE = 128.0, float(1 << 23)


def _uniform(h: str, shift: int) -> str:
    return f"((shiftrightunsigned({h}, {shift}) & {(1 << BITS) - 1}L) + 0.5D) * {2.0 ** -BITS!r}D"


def sample_at(j: int, each: int) -> Column:
    """Packed (rank, hash of term and t) of a row with ``term``, ``ln_s`` and
    ``part``: sample number ``part * each + j``."""
    k = f"(part * {each} + {j})"
    h1, h2 = f"xxhash64(term, {k})", f"xxhash64({k}, term)"
    r = f"(-ln({_uniform(h1, 0)} * {_uniform(h1, BITS)}))"
    b = f"(shiftrightunsigned({h1}, {2 * BITS}) * {2.0 ** -(64 - 2 * BITS)!r}D)"
    ln_c = f"ln(-ln({_uniform(h2, 0)} * {_uniform(h2, BITS)}))"
    t = f"floor(ln_s / {r} + {b})"
    rank = f"cast((({ln_c} - {r} * ({t} - {b} + 1.0D)) + {RANK_OFFSET}D) * {RANK_SCALE!r}D as bigint)"
    return F.expr(f"shiftleft({rank}, 32) | (xxhash64({h2}, {t}) & 4294967295L)")


def weighted_terms(texts: DataFrame, text_col: str, keys: list[str]) -> DataFrame:
    """One row per key and distinct word: its hash ``term`` and ``ln_s``, the
    logarithm of its count; one row with nulls for a text without words. Made row
    by row, without a shuffle."""
    w = texts.select(*keys, F.array_remove(F.split(text_col, WORD_BREAK), "").alias("w"))
    w = w.select(*keys, F.expr("sort_array(transform(w, x -> xxhash64(x)))").alias("h"))
    # where a run of equal hashes begins; the last entry is the end
    w = w.select(*keys, "h", F.expr("zip_with(concat(array(cast(null as bigint)), h), h, (a, b) -> b is not null and (a is null or a <> b))").alias("new"))
    # no lambda names another array: it would be built anew for each element
    w = w.select(
        *keys,
        F.expr("array_compact(zip_with(h, new, (t, first) -> if(first, t, null)))").alias("term"),
        F.expr("concat(array_compact(transform(new, (first, i) -> if(first, i, null))), array(size(new)))").alias("at"),
    )
    w = w.select(*keys, "term", F.expr("zip_with(slice(at, 1, size(at) - 1), slice(at, 2, size(at) - 1), (a, b) -> b - a)").alias("n"))
    w = w.select(*keys, F.arrays_zip("term", "n").alias("terms"))
    # outer: no filter on the arrays is inferred, which would build them twice
    rows = w.select(*keys, F.explode_outer("terms").alias("x"))
    return rows.select(*keys, F.col("x.term").alias("term"), F.expr("ln(cast(x.n as double))").alias("ln_s"))


def signatures(texts: DataFrame, text_col: str, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """The keys and ``fingerprint`` of every text, also of one without words.

    A row of a term draws ``EACH`` samples; a few rows a term keep the generated
    code small enough to be compiled."""
    terms = weighted_terms(texts, text_col, keys)
    parts = F.explode(F.sequence(F.lit(0), F.lit(samples // EACH - 1))).alias("part")
    drawn = terms.select("*", parts).groupBy(*keys, "part").agg(*[F.min(sample_at(j, EACH)).alias(f"s{j}") for j in range(EACH)])
    one = drawn.groupBy(*keys).agg(F.collect_list(F.struct("part", _digits())).alias("x"))
    return one.select(*keys, _joined().alias("fingerprint"))


def _digits() -> Column:
    """The samples of a part as bytes: four each, none without a term."""
    each = [F.lpad(F.hex(F.col(f"s{j}").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0") for j in range(EACH)]
    return F.when(F.col("s0").isNull(), F.lit(b"")).otherwise(F.unhex(F.concat(*each))).alias("d")


def _joined() -> Column:
    """The parts in order as hexadecimal digits."""
    return F.lower(F.expr("array_join(transform(array_sort(x), p -> hex(p.d)), '')"))


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints."""
    x, y = F.col(a), F.col(b)
    same = sum((F.substring(x, 8 * k + 1, 8) == F.substring(y, 8 * k + 1, 8)).cast("int") for k in range(samples))
    return F.when((x == "") | (y == ""), (x == y).cast("double")).otherwise(same / F.lit(float(samples)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(doc_id, fingerprint) of every text; rows of one id and text give one row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = rows.withColumn("text_hash", F.xxhash64("text"))
    return signatures(keyed, "text", ["doc_id", "text_hash"], samples).select("doc_id", "fingerprint")


# -- next documents ----------------------------------------------------------
def _bucket(bounds: list[int]) -> Column:
    """The bucket of an id (descending ids, none last): how many bounds lie
    above it, by a look at every 64th bound and then at 64 of them."""
    step = 64
    down = sorted(set(bounds), reverse=True)
    groups = [down[i : i + step] for i in range(0, len(down), step)]
    if not groups:
        return F.when(F.col("doc_id").isNull(), F.lit(1)).otherwise(F.lit(0))
    tops = F.array(*[F.lit(g[-1]).cast("long") for g in groups])
    whole = F.size(F.filter(tops, lambda x: x > F.col("doc_id")))
    nested = F.array(*[F.array(*[F.lit(v).cast("long") for v in g]) for g in groups], F.array().cast("array<bigint>"))
    rest = F.size(F.filter(F.element_at(nested, whole + 1), lambda x: x > F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), F.lit(len(down) + 1)).otherwise(whole * step + rest)


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text, text_hash) and next_id, next_hash, next_text: the
    following row by descending doc_id and text_hash; the last's is the first."""
    spark = docs.sparkSession
    if buckets is None:
        buckets = min(MOST_BUCKETS, BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.select("doc_id")
    points = [i / buckets for i in range(1, buckets)]
    # a bounded number of ids reaches the driver: bounds and first rows of buckets
    bounds = ids.agg(F.percentile_approx("doc_id", points, 100_000).alias("p")).first()["p"] or []
    rows = docs.withColumn("bucket", _bucket(bounds))
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text_hash")
    firsts = {r["bucket"]: r["first"] for r in rows.groupBy("bucket").agg(F.max(order).alias("first")).collect()}
    if not firsts:
        return docs.select("*", F.lit(None).cast("long").alias("next_id"), F.lit(None).cast("long").alias("next_hash"), F.lit(None).cast("string").alias("next_text"))
    used = sorted(firsts)
    # the first row of each bucket is a guest in the one before it
    guests = [(b, before, firsts[b]["doc_id"], firsts[b]["text_hash"]) for before, b in zip([used[-1], *used], used)]
    table = spark.createDataFrame(guests, "guest_of int, to_bucket int, guest_id long, guest_hash long")
    match = (F.col("bucket") == F.col("guest_of")) & F.col("doc_id").eqNullSafe(F.col("guest_id")) & (F.col("text_hash") == F.col("guest_hash"))
    marked = rows.join(F.broadcast(table), match, "left")
    places = F.when(F.col("to_bucket").isNull(), F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("guest")))).otherwise(
        F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("guest")), F.struct(F.col("to_bucket").alias("b"), F.lit(True).alias("guest")))
    )
    dealt = marked.select("doc_id", "text", "text_hash", F.explode(places).alias("p")).select("doc_id", "text", "text_hash", "p.b", "p.guest")
    w = Window.partitionBy("b").orderBy(F.col("guest").asc(), F.col("doc_id").desc_nulls_last(), F.col("text_hash").desc())
    lead = [F.lead(c).over(w).alias(n) for c, n in (("doc_id", "next_id"), ("text_hash", "next_hash"), ("text", "next_text"))]
    return dealt.select("doc_id", "text", "text_hash", "guest", *lead).where("NOT guest").drop("guest")


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES, buckets: int | None = None) -> DataFrame:
    """One row per document: n_chars, fingerprints of its text and of its edited
    text, and how alike the text's is to the edited and to the next one."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    pairs = with_next(rows, buckets)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    both = pairs.select("doc_id", "text_hash", "next_id", "next_hash", "text", n.cast("long").alias("n_chars"), F.concat(F.left("text", n - half), F.left("next_text", half)).alias("edited"))
    about = ["doc_id", "text_hash", "next_id", "next_hash", "n_chars", "edited_sha"]
    both = both.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text_hash", "next_id", "next_hash", "n_chars", F.unhex(F.sha2("edited", 256)).alias("edited_sha"), "text", "edited")
    texts = F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))
    terms = weighted_terms(both.select("row", *about, F.explode(texts).alias("x")).select("row", *about, F.col("x.which").alias("which"), F.col("x.t").alias("t")), "t", ["row", *about, "which"])
    rows_of_parts = terms.select("*", F.explode(F.sequence(F.lit(0), F.lit(samples // EACH - 1))).alias("part"))
    # what is known about a document travels with one of its groups only
    told = [F.when((F.col("which") == 0) & (F.col("part") == 0), F.col(c)).alias(c) for c in about]
    drawn = rows_of_parts.select("row", "which", "part", *told, "term", "ln_s").groupBy("row", "which", "part", *about).agg(*[F.min(sample_at(j, EACH)).alias(f"s{j}") for j in range(EACH)])
    one = drawn.groupBy("row").agg(F.collect_list(F.struct("which", "part", _digits(), *about)).alias("all"))
    one = one.select(F.expr("array_sort(all)").alias("all"))
    one = one.select(*[F.col("all")[0][c].alias(c) for c in about], *[F.expr(f"lower(array_join(transform(filter(all, p -> p.which = {i}), p -> hex(p.d)), ''))").alias(n) for i, n in ((0, "fingerprint"), (1, "edited_fingerprint"))])
    path = shared_path(spark, "fingerprints")
    one.withColumns({"fingerprint": F.unhex("fingerprint"), "edited_fingerprint": F.unhex("edited_fingerprint")}).write.parquet(path)
    kept = spark.read.parquet(path).withColumns({"fingerprint": F.lower(F.hex("fingerprint")), "edited_fingerprint": F.lower(F.hex("edited_fingerprint"))})
    after = kept.groupBy(F.col("doc_id").alias("after_id"), F.col("text_hash").alias("after_hash")).agg(F.max("fingerprint").alias("next_fingerprint"))
    found = kept.join(after, F.col("next_id").eqNullSafe(F.col("after_id")) & (F.col("next_hash") == F.col("after_hash")), "left")
    return found.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_sha")).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint", samples).alias("near_edited"),
        likeness("fingerprint", "next_fingerprint", samples).alias("near_next"),
    )
