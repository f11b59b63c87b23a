"""Single-pass table profiling: missing values, numeric statistics,
cardinality, rule violations and duplicates, as long-form tables.

The wide statistics are one ``agg`` over the table (partial aggregation on
every executor, one small final merge), unpivoted with ``inline``; what comes
back is bounded by the number of columns and checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from mercato.functions.columns import count_when, missing
from mercato.operators.rules import TableSpec
from mercato.session import stored


def _pct(n: Column, total: Column) -> Column:
    """``round(100 n / total, 2)`` half-even, 0.0 for an empty table."""
    return F.when(total > 0, _round_half_even(F.lit(100.0) * n / total, 2)).otherwise(F.lit(0.0))


def _round_half_even(x: Column, d: int) -> Column:
    return F.bround(x.cast("double").try_cast("decimal(38,9)"), d).cast("double")


# Sub-ranges into which the bracket of a median is cut.
SLICES = 1024


def _first_pass(df: DataFrame, spec: TableSpec, accuracy: int, exact_median: bool, approx_cardinality: bool) -> DataFrame:
    """One aggregate of the source, as one row per column: everything but the exact
    median and the exact cardinality; a bracket for the median."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = [F.count(F.lit(1)).alias("__total")]
    for i, c in enumerate(df.columns):
        exprs.append(count_when(missing(c, types[c])).alias(f"__miss_{i}"))
        if c in spec.numeric_cols:
            x = F.col(c).cast("double")
            # the rank error of the sketch is n / accuracy at most
            q = [max(0.0, 0.5 - 3.0 / accuracy), min(1.0, 0.5 + 3.0 / accuracy)] if exact_median else [0.5, 0.5]
            exprs += [
                F.min(x).alias(f"__min_{i}"), F.max(x).alias(f"__max_{i}"), F.avg(x).alias(f"__mean_{i}"),
                F.stddev_samp(x).alias(f"__std_{i}"), F.count(x).alias(f"__n_{i}"), F.percentile_approx(x, q, accuracy).alias(f"__q_{i}"),
            ]
        if c in spec.cardinality_cols and approx_cardinality:
            exprs.append(F.approx_count_distinct(c).alias(f"__card_{i}"))
    rows = []
    for i, c in enumerate(df.columns):
        num = c in spec.numeric_cols

        def dbl(value: Column, num: bool = num) -> Column:
            return value.cast("double") if num else F.lit(None).cast("double")

        none = F.lit(None)
        card = F.col(f"__card_{i}") if c in spec.cardinality_cols and approx_cardinality else none
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(types[c].simpleString()).alias("dtype"),
                F.coalesce(F.col(f"__miss_{i}"), F.lit(0)).cast("bigint").alias("missing_count"),
                F.coalesce(_pct(F.col(f"__miss_{i}"), F.col("__total")), F.lit(0.0)).alias("missing_pct"),
                dbl(F.col(f"__min_{i}") if num else none).alias("min_value"),
                dbl(F.col(f"__max_{i}") if num else none).alias("max_value"),
                dbl(_round_half_even(F.col(f"__mean_{i}"), 4) if num else none).alias("mean_value"),
                dbl(_round_half_even(F.coalesce(F.col(f"__std_{i}"), F.lit(0.0)), 4) if num else none).alias("std_value"),
                (F.col(f"__n_{i}") if num else none).cast("bigint").alias("n"),
                dbl(F.col(f"__q_{i}")[0] if num else none).alias("lo"),
                dbl(F.col(f"__q_{i}")[1] if num else none).alias("hi"),
                card.cast("bigint").alias("cardinality"),
            )
        )
    return df.agg(*exprs).select(F.lit(spec.source).alias("source"), F.inline(F.array(*rows)))


def _tagged(df: DataFrame, wanted: list[tuple[int, str, tuple[float, float] | None]]) -> DataFrame:
    """Narrow rows (tag, slice, s, x): of a column whose cardinality is wanted every
    value as text, of one whose median is wanted the values inside the bracket
    and one mark for each below it."""
    cells = []
    for tag, c, bracket in wanted:
        text, x = F.col(c).cast("string"), F.col(c).cast("double")
        no_text, no_x = F.lit(None).cast("string"), F.lit(None).cast("double")
        if bracket is None:
            cell = F.when(text.isNotNull(), F.struct(F.lit(tag).alias("tag"), F.lit(-1).alias("slice"), text.alias("s"), no_x.alias("x")))
        else:
            lo, hi = bracket
            part = F.least(F.lit(SLICES - 1), F.floor((x - lo) / (hi - lo) * SLICES)).cast("int") if hi > lo else F.lit(0)
            inside = F.struct(F.lit(tag).alias("tag"), part.alias("slice"), no_text.alias("s"), (x + 0.0).alias("x"))
            below = F.struct(F.lit(tag).alias("tag"), F.lit(-1).alias("slice"), no_text.alias("s"), no_x.alias("x"))
            cell = F.when(x < lo, below).when(x <= hi, inside)
        cells.append(cell)
    return df.select(F.explode(F.filter(F.array(*cells), lambda cell: cell.isNotNull())).alias("cell")).select("cell.*")


def profile_tables(
    frames: dict[str, DataFrame],
    specs: dict[str, TableSpec],
    *,
    exact_median: bool = True,
    approx_cardinality: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """``column_profile`` of several tables in two passes over each.

    Pass 1 is one aggregate per table; a quantile sketch brackets each median.
    Of it one row per column comes back. Pass 2 turns all tables into one stream
    of narrow tagged rows, counted in place before they are shuffled: distinct
    values of the cardinality columns, and the values inside the brackets, which
    are cut into slices, so that only the slice that holds the median is sorted."""
    spark = next(iter(frames.values())).sparkSession
    first = None
    for name, df in frames.items():
        part = _first_pass(df, specs[name], accuracy, exact_median, approx_cardinality)
        first = part if first is None else first.unionByName(part)
    columns = first.collect()
    by_place = {(r.source, r.column_name): i for i, r in enumerate(columns)}
    tagged, ranks = None, []
    for name, df in frames.items():
        spec, wanted = specs[name], []
        for c in df.columns:
            i = by_place[spec.source, c]
            if c in spec.numeric_cols and exact_median and columns[i].n:
                wanted.append((2 * i, c, (columns[i].lo, columns[i].hi)))
                ranks.append((2 * i, max(1, -(-columns[i].n // 2))))
            if c in spec.cardinality_cols and not approx_cardinality:
                wanted.append((2 * i + 1, c, None))
        if wanted:
            part = _tagged(df, wanted)
            tagged = part if tagged is None else tagged.unionByName(part)
    plain = spark.createDataFrame(
        [(2 * i, 2 * i + 1, *[r[c] for c in PROFILE_FIRST], r.cardinality, r.lo) for i, r in enumerate(columns)],
        "median_tag int, card_tag int, source string, column_name string, dtype string, missing_count bigint, missing_pct double, "
        "min_value double, max_value double, mean_value double, std_value double, first_cardinality bigint, lo double",
    )
    if tagged is None:
        return plain.select(*PROFILE_FIRST[:8], F.col("lo").alias("median_value"), "std_value", F.col("first_cardinality").alias("cardinality"))
    # written: the slices, the cardinalities and the medians all read them
    counts = stored(tagged.groupBy("tag", "slice", "s", "x").agg(F.count(F.lit(1)).alias("c")), "profile")
    per_slice = counts.groupBy("tag", "slice").agg(F.count(F.lit(1)).alias("values"), F.sum("c").alias("c"))
    cards = per_slice.where(F.col("tag") % 2 == 1).select(F.col("tag").alias("of_card"), F.col("values").alias("card"))
    # the slice in which the running count reaches the rank: at most SLICES + 1 rows a column
    rank = spark.createDataFrame(ranks, "tag int, k bigint")
    upto = F.sum("c").over(Window.partitionBy("tag").orderBy("slice"))
    slices = per_slice.join(rank, "tag").withColumn("upto", upto).where((F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("c") < F.col("k")))
    target = slices.select("tag", "slice", (F.col("k") - F.col("upto") + F.col("c")).alias("k"))
    running = F.sum("c").over(Window.partitionBy("tag", "slice").orderBy("x"))
    inside = counts.where("x IS NOT NULL").join(target, ["tag", "slice"]).withColumn("upto", running)
    medians = inside.where(F.col("upto") >= F.col("k")).groupBy(F.col("tag").alias("of_median")).agg(F.min("x").alias("median"))
    out = plain.join(medians, F.col("median_tag") == F.col("of_median"), "left").join(cards, F.col("card_tag") == F.col("of_card"), "left")
    exact = {s.source: set(s.cardinality_cols) for s in specs.values()}
    is_card = F.lit(False)
    for source, names in exact.items():
        is_card = is_card | ((F.col("source") == source) & F.col("column_name").isin(list(names)))
    median = F.col("median") if exact_median else F.col("lo")
    card = F.coalesce("first_cardinality", F.when(is_card, F.coalesce("card", F.lit(0))))
    return out.select(*PROFILE_FIRST[:8], median.alias("median_value"), "std_value", card.cast("bigint").alias("cardinality")).select(*PROFILE_COLUMNS)


PROFILE_FIRST = ["source", "column_name", "dtype", "missing_count", "missing_pct", "min_value", "max_value", "mean_value", "std_value"]
PROFILE_COLUMNS = [*PROFILE_FIRST[:8], "median_value", "std_value", "cardinality"]


def column_profile(
    df: DataFrame,
    spec: TableSpec,
    *,
    exact_median: bool = True,
    approx_cardinality: bool = False,
) -> DataFrame:
    """One row per column: dtype, missing count/pct, min, max, mean,
    median, std (numeric columns), cardinality (chosen columns)."""
    return profile_tables({spec.source: df}, {spec.source: spec}, exact_median=exact_median, approx_cardinality=approx_cardinality)


def rule_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per domain/range rule with its violation count and status."""
    rules = list(spec.domain_rules) + list(spec.range_rules)
    if not rules:
        schema = "source string, check_name string, kind string, column_name string, expected string, violations bigint, status string"
        return df.sparkSession.createDataFrame([], schema)
    wide = df.agg(*[count_when(r.report()).cast("bigint").alias(f"__v{i}") for i, r in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(r.name).alias("check_name"),
            F.lit(r.family).alias("kind"),
            F.lit(r.column).alias("column_name"),
            F.lit(r.expected).cast("string").alias("expected"),
            F.col(f"__v{i}").alias("violations"),
        )
        for i, r in enumerate(rules)
    ]
    return wide.select(F.lit(spec.source).alias("source"), F.inline(F.array(*rows))).withColumn(
        "status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL")
    )


def _row_digest(df: DataFrame) -> Column:
    """64 bits of a row, equal for equal rows: a hash of all values and of which are
    NULL (it passes over NULLs)."""
    values = [F.col(f.name) + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name) for f in df.schema.fields]
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in df.columns])
    return F.xxhash64(nulls, *values)


#: Bits of the filter of repeated digests: 8 MB, whatever their number.
FILTER_BITS = 26


def _marks(digest: Column) -> tuple[Column, Column]:
    """The word of the filter that a digest is in, and its bit there."""
    place = digest.bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    return F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))


def duplicate_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Full-row duplicates (NULL-safe), the NULL-skipping figure of
    ``countDistinct(*cols)`` and primary-key duplicates, with statuses.

    Rows are shuffled once, as key and 64-bit digest, and counted. Rows whose key and
    digest are alone are distinct. Of the others the digests are marked in a filter of
    fixed size, and only rows that it lets pass are shuffled and compared in full; the
    rows that it stops are counted by their digests."""
    cols = df.columns
    nulls = F.lit(False)
    for c in cols:
        nulls = nulls | F.col(c).isNull()
    keyed = df.withColumn("__nulls", nulls).withColumn("__d", _row_digest(df))
    keys = [f"__k{i}" for i in range(len(spec.pk))]
    digests = keyed.select(*[F.col(c).alias(k) for c, k in zip(spec.pk, keys)], "__nulls", "__d")
    groups = stored(digests.groupBy(*keys, "__nulls", "__d").agg(F.count(F.lit(1)).alias("n")), "digests")
    found = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("__nulls")).alias("whole"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    ).first()
    rows, whole_rows = found.rows, found.whole
    word, bit = _marks(F.col("__d"))
    if found.repeated:
        marked = groups.where("n > 1").groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))
        marked = F.broadcast(stored(marked, "marked"))
        passes = F.col("__bits").bitwiseAND(bit) != 0
        figures = (F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("__nulls")).alias("whole"))
        passed = groups.join(marked, word == F.col("__word")).where(passes).agg(*figures).first()
        # the rows that pass, compared by all their values
        alike = keyed.join(marked, word == F.col("__word")).where(passes)
        more = alike.groupBy(*cols, "__nulls").agg(F.count(F.lit(1)).alias("n")).agg(*figures).first()
        rows, whole_rows = rows - passed.rows + more.rows, whole_rows - passed.whole + more.whole
    n_keys = groups.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).select(*keys).distinct().count() if keys else 0
    pk = max(0, found.total - n_keys) if spec.pk else 0
    compat = max(0, found.total - whole_rows)
    out = (spec.source, found.total, found.total - rows, compat, pk, "WARN" if compat else "PASS", "WARN" if pk else "PASS")
    return df.sparkSession.createDataFrame([out], DUPLICATES)


DUPLICATES = (
    "source string, total_rows bigint, full_row_duplicates bigint, duplicate_rows_compat bigint, pk_duplicates bigint, "
    "duplicates_status string, pk_status string"
)


def value_distribution(df: DataFrame, c: str) -> DataFrame:
    """Value counts of one column, NULL left out."""
    return df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("count"))


def contract_check(df: DataFrame, required: list[str]) -> DataFrame:
    """Required-column contract: one row per required column with presence,
    NULL count (one pass for all present columns) and OK/WARN/MISSING."""
    present = [c for c in required if c in df.columns]
    wide = df.agg(
        F.count(F.lit(1)).alias("__total"),
        *[count_when(F.col(c).isNull()).cast("bigint").alias(f"__n_{c}") for c in present],
    )
    rows = []
    for c in required:
        if c in present:
            n = F.col(f"__n_{c}")
            rows.append(
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(True).alias("present"),
                    n.alias("null_count"),
                    F.when(n > 0, "WARN").otherwise("OK").alias("status"),
                )
            )
        else:
            rows.append(
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(False).alias("present"),
                    F.lit(None).cast("bigint").alias("null_count"),
                    F.lit("MISSING").alias("status"),
                )
            )
    return wide.select(F.inline(F.array(*rows)))


def is_string(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, StringType)
