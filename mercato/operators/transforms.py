"""Column-to-column feature transforms that need a fitted statistic.

* Global statistics (min, max) are uncorrelated scalar subqueries: Spark
  runs one aggregate job, merges the subqueries of a frame into a single
  struct and folds the result into the projection. No Python round trip,
  no join.
* Label encoding ranks the *distinct values* only. A bounded distinct set
  (size checked) is ranked in one task and broadcast back; beyond the
  bound the ranking is distributed (range-partitioned sort + per-partition
  offsets) and joined back with a shuffle join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.quantiles import small_distinct
from mercato.session import ensure_checkpoint_dir

# Largest distinct-value table that is ranked in one task and broadcast.
DEFAULT_BROADCAST_LIMIT = 1_000_000


def _as_map(cols: str | Sequence[str] | Mapping[str, str], suffix: str) -> dict[str, str]:
    if isinstance(cols, str):
        return {cols: f"{cols}{suffix}"}
    if isinstance(cols, Mapping):
        return dict(cols)
    return {c: f"{c}{suffix}" for c in cols}


def min_max_normalize(df: DataFrame, cols: str | Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Scale each column to [0, 1] as ``(x - min) / (max - min)``.

    A constant column (``max == min``), an all-NULL or an empty one maps
    every row to 0.0, NULL rows included; otherwise NULL stays NULL.
    """
    mapping = _as_map(cols, "_norm")
    out = df
    for src, dst in mapping.items():
        mn = df.select(F.min(src)).scalar()
        mx = df.select(F.max(src)).scalar()
        out = out.withColumn(
            dst,
            F.when(mx.eqNullSafe(mn), F.lit(0.0)).otherwise(
                (F.col(src) - mn).cast("double") / (mx - mn).cast("double")
            ),
        )
    return out


def log1p_columns(df: DataFrame, cols: str | Sequence[str] | Mapping[str, str]) -> DataFrame:
    mapping = _as_map(cols, "_log")
    return df.withColumns({dst: F.log1p(F.col(src)) for src, dst in mapping.items()})


def rank_distinct(
    values: DataFrame,
    c: str,
    out: str,
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
    small: bool | None = None,
) -> tuple[DataFrame, bool]:
    """Dense rank from 0 of the distinct values of column ``c`` (ascending,
    NULL first). Returns (ranked frame with columns ``c``, ``out``; whether
    it is small enough to broadcast). ``small`` is the outcome of a size
    check already made by the caller.
    """
    distinct = values.select(c).distinct()
    if small is None:
        small = small_distinct(values, [c], broadcast_limit)[c]
    if small:
        ranked = distinct.withColumn(
            out, (F.dense_rank().over(Window.orderBy(F.col(c).asc_nulls_first())) - 1).cast("int")
        )
        return ranked, True
    # Distributed: a range-partitioned sort gives each partition a
    # contiguous slice; monotonically_increasing_id carries (partition,
    # position). The checkpoint pins partition contents so the offsets
    # computed from it agree with the ids after any task retry.
    ensure_checkpoint_dir(values.sparkSession)
    pinned = (
        distinct.orderBy(F.col(c).asc_nulls_first())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    pid = F.shiftright(F.col("_mid"), 33)
    counts = pinned.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).select("_pid", "_off")
    # ``offsets`` has one row per partition of the sort: bounded by the
    # shuffle partition count, so broadcasting it is safe.
    ranked = pinned.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid").select(
        c, (F.col("_off") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))).cast("int").alias(out)
    )
    return ranked, False


def label_encode(
    df: DataFrame,
    cols: str | Sequence[str] | Mapping[str, str],
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
) -> DataFrame:
    """``dense_rank() over (order by c) - 1`` without a global window over
    all rows: NULL takes code 0 when present, then values ascending."""
    mapping = _as_map(cols, "_enc")
    sizes = small_distinct(df, list(mapping), broadcast_limit)
    out = df
    for src, dst in mapping.items():
        ranked, small = rank_distinct(df, src, dst, broadcast_limit, small=sizes[src])
        ranked = ranked.withColumnRenamed(src, "_enc_value")
        side = F.broadcast(ranked) if small else ranked
        out = out.join(side, out[src].eqNullSafe(side["_enc_value"]), "left").drop("_enc_value")
    return out


def one_hot(df: DataFrame, c: str, values: Iterable[str], prefix: str | None = None) -> DataFrame:
    """One 0/1 column per listed value, named ``{prefix}_{value}``; NULL is none
    of them and gives 0 in all."""
    p = prefix or c
    return df.withColumns({f"{p}_{v}": F.col(c).eqNullSafe(F.lit(v)).cast("int") for v in values})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def clip_columns(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    from mercato.functions.columns import clip

    return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in bounds.items()})
