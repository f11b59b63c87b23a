"""Operator 6: quality classifier by hierarchical empirical Bayes.

A document classifier gives evidence from the text alone: a naive Bayes score
over hashed words and word shapes, and a few shares (symbols, capitals, repeats,
...), combined by a logistic regression. It is fitted on a bounded sample of the
labelled rows (``MOST_LABELLED``, by the hash of the id): one half gives the
counts of naive Bayes, the other the regression, so that the score is not judged
on its own counts.

Sites add what the text does not say. The expected number of bad documents of
every path (host and path columns) and host is summed over all documents; the
rate of a host is its mean shrunk toward the global rate, the rate of a path
toward its host's. How strongly is estimated from how much the sites differ
(moments of the beta distribution), so sparse sites stay close to their prior. A
document's posterior is its evidence against the prior of its path.

Only sums by path leave the scoring tasks (partial sums first, so a host of a
third of all rows is no hot key); posteriors come back by a join that is a
broadcast only if the number of paths is within a checked bound.

Defined results: null and empty texts are scored as texts without words; null
host or path is a site of its own; texts of any length are read whole; repeated
rows and repeated or null ids are scored one by one; without labels of both
kinds the evidence is 0 and every document is kept; an empty table gives none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import Memo, gives_back, shared_path, stored

#: Bound of the labelled sample.
MOST_LABELLED = 20_000
BUCKETS = 1 << 16
#: A document is rejected from this posterior probability of being bad.
REJECT = 0.8
#: Paths up to this number are broadcast.
MOST_BROADCAST = 100_000
SYMBOLS = b"#*$%&|<>"
LETTERS = bytes(range(ord("A"), ord("Z") + 1))

_runs = re.compile(r"([a0A]|[^\w\s])\1+").sub


def word_features(word: str) -> tuple[int, int]:
    """Buckets of the word and of its shape (letters a, capitals A, digits 0,
    runs of one kind written once)."""
    shape = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word[:64])
    shape = _runs(r"\1", shape)
    low = word.lower().encode("utf-8", "surrogatepass")
    return xxhash.xxh3_64_intdigest(low) % BUCKETS, xxhash.xxh3_64_intdigest(shape.encode("utf-8", "surrogatepass"), seed=1) % BUCKETS


class Model(NamedTuple):
    """Log ratios by bucket, and the regression on the dense features."""

    ratios: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float


class Scorer:
    def __init__(self, ratios: np.ndarray):
        r = ratios

        def ratio(word: str) -> float:
            a, b = word_features(word)
            return float(r[a] + r[b])

        self.ratio = Memo(ratio, 400_000)

    def features(self, text: str) -> list[float]:
        words = text.split()
        n = len(words)
        if not n:
            return [0.0] * N_FEATURES
        raw = text.encode("utf-8", "surrogatepass")
        size = max(1, len(raw))
        lines = [x for x in text.split("\n") if x.strip()]
        three = n - 2
        scores = np.fromiter(map(self.ratio.__getitem__, words), dtype=np.float64, count=n)
        return [
            float(scores.mean()),
            float((scores > 1.0).mean()),
            (size - len(raw.translate(None, SYMBOLS))) / size,
            raw.count(b"|") / size,
            raw.count(b"!") / size,
            (size - len(raw.translate(None, LETTERS))) / size,
            (size - len(raw.translate(None, b"0123456789"))) / size,
            1 - len(set(lines)) / max(1, len(lines)),
            1 - len(set(words)) / n,
            1 - len(set(zip(words, words[1:], words[2:]))) / three if three > 0 else 0.0,
            size / n,
            float(np.log1p(n)),
            float(n < 20),
        ]


N_FEATURES = 13


def _half(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(7)), F.lit(2))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, bad, half) of at most ``most`` labelled ids."""
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("marked")).agg((1 - F.min("quality")).cast("int").alias("bad"))
    some = marks.orderBy(F.xxhash64("marked"), "marked").limit(most)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(some), F.col("doc_id") == F.col("marked")).select("doc_id", "text", "bad", _half(F.col("doc_id")).cast("int").alias("half"))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    sample = labelled_sample(docs, labels, most, id_col, text_col)

    @gives_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = np.zeros((2, BUCKETS), dtype=np.int64)
            for text, bad in zip(b.column(0), b.column(1).to_pylist()):
                for word, n in Counter(text.as_py().split()).items():
                    for f in word_features(word):
                        sums[bad, f] += n
            used = np.flatnonzero(sums.sum(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[0, used]), pa.array(sums[1, used])], names=["f", "good", "bad"])

    counts = sample.where("half = 0").select("text", "bad").mapInArrow(count, "f int, good long, bad long").groupBy("f").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toArrow()
    seen = np.zeros((2, BUCKETS))
    at = counts.column("f").to_numpy()
    seen[0, at], seen[1, at] = counts.column("good").to_numpy(), counts.column("bad").to_numpy()
    ratios = np.log((seen[1] + 1) / (seen[1].sum() + BUCKETS)) - np.log((seen[0] + 1) / (seen[0].sum() + BUCKETS))

    @gives_back
    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(ratios)
        for b in batches:
            x = [scorer.features(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(x, pa.list_(pa.float64()))], names=["bad", "doc_id", "x"])

    table = sample.where("half = 1").select("text", "bad", "doc_id").mapInArrow(dense, "bad int, doc_id long, x array<double>").toArrow().sort_by("doc_id")
    y = table.column("bad").to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return None
    x = np.array(table.column("x").to_pylist())
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    return Model(ratios, centre, scale, logistic((x - centre) / scale, y), float(np.log(y.mean() / (1 - y.mean()))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.diag(np.append(np.full(x.shape[1] - 1, ridge), 1e-6))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def evidence(docs: DataFrame, model: Model | None, text_col: str, name: str) -> DataFrame:
    """``docs`` with a column ``name``: the log odds of bad that the text alone
    speaks for (the sample's prior taken off)."""
    at = docs.columns.index(text_col)
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in docs.schema.fields], T.StructField(name, T.DoubleType())])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None if model is None else Scorer(model.ratios)
        for b in batches:
            if scorer is None:
                e = np.zeros(b.num_rows)
            else:
                x = np.array([scorer.features(t.as_py() or "") for t in b.column(at)]).reshape(-1, N_FEATURES)
                e = np.clip((x - model.centre) / model.scale, -20, 20) @ model.weights[:-1] + model.weights[-1] - model.prior
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.clip(e, -30, 30))], names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def _strength(rates: DataFrame, mean: float) -> float:
    """Pseudo-count of a beta prior from the spread of the rates of sites."""
    row = rates.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * (F.col("bad") / F.col("n") - mean) ** 2).alias("v")).first()
    if not row["n"] or row["k"] < 2:
        return 100.0
    noise = mean * (1 - mean)
    between = row["v"] / row["n"] - noise * row["k"] / row["n"]
    return float(min(10_000.0, max(10.0, noise / between - 1))) if between > 0 else 10_000.0


def site_rates(scored: DataFrame, base: float) -> DataFrame:
    """(host, path, rate): posterior rate of bad documents of every path.
    ``scored`` has host, path, evidence of all documents."""
    p = 1 / (1 + F.exp(-(F.col("evidence") + F.lit(base))))
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("bad"))
    path = shared_path(scored.sparkSession, "paths")
    paths.write.parquet(path)
    paths = scored.sparkSession.read.parquet(path)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    if not total["n"]:
        return paths.select("host", "path", F.lit(0.5).alias("rate"))
    mean = min(1 - 1e-6, max(1e-6, total["bad"] / total["n"]))
    of_host, of_path = _strength(hosts, mean), _strength(paths, mean)
    host_rates = hosts.select(F.col("host").alias("of"), ((F.col("bad") + of_host * mean) / (F.col("n") + of_host)).alias("host_rate"))
    joined = paths.join(host_rates, F.col("host") == F.col("of"))
    return joined.select("host", "path", ((F.col("bad") + of_path * F.col("host_rate")) / (F.col("n") + of_path)).alias("rate"))


def _site(cols: list[str]) -> Column:
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in cols]
    return F.concat_ws("/", *parts) if parts else F.lit("-")


def _posterior(rate: Column, ev: Column) -> Column:
    return 1 / (1 + F.exp(-(ev + F.ln(rate / (1 - rate)))))


def _with_rates(scored: DataFrame, rates: DataFrame, host: str, path: str) -> DataFrame:
    right = rates.select(F.col("host").alias("rate_host"), F.col("path").alias("rate_path"), "rate")
    if rates.count() <= MOST_BROADCAST:
        right = F.broadcast(right)
    return scored.join(right, (F.col(host) == F.col("rate_host")) & (F.col(path) == F.col("rate_path")), "left").drop("rate_host", "rate_path")


def classify(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_cols: tuple[str, ...] = ("lang",), id_col: str = "doc_id", text_col: str = "text", most_labelled: int = MOST_LABELLED, reject: float = REJECT) -> DataFrame:
    """(doc_id, evidence, site_rate, p_bad, kept) of every row."""
    model = fit(docs, labels, most_labelled, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _site([host_col]).alias("host"), _site(list(path_cols)).alias("path"), F.col(text_col).cast("string").alias("text"))
    place = shared_path(docs.sparkSession, "evidence")
    evidence(rows, model, "text", "evidence").drop("text").write.parquet(place)
    scored = docs.sparkSession.read.parquet(place)
    rates = site_rates(scored, model.prior if model else 0.0)
    out = _with_rates(scored, rates, "host", "path").withColumn("p_bad", _posterior(F.col("rate"), F.col("evidence")))
    kept = F.lit(True) if model is None else F.col("p_bad") < reject
    return out.select("doc_id", "evidence", F.col("rate").alias("site_rate"), "p_bad", kept.alias("kept"))


def drop_rejected(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_cols: tuple[str, ...] = ("lang",), id_col: str = "doc_id", text_col: str = "text", most_labelled: int = MOST_LABELLED, reject: float = REJECT) -> DataFrame:
    """``docs`` with all its columns, without the documents that are rejected."""
    model = fit(docs, labels, most_labelled, id_col, text_col)
    if model is None:
        return docs
    names = docs.columns
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], _site([host_col]).alias("host"), _site(list(path_cols)).alias("path"))
    text = f"c{names.index(text_col)}"
    # scored once: written with the documents, read for the rates and for the result
    scored = stored(evidence(plain, model, text, "evidence"))
    rates = site_rates(scored.select("host", "path", "evidence"), model.prior)
    out = _with_rates(scored, rates, "host", "path").where(_posterior(F.col("rate"), F.col("evidence")) < reject)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
