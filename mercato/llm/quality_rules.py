"""Operator 9: document quality rules as a learned decision list.

DataFrame functions only. The features of a text come from one row: its words,
the counts of characters, and the repetition figures. Repeated three-word
windows are found without moving a row: the hash of each window is packed with
its place into one long, the longs are sorted, and neighbours with one hash and
the same words are a repetition. A text in which two different windows share a
hash is counted by the windows themselves, so the figures are exact.

The rules are learned from labelled documents by sequential covering. A rule is
a conjunction of thresholds; it grows by the condition with the best FOIL gain
over the labelled statistics of the grow part, is pruned (last conditions first)
on the prune part, and is kept if its precision there is high enough; the rows
it covers leave and the next rule is grown. Every step is one aggregation that
counts all candidate conditions at once, so only counts reach the driver. The
list is emitted as one ordered conditional expression.

The figures of all rows are written once (some numbers a row); the labels are
joined with them and the list is applied to them, so no text is shuffled and
none is read twice.

Defined results: null text has no words and fails the base rule; texts of any
length are read whole; repeated rows and repeated or null ids give one row each;
other columns are ignored; without usable labels the list is empty and the base
rule decides alone; an empty table gives none.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import WORD_BREAK, materialize, shared_path

#: Fixed by the query's contract.
LEAST_WORDS = 50
MOST_REPEATED_PCT = 50
SYMBOLS = "#*$%&|<>"
WHITE = "\t\n\x0b\x0c\r "

#: Parameters of the learner.
THRESHOLDS = 24
MOST_RULES = 8
MOST_CONDITIONS = 3
LEAST_PRECISION = 0.9
LEAST_COVERED = 8
NEAR_BEST = 0.97

FEATURES = ("word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "bang_share", "bar_share", "line_words", "n_words")


def _array(expr: str) -> Column:
    return F.expr(expr)


WINDOW_HASH = "xxhash64({0}, {1})"
#: Places of repeated windows by the windows themselves: words hold no space, so
#: joined words tell windows apart.
_WINDOWS = "sort_array(transform(sequence(0, size(w) - 3), i -> struct(array_join(slice(w, i + 1, 3), ' ') as t, cast(i as bigint) as i)))"
_BY_WORDS = (
    f"sort_array(flatten(transform(array({_WINDOWS}), x -> transform(filter(transform(x, (y, i) -> struct(y.i as i,"
    " (i > 0 and element_at(x, greatest(i, 1)).t = y.t) or (i + 1 < size(x) and element_at(x, least(i + 2, size(x))).t = y.t) as again)), z -> z.again), z -> z.i))))"
)


def text_figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    the character counts that the features need."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    step = base.select(
        "doc_id",
        "text",
        F.array_remove(F.split("text", WORD_BREAK), "").alias("w"),
        F.length("text").alias("chars"),
        F.length(F.translate("text", WHITE, "")).alias("word_chars"),
    )
    step = step.select(
        "doc_id",
        F.size("w").alias("n_words"),
        "word_chars",
        (F.col("chars") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        (F.col("chars") - F.length(F.translate("text", "|", ""))).alias("n_bars"),
        (F.col("chars") - F.length(F.translate("text", "!", ""))).alias("n_bangs"),
        (F.col("chars") - F.length(F.translate("text", "0123456789", ""))).alias("n_digits"),
        (F.col("chars") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).alias("n_upper"),
        # lines with a word
        _array("filter(split(text, '\n'), x -> length(translate(x, '\t\x0b\x0c\r ', '')) > 0)").alias("lines"),
        # bits that the place of a window needs
        F.ceil(F.log2(F.size("w") + F.lit(2))).cast("int").alias("bits"),
        _array(f"zip_with(zip_with(w, slice(w, 2, greatest(size(w) - 1, 0)), (a, b) -> {WINDOW_HASH.format('a', 'b')}), slice(w, 3, greatest(size(w) - 2, 0)), (h, c) -> if(c is null, null, {WINDOW_HASH.format('h', 'c')}))").alias("h"),
        "w",
    )
    step = step.withColumn("packed", _array("sort_array(array_compact(transform(h, (x, i) -> if(x is null, null, shiftleft(shiftrightunsigned(x, bits + 1), bits) + i))))"))
    figures = [c for c in step.columns if c not in ("w", "h", "packed", "lines")]
    words = "slice(w, cast(1 + ({0} & (shiftleft(1L, bits) - 1)) as int), 3)"
    step = step.select(
        *figures,
        "w",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        "packed",
        # of neighbours in hash order: 0 other hashes, 1 the same words, 2 a hash shared by different words
        _array(
            "zip_with(packed, slice(packed, 2, greatest(size(packed) - 1, 0)), (a, b) -> if(b is not null and shiftright(a, bits) = shiftright(b, bits),"
            f" if({words.format('a')} = {words.format('b')}, 1, 2), 0))"
        ).alias("same"),
    )
    # a window counts if it equals the one before it or behind it in hash order
    step = step.select(
        *figures,
        "n_lines",
        "n_dup_lines",
        _array(
            f"case when array_contains(same, 2) then {_BY_WORDS} when array_contains(same, 1) then"
            " sort_array(array_compact(zip_with(packed, zip_with(same, concat(array(0), same),"
            " (a, b) -> coalesce(a, 0) = 1 or coalesce(b, 0) = 1), (p, s) -> if(s, p & (shiftleft(1L, bits) - 1), null)))) else array() end"
        ).alias("at"),
    )
    # places ascend: each window adds the words up to the next one, three at most
    step = step.withColumn("next", _array("slice(at, 2, greatest(size(at) - 1, 0))"))
    return step.select(
        "doc_id",
        *[F.col(c).cast("long").alias(c) for c in figures if c not in ("doc_id", "bits")],
        F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
        _array("aggregate(zip_with(at, next, (a, b) -> if(b is null, 3L, least(3L, b - a))), 0L, (s, x) -> s + x)").alias("n_repeat_words"),
    )


def with_features(figures: DataFrame) -> DataFrame:
    """``figures`` and the features of the rules (doubles, 0 for empty texts)."""

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return figures.select(
        "*",
        share("word_chars", "n_words").alias("word_length"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_upper", "word_chars").alias("upper_share"),
        share("n_digits", "word_chars").alias("digit_share"),
        share("n_bangs", "word_chars").alias("bang_share"),
        share("n_bars", "word_chars").alias("bar_share"),
        share("n_words", "n_lines").alias("line_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PCT * F.col("n_words"))


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature).cast("double")
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def all_hold(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def _marks(rows: DataFrame, features: tuple[str, ...], thresholds: int) -> dict[str, list[float]]:
    """Thresholds of each feature: halfway between neighbouring quantiles of the
    bad and the good rows."""
    points = [i / thresholds for i in range(thresholds + 1)]
    found = rows.groupBy("bad").agg(*[F.percentile_approx(F.col(f).cast("double"), points, 10_000).alias(f) for f in features]).collect()
    if len(found) < 2:
        return {}
    seen = {f: sorted({float(x) for m in found for x in (m[f] or [])}) for f in features}
    return {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in seen.items()}


def _below(bounds: Column, value: Column) -> Column:
    return F.filter(bounds, lambda t: t < value)


def _binned(rows: DataFrame, marks: dict[str, list[float]]) -> DataFrame:
    """Of each feature only how many thresholds lie below it."""
    bins = []
    for f, ts in marks.items():
        bounds = F.array(*[F.lit(t) for t in ts]) if ts else F.array().cast("array<double>")
        value = F.col(f).cast("double")
        bins.append(F.size(_below(bounds, value)).alias(f))
    return rows.select("bad", "prune", *bins)


def _holds(rule: Rule, marks: dict[str, list[float]]) -> Column:
    """``all_hold`` on binned rows."""
    out = F.lit(True)
    for c in rule:
        i = marks[c.feature].index(c.threshold)
        out = out & ((F.col(c.feature) > i) if c.above else (F.col(c.feature) <= i))
    return out


def _histogram(rows: DataFrame, marks: dict[str, list[float]]) -> dict[str, list[tuple[int, int]]]:
    """(bad, good) rows in each bin of each feature, in one aggregation of which
    only these counts reach the driver."""
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("bin")) for f in marks])
    counted = rows.select("bad", F.explode(pairs).alias("x")).groupBy("x.f", "x.bin").agg(F.sum("bad").alias("b"), F.sum(1 - F.col("bad")).alias("g")).collect()
    out = {f: [(0, 0)] * (len(ts) + 1) for f, ts in marks.items()}
    for r in counted:
        out[r["f"]][r["bin"]] = (r["b"], r["g"])
    return out


def learn_rules(
    labelled: DataFrame,
    features: tuple[str, ...] = FEATURES,
    thresholds: int = THRESHOLDS,
    most_rules: int = MOST_RULES,
    most_conditions: int = MOST_CONDITIONS,
    least_precision: float = LEAST_PRECISION,
    least_covered: int = LEAST_COVERED,
) -> list[Rule]:
    """An ordered list of rules for the rows with bad = 1.

    ``labelled`` has the features, bad (0 or 1) and doc_id; a third of the ids
    (by hash) prunes, the others grow."""
    rows = labelled.where("bad IS NOT NULL").withColumn("prune", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    marks = _marks(rows, features, thresholds)
    if not marks:
        return []
    rows = materialize(_binned(rows, marks))
    rules: list[Rule] = []

    def uncovered() -> Column:
        out = F.lit(True)
        for r in rules:
            out = out & ~_holds(r, marks)
        return out

    while len(rules) < most_rules:
        grow, prune = rows.where(uncovered() & ~F.col("prune")), rows.where(uncovered() & F.col("prune"))
        rule: Rule = ()
        while len(rule) < most_conditions:
            bins = _histogram(grow.where(_holds(rule, marks)), marks)
            bad, good = (sum(x) for x in zip(*bins[features[0]]))
            if bad < least_covered or not good:
                break
            before = math.log2(bad / (bad + good))
            tries = []
            for f, ts in marks.items():
                b = g = 0
                for i, t in enumerate(ts):
                    b, g = b + bins[f][i][0], g + bins[f][i][1]
                    for above, nb, ng in ((False, b, g), (True, bad - b, good - g)):
                        if nb >= least_covered:
                            tries.append((nb * (math.log2(nb / (nb + ng)) - before), nb + ng, Condition(f, above, t)))
            top = max((t[0] for t in tries), default=0.0)
            if top <= 1e-9:
                break
            # of nearly equal gains the condition that covers least: sure of clean rows
            rule += (min((t for t in tries if t[0] >= NEAR_BEST * top), key=lambda t: (t[1], -t[0]))[2],)
        if not rule:
            break
        # the shortest beginning of the rule with the best (p - n) / (p + n)
        begun = [rule[: i + 1] for i in range(len(rule))]
        isbad = F.col("bad") == 1
        row = prune.agg(*[F.count_if(_holds(r, marks) & c).alias(f"{n}{i}") for i, r in enumerate(begun) for n, c in (("b", isbad), ("g", ~isbad))]).first()
        worth = [((row[f"b{i}"] - row[f"g{i}"]) / (row[f"b{i}"] + row[f"g{i}"]) if row[f"b{i}"] + row[f"g{i}"] else -1.0) for i in range(len(begun))]
        best_i = max(range(len(begun)), key=lambda i: (worth[i], -i))
        if (worth[best_i] + 1) / 2 < least_precision:
            break
        rules.append(begun[best_i])
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered expression: the number of the first rule that
    holds (from 1), 0 for the base rule, null if none does."""
    out = F.when(base_failed(), F.lit(0))
    for i, r in enumerate(rules, 1):
        out = out.when(all_hold(r), F.lit(i))
    return out


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its figures, base_failed, kept and the rule that
    decided. ``labels`` has doc_id and quality (1 good, 0 bad); of several
    labels of a document the lower one counts."""
    path = shared_path(docs.sparkSession, "figures")
    text_figures(docs, id_col, text_col).write.parquet(path)
    figures = with_features(docs.sparkSession.read.parquet(path))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("marked_id")).agg((1 - F.min("quality")).cast("int").alias("bad"))
    learned = materialize(figures.join(marks, F.col("doc_id") == F.col("marked_id")).select("doc_id", "bad", "n_repeat_words", *FEATURES))
    rules = learn_rules(learned.where(~base_failed()))
    return figures.select("*", F.coalesce(base_failed(), F.lit(False)).alias("base_failed"), verdict(rules).alias("rule")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("rule").isNull().alias("kept"), "rule"
    )
