"""Operator 11: URL filters by a trie.

Rules (host, path, verdict) stand in one trie: the labels of the host from the
last to the first, then the segments of the path. A rule fits its host and all
hosts below it, if the path of the URL starts with the path of the rule (which
may end inside a segment). Of the rules that fit the longest one decides: the one
with more labels, then the one with the longer path; of two rules for the same
place the blocking one. Without a fitting rule the default verdict holds.

The trie is broadcast if the rules are within a checked bound (``MOST_RULES``,
``MOST_BYTES``) and looked up by batch, so no row of the pages is shuffled. Larger
rule sets stay distributed: the distinct (host, path) pairs are spread over the
places of the trie at which a rule may stand, and joined with the rules. A place
that many pages share (a whole top-level domain) reaches the join once, and the
few rules that were met come back salted, so no task holds all pages of a place.

Defined results: a null URL, an empty one or one without ``://`` has an empty host
and an empty path; a port or a user name counts as part of the host, as it stands
there; URLs of any length are read whole; repeated rows and repeated or null ids
give one row each; other columns, also of the names of the result, are ignored by
``judge_urls`` and kept by ``drop_blocked``; an empty table gives none. Rules with
a null host or path count as empty there, other verdicts than allow and block are
an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import Memo

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rules that are broadcast at most: a trie of this size stays below 100 MB.
MOST_RULES = 200_000
MOST_BYTES = 16_000_000
#: Copies of a met rule when it goes back to the pages.
SALTS = 32

RULES = "host string, path string, verdict string"


def url_host(url: Column) -> Column:
    """What stands behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(_behind(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What stands behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_behind(url), r"^[^/?#]*([^?#]*)", 1)


def _behind(url: Column) -> Column:
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", text)
    return F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULES)


def _plain_rules(rules: DataFrame) -> DataFrame:
    """One row per place, its text, and whether it blocks."""
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    verdict = F.when(F.col("verdict").isin(ALLOW, BLOCK), F.col("verdict")).otherwise(F.raise_error(F.lit("a verdict is allow or block")))
    plain = rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), verdict.alias("verdict"))
    return plain.groupBy("host", "path").agg(F.max(F.col("verdict") == BLOCK).alias("blocks"))


class UrlTrie:
    """A node is [children by label or segment, paths below this host, ends by
    rest, lengths of rests from long to short]; an end is (rule, verdict)."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root = self._node()
        self.deepest = 1
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node[0].setdefault(label, self._node())
            if node[1] is None:
                node[1] = self._node()
            node = node[1]
            *inner, rest = path.split("/")
            self.deepest = max(self.deepest, len(inner) + 1)
            for segment in inner:
                node = node[0].setdefault(segment, self._node())
            if node[2].get(rest, (None, ALLOW))[1] != BLOCK:
                node[2][rest] = (host + path, verdict)
            node[3] = sorted({len(r) for r in node[2]}, reverse=True)

    @staticmethod
    def _node() -> list:
        return [{}, None, {}, []]

    def hosts(self, host: str) -> list:
        """The path tries of the hosts that ``host`` belongs to, deepest first."""
        node, found = self.root, []
        labels = reversed(host.split(".")) if host else iter(())
        while node is not None:
            if node[1] is not None:
                found.append(node[1])
            label = next(labels, None)
            node = None if label is None else node[0].get(label)
        return found[::-1]

    def in_path(self, node: list, path: str) -> tuple[str, str] | None:
        """The end of the longest beginning of ``path`` below a host."""
        parts = path.split("/", self.deepest)
        best = None
        for k, part in enumerate(parts):
            for n in node[3]:
                if n <= len(part) and (end := node[2].get(part[:n])):
                    best = end
                    break
            node = node[0].get(part) if k + 1 < len(parts) else None
            if node is None:
                return best
        return best

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        return next((end for node in self.hosts(host) if (end := self.in_path(node, path))), None)


def small_trie(rules: DataFrame) -> UrlTrie | None:
    """The trie of ``_plain_rules`` if they are within the bound."""
    size = rules.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("host") + F.octet_length("path")).alias("b")).first()
    if size["n"] > MOST_RULES or (size["b"] or 0) > MOST_BYTES:
        return None
    return UrlTrie((r["host"], r["path"], BLOCK if r["blocks"] else ALLOW) for r in rules.toLocalIterator())


def _by_trie(targets: DataFrame, trie: UrlTrie) -> DataFrame:
    shared = targets.sparkSession.sparkContext.broadcast(trie)
    names = targets.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        below = Memo(held.hosts, 100_000)
        for b in batches:
            ends = [next((e for node in below[h] if (e := held.in_path(node, p))), (None, None)) for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            rules, verdicts = zip(*ends) if ends else ((), ())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], names=[*names, "rule", "verdict"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in targets.dtypes)
    return targets.mapInArrow(run, f"{kinds}, rule string, verdict string")


def _by_join(targets: DataFrame, rules: DataFrame) -> DataFrame:
    """``_by_trie`` for rules of any number."""
    parts = F.split("path", "/", -1)
    rest = F.length(F.element_at(parts, -1))
    bounds = rules.agg(F.collect_set(rest).alias("rests"), F.max(F.size(parts)).alias("deep"), F.max(F.size(F.split("host", r"\."))).alias("labels")).first()
    rests = F.array(*[F.lit(n).cast("int") for n in sorted(bounds["rests"])]) if bounds["rests"] else F.array().cast("array<int>")
    pairs = targets.select("host", "path").distinct().withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)))
    hosts = (
        f"concat(array(''), if(host = '', array(), transform(filter(sequence(0, size(split(host, '[.]')) - 1), i -> size(split(host, '[.]')) - i <= {bounds['labels'] or 0}),"
        " i -> array_join(slice(split(host, '[.]'), i + 1, size(split(host, '[.]'))), '.'))))"
    )
    places = pairs.withColumn("k", F.explode(F.sequence(F.lit(0), F.least(F.size(parts), F.lit(bounds["deep"] or 1)) - 1)))
    begin = F.expr("if(k = 0, '', concat(array_join(slice(split(path, '/', -1), 1, k), '/'), '/'))")
    places = places.select("host", "path", "salt", begin.alias("begin"), F.expr("element_at(split(path, '/', -1), k + 1)").alias("part"))
    places = places.select("host", "path", "salt", F.explode(F.transform(F.filter(rests, lambda n: n <= F.length("part")), lambda n: F.concat("begin", F.substring("part", F.lit(1), n)))).alias("at_path"))
    places = places.select("host", "path", "salt", "at_path", F.explode(F.expr(hosts)).alias("at_host"))
    met = places.select("at_host", "at_path").distinct().join(rules.select(F.col("host").alias("at_host"), F.col("path").alias("at_path"), "blocks"), ["at_host", "at_path"])
    met = met.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    depth = F.when(F.col("at_host") == "", 0).otherwise(F.size(F.split("at_host", r"\.")))
    order = F.struct(depth.alias("labels"), F.length("at_path").alias("n"), F.concat("at_host", "at_path").alias("rule"), "blocks")
    best = places.join(met, ["at_host", "at_path", "salt"]).groupBy("host", "path").agg(F.max(order).alias("m"))
    best = best.select(F.col("host").alias("of_host"), F.col("path").alias("of_path"), F.col("m.rule").alias("rule"), F.when(F.col("m.blocks"), BLOCK).otherwise(ALLOW).alias("verdict"))
    return targets.join(best, (F.col("host") == F.col("of_host")) & (F.col("path") == F.col("of_path")), "left").drop("of_host", "of_path")


def _judged(targets: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    if default not in (ALLOW, BLOCK):
        raise ValueError("the default is allow or block")
    plain = _plain_rules(rules)
    trie = small_trie(plain)
    out = _by_join(targets, plain) if trie is None else _by_trie(targets, trie)
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page; ``rules`` has host,
    path and verdict. ``rule`` is the deciding rule's host and path, or null."""
    url = F.col(url_col)
    return _judged(pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path")), rules, default)


def drop_blocked(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """``pages`` with all its columns, without those that a rule blocks. Only the
    distinct hosts and paths are judged; the pages are joined with those blocked."""
    url = F.col(url_col)
    named = pages.select(url_host(url).alias("host"), url_path(url).alias("path")).distinct().select(F.lit(None).cast("long").alias("none"), "host", "path")
    judged = _judged(named, rules, default).where(F.col("verdict") == BLOCK)
    plain = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(pages.columns)])
    own = F.col(f"c{pages.columns.index(url_col)}")
    kept = plain.join(judged.select("host", "path"), (url_host(own) == F.col("host")) & (url_path(own) == F.col("path")), "left_anti")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(pages.columns)])
