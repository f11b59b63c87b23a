"""The registered queries opN_<name> of this subpackage: each applies one
operator with production parameters to its whole table and derives the digest
columns of the query's contract from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.bpe import bpe_digests
from mercato.llm.common import read_table, shared_path
from mercato.llm.fingerprints import edited_fingerprints
from mercato.llm.hard_negatives import mine_hard_negatives
from mercato.llm.jaccard_join import jaccard_components
from mercato.llm.line_dedup import dedup_lines
from mercato.llm.merkle import folded, hex_text, leaf_digest, merkle_ways, proof_text
from mercato.llm.packing import pack
from mercato.llm.quality_classifier import classify
from mercato.llm.quality_rules import apply_rules
from mercato.llm.secret_scan import scan_secrets
from mercato.llm.token_counts import token_counts
from mercato.llm.url_filters import LOWER, UPPER, judge_urls, rules_frame
from mercato.llm.warc import page_records, read_warc, write_warc

Query = Callable[[SparkSession, str], DataFrame]

WORD_VOCAB = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"

#: Fixed by the query's contract: (host, path, verdict).
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_file(WORD_VOCAB))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), tokenizer_file(PIECE_MODEL))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents"), anchored=False).select("doc_id", "n_lines", "n_dropped", "text")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warc(read_table(spark, sf_dir, "pages"), path)
    return page_records(read_warc(spark, path))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read_table(spark, sf_dir, "documents"), tokenizer_file(WORD_VOCAB))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"), rules_frame(spark, URL_RULES))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", "embedding", moved.alias("label"))
    return mine_hard_negatives(rows, F.col("id") % 50 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    bad = F.when(hit, leaf_digest([*fields, F.translate("text", UPPER, LOWER)]))
    ways = merkle_ways(docs.select("doc_id", "lang", leaf_digest([*fields, F.col("text")]).alias("leaf"), bad.alias("bad")), "lang", "doc_id", "leaf")
    back = hex_text(folded(F.coalesce("bad", "leaf"), F.col("m_way")))
    out = ways.select("doc_id", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("m_subroot")).alias("subroot"), hex_text(F.col("m_root")).alias("root"), F.sha2(proof_text(F.col("m_way")), 256).alias("proof_sha256"), back.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_secret_scan": op2_secret_scan,
    "op3_token_counts": op3_token_counts,
    "op4_line_dedup": op4_line_dedup,
    "op5_warc": op5_warc,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_fingerprints": op7_fingerprints,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_quality_rules": op9_quality_rules,
    "op10_bpe": op10_bpe,
    "op11_url_filters": op11_url_filters,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle_manifest": op13_merkle_manifest,
}


def _rule_sql(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


def _url_sql() -> str:
    # longest first: more labels, then the longer path
    rules = sorted(URL_RULES, key=lambda r: (-r[0].count("."), -len(r[1])))
    name = " ".join(f"WHEN {_rule_sql(h, p)} THEN '{h}{p}'" for h, p, _ in rules)
    verdict = " ".join(f"WHEN {_rule_sql(h, p)} THEN '{v}'" for h, p, v in rules)
    return f"""
        WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
                   FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
        h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p)
        SELECT page_id, host, path, CASE {name} END AS rule, CASE {verdict} ELSE 'allow' END AS verdict FROM h"""


NEGATIVES_SQL = """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same, CAST(list_dot_product(a.e, v.e) AS BIGINT) AS score
              FROM v a JOIN v ON a.vec_id % 50 = 0 AND v.vec_id <> a.vec_id),
        p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
        n AS (SELECT p.anchor_id, p.positive_id, p.positive_score, s.other AS negative_id, s.score AS negative_score,
                     row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS rank
              FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
              AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""

#: Levels that the SQL of the manifest unrolls: up to 8^8 documents of a language and 8^3 languages.
ROW_LEVELS, LANG_LEVELS = 8, 3


def _merkle_sql() -> str:
    def framed(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(framed(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def level(name: str, of: str, group: str) -> str:
        run = f"PARTITION BY {group}, pos // 8 ORDER BY pos ROWS BETWEEN"
        return f"""{name} AS (SELECT {group}, pos, n, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
            coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {of})"""

    def grown(name: str, of: str, group: str) -> str:
        return f"""{name} AS (SELECT {group}, pos // 8 AS pos, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h
            FROM {of} GROUP BY {group}, pos // 8, n)"""

    # crc32 bit by bit: each byte is xored in, then eight shifts
    crc = """xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
            lambda x: [ascii(x)::BIGINT] || list_transform(range(8), lambda i: -1::BIGINT))),
            lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"""
    low = f"translate(text, '{UPPER}', '{LOWER}')"
    parts = [
        f"d AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS bad FROM documents)",
        "l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d)",
        "k0 AS (SELECT lang, pos, n, leaf AS h FROM l)",
    ]
    for i in range(ROW_LEVELS):
        parts += [level(f"s{i}", f"k{i}", "lang"), grown(f"k{i + 1}", f"k{i}", "lang")]
    parts.append(f"t AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS num, h AS subroot FROM k{ROW_LEVELS})")
    parts.append("g0 AS (SELECT 0 AS z, num AS pos, count(*) OVER () AS n, subroot AS h FROM t)")
    for i in range(LANG_LEVELS):
        parts += [level(f"u{i}", f"g{i}", "z"), grown(f"g{i + 1}", f"g{i}", "z")]
    ups = [f"s{i}" for i in range(ROW_LEVELS)] + [f"u{i}" for i in range(LANG_LEVELS)]
    folds, last = [], "l.bad"
    for i, s in enumerate(ups):
        folds.append(f"CASE WHEN {s}.n > 1 THEN sha256({s}.b || {last} || {s}.a) ELSE {last} END AS f{i}")
        last = f"f{i}"
    joins = " ".join(f"JOIN s{i} ON s{i}.lang IS NOT DISTINCT FROM l.lang AND s{i}.pos = l.pos // {8**i}" for i in range(ROW_LEVELS))
    joins += " JOIN t ON t.lang IS NOT DISTINCT FROM l.lang " + " ".join(f"JOIN u{i} ON u{i}.pos = t.num // {8**i}" for i in range(LANG_LEVELS))
    proof = " || ".join(f"{s}.b || {s}.a" for s in ups)
    parts.append(f"f AS (SELECT l.doc_id, l.leaf, t.subroot, g.h AS root, sha256({proof}) AS proof_sha256, {', '.join(folds)} FROM l {joins} CROSS JOIN g{LANG_LEVELS} g)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, {last} AS folded_root, {last} = root AS verified FROM f"


ORACLE: dict[str, str] = {
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        q AS (SELECT page_id, strlen(body) AS n, sha1(body) AS d, max(page_id) OVER (PARTITION BY sha1(body)) AS last FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
        FROM q""",
    "op11_url_filters": _url_sql(),
    "op12_hard_negatives": NEGATIVES_SQL,
    "op13_merkle_manifest": _merkle_sql(),
}
