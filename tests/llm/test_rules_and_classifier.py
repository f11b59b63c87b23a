import collections
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from mercato.llm import fingerprints as P
from mercato.llm import quality_classifier as C
from mercato.llm import quality_rules as R

SF = "/root/testdata/sf0.001"
W = re.compile(r"[^\x20\x09-\x0D]+")


def brute_figures(t):
    t = t or ""
    w = W.findall(t)
    c = collections.Counter(zip(w, w[1:], w[2:]))
    hit = [False] * len(w)
    for i in range(len(w) - 2):
        if c[w[i], w[i + 1], w[i + 2]] > 1:
            hit[i : i + 3] = [True] * 3
    lines = [x for x in t.split("\n") if W.search(x)]
    return len(w), sum(map(len, w)), sum(t.count(x) for x in R.SYMBOLS), len(lines) - len(set(lines)), sum(hit)


@pytest.mark.parametrize("hashed", [R.WINDOW_HASH, "pmod(xxhash64({0}, {1}), 3L)"])
def test_figures_equal_brute_force(docs_of, monkeypatch, hashed):
    monkeypatch.setattr(R, "WINDOW_HASH", hashed)  # the second one lets all windows of a text share a hash
    rnd = random.Random(1)
    rows = [(i, "".join(rnd.choice(["a ", "b ", "é$ ", "\n", "\t", "a b a\n", "\x0b", "x|y ", " "]) for _ in range(rnd.randrange(0, 60)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "a " * 5000), (203, "\n\n"), (204, "a b"), (204, "a b")]
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in R.text_figures(docs_of(rows)).collect())
    assert got == collections.Counter((i, *brute_figures(t)) for i, t in rows)


def test_rules_are_learned_and_keep_clean_rows(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(600):
        bad = i % 3 == 0
        rows.append((i, int(bad), rnd.uniform(0.2, 0.5) if bad and i % 2 else 0.0, rnd.uniform(0.5, 0.9) if bad and not i % 2 else rnd.uniform(0, 0.1), rnd.random()))
    df = spark.createDataFrame(rows, "doc_id long, bad int, a double, b double, noise double")
    rules = R.learn_rules(df, ("a", "b", "noise"))
    assert 1 <= len(rules) <= 3
    hit = F.lit(False)
    for r in rules:
        hit = hit | R.all_hold(r)
    assert df.where(hit & (F.col("bad") == 0)).count() == 0
    assert df.where(hit).count() >= 180
    assert R.learn_rules(df.where("bad = 0"), ("a", "b")) == []
    assert R.learn_rules(df.where("false"), ("a", "b")) == []


def test_verdicts_equal_a_plain_reading_of_the_list(docs_of, spark):
    """``rule`` and ``kept`` from brute-force figures and the learned conditions, row by row."""
    rnd = random.Random(6)
    rows = [(i, " ".join((f"buy{rnd.randrange(400)}" + rnd.choice(["!!", "|", "##"]) if i % 3 == 0 else f"word{rnd.randrange(400)}") for _ in range(rnd.randrange(45, 90)))) for i in range(240)] + [(None, "w"), (7, None)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    docs = docs_of(rows)
    figures = R.with_features(R.text_figures(docs))
    rules = R.learn_rules(figures.join(labels.withColumnRenamed("doc_id", "of"), F.col("doc_id") == F.col("of")).withColumn("bad", 1 - F.col("quality")).where(~R.base_failed()))
    assert rules

    def plain(r):
        n, chars, _, _, again = brute_figures(r.text)
        if n < 50 or 100 * again > 50 * n:
            return 0
        shares = {"word_length": chars / n, "bang_share": r.text.count("!") / chars, "bar_share": r.text.count("|") / chars, "symbol_share": sum(r.text.count(x) for x in R.SYMBOLS) / chars, "n_words": n, "repeat_share": again / n, "line_words": n, "dup_line_share": 0.0, "upper_share": 0.0, "digit_share": sum(map(str.isdigit, r.text)) / chars}
        return next((i for i, rule in enumerate(rules, 1) if all((shares[c.feature] > c.threshold) == c.above for c in rule)), None)

    got = R.apply_rules(docs, labels).collect()
    want = collections.Counter((r.doc_id, plain(r)) for r in docs.collect())
    assert collections.Counter((r.doc_id, r.rule) for r in got) == want
    assert all(r.kept == (r.rule is None) for r in got)


def test_rule_tables(docs_of, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 0, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    rows = [(1, "w " * 20), (2, " ".join(f"w{k}" for k in range(80))), (None, None), (2, "")]
    got = R.apply_rules(docs_of(rows), labels).collect()
    assert len(got) == 4
    assert [r.kept for r in got if r.n_words == 80] == [True]
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 50)
    assert R.apply_rules(docs_of([]), labels).count() == 0
    assert R.apply_rules(docs_of(rows), labels.where("false")).count() == 4
    clash = docs_of(rows).withColumnRenamed("key", "bad").withColumnRenamed("n", "n_words").withColumnRenamed("component", "rule")
    assert R.apply_rules(clash, labels).count() == 4


def tables(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_classifier_on_held_out_labels(spark):
    docs, labels = tables(spark)
    known = labels.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)))
    scored = C.classify(docs, known.where("part > 0").drop("part")).withColumnRenamed("doc_id", "id")
    held = known.where("part = 0").join(scored, F.col("doc_id") == F.col("id")).groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in held}
    assert n.get((0, False), 0) >= 0.85 * (n.get((0, False), 0) + n.get((0, True), 0))
    assert n.get((1, False), 0) <= 0.02 * n[1, True] + 1


def test_sparse_sites_shrink(spark):
    rows = [("h", "a", -3.0)] * 400 + [("h", "b", 3.0)] * 400 + [("g", "a", -3.0)] * 800 + [("s", "a", 3.0)]
    rates = {(r.host, r.path): r.rate for r in C.site_rates(spark.createDataFrame(rows, "host string, path string, evidence double"), 0.0).collect()}
    assert rates["g", "a"] < 0.15 and rates["h", "b"] > 0.7
    assert rates["s", "a"] < 0.6 < 0.95  # one document says little
    assert C.site_rates(spark.createDataFrame([], "host string, path string, evidence double"), 0.0).count() == 0


def test_classifier_tables(docs_of, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(1, "a b"), (1, "a b"), (None, None), (2, "")]
    got = C.classify(docs_of(rows), none).collect()
    assert len(got) == 4 and all(r.kept for r in got)
    assert C.classify(docs_of([]), none).count() == 0
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    many = docs_of([(i, "good words here" if i % 2 else "bad### junk###") for i in range(80)] + rows)
    out = C.drop_rejected(many, labels)
    assert out.columns == many.columns
    assert not [r for r in out.collect() if r.text and "junk" in r.text] and out.where("text like 'good%'").count() == 40


# -- fingerprints -----------------------------------------------------------
def similarity(a, b):
    x, y = collections.Counter(W.findall(a)), collections.Counter(W.findall(b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


@pytest.mark.parametrize("buckets", [1, 7])
def test_fingerprints_against_brute_force(spark, docs_of, buckets):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["a", "b", "cé", "d", "e", "f", "g"]) + str(rnd.randrange(6)) for _ in range(rnd.randrange(0, 90)))) for i in range(60)]
    rows += [(100, rows[5][1]), (101, None), (102, ""), (-7, "x " * 3000)]
    got = {r.doc_id: r for r in P.edited_fingerprints(docs_of(rows), buckets=buckets).collect()}
    down = sorted(rows, key=lambda r: -r[0])
    off = []
    for k, (i, t) in enumerate(down):
        t, nxt = t or "", down[(k + 1) % len(down)][1] or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        off.append(r.near_edited - similarity(t, edited) if t and edited else 0.0)
    assert got[5].fingerprint == got[100].fingerprint
    assert got[101].fingerprint == got[102].fingerprint == ""
    assert abs(sum(off) / len(off)) < 0.05 and max(map(abs, off)) < 0.5


def test_equal_texts_have_equal_fingerprints(docs_of):
    got = P.fingerprints(docs_of([(1, "a b a"), (2, "a a b"), (3, "a b"), (4, None), (None, "a b a")])).collect()
    by = {r.doc_id: r.fingerprint for r in got}
    assert by[1] == by[2] == by[None] != by[3] and by[4] == ""


def test_fingerprint_tables(docs_of):
    assert P.edited_fingerprints(docs_of([])).count() == 0
    one = P.edited_fingerprints(docs_of([(1, "a b c")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    rows = [(1, "a b"), (1, "a b"), (None, "c d"), (None, None), (2, "e")]
    assert P.edited_fingerprints(docs_of(rows)).count() == 5


def brute_posteriors(rows, model):
    """p_bad by (text, source, lang), from the model's weights and plain loops."""
    scorer = C.Scorer(model.ratios)
    ev = []
    for _, text, lang, source in rows:
        x = [(f - m) / s for f, m, s in zip(scorer.features(text or ""), model.centre, model.scale)]
        e = sum(max(-20.0, min(20.0, v)) * w for v, w in zip(x, model.weights)) + model.weights[-1] - model.prior
        ev.append(max(-30.0, min(30.0, e)))
    paths, hosts = collections.defaultdict(list), collections.defaultdict(list)
    for (_, _, lang, source), e in zip(rows, ev):
        p = 1 / (1 + math.exp(-(e + model.prior)))
        paths[source, lang].append(p)
        hosts[source].append(p)
    every = [p for v in hosts.values() for p in v]
    mean = sum(every) / len(every)

    def strength(groups):
        k, n = len(groups), len(every)
        if k < 2:
            return 100.0
        noise = mean * (1 - mean)
        between = sum(len(v) * (sum(v) / len(v) - mean) ** 2 for v in groups.values()) / n - noise * k / n
        return min(10_000.0, max(10.0, noise / between - 1)) if between > 0 else 10_000.0

    of_host, of_path = strength(hosts), strength(paths)
    out = []
    for (_, _, lang, source), e in zip(rows, ev):
        h, q = hosts[source], paths[source, lang]
        host_rate = (sum(h) + of_host * mean) / (len(h) + of_host)
        rate = (sum(q) + of_path * host_rate) / (len(q) + of_path)
        out.append(1 / (1 + math.exp(-(e + math.log(rate / (1 - rate))))))
    return out


def test_classifier_equals_brute_force(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(240):
        bad = rnd.random() < (0.7 if i % 4 == 0 else 0.1)
        text = " ".join(rnd.choice(["buy", "cheap!!", "now|", "$$$"] if bad else ["river", "stone", "house", "garden", "walked"]) + str(rnd.randrange(40)) for _ in range(rnd.randrange(5, 60)))
        rows.append((i, text, rnd.choice(["en", "de", None]), None if i % 4 == 3 else f"host{i % 4}"))
    rows += [(900, None, None, None), (901, "", "en", "host0"), (902, "river1 " * 60_000, "en", "host1"), (None, "stone2 house3", "de", "host2"), (5, rows[5][1], rows[5][2], rows[5][3])]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, host string, rate int")
    labels = spark.createDataFrame([(i, int("cheap" not in rows[i][1] and "buy" not in rows[i][1]), 0) for i in range(160)], "doc_id long, quality int, toxic int")
    model = C.fit(docs, labels)
    want = collections.Counter((r[0], round(p, 6), p < C.REJECT) for r, p in zip(rows, brute_posteriors(rows, model)))
    got = C.classify(docs, labels).collect()
    assert collections.Counter((r.doc_id, round(r.p_bad, 6), r.kept) for r in got) == want
    assert len({r.kept for r in got}) == 2
    left = C.drop_rejected(docs, labels)
    assert left.columns == docs.columns
    assert collections.Counter(r.doc_id for r in left.collect()) == collections.Counter(r.doc_id for r in got if r.kept)
