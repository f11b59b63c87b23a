import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from mercato.llm import merkle as M
from mercato.llm.queries import op13_merkle_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """The top, and of each node its siblings on the way: (before, after) by level."""
    ways = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, above = [], []
        for k in range(0, len(nodes), 8):
            run = nodes[k : k + 8]
            for j in range(len(run)):
                for i in under[k + j]:
                    ways[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(h(*run))
            above.append([i for u in under[k : k + 8] for i in u])
        nodes, under = up, above
    return nodes[0], ways


def manifest(rows):
    """The contract's columns of rows (doc_id, text, lang, source, n_chars)."""
    leaves = [(r, leaf_of((r[0], r[3], r[2], r[4], r[1]))) for r in rows]
    groups = {}
    for r, own in leaves:
        groups.setdefault(r[2], []).append((r, own))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        groups[x].sort(key=lambda p: (p[0][0] is not None, p[0][0] or 0, p[1]))
    trees = [tree([own for _, own in groups[x]]) for x in langs]
    root, crown = tree([top for top, _ in trees]) if langs else (None, [])
    out = []
    for x, (top, ways), last in zip(langs, trees, crown):
        for (r, own), way in zip(groups[x], ways):
            way = way + last
            now = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
                now = leaf_of((r[0], r[3], r[2], r[4], low))
            for before, after in way:
                now = h(before, now, after)
            out.append((r[0], own, top, root, h("".join(b + a for b, a in way)), now, now == root))
    return sorted(out, key=str)


def run(spark, rows, tmp_path, name):
    base = str(tmp_path / name)
    spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, m_leaf string, tree long").write.parquet(f"{base}/documents.parquet")
    return sorted(map(tuple, op13_merkle_manifest(spark, base).collect()), key=str)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 70, "de": 8, None: 9, "fr": 1, "ZZ": 2}, {f"l{k}": 1 + k % 3 for k in range(20)}, {"en": 513}])
def test_equals_brute_force(spark, tmp_path, sizes):
    rnd = random.Random(len(sizes))
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += rnd.randrange(1, 4)
            rows.append((i, rnd.choice(["Some Text", "ünicode Ä", None, "", "plain"]) if rnd.random() < 0.7 else f"Text {i}\n" * rnd.randrange(1, 400), lang, rnd.choice(["web", None]), rnd.choice([i, None])))
    rnd.shuffle(rows)
    got = run(spark, rows, tmp_path, "t")
    assert got == manifest(rows)
    assert len(sizes) == 1 or {r[-1] for r in got} == {True, False}


def test_tables(spark, tmp_path):
    assert run(spark, [], tmp_path, "none") == []
    same = (7, "Same Text", "en", "web", 9)
    rows = [same] * 30 + [(None, "No id", "en", None, None)] * 3 + [(7, "Same Text", None, None, 9), (7, None, "en", "web", 9), (3, "A" * 300_000, "en", "s", 1)]
    assert run(spark, rows, tmp_path, "ties") == manifest(rows)


def test_general_interface(spark):
    rows = [(f"k{k:03d}", k % 2, "text", k) for k in range(40)]
    df = spark.createDataFrame(rows, "name string, part int, way string, size int").withColumn("own", M.leaf_digest([F.col("name")]))
    out = M.merkle_ways(df, "part", "name", "own")
    assert out.columns == [*df.columns, "m_subroot", "m_root", "m_way"]
    assert out.where(M.folded(F.col("own"), F.col("m_way")) == F.col("m_root")).count() == 40
    tops = {g: tree([h(f"{len(n)}:{n}") for n, p, _, _ in rows if p == g])[0] for g in (0, 1)}
    assert {(r.part, r.s) for r in out.select("part", M.hex_text(F.col("m_subroot")).alias("s")).distinct().collect()} == set(tops.items())
    assert {len(r.m_way) for r in out.collect()} == {3}
