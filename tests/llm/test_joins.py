import collections
import itertools
import random
import re

import numpy as np
import pytest
from llm_brute import brute_components, brute_lines, brute_sets

from mercato.llm import jaccard_join as J
from mercato.llm import line_dedup as D
from mercato.llm import links as L
from mercato.llm.links import bloom, components


def corpus(seed):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    shared = " ".join(rnd.choice(words) for _ in range(30))
    rows = []
    for g in range(25):
        base = [rnd.choice(words) for _ in range(rnd.choice([1, 3, 5, 8, 11, 13, 16, 19, 23, 40, 90]))]
        for _ in range(rnd.randrange(1, 7)):
            own = list(base)
            for _ in range(rnd.randrange(0, 3)):
                k = rnd.randrange(0, len(own) + 1)
                own[k : k + rnd.randrange(0, 2)] = [rnd.choice(words)] * rnd.randrange(0, 2)
            rows.append(" ".join(own) + (" " + shared if g % 5 == 0 else ""))
    return list(enumerate(rows)) + [(900, None), (901, ""), (902, " \n\t"), (903, "Über ÜBER x"), (904, "w1 " * 4000)]


@pytest.mark.parametrize("seed,light", [(1, None), (2, 0), (3, 12), (4, 15)])
def test_components_equal_brute_force(docs_of, seed, light):
    rows = corpus(seed)
    sets = brute_sets(rows)
    want = brute_components(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(docs_of(rows), light).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_sizes():
    for n in range(1, 200):
        for b in range(J.least_partner(n) or 1, J.most_partner(n) + 1):
            need = next(c for c in range(1, n + b) if 100 * c >= 80 * (n + b - c))
            assert J.least_overlap(n, b) == need
        assert 1 <= J.index_length(n) <= J.prefix_length(n) <= n
    assert J.light_boundary({}) == J.MOST_LIGHT
    assert 0 < J.light_boundary({n: 10 for n in range(1, 30)}) < J.MOST_LIGHT + 1


def test_join_tables(docs_of):
    assert J.jaccard_components(docs_of([])).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A B C D E F"), (3, "x")]
    got = sorted(map(tuple, J.jaccard_components(docs_of(rows)).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (2, 2, 1), (3, 1, 3)], key=str)
    kept = J.drop_near_copies(docs_of(rows))  # one row of a class, equal rows of one id and rows without id included
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3] and kept.columns == docs_of([]).columns


def test_unlike_rows_of_one_id_stay(docs_of):
    same, unlike = "a b c d e f g h", "one two three four five six"
    docs = docs_of([(1, same), (2, same), (2, unlike), (2, None), (3, unlike), (4, same), (4, same), (None, same), (None, "text without a name, twice"), (None, "text without a name, twice"), (None, "")])
    kept = J.drop_near_copies(docs)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, same), (2, unlike), (2, None), (None, "text without a name, twice"), (None, "")], key=str)
    assert kept.schema == docs.schema


@pytest.mark.parametrize("names", [("dropped_id", "mixed"), ("n_dropped", "n_lines"), ("of", "first_id"), ("C0", "gone")])
def test_clashing_names(docs_of, names):
    """Columns named like those that the operators use inside stay as they are."""
    rows = [(1, "a b c d e f\nsame line of two here"), (2, "a b c d e f\nsame line of two here"), (2, "else\nsame line of two here"), (None, "a b c d e f\nsame line of two here")]
    docs = docs_of(rows).withColumnRenamed("key", names[0]).withColumnRenamed("n", names[1])
    kept = J.drop_near_copies(docs)
    assert kept.columns == docs.columns and {r[names[0]] for r in kept.collect()} == {"x"} and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    out = D.dedup_lines(docs)
    assert out.columns[: len(docs.columns)] == docs.columns and {r[5] for r in out.collect()} == {"x"} and sum(r[-1] for r in out.collect()) == 5


@pytest.mark.parametrize("seed", [1, 5])
def test_long_lists_equal_brute_force(docs_of, monkeypatch, seed):
    """Every list of more than two ids takes the way of the long ones, and the
    components are found by rounds over all links."""
    monkeypatch.setattr(L, "LONG_LIST", 2)
    monkeypatch.setattr(L, "MOST_EDGES", 0)
    rows = corpus(seed)
    want = brute_components(brute_sets(rows))
    got = {r.doc_id: r.component_id for r in J.jaccard_components(docs_of(rows)).collect()}
    assert got == want

@pytest.mark.parametrize("most", [L.MOST_EDGES, 0])
def test_components_of_a_path_and_a_star(spark, monkeypatch, most):
    monkeypatch.setattr(L, "MOST_EDGES", most)
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (5, 4), (-3, 200), (200, -3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 160)}, -3: -3, 200: -3}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_keep_forty_bits():
    s = J.shingle_set("a b c d e f g a b c d e")
    assert (J.unpack_set(J.pack_set(s)) == s >> np.uint64(24) << np.uint64(24)).all()
    assert len(J.unpack_set(J.pack_set(J.shingle_set("")))) == 0


def test_bloom_never_loses_a_key(spark):
    rnd = random.Random(1)
    keys = [rnd.getrandbits(64) - (1 << 63) for _ in range(5000)]
    f = bloom(spark.createDataFrame([(k,) for k in keys], "k long"), "k", L.bits_for(len(keys)))
    assert f.has(np.array(keys)).all()
    others = np.array([rnd.getrandbits(64) - (1 << 63) for _ in range(5000)])
    assert f.has(others).mean() < 0.1


# -- lines ------------------------------------------------------------------
def test_units_join_again():
    rnd = random.Random(2)
    for _ in range(200):
        text = "".join(rnd.choice(["ab ", "\n", "x" * 3000, "word " * 900]) for _ in range(rnd.randrange(0, 9)))
        assert D.without(text, set()) == (text, 0)


def test_simhash_of_equal_and_near_lines():
    words = [f"w{k}" for k in range(200)]
    a, b, c = D.simhashes([words, words[:-1] + ["z"], [f"q{k}" for k in range(200)]])
    assert bin(int(a) ^ int(b)).count("1") <= 8 < bin(int(a) ^ int(c)).count("1")
    tokens = D.block_tokens(np.array([a, a ^ np.uint64(0b111)], dtype=np.uint64))
    assert (tokens[0] == tokens[1]).sum() >= 1


def test_no_word_prevails_in_a_simhash():
    rows = [" | ".join(f"w{i}x{k}" for k in range(30)).split() for i in range(2)]
    a, b = D.simhashes(rows)
    assert bin(int(a) ^ int(b)).count("1") > 8
    assert D.features(["|"] * 6) and D.features(["ab"] * 20) == ["ab"] * 3
    assert D.features("the cat and the dog".split()) != []


def test_rests_of_lines():
    assert D.trimmed("abc", "abc") == ("", "")
    assert D.trimmed("abc", "abcd") == ("", "d")
    assert D.trimmed("xaby", "xcy") == ("ab", "c")
    assert D.trimmed("aa", "aaa") == ("", "a")
    assert D.trimmed("", "q") == ("", "q")


def test_within_equals_the_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            old, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
        return row[-1]

    rnd = random.Random(8)
    for _ in range(400):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randrange(0, 90))) for _ in "ab")
        if rnd.random() < 0.5:
            b = a[:20] + rnd.choice(["", "b", "cab"]) + a[25:]
        d = distance(a, b)
        assert D.letters_apart(a, b) <= d and distance(*D.trimmed(a, b)) == d
        assert D.within(a, b, d) and not (d and D.within(a, b, d - 1))


def test_pigeonhole():
    rnd = random.Random(3)
    sims = np.array([rnd.getrandbits(64) for _ in range(300)], dtype=np.uint64)
    flipped = sims.copy()
    for i in range(300):
        for bit in rnd.sample(range(64), D.DISTANCE):
            flipped[i] ^= np.uint64(1 << bit)
    assert (D.block_tokens(sims) == D.block_tokens(flipped)).any(axis=1).all()


@pytest.mark.parametrize("long_list", [L.LONG_LIST, 2])
def test_lines_equal_brute_force(docs_of, monkeypatch, long_list):
    monkeypatch.setattr(L, "LONG_LIST", long_list)
    rnd = random.Random(5)
    words = [f"word{chr(97 + k)}" for k in range(26)]
    bases = [[rnd.choice(words) for _ in range(rnd.randrange(3, 40))] for _ in range(20)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rnd.randrange(1, 5)):
            own = list(rnd.choice(bases))
            if rnd.random() < 0.4:
                own[rnd.randrange(len(own))] += rnd.choice(["s", "ed", ""])
            lines.append(" ".join(own).upper() if rnd.random() < 0.2 else " ".join(own))
        rows.append((i, "\n".join(lines)))
    want = brute_lines(rows)
    out = {r.doc_id: r for r in D.dedup_lines(docs_of(rows)).collect()}
    assert {i: r.text for i, r in out.items()} == want
    assert all(r.n_chars == len(r.text) for r in out.values())
    assert sum(r.n_dropped for r in out.values()) > 10


@pytest.mark.parametrize(("cell", "most"), [(4, 10**6), (4, 40), (2, 0)])
def test_cells_hold_the_pairs_of_long_lists(spark, monkeypatch, cell, most):
    """Lists in one cell, in parts and classes of size, and left for pairs of blocks:
    every near pair of different components meets, and postings are not copied by pairs of blocks."""
    monkeypatch.setattr(D, "CELL", cell)
    monkeypatch.setattr(D, "MOST_CELLED", most)
    rnd = random.Random(8)
    rows, base = [], [rnd.getrandbits(64) for _ in range(6)]
    for i in range(160):
        sim = rnd.choice(base)
        for bit in rnd.sample(range(64), rnd.randrange(10)):
            sim ^= 1 << bit
        rows.append((rnd.choice([1, 1, 1, 2, 3]), i % 90, i, sim - (1 << 64) if sim >> 63 else sim, rnd.choice([5, 40, 41, 48, 50, 51, 60, 63, 80, 300])))
    rows += [(9, 1000 + k, 1000 + k, rows[0][3], 50) for k in range(3)]
    placed = spark.createDataFrame(rows, "token long, component long, id long, sim long, size int")
    compared, left = D.in_cells(0.8)(placed)
    got = {(r.a, r.b) for r in compared.collect()}
    n = collections.Counter(r[0] for r in rows)
    want = set()
    for x in rows:
        for y in rows:
            apart = x[0] == y[0] and x[1] != y[1] and x[2] < y[2] and abs(x[4] - y[4]) <= 0.2 * max(x[4], y[4]) + 1e-9
            if apart and n[x[0]] <= most and bin((x[3] ^ y[3]) & ((1 << 64) - 1)).count("1") <= D.DISTANCE:
                want.add((x[2], y[2]))
    assert got == want and (most == 0 or len(got) > 3)
    assert (left is None) == (most == 10**6) and (left is None or left.count() == 120 * sum(k for k in n.values() if k > most))


@pytest.mark.parametrize(("cell", "most"), [(8, 10**6), (10**6, 10**6)])
def test_cells_verify_their_pairs(spark, monkeypatch, cell, most):
    """With texts a cell gives links alone, no row for each near pair, enough for the
    components of all links; pairs that share several anchors count once."""
    monkeypatch.setattr(D, "CELL", cell)
    monkeypatch.setattr(D, "MOST_CELLED", most)
    rnd = random.Random(4)
    lines = []
    for i in range(120):
        own = list("abcde" + "".join(rnd.choice("xyz") for _ in range(5)) * 3 + "vwxyz") if i % 3 else list("abcde" + "m" * 15 + "vwxyz")
        own[rnd.randrange(6, 18)] = rnd.choice("xym")
        lines.append("".join(own))
    texts = dict(enumerate(dict.fromkeys(lines)))
    ends = {i: D.anchors(t) for i, t in texts.items()}
    sim = dict(zip(texts, D.simhashes([[t] for t in texts.values()]).view("int64").tolist()))
    placed = spark.createDataFrame([(t, i, i, sim[i], len(texts[i])) for i in texts for t in ends[i]], "token long, component long, id long, sim long, size int")
    known = spark.createDataFrame(list(texts.items()), "key long, text string")
    links, left = D.in_cells(0.8, lambda: known)(placed)
    got = [(r.a, r.b) for r in links.collect()]
    near = {(i, j) for i in texts for j in texts if i < j and set(ends[i]) & set(ends[j]) and ((sim[i] ^ sim[j]) & ((1 << 64) - 1)).bit_count() <= D.DISTANCE}
    want = {(i, j) for i, j in near if D.similar(texts[i], texts[j], 0.8)}

    def groups(pairs):
        of = {i: i for i in texts}
        for _ in texts:
            for i, j in pairs:
                of[i] = of[j] = min(of[i], of[j])
        return of

    assert left is None and set(got) <= want and len(got) == len(set(got)) and groups(got) == groups(want)
    assert 0 < len(got) < len(want) < len(near) and len(set(groups(want).values())) > 1


def test_line_tables(docs_of):
    same = "one two three four five six"
    rows = [(5, same), (3, f"{same}\nshort line\n{same}"), (None, None), (4, ""), (6, "ONE  two three four five six\nnew"), (7, "p 1 of 20 in all"), (8, "p 2 of 20 in all")]
    out = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in D.dedup_lines(docs_of(rows)).collect()}
    assert out == {3: (f"{same}\nshort line", 3, 1), 4: ("", 1, 0), 5: ("", 1, 1), 6: ("new", 2, 1), None: (None, 0, 0), 7: ("p 1 of 20 in all", 1, 0), 8: ("", 1, 1)}
    assert D.dedup_lines(docs_of([])).count() == 0
    assert D.dedup_lines(docs_of(rows)).columns == [*docs_of([]).columns, "n_lines", "n_dropped"]


#: Least share found of lines with a changed copy of edit similarity 0.8: by letters
#: of the line, for one other word, one other letter, and a tenth of the letters.
RECALL = ((5, 20, 0.9, 0.9, 0.6), (20, 50, 0.85, 0.95, 0.5), (50, 100, 0.9, 0.95, 0.3), (100, 200, 0.95, 0.95, 0.2), (200, 4096, 0.95, 0.95, 0.1))


def changed(rnd, line, how, words):
    if how == 0:
        w = line.split()
        w[rnd.randrange(len(w))] = rnd.choice(words)
        return " ".join(w)
    out = list(line)
    for k in rnd.sample(range(len(out)), 1 if how == 1 else max(1, len(out) // 10)):
        out[k] = rnd.choice("aeiou")
    return " ".join("".join(out).split())


def test_recall_of_changed_lines():
    pq = pytest.importorskip("pyarrow.parquet")
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    lines = sorted({" ".join(w) for t in texts for _, u in D.units(t or "") if (w := D.normalised(u))})
    rnd = random.Random(9)
    rnd.shuffle(lines)
    words = sorted({w for x in lines[:500] for w in x.split()})
    found = {}
    for lo, hi, *least in RECALL:
        for how, share in enumerate(least):
            pairs = [(x, changed(rnd, x, how, words)) for x in [x for x in lines if lo <= len(x) < hi][:600]]
            pairs = [(x, y) for x, y in pairs if x != y and y and D.within(x, y, int((1 - D.SIMILARITY) * max(len(x), len(y)) + 1e-9))]
            sims = [D.simhashes([x.split() for x in side]) for side in zip(*pairs)]
            hits = sum(bin(int(p) ^ int(q)).count("1") <= D.DISTANCE and bool(set(D.anchors(x)) & set(D.anchors(y))) for (x, y), p, q in zip(pairs, *sims))
            found[lo, how] = (hits / len(pairs), len(pairs), share)
    print(found)
    assert all(n >= 15 and got >= share for got, n, share in found.values()), found


def test_long_lines_are_cut_alike_behind_an_insertion():
    rnd = random.Random(3)
    line = " ".join(f"w{rnd.randrange(5000)}" for _ in range(6000))
    a, b = ({u for _, u in D.units(x)} for x in (line, "one more word " + line))
    assert len(a) > 6 and len(a & b) >= len(a) - 2


def test_short_lines_and_lines_without_spaces(docs_of):
    rnd = random.Random(4)
    plain = "".join(chr(0x4E00 + rnd.randrange(900)) for _ in range(300))
    other = plain[:150] + "\u3042" + plain[151:]
    rows = [(1, f"All rights reserved.\n{plain}\nab"), (2, "x\nall  rights reserved."), (3, f"{other}\nac\n \n"), (4, f"{plain}\nAB\n \nkept"), (5, "7"), (6, "8")]
    out = {r.doc_id: (r.text, r.n_dropped) for r in D.dedup_lines(docs_of(rows)).collect()}
    assert out == {1: (rows[0][1], 0), 2: ("x", 1), 3: ("ac\n \n", 1), 4: (" \nkept", 2), 5: ("7", 0), 6: ("", 1)}


def test_removed_lines_go_by_row(docs_of):
    rows = [(None, f"first line of all here\nown line {'x' * k}\nsecond line that comes again") for k in range(0, 60, 3)] + [(7, "first line of all here\nother"), (7, "quite another text\nsecond line that comes again")]
    docs = docs_of(rows)
    gone = D.repeated_lines(docs.select("doc_id", "text"))
    assert gone.groupBy("doc_id", "row").count().agg({"count": "max"}).first()[0] <= 3
    out = D.dedup_lines(docs).collect()
    assert sorted(r.text for r in out if r.doc_id == 7) == ["other", "quite another text"]
    assert len(out) == len(rows) and all(r.n_dropped <= 3 for r in out)
    assert sum("first line of all here" in r.text for r in out) == 20


def test_whole_sets_of_unlike_long_texts_are_not_fetched(docs_of, monkeypatch):
    """Long texts with seven tenths in common meet by their first shingles and pass the
    coarse counts; the sketches tell them apart, so no whole set is shuffled."""
    rnd = random.Random(5)
    text = [f"w{rnd.randrange(10**6)}" for _ in range(4000)]
    other = text[:2800] + [f"v{rnd.randrange(10**6)}" for _ in range(1200)]
    near = text[:3900] + [f"x{k}" for k in range(100)]
    compared, known, similar = [], [], J._similar_pairs
    may = J._may_pairs
    monkeypatch.setattr(J, "_may_pairs", lambda both: known.extend(both.select("a", "b").collect()) or may(both))
    monkeypatch.setattr(J, "_similar_pairs", lambda both: compared.extend(both.select("a", "b").collect()) or similar(both))
    rows = [(1, " ".join(text)), (2, " ".join(other))]
    got = {r.doc_id: r.component_id for r in J.jaccard_components(docs_of(rows)).collect()}
    assert got == {1: 1, 2: 2} and known and not compared
    rows.append((3, " ".join(near)))
    got = {r.doc_id: r.component_id for r in J.jaccard_components(docs_of(rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1} and compared


def test_sketches_never_fall_below_the_overlap():
    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (3, 4), (40, 50), (900, 1100), (1023, 1024), (5000, 4100), (9, 3000)):
        every = np.unique(rng.integers(0, 1 << 64, n + m, dtype=np.uint64))
        x, y = np.sort(every[:n]), np.sort(every[n // 2 : n // 2 + m])
        most, sizes = J.most_common(J.sketch(x), J.sketch(y))
        assert len(np.intersect1d(x, y)) <= most and sizes == len(x) + len(y)
    assert J.sketch(np.arange(300, dtype=np.uint64)) is None  # a count passes its byte
