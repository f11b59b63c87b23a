import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, id long, rank string"


def brute(rows, every, n_pos=5, n_neg=3, low=50, high=95, scale=256):
    def whole(x):
        return math.floor(scale * x) if math.isfinite(scale * x) else int(x) * scale

    part = [(i, [whole(x) for x in v], y) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in sorted({i for i, _, _ in part if i % every == 0}):
        _, av, al = min(((i, v, y) for i, v, y in part if i == a), key=lambda r: (r[2], r[1]))
        scored = [(sum(p * q for p, q in zip(av, v)), i, y) for i, v, y in part if i != a]
        pos = sorted((r for r in scored if r[2] == al), key=lambda r: (-r[0], r[1]))[:n_pos]
        for ps, pi, _ in pos:
            neg = sorted((r for r in scored if r[2] != al and low * ps <= 100 * r[0] <= high * ps), key=lambda r: (-r[0], r[1]))[:n_neg]
            out += [(a, pi, k, ni, ps, ns) for k, (ns, ni, _) in enumerate(neg, 1)]
    return sorted(out)


def mined(spark, rows, every, **more):
    df = spark.createDataFrame([(i, v, y, 1, "x") for i, v, y in rows], SCHEMA)
    return sorted(map(tuple, H.mine_hard_negatives(df, F.col("id") % every == 0, **more).collect()))


def vectors(rnd, n, dims=8, spread=1.0):
    return [(i, [rnd.gauss(0.3, spread) for _ in range(dims)], rnd.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("seed,group,anchors", [(1, 1024, 4096), (2, 40, 6)])
def test_equals_brute_force(spark, monkeypatch, seed, group, anchors):
    monkeypatch.setattr(H, "ROWS_A_GROUP", group)
    monkeypatch.setattr(H, "ANCHORS_A_GROUP", anchors)
    rnd = random.Random(seed)
    rows = vectors(rnd, 260)
    rows[20] = (20, [None] * 8, 1)
    rows[30] = (30, [float("nan")] + [0.1] * 7, 1)
    rows[31] = (31, [float("inf")] + [0.1] * 7, 1)
    rows[40] = (40, None, 1)
    rows[50] = (50, rows[50][1], None)
    rows[60] = (None, rows[60][1], 1)
    rows[70] = (70, [], 2)
    rows[71] = (71, [0.4], 0)
    rows += [(100, rows[100][1], rows[100][2])] + [(500 + k, rows[3][1], 1 + k % 2) for k in range(80)]  # a repeated anchor, a hot vector
    want = brute(rows, 10)
    assert mined(spark, rows, 10) == want and len(want) > 60
    assert mined(spark, rows, 10, n_positives=2, n_negatives=1, low=10, high=99, scale=8) == brute(rows, 10, 2, 1, 10, 99, 8)


def test_tables(spark):
    assert mined(spark, [], 10) == []
    assert mined(spark, [(0, [1.0], 1)], 10) == [] and mined(spark, [(3, [1.0], 1), (4, [1.0], 2)], 10) == []
    two = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 9.0], 2), (3, [0.95, 0.0], 3), (4, [0.96, 0.0], 3)]
    assert mined(spark, two, 10) == brute(two, 10) == [(0, 1, 1, 3, 65536, 62208), (0, 1, 2, 2, 65536, 32768)]


def test_large_components_keep_exact_scores(spark):
    rnd = random.Random(4)
    rows = vectors(rnd, 60) + [(100 + k, [rnd.choice([1e4, 1e6, 3e5]) * rnd.random() for _ in range(8)], k % 3) for k in range(20)]
    assert mined(spark, rows, 10) == brute(rows, 10)
    rows += [(200, [1e300] * 8, 1), (210, [1.7e308, -1.7e308] + [0.0] * 6, 2), (220, [3e38] * 8, 0)]
    got = mined(spark, rows, 10)  # scores beyond a long stand at its end
    assert [r for r in got if max(map(abs, r[4:])) < H.MOST_LONG] == [r for r in brute(rows, 10) if max(map(abs, r[4:])) < H.MOST_LONG]


@pytest.mark.parametrize("most", [1, 100, 4096, 1 << 20, 1 << 27, 1 << 40, 1 << 90])
def test_packed_products_are_inner_products(most):
    rnd = random.Random(most)
    rows = [[rnd.randint(-most, most) for _ in range(16)] for _ in range(33)]
    rows[0] = [most] * 16
    rows[1] = [-most] * 16
    packed = H.Packed(np.array(rows, dtype=object if most >= 1 << 62 else np.int64))
    for anchor in ([most] * 16, [-most] * 16, [0] * 16, [rnd.randint(-most, most) for _ in range(16)]):
        assert [int(x) for x in packed.scores(anchor)] == [sum(a * b for a, b in zip(anchor, r)) for r in rows]
    assert H.field_bytes(64, 333, 333) == 4 and H.field_bytes(64, 1 << 20, 1 << 20) == 8 and H.field_bytes(64, 1 << 40, 1 << 40) > 8


def test_blocks_hold_large_components_apart():
    rows = np.array([[1, 2], [1 << 30, 5], [3, -4], [1 << 14, 0]], dtype=np.int64)
    block = H.Block(np.array([4, 3, 2, 1]), rows)
    assert len(block.parts) == 3
    assert dict(zip(block.ids.tolist(), map(int, block.scores([7, -9])))) == {4: -11, 3: 7 * (1 << 30) - 45, 2: 57, 1: 7 << 14}


def test_best_keeps_ties():
    scores, ids = np.array([5] * 40 + [9, 1]), np.array([*range(40, 0, -1), 50, 51])
    assert [int(ids[i]) for i in H.best(scores, ids, 3)] == [50, 1, 2]
    assert H.score_window(-7, 50, 95) == (-3, -7) and H.score_window(100, 50, 95) == (50, 95) and H.score_window(101, 50, 95) == (51, 95)
