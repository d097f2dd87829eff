import math
import random

import numpy as np
import pytest

from postloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, window int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "r", 1) for i, v, y in rows], SCHEMA)


def slow(rows, asked, positives=5, count=3, low=50, high=95):
    def clean(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    whole = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if i is not None and y is not None and clean(v)]
    out = []
    for a in sorted({i for i, _, _ in whole if asked(i)}):
        y, v = min((y, v) for i, v, y in whole if i == a)
        hits = [(-sum(p * q for p, q in zip(v, w)), i, z) for i, w, z in whole if i != a and len(w) == len(v)]
        for p, i, _ in sorted(h for h in hits if h[2] == y)[:positives]:
            inside = sorted((n, j) for n, j, z in hits if z != y and low * -p <= 100 * -n <= high * -p)
            out += [(a, i, r + 1, j, -p, -n) for r, (n, j) in enumerate(inside[:count])]
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 19, 60])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "TILE_ANCHORS", 3)
    monkeypatch.setattr(negatives, "TILE_ROWS", 16)
    rng = random.Random(block)
    base = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(160):
        y = 0 if i % 3 else rng.randrange(4)  # a hot label
        rows.append((i, [x + rng.gauss(0, 0.7) for x in base[rng.randrange(4)]], y))
    rows += [(200 + i, rows[1][1], rng.randrange(3)) for i in range(30)]  # one vector many times: ties
    rows += [(300, None, 1), (305, [0.1, None, 0.2], 1), (310, [float("nan")] * 6, 1), (315, [float("-inf")] * 6, 0)]
    rows += [(320, [0.5] * 6, None), (None, [0.5] * 6, 1), (325, [], 1), (326, [], 0), (327, [], 1), (330, [1.0, 2.0], 1)]
    rows += [(331, [1.0, 2.0], 1), (332, [1.0, 1.0], 2), (10, rows[10][1], 2), rows[7], (335, [0.0] * 6, 1), (336, [-1e-20, 0.5, 0.5, 0.5, 1e-300, -0.0], 2)]
    rng.shuffle(rows)
    vectors = frame(spark, rows).repartition(4)
    got = negatives.mine(vectors, vectors.filter("vec_id % 5 = 0"), block=block).collect()
    want = slow(rows, lambda i: i % 5 == 0)
    assert sorted(tuple(r) for r in got) == want and len(want) > 100


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for size, dim in ((3, 1), (300, 64), (1e4, 1500), (3e6, 40)):
        a, b = (np.floor(rng.uniform(-size, size, (n, dim))) for n in (5, 7))
        want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        assert negatives._Factor(a).scores(b).tolist() == want
    extreme = np.array([[3e9, -1.0], [2.0**60, 0.0]])
    small = np.array([[1.0, 2.0], [3.0, -5.0]])
    assert negatives._Factor(extreme[:1]).scores(extreme[:1])[0, 0] == 9 * 10**18 + 1
    assert negatives._Factor(extreme).scores(small).tolist() == [[3 * 10**9 - 2, 9 * 10**9 + 5], [2**60, 3 * 2**60]]
    with pytest.raises(OverflowError):
        negatives._Factor(extreme).scores(extreme)
    with pytest.raises(OverflowError):
        negatives._Factor(np.array([[1e300]])).scores(np.array([[1.0]]))


def test_sums_stay_below_what_float32_holds():
    for prime in negatives.PRIMES:
        wide = (negatives._FLOAT32 - 1) // (prime // 2) ** 2
        assert wide >= 1 and wide * (prime // 2) ** 2 < 2**24
    assert all(np.abs(negatives.residues(np.arange(-2000.0, 2000.0), p)).max() <= p // 2 for p in negatives.PRIMES)


def test_empty_table_and_lone_rows(spark):
    empty = frame(spark, [])
    assert negatives.mine(empty, empty).count() == 0
    one = frame(spark, [(0, [1.0], 1), (1, [0.7], 2)])
    assert negatives.mine(one, one).count() == 0
