import math
import random

import pytest

from postloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score int, rank string"


def slow(rows, asked, k):
    def clean(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and clean(v)]
    out = []
    for q in sorted({i for i, _ in whole if asked(i)}):
        v = min(v for i, v in whole if i == q)
        hits = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v)]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(hits)[:k])]
    return out


@pytest.mark.parametrize("k,block", [(10, 4096), (3, 2), (500, 7)])
def test_against_brute_force(spark, monkeypatch, k, block):
    monkeypatch.setattr(topk, "TILE_QUERIES", 3)
    monkeypatch.setattr(topk, "TILE_VECTORS", 16)
    rng = random.Random(k)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.1234567, 0.9]) for _ in range(4)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]  # one vector many times: ties
    rows += [(300, None), (305, [0.1, None, 0.2, 0.3]), (310, [float("nan")] * 4), (315, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, [0.5] * 4), (320, []), (321, []), (325, [1.0, 2.0]), (326, [2.0, 1.0]), (10, rows[10][1]), (7, rows[8][1])]
    rng.shuffle(rows)
    vectors = spark.createDataFrame([(i, v, 1, "r") for i, v in rows], SCHEMA).repartition(3)
    got = topk.top_k(vectors, vectors.filter("vec_id % 5 = 0"), k=k, block=block).orderBy("query_id", "rank").collect()
    want = slow([(r.vec_id, r.embedding) for r in vectors.collect()], lambda i: i % 5 == 0, k)
    assert [tuple(r) for r in got] == want


def test_large_components_stay_exact(spark):
    rows = [(0, [1e6, 1.0]), (1, [1e6, 1.001]), (2, [1e6, 1.0]), (3, [-1e6, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(vectors, vectors.filter("vec_id = 0")).orderBy("rank").collect()]
    assert got == slow(rows, lambda i: i == 0, 10)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, empty).count() == 0
