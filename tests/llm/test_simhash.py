import random

import pytest
import xxhash
from pyspark.sql import functions as F

from postloom.llm import graph, simhash

SCHEMA = "doc_id long, text string, fp long"


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else " " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(fps):
    low = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = low[i], low[j]
                low = [min(a, b) if x in (a, b) else x for x in low]
    return low


@pytest.mark.parametrize("text", [None, "", " \t", "A", "a B c", "ÀÉ x y z w", "one two three four five " * 20, "r r r r r r"])
def test_fingerprint(text):
    assert simhash.fingerprint(text and text.encode()) == slow_fingerprint(text)


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefghij", k=1000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text.encode()) == whole == slow_fingerprint(text)


@pytest.mark.parametrize("limit", [2, 5, 4096])
def test_links_connect_what_four_bits_connect(spark, limit):
    rng = random.Random(7)
    fps = {rng.getrandbits(64) for _ in range(60)} | {0, 1, (1 << 64) - 1}
    for base in list(fps)[:12]:  # chains and balls of near values, and values just too far away
        at = base
        for _ in range(6):
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5])):
                at ^= 1 << b
            fps.add(at)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), limit)
    for a, b in links.collect():
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4
    roots = {r.node: r.root for r in graph.components(links).collect()}
    want = slow_components(fps)
    groups = {}
    for f, w in zip(signed, want):
        groups.setdefault(w, set()).add(roots.get(f, f))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_near_dedup(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=400)) for _ in range(6)]
    rows = [(10 + i, t) for i, t in enumerate(base)] + [(50 + i, t + " tail") for i, t in enumerate(base[:3])]
    rows += [(1, None), (2, ""), (3, None), (None, base[0]), (None, "alone here"), (12, base[2]), (70, base[1].upper())]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(d, t, 5) for d, t in rows], SCHEMA)
    got = sorted((str(r.doc_id), r.fp, r.component_id) for r in simhash.near_dedup(docs).collect())
    fps = [slow_fingerprint(t) for _, t in rows]
    low = slow_components(fps)
    best = {}
    for (d, _), w in zip(rows, low):
        if d is not None:
            best[w] = min(d, best.get(w, d))
    want = sorted((str(d), f - (1 << 64) if f >> 63 else f, best.get(w)) for (d, _), f, w in zip(rows, fps, low))
    assert got == want


def test_empty_table(spark):
    assert simhash.near_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (3, 4)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
