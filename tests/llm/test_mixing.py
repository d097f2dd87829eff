import hashlib
import math
import random

import pytest

from postloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, target string, number int"


def slow_targets(sizes, weights=(5, 2, 1)):
    """Share by weight, cap, share what is left over among those below their cap, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total = sum(sizes.values())
    target = {s: total * w[s] / sum(w.values()) for s in names}
    while True:
        over = [s for s in names if target[s] > 3 * sizes[s] + 1e-6]
        if not over:
            return target
        excess = sum(target[s] - 3 * sizes[s] for s in over)
        for s in over:
            target[s] = 3 * sizes[s]
        free = [s for s in names if target[s] < 3 * sizes[s] - 1e-6]
        for s in free:
            target[s] += excess * w[s] / sum(w[f] for f in free)


def rows_of(seed, n=120):
    rng = random.Random(seed)
    sources = ["hot"] * 6 + ["b", "a", "Z", "é", None, "tiny"]
    rows = [(d, " ".join(["w"] * rng.choice([0, 1, 7, 100, 700])), rng.choice(sources)) for d in range(n)]
    return rows + [(None, "x y z", "a"), (3, rows[3][1], rows[3][2]), (500, None, "b"), (501, "", "nothing"), (502, "one", "small")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 1) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken(spark, seed):
    rows = rows_of(seed)
    got = mixing.mix(frame(spark, rows), block=8).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = slow_targets(sizes)
    by_size = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by_size.setdefault((r.source_size, round(r.target, 6)), []).append(r)
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(d), len((t or "").split())) for d, t, _ in rows)
    want = {}
    for s, t in target.items():
        want.setdefault((sizes[s], round(t, 6)), []).append(s)
    assert by_size.keys() == want.keys()
    for key, sources in want.items():
        taken = sum(r.taken for r in by_size[key])
        assert abs(taken - key[1] * len(sources)) <= len(sources) * 4 * 8 or taken == 3 * key[0]
    again = mixing.mix(frame(spark, rows[::-1]), block=8).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_taken_follows_the_schedule(spark):
    """Brute force: walk the slots, hand each its source's next block of words, count words per document."""
    rows = [r for r in rows_of(3) if r[0] is not None][:100]
    docs = frame(spark, rows)
    got = {(r.doc_id, r.size): r.taken for r in mixing.mix(docs, block=16).collect()}
    sized = docs.selectExpr("source", "coalesce(size(filter(split(text, ' '), x -> x <> '')), 0) AS size")
    targets = mixing.source_targets(sized)
    number = {r.source: r.number for r in targets.collect()}
    slots = sorted(tuple(r) for r in mixing.schedule(targets, 16).collect())
    assert [s[0] for s in slots] == list(range(len(slots)))
    stream, taken = {}, {}
    for d, t, s in sorted(rows, key=lambda r: hashlib.md5(f"mix-1/{r[0]}".encode()).hexdigest()):
        stream.setdefault(number[s], []).extend([(d, len((t or "").split()))] * len((t or "").split()))
    seen = {}
    for _, source, rank in slots:
        assert rank == seen.get(source, 0)
        seen[source] = rank + 1
        for i in range(rank * 16, rank * 16 + 16):
            if i < 3 * len(stream[source]):
                key = stream[source][i % len(stream[source])]
                taken[key] = taken.get(key, 0) + 1
    assert got == {(d, len((t or "").split())): taken.get((d, len((t or "").split())), 0) for d, t, _ in rows}


def test_schedule_spreads_sources(spark):
    targets = spark.createDataFrame([(0, 5000.0), (1, 2000.0), (2, 1000.0), (3, 0.0)], "number long, target double")
    slots = [r.number for r in mixing.schedule(targets, 10).orderBy("slot").collect()]
    for at in range(0, len(slots) - 100, 37):
        some = slots[at : at + 100]
        for source, share in ((0, 62.5), (1, 25), (2, 12.5)):
            assert abs(some.count(source) - share) <= 4


def test_rows_of_the_mixture(spark):
    rows = rows_of(4)
    docs = frame(spark, rows)
    taken = {}
    for r in mixing.mix(docs).collect():
        taken[r.doc_id, r.size] = taken.get((r.doc_id, r.size), 0) + r.taken
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    words, texts = {}, {(d, t) for d, t, _ in rows}
    full = {d: len(t.split()) for d, t, _ in rows if t}
    for r in out.collect():
        n = len(r.text.split())
        words[r.doc_id, full[r.doc_id]] = words.get((r.doc_id, full[r.doc_id]), 0) + n
        assert n == full[r.doc_id] and (r.doc_id, r.text) in texts or n < full[r.doc_id]
    assert words == {k: v for k, v in taken.items() if v}


def test_tables_without_words(spark):
    assert mixing.mix(frame(spark, [(1, "x", "a")]).limit(0)).count() == 0
    got = mixing.mix(frame(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    assert mixing.apply_mix(frame(spark, [(1, None, "a")])).count() == 0
    assert math.isclose(mixing.mix(frame(spark, [(1, "a b", "s")])).first().target, 2)
