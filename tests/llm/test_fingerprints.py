import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from postloom.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, range long, kind string"


def terms_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", F.explode(fp._phrases(F.col("t"))).alias("p")).select("i", F.xxhash64("p").alias("term"), F.col("p")).collect()
    out = [{} for _ in texts]
    for r in rows:
        out[r.i][r.term] = out[r.i].get(r.term, 0) + r.p.count(" ") + 1
    return out


def sampled(spark, weights, samples):
    rows = [(i, t, math.log(w)) for i, ws in enumerate(weights) for t, w in ws.items()]
    df = spark.createDataFrame(rows, "i int, term long, log_weight double")
    got = df.groupBy("i").agg(*[F.min(fp.sample(h)).alias(f"s{h}") for h in range(samples)]).collect()
    return {r.i: list(r)[1:] for r in got}


FEW = 12


def edited(a, b):
    half = len(a) // 2
    return a[: len(a) - half] + b[:half]


@pytest.mark.parametrize("segments,width", [(1024, 2048), (3, 4)])
def test_against_plain_python(spark, monkeypatch, segments, width):
    monkeypatch.setattr(fp, "SEGMENTS", segments)
    monkeypatch.setattr(fp, "RANGE", width)
    rng = random.Random(width)
    words = [f"w{i}é" for i in range(80)]
    rows = [(d * d - 50, rng.choice([" ", "\n", "\t "]).join(rng.choices(words, k=rng.choice([0, 1, 2, 9, 60])))) for d in range(40)]
    rows += [(10**12, "far away \U0001f600 text"), (10**12 + 1, None), (7777, "  lead and trail  "), (7778, "x" * 3000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], SCHEMA).repartition(3)
    got = sorted(fp.fingerprint(docs, samples=FEW).collect(), key=lambda r: r.doc_id)
    ordered = [(d, t or "") for d, t in sorted(rows)]
    texts = [t for _, t in ordered]
    changed = [edited(t, u) for t, u in zip(texts, texts[1:] + texts[:1])]
    own = sampled(spark, terms_of(spark, texts), FEW)
    other = sampled(spark, terms_of(spark, changed), FEW)
    like = lambda a, b: sum(x == y for x, y in zip(a, b)) / FEW
    for i, r in enumerate(got):
        assert (r.doc_id, r.n_chars) == (ordered[i][0], len(texts[i]))
        assert r.edited_sha256 == hashlib.sha256(changed[i].encode()).hexdigest()
        assert (r.near_edited, r.near_next) == (like(own[i], other[i]), like(own[i], own[(i + 1) % len(got)]))
        assert re.fullmatch("[0-9a-f]{48}", r.fingerprint) and len(r.edited_fingerprint) == 48
        printed = [[x[k : k + 4] for k in range(0, 48, 4)] for x in (r.fingerprint, r.edited_fingerprint, got[(i + 1) % len(got)].fingerprint)]
        assert (r.near_edited, r.near_next) == (like(printed[0], printed[1]), like(printed[0], printed[2]))
    by_text = {}
    for t, r in zip(texts, got):
        by_text.setdefault(t, set()).add(r.fingerprint)
    for t, r in zip(changed, got):
        by_text.setdefault(t, set()).add(r.edited_fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_collision_rate_is_generalised_jaccard(spark):
    rng = random.Random(5)
    for _ in range(3):
        a = {k: rng.choice([1, 2, 5, 20]) for k in rng.sample(range(10**9), 12)}
        b = {k: rng.choice([w, 2 * w, 1]) for k, w in a.items() if rng.random() < 0.7} | {rng.randrange(10**9): 3 for _ in range(3)}
        keys = a.keys() | b.keys()
        want = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
        s = sampled(spark, [a, b], 300)
        got = sum(x == y for x, y in zip(s[0], s[1])) / 300
        assert abs(got - want) < 4 * math.sqrt(want * (1 - want) / 300) + 0.01


def test_phrases_hold_every_word(spark):
    text = " the cat\nsat on\tthe mat " * 9
    rows = spark.createDataFrame([(text,)], "t string").select(F.explode(fp._phrases(F.col("t"))).alias("p")).collect()
    assert len(rows) > 1
    assert sorted(w for r in rows for w in r.p.split()) == sorted(text.split())


def test_odd_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "other"), (None, "n1"), (None, "n2"), (None, None), (2, ""), (3, None)]
    got = fp.fingerprint(spark.createDataFrame([(d, t, 0, "k") for d, t in rows], SCHEMA), samples=FEW).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _ in rows)
    assert sorted(r.n_chars for r in got) == sorted(len(t or "") for _, t in rows)
    empty = {r.fingerprint for r in got if r.n_chars == 0}
    assert len(empty) == 1
    alone = fp.fingerprint(spark.createDataFrame([(4, "one two three")], "doc_id long, text string"), samples=FEW).collect()
    assert alone[0].near_next == 1.0


def test_native_plan(spark, plan, tmp_path):
    spark.range(300).selectExpr("id AS doc_id", "repeat(concat('a b ', uuid()), 50) AS text").write.parquet(str(tmp_path / "d"))
    text = plan(fp.fingerprint(spark.read.parquet(str(tmp_path / "d"))))
    assert not re.search("Python|Arrow|Pandas|ExistingRDD|MapPartitions", text)
    # One exchange moves texts; nothing after the terms is exchanged again.
    above = text.split("Generate")[0]
    assert above.count("HashAggregate") == 4 and "Exchange" not in above
    assert len(re.findall("Exchange hashpartitioning", text)) == 1


def test_empty_table(spark):
    assert fp.fingerprint(spark.createDataFrame([], SCHEMA), samples=FEW).count() == 0
