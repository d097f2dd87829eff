import random
import zlib

import numpy as np
import pytest

from postloom.llm import quality

SCHEMA = "doc_id long, text string, score string, lang string"


def corpus(seed, n):
    """Sentences are good; shouting, tables and stutter are not."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9))) for _ in range(300)]
    docs, labels = [], []
    for d in range(n):
        w = rng.choices(words, k=rng.randrange(20, 200))
        kind = rng.choice(["good"] * 6 + ["loud", "table", "stutter"])
        text = {"good": " ".join(w).capitalize() + ".", "loud": "!! ".join(w).upper(), "table": " | ".join(w), "stutter": (w[0] + " ") * len(w)}[kind]
        docs.append((d, text))
        if d % 3:
            labels.append((d, int(kind == "good"), 0))
    return docs, labels


def frames(spark, docs, labels):
    d = spark.createDataFrame([(i, t, "x", "en") for i, t in docs], SCHEMA)
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(1, 1500)
    d, l = frames(spark, docs, labels)
    rows = {r.doc_id: r for r in quality.score_quality(d, l).collect()}
    truth = {i: q for i, q, _ in labels}
    assert len(rows) == len(docs)
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    unseen = [(rows[i].predicted, q) for i, q in truth.items() if rows[i].held_out]
    assert np.mean([p == q for p, q in unseen]) > 0.97


def test_held_out_labels_change_nothing(spark):
    docs, labels = corpus(2, 300)
    d, l = frames(spark, docs, labels)
    _, other = frames(spark, docs, [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels])
    score = lambda labels: sorted((r.doc_id, r.score) for r in quality.score_quality(d, labels).collect())
    assert score(l) == score(other)


def test_odd_rows(spark):
    docs, labels = corpus(3, 200)
    docs += [(None, "No id here."), (500, None), (501, ""), (502, " \n"), (503, "\x00\x7f\x1e"), (504, "z" * 300_000), (7, "Another seven."), docs[8]]
    labels += [(None, 1, 0), (11, 0, 0), (11, 1, 0), (12, None, 0)]
    d, l = frames(spark, docs, labels)
    got = quality.score_quality(d, l).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in docs)
    assert all(np.isfinite(r.score) for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    assert len({r.score for r in got if r.doc_id in (500, 501, 502)}) == 1
    kept = quality.keep_good(d, l).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(r.doc_id) for r in got if r.predicted)
    assert kept[0].asDict().keys() == {"doc_id", "text", "score", "lang"}


def test_nothing_to_learn_from(spark):
    d, l = frames(spark, [(1, "A text."), (2, None)], [(1, 0, 0)])
    assert [r.score for r in quality.score_quality(d, l).collect()] == [0.5, 0.5]
    assert quality.keep_good(d, l).count() == 2
    assert quality.score_quality(d.limit(0), l).count() == 0 and quality.keep_good(d.limit(0), l.limit(0)).count() == 0


def test_risk_estimate_never_rewards_overfitting():
    rng = np.random.default_rng(0)
    positive = rng.normal(1, 1, (200, 3))
    unlabelled = np.concatenate([rng.normal(1, 1, (100, 3)), rng.normal(-1.5, 1, (100, 3))])
    model = quality.fit(positive, unlabelled, 0.5, steps=800)
    fresh = rng.normal(1, 1, (500, 3)), rng.normal(-1.5, 1, (500, 3))
    assert (model.score(fresh[0]) > 0.5).mean() > 0.9 and (model.score(fresh[1]) < 0.5).mean() > 0.9
