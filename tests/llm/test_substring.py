import hashlib
import random

import numpy as np
import pytest

from postloom.llm import substring

SCHEMA = "doc_id long, text string, kept string, n_chars long"


def slow(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    low = {}
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - window + 1):
            if d is not None:
                key = tuple(w[i : i + window])
                low[key] = min(d, low.get(key, d))
    out = []
    for (d, t), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and low[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(d), len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode() if gone else t or ""))
    return sorted(out)


def fast(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(3)
    got = substring.remove_copied(docs, **options)
    assert got.columns == ["doc_id", "n_chars", "n_words", "n_removed", "kept_sha256", "kept"]
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got.collect())


@pytest.mark.parametrize("window,piece,share", [(13, 3, 50_000), (5, 2, 20), (4, 4, 50_000)])
def test_against_every_window(spark, monkeypatch, window, piece, share):
    monkeypatch.setattr(substring, "HOT_SHARE", share)
    monkeypatch.setattr(substring, "BATCH_COUNT", 2)
    monkeypatch.setattr(substring, "BUCKET", 100)
    monkeypatch.setattr(substring, "FLUSH", 150)
    rng = random.Random(window)
    vocabulary = [f"w{i}é" for i in range(300)]
    passage = rng.choices(vocabulary, k=30)
    rows = []
    for d in range(60):
        w = rng.choices(vocabulary, k=rng.choice([0, 3, 12, 13, 40, 90]))
        if d % 2:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[rng.randrange(6) : 30 - rng.randrange(6)]
        rows.append((d * 3 % 61, rng.choice([" ", "\n", " \t", "  "]).join(w)))
    rows += [(200 + i, rows[9][1]) for i in range(10)] + [(300, None), (301, ""), (None, rows[9][1]), (302, "a " * 200), (303, "a " * 300)]
    rows += [(9, rows[9][1] + " tail"), rows[9], rows[9], (304, "x\x00y \x1f z" * 20)]
    rng.shuffle(rows)
    assert fast(spark, rows, window=window, piece=piece) == slow(rows, window)


def test_hot_minimisers_are_found_and_bounded(spark, monkeypatch):
    rng = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(d, f"{rng.random()} {rng.random()} {passage} {rng.random()}") for d in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(substring, "HOT_SHARE", 50)
    monkeypatch.setattr(substring, "BUCKET", 40)
    hot, total = substring.minimiser_counts(docs)
    assert 0 < len(hot) <= 50 and list(hot) == sorted(hot)


def test_minima():
    values = np.random.default_rng(1).integers(0, 1 << 60, 50).astype(np.uint64)
    for width in (1, 2, 3, 7, 8, 11, 50):
        assert substring._minima(values, width).tolist() == [min(values[i : i + width]) for i in range(51 - width)]


def test_empty_table(spark):
    assert substring.remove_copied(spark.createDataFrame([], SCHEMA)).count() == 0
