"""Every stage against a brute-force version on what the stage before it kept."""

import random

import pytest

import corpus_pipeline as pipeline
from postloom.llm import mixing, quality
from tests.llm.test_quality import corpus
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.llm.test_substring import slow


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    docs, labels = corpus(6, 260)
    good = [t for _, t in docs if t.endswith(".")]
    passage = " ".join(rng.choices(good[0].split(), k=40))
    docs += [(300 + i, good[1]) for i in range(20)] + [(330 + i, good[2] + f" Edit {i}.") for i in range(20)]
    docs += [(360 + i, f"{good[3 + i][:300]} {passage} {good[20 + i][:200]}.") for i in range(8)]
    docs += [(400, None), (401, ""), (None, good[30]), (402, " ".join(good[40:80]))]
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", rng.choice(["a", "b", "b", None]), len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path + "/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(path + "/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    docs, out = spark.read.parquet(folder + "/documents.parquet"), []
    for n, (name, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("out")) + f"/{n}"
        stage(spark, docs, folder).write.parquet(path)
        made = spark.read.parquet(path)
        out.append((docs, made))
        docs = made
    return out


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)


def test_columns(stages):
    for _, made in stages[:-1]:
        assert made.columns == list(pipeline.COLUMNS)


def test_quality(spark, stages, folder):
    docs, made = stages[0]
    scores = quality.score_quality(docs, spark.read.parquet(folder + "/labels.parquet")).collect()
    keep = {r.doc_id for r in scores if r.predicted}
    assert rows(made) == [r for r in rows(docs) if r[0] in keep]
    kept = {r[0] for r in rows(made)}
    assert 0 < len(kept) < docs.count() and {r[0] for r in rows(docs) if (r[1] or "").endswith(".") and r[0] is not None} <= kept


def test_near_dedup(stages):
    docs, made = stages[1]
    before = rows(docs)
    groups = {}
    for r, c in zip(before, slow_components([slow_fingerprint(r[1]) for r in before])):
        groups.setdefault(c, []).append(r)
    want = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    assert rows(made) == sorted(want, key=str) and len(want) < len(before)


def test_substring(stages):
    docs, made = stages[2]
    before = rows(docs)
    judged = slow([(r[0], r[1]) for r in before], 13)
    want = {(d, kept) for d, n, gone, _, kept in judged if n > gone or not gone}
    assert {(str(r[0]), r[1] or "") for r in rows(made)} == want
    assert all(r[4] == len(r[1] or "") for r in rows(made))
    assert any(gone for _, _, gone, _, _ in judged)


def test_mixing(stages):
    docs, made = stages[3]
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken}
    words = {}
    for d, t, *_ in rows(made):
        words[d] = words.get(d, 0) + len(t.split())
    assert words == taken
    texts = {r[0]: r[1] for r in rows(docs)}
    assert all(t == texts[d] or texts[d].split()[: len(t.split())] == t.split() for d, t, *_ in rows(made))


def test_packing(stages):
    docs, made = stages[4]
    pieces = made.collect()
    want = {}
    for d, *_ in rows(docs):
        want[d] = want.get(d, 0) + 1
    firsts = {}
    for p in pieces:
        if p.piece == 0:
            firsts[p.doc_id] = firsts.get(p.doc_id, 0) + 1
    assert firsts == want
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0)
        filled[p.sequence_id] = p.offset + p.length
    assert max(filled.values()) <= 2048


def test_run(spark, folder, stages):
    got = pipeline.run(spark, folder)
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(map(str, got.select(*key).collect())) == sorted(map(str, stages[-1][1].select(*key).collect()))


def test_empty_tables(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
