import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector

from postloom.operators import vector_index as vi
from postloom.operators import vectors
from postloom.session import materialize


def frame(spark, rows, key="vec_id"):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame(rows, f"{key} bigint, embedding array<float>").repartition(4)


def pairs(df):
    return {(r.query_id, r.rank): r.vec_id for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    """Loose groups, and one vector that a third of all rows have."""
    rng = np.random.default_rng(1)
    m = np.repeat(rng.normal(size=(40, 18)), 20, axis=0) + 0.6 * rng.normal(size=(800, 18))
    m = np.concatenate([m, np.repeat(m[:1], 400, axis=0)])
    odd = [(5000, None), (5001, [0.0] * 18), (5002, [float("nan")] * 18), (5003, [1.0] * 3), (5004, [None] * 18), (5005, [])]
    return [*enumerate(m), *odd], list(enumerate(m[3:800:9] + 0.3 * rng.normal(size=(89, 18))))


@pytest.fixture(scope="module")
def built(spark, data):
    corpus = frame(spark, data[0])
    index = vi.fit_index(corpus)
    return corpus, index, materialize(vi.encode(corpus, index), "coded")


def test_everything_probed_is_the_exact_search(spark, data, built):
    corpus, index, coded = built
    queries = frame(spark, [*data[1][:12], (900, None), (901, [0.0] * 18), (902, [1.0])], "query_id")
    assert coded.count() == 1200
    sound = vi.directed(corpus, 18)
    want = pairs(vectors.search_exact(sound, vi.directed(queries, 18), 5))
    assert pairs(vi.search_index(corpus, coded, queries, index, 5, 1.1, 2000)) == want


def test_parts_and_blocks_change_nothing(spark, data, built, monkeypatch):
    corpus, index, coded = built
    queries = frame(spark, data[1], "query_id")
    whole = pairs(vi.search_index(corpus, coded, queries, index, 5, 0.4, 30))
    monkeypatch.setattr(vi, "ROWS", 60)
    monkeypatch.setattr(vi, "QUERIES", 10)
    assert pairs(vi.search_index(corpus, coded, queries, index, 5, 0.4, 30)) == whole


def test_recall_of_other_queries(spark, data, built):
    corpus, index, coded = built
    chosen = [q for q in data[1] if q[0] % 2]
    share, short = vi.settings_for(corpus, coded, frame(spark, chosen, "query_id"), index, 10)
    others = frame(spark, [q for q in data[1] if q[0] % 2 == 0], "query_id")
    want = vectors.search_exact(vi.directed(corpus, 18), others, 10).select("query_id", "vec_id")
    got = vi.search_index(corpus, coded, others, index, 10, share, short)
    assert want.join(got, ["query_id", "vec_id"]).count() >= 0.9 * want.count()
    assert share < 1 and short <= 120


def test_no_rows(spark, built):
    corpus, index, coded = built
    none = frame(spark, [(1, None)], "query_id")
    assert vi.search_index(corpus, coded, none, index, 5, 0.5, 10).count() == 0
    assert vi.search_index(corpus, coded.limit(0), frame(spark, [(1, [1.0] * 18)], "query_id"), index, 5, 0.5, 10).count() == 0
    assert vi.fit_index(frame(spark, [(1, None), (2, [0.0])])) is None
    assert vi.fit_clusters(frame(spark, [(1, None)]))[1] == {}


def test_sample_is_bounded(spark, data):
    corpus = frame(spark, data[0][:800])
    few = vi.sample_matrix(corpus, 100)
    assert len(few) == 100 and np.array_equal(few, vi.sample_matrix(corpus.repartition(7), 100))


def test_clusters_by_a_measure(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 24))
    rows = list(enumerate(np.repeat(base, 200, axis=0) + 0.25 * rng.normal(size=(1200, 24))))
    corpus = frame(spark, rows)
    centres, measured = vi.fit_clusters(corpus, sample=600)
    assert len(centres) == 6 and max(measured, key=measured.get) == 6
    assert np.array_equal(centres, vi.fit_clusters(corpus.repartition(3), sample=600)[0])
    m = np.array([v for _, v in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    inertia = lambda c: ((m[:, None] - np.array(c)[None]) ** 2).sum(axis=2).min(axis=1).sum()
    unit = spark.createDataFrame([(v.tolist(),) for v in m], "embedding array<double>")
    full = vectors.KMeans(k=6, seed=42, maxIter=20).fit(unit.select(array_to_vector("embedding").alias("features")))
    assert inertia(centres) <= 1.05 * inertia(full.clusterCenters())
    got = {r.vec_id: r.cell for r in vi.nearest_cell(frame(spark, [*rows, (7000, None), (7001, [0.0] * 24), (7002, [1.0])]), centres).collect()}
    want = ((m[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert got == dict(enumerate(want)) | {7000: None, 7001: None, 7002: None}


def test_rows_are_assigned_and_encoded_in_slices(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = pa.RecordBatch.from_pydict({
        "vec_id": list(range(3000)), "mark": [0] * 3000, "embedding": pa.array(rng.normal(size=(3000, 8)).tolist(), pa.list_(pa.float64()))})
    index = vi.fit_index(frame(spark, [(i, v) for i, v in enumerate(rows.column("embedding").to_pylist()[:500])]))
    whole = lambda: [r for b in vi._coded(iter([rows]), index) for r in b.to_pylist()]
    made, gaps = [], vi._gaps
    monkeypatch.setattr(vi, "_gaps", lambda x, c: made.append(len(x)) or gaps(x, c))
    some = whole()
    assert max(made) == vi.SLICE and [r["vec_id"] for r in some] == list(range(3000))
    monkeypatch.setattr(vi, "SLICE", 5000)
    assert some == whole()
