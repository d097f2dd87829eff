"""Exact top-k search by integer inner product: tiles of queries and vectors, merged per query.

Queries come in blocks of at most ``BLOCK``, which is what is held on the driver and sent to tasks at a time, however
many there are. For each block the table is read once: a task multiplies tiles of queries and vectors, selects within
each tile and keeps k hits per query. The lists of the tasks are merged in two levels.
"""

from __future__ import annotations

from functools import partial
from itertools import islice

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.common import arrow_map
from postloom.session import scratch_path

K = 10
BLOCK = 4096
TILE_QUERIES = 1024
TILE_VECTORS = 2048
SCALE = 1024
FAN_IN = 32


def whole_numbers(flat: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * flat.astype(np.float64))


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part: an id, and a vector of finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return rows.filter("vec_id is not null and v is not null").filter(F.forall("v", finite))


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    if np.abs(q).max() * np.abs(c).max() * q.shape[1] < 2**53:
        return (q @ c.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in q], object) @ np.array([[int(x) for x in r] for r in c], object).T
    return exact.astype(np.int64)  # raises where a score does not fit


class _Best:
    """The k best hits of each query of a block so far."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int):
        self.ids, self.matrix, self.k = ids, matrix, k
        self.row, self.score, self.hit = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(len(ids), np.iinfo(np.int64).min)
        self.waiting = []

    def tile(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        for lo in range(0, len(self.ids), TILE_QUERIES):
            own = self.ids[lo : lo + TILE_QUERIES]
            scores = _products(self.matrix[lo : lo + TILE_QUERIES], matrix)
            other = own[:, None] != ids[None, :]
            least = self.floor[lo : lo + TILE_QUERIES]
            if scores.shape[1] > self.k:
                held = np.where(other, scores, np.iinfo(np.int64).min)
                least = np.maximum(least, np.partition(held, -self.k, axis=1)[:, -self.k])
            rows, cols = np.nonzero((scores >= least[:, None]) & other)
            self.waiting.append((rows + lo, scores[rows, cols], ids[cols]))
        if sum(len(w[0]) for w in self.waiting) > 20 * self.k * len(self.ids):
            self.merge()

    def merge(self) -> None:
        row, score, hit = (np.concatenate(c) for c in zip((self.row, self.score, self.hit), *self.waiting))
        self.waiting = []
        order = np.lexsort((hit, -score, row))
        row = row[order]
        first = np.searchsorted(row, row)
        keep = np.arange(len(row)) - first < self.k
        order, row = order[keep], row[keep]
        self.row, self.score, self.hit = row, score[order], hit[order]
        full = np.bincount(row, minlength=len(self.ids)) >= self.k
        last = np.searchsorted(row, np.flatnonzero(full), side="right") - 1
        self.floor[full] = self.score[last]


def _search(batches, block, k):
    best = {dim: _Best(ids, matrix, k) for dim, (ids, matrix) in block.value.items()}
    for batch in batches:
        ids, vectors = batch.column("vec_id").to_numpy(), batch.column("v")
        sizes = np.diff(vectors.offsets.to_numpy())
        flat, starts = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()[:-1]
        for dim, held in best.items():
            rows = np.flatnonzero(sizes == dim)
            for lo in range(0, len(rows), TILE_VECTORS):
                some = rows[lo : lo + TILE_VECTORS]
                held.tile(ids[some], whole_numbers(flat[starts[some][:, None] + np.arange(dim)]))
    part = TaskContext.get().partitionId()
    for held in best.values():
        held.merge()
        yield {"query_id": held.ids[held.row], "score": held.score, "vec_id": held.hit, "part": np.full(len(held.row), part)}


def _merged(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row of ``queries(vec_id, embedding)`` the k rows of
    ``vectors(vec_id, embedding)`` with the highest inner product of the scaled, floored components, ties to the
    smaller vec_id; all where there are fewer. Runs one job per block of queries.

    Rows with the query's own vec_id are no candidates. Null vectors, vectors with a null or non-finite component, and
    rows without vec_id take no part; vectors meet queries of their own length only. A vec_id that occurs in several
    rows may be listed as often; of several queries with one vec_id the smallest vector is asked. Scores are exact; one
    beyond 64 bits is an error. No rows give no rows; further columns are not read.
    """
    spark = vectors.sparkSession
    usable = _usable(vectors)
    asked = _usable(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    path = scratch_path(spark, "hits")
    rows = asked.toLocalIterator()
    spark.createDataFrame([], "query_id long, score long, vec_id long, part int").write.parquet(path)
    while some := list(islice(rows, block)):
        by_length: dict[int, list] = {}
        for r in some:
            by_length.setdefault(len(r.v), []).append(r)
        held = {
            dim: (
                np.array([r.vec_id for r in part], np.int64),
                whole_numbers(np.array([r.v for r in part], np.float64).reshape(len(part), dim)),
            )
            for dim, part in by_length.items()
        }
        sent = spark.sparkContext.broadcast(held)
        hits = arrow_map(usable, partial(_search, block=sent, k=k), "query_id long, score long, vec_id long, part int")
        hits.write.mode("append").parquet(path)
        sent.destroy()
    hits = spark.read.parquet(path).withColumn("part", F.col("part") % FAN_IN)
    few = _merged(hits, ["query_id", "part"], k).drop("rank")
    return _merged(few, ["query_id"], k).select("query_id", "rank", "vec_id", "score")
