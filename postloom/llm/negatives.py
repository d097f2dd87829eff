"""Hard negatives by exact integer scores, computed as matrix products modulo small primes.

Components are scaled and floored to whole numbers. Scores come from float32 products of their residues: residues lie
around zero, a product sums so few of them at a time that every partial sum is a whole number below 2**24, which float32
holds exactly, and as many primes are taken as it needs for their product to exceed twice the largest possible score.
Chinese remaindering puts the signed score together.

Anchors come in blocks of bounded size. For each block the table is read twice: once for the anchors' best rows of their
own label, the positives, whose scores open a window each, and once for the best rows of other labels inside the windows.
A task selects within each tile and keeps as many hits per anchor or window as can be returned; the lists of the tasks are
merged in two levels.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.common import arrow_map
from postloom.session import materialize, scratch_path

POSITIVES = 5
NEGATIVES = 3
SCALE = 256
#: The window of a positive's score p: ``LOW * p <= 100 * score <= HIGH * p``.
LOW, HIGH = 50, 95
#: Components of the anchors of one block, which are on the driver and in every task at a time.
BLOCK = 1 << 19
TILE_ANCHORS = 512
TILE_ROWS = 2048
FAN_IN = 32

_FLOAT32 = 1 << 24
_NONE = np.iinfo(np.int64).min
_HITS = "anchor_id long, score long, vec_id long, part int, window int"


def _small_primes(below: int) -> Iterator[int]:
    """Odd primes under ``below``, the largest first."""
    for n in range(below - 1, 2, -1):
        if n % 2 and all(n % d for d in range(3, int(n**0.5) + 1, 2)):
            yield n


PRIMES = tuple(_small_primes(256))


def residues(m: np.ndarray, prime: int) -> np.ndarray:
    """Whole numbers modulo an odd prime, between -(prime // 2) and prime // 2."""
    r = np.fmod(m, prime)  # exact for floats
    return (r - prime * np.rint(r / prime)).astype(np.float32)


def _product(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """``a @ b.T`` modulo the prime, from 0, of two matrices of residues."""
    wide = (_FLOAT32 - 1) // (prime // 2) ** 2  # columns whose sum float32 holds
    total = np.zeros((len(a), len(b)), np.int32)
    for at in range(0, a.shape[1], wide):
        total += (a[:, at : at + wide] @ b[:, at : at + wide].T).astype(np.int32) % prime
    return total % prime


def _moduli(most: float) -> tuple[int, ...]:
    """Primes whose product exceeds twice the largest absolute score ``most``."""
    product = 1
    for count, prime in enumerate(PRIMES, 1):
        product *= prime
        if product > 2 * most + 1:
            return PRIMES[:count]
    raise OverflowError("scores are beyond the product of all primes")


def _signed(digits: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """The numbers around zero that have these remainders: mixed-radix digits, one prime after another."""
    product = 1
    total = np.zeros(digits[0].shape, np.int64 if np.prod([float(p) for p in primes]) < 2.0**62 else object)
    for prime, remainder in zip(primes, digits):
        digit = (remainder - total % prime) * pow(product, -1, prime) % prime
        total = total + digit.astype(total.dtype) * product
        product *= prime
    total = np.where(total > product // 2, total - product, total)
    return total.astype(np.int64)  # raises where a score does not fit


def _longest(m: np.ndarray) -> float:
    with np.errstate(over="ignore"):
        return float(np.sqrt((m * m).sum(axis=1)).max())


class _Factor:
    """A matrix of whole numbers as the left factor of many products; residues are kept once made."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, self.longest = matrix, _longest(matrix)
        self.made: dict[int, np.ndarray] = {}

    def scores(self, other: np.ndarray) -> np.ndarray:
        """Exact inner products with the rows of ``other``; one beyond 64 bits is an error."""
        if not other.size or not self.matrix.size:
            return np.zeros((len(self.matrix), len(other)), np.int64)
        most = self.longest * _longest(other) * 1.0001 + 1  # no score exceeds the product of the lengths
        if not np.isfinite(most):
            raise OverflowError("scores are beyond 64 bits")
        primes = _moduli(most)
        for p in primes:
            if p not in self.made:
                self.made[p] = residues(self.matrix, p)
        return _signed([_product(self.made[p], residues(other, p), p) for p in primes], primes)


class _Top:
    """The k best hits of each of some rows so far, equal scores by smaller id."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.row, self.score, self.hit = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(rows, _NONE)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def offer(self, rows: np.ndarray, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Hits of one tile: ``scores[i, j]`` of ``rows[i]`` and ``ids[j]`` where ``allowed``."""
        allowed = allowed & (scores >= self.floor[rows][:, None])
        if np.count_nonzero(allowed) > 4 * self.k * len(rows):
            held = np.where(allowed, scores, _NONE)
            allowed &= held >= np.partition(held, -self.k, axis=1)[:, -self.k][:, None]
        at, col = np.nonzero(allowed)
        if len(at):
            self.waiting.append((rows[at], scores[at, col], ids[col]))
        if sum(len(w[0]) for w in self.waiting) > 20 * self.k * len(self.floor):
            self.merge()

    def merge(self) -> None:
        row, score, hit = (np.concatenate(c) for c in zip((self.row, self.score, self.hit), *self.waiting))
        self.waiting = []
        order = np.lexsort((hit, -score, row))
        row = row[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < self.k
        order, row = order[keep], row[keep]
        self.row, self.score, self.hit = row, score[order], hit[order]
        full = np.bincount(row, minlength=len(self.floor)) >= self.k
        self.floor[full] = self.score[np.searchsorted(row, np.flatnonzero(full), side="right") - 1]


def _tiles(batches, dims):
    """``(length, ids, labels, matrix)`` of at most TILE_ROWS vectors of one length that some anchor has."""
    for batch in batches:
        ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
        vectors = batch.column("v")
        ends = vectors.offsets.to_numpy()
        flat, starts, sizes = vectors.values.to_numpy(zero_copy_only=False), ends[:-1], np.diff(ends)
        for dim in dims:
            rows = np.flatnonzero(sizes == dim)
            for lo in range(0, len(rows), TILE_ROWS):
                some = rows[lo : lo + TILE_ROWS]
                yield dim, ids[some], labels[some], flat[starts[some][:, None] + np.arange(dim)]


def _factors(anchors, group):
    """Anchors in parts of at most TILE_ANCHORS: by length (``group`` 0) or by length and label: (indices, factor)."""
    out: dict[tuple, list] = {}
    for dim, (index, labels, matrix) in anchors.items():
        keys = labels if group else np.zeros(len(labels), np.int64)
        for key in np.unique(keys):
            own = np.flatnonzero(keys == key)
            for lo in range(0, len(own), TILE_ANCHORS):
                some = own[lo : lo + TILE_ANCHORS]
                out.setdefault((dim, int(key)), []).append((index[some], labels[some], _Factor(matrix[some])))
    return out


def _emitted(top, ids, windows=None):
    """A row per hit of the task; with windows, rows of ``top`` are numbers of windows."""
    top.merge()
    if not len(top.row):
        return
    part = np.full(len(top.row), TaskContext.get().partitionId() % FAN_IN)
    anchor, window = (top.row, np.zeros(len(top.row), np.int64)) if windows is None else (top.row // windows, top.row % windows)
    yield {"anchor_id": ids[anchor], "score": top.score, "vec_id": top.hit, "part": part, "window": window}


def _positives(batches, block, k):
    """The best rows of each anchor's label: products of one label's anchors and rows only."""
    ids, anchors = block.value
    factors, top = _factors(anchors, True), _Top(len(ids), k)
    for dim, hits, labels, matrix in _tiles(batches, anchors):
        for label in np.unique(labels):
            own = np.flatnonzero(labels == label)
            for index, _, factor in factors.get((dim, int(label)), ()):
                top.offer(index, factor.scores(matrix[own]), ids[index][:, None] != hits[own][None, :], hits[own])
    yield from _emitted(top, ids)


def _negatives(batches, block, windows, k):
    """The best rows of other labels inside each window of an anchor."""
    ids, anchors = block.value
    low, high = windows.value  # by anchor and window; an absent window has its bounds crossed
    wide = low.shape[1]
    factors, top = _factors(anchors, False), _Top(low.size, k)
    for dim, hits, labels, matrix in _tiles(batches, anchors):
        for index, own, factor in factors.get((dim, 0), ()):
            found = factor.scores(matrix)
            other = (own[:, None] != labels[None, :]) & (ids[index][:, None] != hits[None, :])
            for w in range(wide):
                inside = other & (found >= low[index, w][:, None]) & (found <= high[index, w][:, None])
                top.offer(index * wide + w, found, inside, hits)
    yield from _emitted(top, ids, wide)


def _usable(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows that take part, their components scaled and floored."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    rows = rows.filter("vec_id is not null and label is not null and v is not null").filter(F.forall("v", finite))
    # From 2**53 on a double is whole, and may be beyond 64 bits.
    whole = lambda x: F.when(F.abs(x) < F.lit(2.0**53), F.floor(x).cast("double")).otherwise(x)
    return rows.withColumn("v", F.transform("v", lambda x: whole(x * F.lit(float(scale)))))


def _blocks(anchors: DataFrame, most: int):
    """Anchors in blocks of at most ``most`` components (one anchor at least): ids, and (index, labels, matrix) by length."""

    def block(rows):
        ids = np.array([r.vec_id for r in rows], np.int64)
        by_length: dict[int, list[int]] = {}
        for i, r in enumerate(rows):
            by_length.setdefault(len(r.v), []).append(i)
        return ids, {
            dim: (
                np.array(own, np.int64),
                np.array([rows[i].label for i in own], np.int64),
                np.array([rows[i].v for i in own], np.float64).reshape(len(own), dim),
            )
            for dim, own in by_length.items()
        }

    held, size = [], 0
    for row in anchors.toLocalIterator():
        if held and size + len(row.v) + 16 > most:
            yield block(held)
            held, size = [], 0
        held.append(row)
        size += len(row.v) + 16
    if held:
        yield block(held)


def _merged(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best hits of each key, ranked; two levels, so that no task has the lists of all tasks."""
    for some in ([*keys, "part"], keys):
        order = Window.partitionBy(*some).orderBy(F.col("score").desc(), "vec_id")
        hits = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return hits


def mine(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = (LOW, HIGH),
    scale: int = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for every row of
    ``anchors(vec_id, embedding, label)`` and each of its positives, which are the ``positives`` other rows of
    ``vectors(vec_id, embedding, label)`` of the same label with the highest inner product of scaled, floored components,
    the ``negatives`` rows of another label with the highest inner product n for which
    ``low * p <= 100 * n <= high * p``, p being the positive's. Equal scores by smaller vec_id; all where there are
    fewer. Runs jobs per block of anchors.

    Rows without vec_id or label, null vectors and those with a null or non-finite component take no part; vectors meet
    vectors of their own length only. Rows with the anchor's vec_id are not among its hits; a vec_id that occurs in several
    rows may be listed as often; of several anchors with one vec_id the one of the smallest label, then vector, is asked.
    An anchor without a positive, and a positive without a row in its window, yield nothing (a positive of negative score
    has an empty window). Scores are exact; one beyond 64 bits is an error. No rows give no rows; further columns are not
    read.
    """
    spark = vectors.sparkSession
    usable = _usable(vectors, scale)
    first = F.min(F.struct("label", "v")).alias("first")
    asked = _usable(anchors, scale).groupBy("vec_id").agg(first).select("vec_id", "first.label", "first.v")
    path = scratch_path(spark, "negatives")
    columns = f"{_HITS}, positive_id long, positive_score long"
    spark.createDataFrame([], columns).write.parquet(path)
    for ids, held in _blocks(asked, block):
        sent = spark.sparkContext.broadcast((ids, held))
        hits = materialize(arrow_map(usable, partial(_positives, block=sent, k=positives), _HITS), "positives")
        near = materialize(_merged(hits, ["anchor_id"], positives).select("anchor_id", "score", "vec_id", "rank"), "near")
        # At most ``positives`` rows per anchor of the block.
        place = {int(a): i for i, a in enumerate(ids)}
        low, high = np.ones((len(ids), positives), np.int64), np.zeros((len(ids), positives), np.int64)
        for r in near.collect():
            at = place[r["anchor_id"]], r["rank"] - 1
            low[at], high[at] = -(-window[0] * r["score"] // 100), window[1] * r["score"] // 100
        bounds = spark.sparkContext.broadcast((low, high))
        found = arrow_map(usable, partial(_negatives, block=sent, windows=bounds, k=negatives), _HITS)
        opened = near.select(
            "anchor_id", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        found = materialize(found, "inside")
        found.join(opened, ["anchor_id", "window"]).select(*[c.split()[0] for c in columns.split(", ")]).write.mode("append").parquet(path)
        sent.destroy()
        bounds.destroy()
    hits = spark.read.schema(columns).parquet(path)
    return _merged(hits, ["anchor_id", "window"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
