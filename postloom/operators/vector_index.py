"""Approximate search by cosine in bounded memory: two levels of cells, quantised residuals, exact scores for a short list.

An index is fitted on a bounded sample and has a fixed size, whatever the number of rows: ``COARSE`` centres, ``FINE``
centres of what is left after the first (shared by all first cells, so there are COARSE x FINE cells), and per ``WIDTH``
components a book of ``BOOK`` values for what is left after both. A row is then a cell and one byte per book. A query reads
the codes of its nearest cells only, until a share of all rows is reached; the best of them by code, the short list, are
scored by their vectors. Rows and queries meet by a join on the first cell, large cells in parts and many queries in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.operators.vectors import search_exact
from postloom.session import materialize

COARSE, FINE, BOOK, WIDTH = 64, 64, 256, 4

#: Rows that an index is fitted on, at most.
SAMPLE = 16_384

#: Rows that a task encodes or assigns at a time.
SLICE = 1_024

#: Code rows and queries that meet in one task group.
ROWS, QUERIES = 65_536, 1_024


@dataclass(frozen=True)
class Index:
    """Centres of both levels, ``(cells, dimensions)`` each, and books ``(parts, values, WIDTH)``; the last part is padded."""

    coarse: np.ndarray
    fine: np.ndarray
    books: np.ndarray

    @property
    def dim(self) -> int:
        return self.coarse.shape[1]


def lloyd(x: np.ndarray, k: int, seed: int = 42, rounds: int = 20) -> np.ndarray:
    """Centres of at most ``k`` groups of the rows ``x``, by K-Means from spread-out rows; the same rows give the same ones."""
    rng = np.random.default_rng(seed)
    centres = x[rng.integers(len(x), size=1)]
    gap = ((x - centres[0]) ** 2).sum(axis=1, dtype="float64")
    while len(centres) < k and gap.sum() > 0:
        # A few rows at a time, far ones more likely.
        live = np.flatnonzero(gap)
        want = min(max(1, len(centres) // 2), k - len(centres), len(live))
        some = x[rng.choice(live, size=want, replace=False, p=gap[live] / gap[live].sum())]
        centres = np.unique(np.concatenate([centres, some]), axis=0)
        gap = np.minimum(gap, _gaps(x, some).min(axis=1))
        gap[gap < 1e-12] = 0
    for _ in range(rounds):
        at = _gaps(x, centres).argmin(axis=1)
        sizes = np.bincount(at, minlength=len(centres))
        sums = np.zeros(centres.shape)
        np.add.at(sums, at, x)
        moved = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres).astype(x.dtype)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def _gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, not below zero."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(axis=1)[None, :], 0)


def _split(x: np.ndarray) -> np.ndarray:
    """``(parts, rows, WIDTH)``, zeros after the last component."""
    parts = -(-x.shape[1] // WIDTH)
    wide = np.zeros((len(x), parts * WIDTH), "float32")
    wide[:, : x.shape[1]] = x
    return wide.reshape(len(x), parts, WIDTH).transpose(1, 0, 2)


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    m = np.asarray(column.flatten().to_numpy(zero_copy_only=False), "float64").reshape(-1, dim)
    return (m / np.sqrt((m * m).sum(axis=1, keepdims=True))).astype("float32")


def directed(df: DataFrame, dim: int | None = None) -> DataFrame:
    """The rows whose ``embedding`` has a direction (and ``dim`` components): not null, finite, not zero throughout."""
    fits = F.size("embedding") > 0 if dim is None else F.size("embedding") == dim
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return df.filter(fits & ~F.exists("embedding", odd) & F.exists("embedding", lambda x: x != 0))


def draw(rows: DataFrame, most: int, seed: int = 42) -> DataFrame:
    """At most ``most`` rows of ``(id, embedding)`` by a hash of both; a first cut by the hash keeps all others out of the
    sort."""
    hashed = rows.withColumn("_draw", F.xxhash64(F.lit(seed), *rows.columns))
    share = min(1.0, 1.3 * most / max(1, rows.count()))
    few = hashed.filter(F.shiftrightunsigned("_draw", 11).cast("double") <= share * 2.0**53)
    return few.orderBy("_draw", rows.columns[0]).limit(most).drop("_draw")


def sample_matrix(corpus: DataFrame, sample: int = SAMPLE, seed: int = 42) -> np.ndarray:
    """Unit vectors of at most ``sample`` rows of ``corpus(vec_id, embedding)``, all of the commonest length."""
    rows = directed(corpus.select("vec_id", "embedding"))
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return np.zeros((0, 0), "float32")
    got = draw(rows.filter(F.size("embedding") == sizes["n"]), sample, seed).select("embedding").toArrow()
    return _unit(got.column("embedding").combine_chunks(), sizes["n"])


def fit_index(corpus: DataFrame, sample: int = SAMPLE, seed: int = 42) -> Index | None:
    """Index fitted on at most ``sample`` rows of ``corpus(vec_id, embedding)``; None where no row has a direction."""
    x = sample_matrix(corpus, sample, seed)
    if not len(x):
        return None
    coarse = lloyd(x, COARSE, seed)
    left = x - coarse[_gaps(x, coarse).argmin(axis=1)]
    fine = lloyd(left, FINE, seed)
    parts = _split(left - fine[_gaps(left, fine).argmin(axis=1)])
    books = np.zeros((len(parts), BOOK, WIDTH), "float32")
    for book, part in zip(books, parts):
        found = lloyd(part, BOOK, seed, rounds=8)
        book[:] = found[0]  # fewer values than places: the first one again
        book[: len(found)] = found
    return Index(coarse, fine, books)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _coded(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        x = _unit(batch.column("embedding"), index.dim)
        first = _gaps(x, index.coarse).argmin(axis=1)
        x = x - index.coarse[first]
        second = _gaps(x, index.fine).argmin(axis=1)
        x = x - index.fine[second]
        code = np.stack([_gaps(p, b).argmin(axis=1) for p, b in zip(_split(x), index.books)], axis=1).astype("uint8")
        yield pa.RecordBatch.from_pydict({
            "vec_id": batch.column("vec_id"), "mark": batch.column("mark"),
            "first": pa.array(first, pa.int32()), "second": pa.array(second, pa.int32()),
            "code": pa.array([row.tobytes() for row in code], pa.binary()),
        })


def _mark() -> Column:
    return F.xxhash64("embedding").alias("mark")


def encode(corpus: DataFrame, index: Index) -> DataFrame:
    """``(vec_id, mark, first, second, code)`` of every row that has a direction: one scan, no shuffle. ``mark`` is a hash
    of the vector and tells rows of one id apart."""
    rows = directed(corpus.select("vec_id", "embedding"), index.dim).select("vec_id", _mark(), "embedding")
    return rows.mapInArrow(lambda it: _coded(it, index), "vec_id long, mark long, first int, second int, code binary")


def cell_sizes(coded: DataFrame, index: Index) -> np.ndarray:
    """Rows per cell, ``(COARSE, FINE)``."""
    out = np.zeros((len(index.coarse), len(index.fine)), "int64")
    for r in coded.groupBy("first", "second").count().toLocalIterator():
        out[r["first"], r["second"]] = r["count"]
    return out


def _reached(q: np.ndarray, index: Index, sizes: np.ndarray) -> np.ndarray:
    """Per query and cell, the share of all rows that lie in nearer cells."""
    centres = (index.coarse[:, None, :] + index.fine[None, :, :]).reshape(-1, index.dim)
    near = np.argsort(_gaps(q, centres), axis=1, kind="stable")
    before = np.cumsum(sizes.ravel()[near], axis=1) - sizes.ravel()[near]
    out = np.empty(before.shape)
    np.put_along_axis(out, near, before / max(1, sizes.sum()), axis=1)
    return out.reshape(len(q), *sizes.shape)


def _routed(batches: Iterator[pa.RecordBatch], index: Index, sizes: np.ndarray, share: float) -> Iterator[pa.RecordBatch]:
    """A row per query and first cell, with its second cells as bits."""
    bits = np.left_shift(np.uint64(1), np.arange(len(index.fine), dtype="uint64"))
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            q = _unit(some.column("embedding"), index.dim)
            wanted = ((_reached(q, index, sizes) < share) & (sizes > 0)).astype("uint64") @ bits
            rows, first = np.nonzero(wanted)
            yield pa.RecordBatch.from_pydict({
                "query_id": some.column("query_id").take(pa.array(rows)),
                "first": pa.array(first, pa.int32()),
                "cells": pa.array(wanted[rows, first].view("int64")),
                "q": pa.array(list(q[rows]), pa.list_(pa.float32())),
            })


def _listed(rows: pa.Table, queries: pa.Table, index: Index, short: int) -> pa.Table:
    """The best ``short`` rows by code per query; rows and queries are of one first cell."""
    out = {"query_id": [], "vec_id": [], "mark": [], "approx": []}
    if rows.num_rows and queries.num_rows:
        first = rows.column("first")[0].as_py()
        second, ids, marks = (np.asarray(rows.column(c)) for c in ("second", "vec_id", "mark"))
        code = np.frombuffer(b"".join(rows.column("code").to_pylist()), "uint8").reshape(len(ids), -1)
        places = np.arange(code.shape[1])
        vectors = np.asarray(queries.column("q").combine_chunks().flatten(), "float32").reshape(-1, index.dim)
        bits = np.asarray(queries.column("cells")).view("uint64")
        for qid, cells, q in zip(queries.column("query_id").to_pylist(), bits, vectors):
            live = np.flatnonzero((cells >> second.astype("uint64")) & np.uint64(1))
            table = np.einsum("pw,pvw->pv", _split(q[None])[:, 0], index.books)
            score = q @ index.coarse[first] + (index.fine @ q)[second[live]] + table[places, code[live]].sum(axis=1)
            score = np.round(score.astype("float64"), 6)
            if len(score) > 4 * short:
                cut = np.partition(score, len(score) - short)[len(score) - short]
                live, score = live[score >= cut], score[score >= cut]
            top = np.lexsort((marks[live], ids[live], -score))[:short]
            out["query_id"].append(np.full(len(top), qid))
            out["vec_id"].append(ids[live[top]])
            out["mark"].append(marks[live[top]])
            out["approx"].append(score[top])
    joined = {c: np.concatenate(v) if v else np.zeros(0) for c, v in out.items()}
    return pa.table({c: pa.array(v, pa.float64() if c == "approx" else pa.int64(), from_pandas=False) for c, v in (
        (c, v if c == "approx" else v.astype("int64")) for c, v in joined.items())})


def short_list(coded: DataFrame, queries: DataFrame, index: Index, sizes: np.ndarray, share: float, short: int) -> DataFrame:
    """``(query_id, vec_id, mark, approx, place)``: the ``short`` rows of highest score by code among the nearest cells that
    hold the ``share`` of all rows (whole cells, one at least)."""
    asked = directed(queries.select("query_id", "embedding"), index.dim)
    blocks = max(1, -(-asked.count() // QUERIES))
    routed = asked.mapInArrow(lambda it: _routed(it, index, sizes, share), "query_id long, first int, cells long, q array<float>")
    parts = F.element_at(F.array(*[F.lit(max(1, -(-int(n) // ROWS))) for n in sizes.sum(axis=1)]), F.col("first") + 1)
    routed = routed.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    routed = routed.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    # Repeated rows of one id are spread by their place in the table.
    rows = coded.withColumn("part", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), parts).cast("int"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ("first", "part", "block")
    hits = rows.groupBy(*key).cogroup(routed.groupBy(*key)).applyInArrow(
        lambda a, b: _listed(a, b, index, short), "query_id long, vec_id long, mark long, approx double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("approx"), "vec_id", "mark")
    return hits.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= short)


def search_index(
    corpus: DataFrame, coded: DataFrame, queries: DataFrame, index: Index, k: int, share: float, short: int
) -> DataFrame:
    """``(query_id, vec_id, score, rank)`` like ``search_exact``, of the rows on each query's short list, by their exact
    cosine; ties go to the smaller id. ``coded`` is ``encode(corpus, index)``, written down. Vectors that are null, zero, not
    finite or of another length take no part; ids of queries are unique, repeated rows stay repeated."""
    few = short_list(coded, queries, index, cell_sizes(coded, index), share, short)
    few = materialize(few.select("query_id", "vec_id", "mark").distinct(), "short_list")
    dot = lambda a, b: F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )
    rows = directed(corpus.select("vec_id", "embedding"), index.dim).select("vec_id", "embedding", _mark())
    met = few.join(rows, ["vec_id", "mark"]).join(queries.select("query_id", F.col("embedding").alias("q")), "query_id")
    score = F.round(dot("embedding", "q") / F.sqrt(dot("embedding", "embedding") * dot("q", "q")), 9)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    met = met.select("query_id", "vec_id", score.alias("score"))
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def settings_for(
    corpus: DataFrame, coded: DataFrame, queries: DataFrame, index: Index, k: int, recall: float = 0.93, sample: int = 64
) -> tuple[float, int]:
    """Share of rows and length of the short list with which ``search_index`` finds ``recall`` of the exact hits of at most
    ``sample`` of the queries, drawn by hash. Half of the loss goes to the cells, the rest to the codes. Ask for more than
    is needed: other queries may fare a little worse."""
    drawn = materialize(draw(directed(queries.select("query_id", "embedding"), index.dim), sample), "drawn")
    hits = materialize(search_exact(directed(corpus, index.dim), drawn, k).select("query_id", "vec_id"), "hits")
    sizes = cell_sizes(coded, index)
    cells = hits.join(coded.select("vec_id", "first", "second"), "vec_id")
    asked = {r["query_id"]: r["embedding"] for r in drawn.collect()}
    if not asked:
        return 1.0, k
    q = _unit(pa.array(list(asked.values()), pa.list_(pa.float64())), index.dim)
    reached = dict(zip(asked, _reached(q, index, sizes)))
    needed = np.sort([reached[r["query_id"]][r["first"], r["second"]] for r in cells.collect()])
    half = (1 + recall) / 2
    share = float(needed[max(0, int(np.ceil(half * len(needed))) - 1)]) + 1e-9 if len(needed) else 1.0
    short, total, rows = 4 * k, hits.count(), int(sizes.sum())
    while True:
        found = short_list(coded, drawn, index, sizes, share, short).select("query_id", "vec_id", "place")
        places = np.sort([r["place"] for r in hits.join(found, ["query_id", "vec_id"]).collect()])
        want = int(np.ceil(recall * total))
        if len(places) >= want:
            return share, max(k, int(places[want - 1])) if want else k
        if short >= rows:
            return 1.0, rows
        short *= 4


def silhouette(x: np.ndarray, centres: np.ndarray) -> float:
    """How much farther the next centre is than the own one, as a share, on average (0 to 1)."""
    if not len(x) or len(centres) < 2:
        return 0.0
    two = np.sqrt(np.partition(_gaps(x, centres), 1, axis=1)[:, :2])
    return float(np.divide(two[:, 1] - two[:, 0], two[:, 1], out=np.zeros(len(x)), where=two[:, 1] > 0).mean())


def fit_clusters(
    corpus: DataFrame, ks: tuple[int, ...] = (2, 3, 4, 6, 8, 12, 16), sample: int = SAMPLE, seed: int = 42
) -> tuple[np.ndarray, dict[int, float]]:
    """Centres of the directions of ``corpus(vec_id, embedding)``, and the measure that chose their number.

    For each number in ``ks``, centres of one half of a bounded sample are measured on the other half by ``silhouette``;
    the number with the highest measure wins, the smaller of equal ones, and is fitted to the whole sample. The same rows
    give the same centres, in whatever order they come. No row with a direction gives no centres.
    """
    x = sample_matrix(corpus, sample, seed)
    measured = {k: silhouette(x[1::2], lloyd(x[::2], k, seed)) for k in ks if k <= len(x[::2])}
    if not len(x):
        return x, {}
    best = max(sorted(measured), key=lambda k: measured[k], default=1)
    return lloyd(x, best, seed), measured


def nearest_cell(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """``rows`` with ``cell``, the number of the centre nearest to the direction of ``embedding``, the smaller of equally
    near ones; null without a direction or with another number of components. A scan without a shuffle."""
    own = rows.select("*", F.lit(None).cast("int").alias("cell"))
    schema, dim = own.schema, centres.shape[1]
    if not len(centres):
        return own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            lists = batch.column("embedding")
            cells: list[int | None] = [None] * batch.num_rows
            vectors = lists.to_pylist()
            fit = [i for i, v in enumerate(vectors) if v is not None and len(v) == dim and None not in v]
            m = np.array([vectors[i] for i in fit], "float64").reshape(-1, dim)
            live = np.isfinite(m).all(axis=1) & m.any(axis=1)
            m = m[live] / np.sqrt((m[live] ** 2).sum(axis=1, keepdims=True))
            for i, c in zip(np.array(fit, int)[live], np.round(_gaps(m, centres.astype("float64")), 12).argmin(axis=1)):
                cells[i] = int(c)
            yield batch.drop_columns(["cell"]).append_column("cell", pa.array(cells, pa.int32()))

    return own.mapInArrow(run, schema)
