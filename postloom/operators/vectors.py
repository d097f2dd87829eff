"""Text vectors: encoding, exact and clustered search, grouping of similar posts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.operators.graph import components
from postloom.session import materialize

# Vectors have 384 dimensions and are made 64 texts at a time.
DIMENSIONS = 384
BATCH = 64

# Query vectors travel inside task closures, this many at a time; each block of them reads the corpus once.
QUERY_BLOCK = 1024

# Scores that a task holds at a time, about.
SCORES = 1 << 19

# Vectors with one band value that a task compares; more are spread over several tasks.
TILE = 2048


def words(c: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def hash_encoder(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """Default encoder: hashed word counts scaled to unit length, all in the JVM. Text without words gives zeros."""
    tf = HashingTF(numFeatures=DIMENSIONS, inputCol="_words", outputCol="_tf")
    unit = Normalizer(p=2.0, inputCol="_tf", outputCol="_unit")
    out = unit.transform(tf.transform(df.withColumn("_words", words(F.col(text_col)))))
    out = out.withColumn(out_col, vector_to_array("_unit", "float32"))
    return out.drop("_words", "_tf", "_unit")


def model_encoder(make_predict: Callable, batch_size: int = BATCH) -> Callable:
    """Encoder from a model: ``make_predict()`` loads it once per worker and returns a function on string arrays."""
    encode = predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)

    def run(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        raw = df.withColumn("_raw", encode(F.col(text_col)))
        norm = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
        scaled = F.transform("_raw", lambda x: (x / F.col("_norm")).cast("float"))
        out = raw.withColumn("_norm", norm)
        return out.withColumn(out_col, F.when(F.col("_norm") > 0, scaled).otherwise(F.col("_raw"))).drop("_raw", "_norm")

    return run


def embed(
    posts: DataFrame, encoder: Callable = hash_encoder, text_col: str = "full_text", out_col: str = "embedding"
) -> DataFrame:
    """Fill ``embedding`` where it is null. The encoder sees only those rows; the others bypass it."""
    if out_col not in posts.columns:
        return encoder(posts, text_col, out_col)
    todo = encoder(posts.filter(F.col(out_col).isNull()).drop(out_col), text_col, out_col)
    return posts.filter(F.col(out_col).isNotNull()).unionByName(todo)


def reuse_vectors(posts: DataFrame, stored: DataFrame, id_col: str = "tweet_id") -> DataFrame:
    """Attach stored vectors by id, so that only new posts are encoded."""
    return posts.join(stored.select(id_col, "embedding"), id_col, "left")


HITS = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def _unit_rows(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten().to_numpy(zero_copy_only=False), dtype="float64").reshape(-1, dim)


def _best(qids: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> dict[str, list]:
    """Top ``k`` rows of each score column; equal scores go to the smaller id."""
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    for j, qid in enumerate(qids):
        col = scores[:, j]
        live = np.flatnonzero(np.isfinite(col))
        if len(live) > 4 * k:  # keep everything tied with the k-th score before ordering
            cut = np.partition(col[live], len(live) - k)[len(live) - k]
            live = live[col[live] >= cut]
        top = live[np.lexsort((ids[live], -col[live]))[:k]]
        out["query_id"] += [int(qid)] * len(top)
        out["vec_id"] += ids[top].tolist()
        out["score"] += col[top].tolist()
    return out


def _score(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of every row with every query, rounded so that equal vectors tie whatever their place in the batch."""
    scores = np.round(rows @ q.T, 9)
    scores[~rows.any(axis=1)] = -np.inf
    return scores


def _top_per_query(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # The rank filter is applied inside each task first (window group limit), then once after the shuffle.
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _query_blocks(queries: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of the queries that have one, block by block: the driver holds one block at a time."""
    rows = queries.select("query_id", "embedding").filter(F.size("embedding") > 0).toLocalIterator()
    while block := list(islice(rows, QUERY_BLOCK)):
        yield np.array([r[0] for r in block], dtype="int64"), np.array([r[1] for r in block], dtype="float64")


def _hits_of(corpus: DataFrame, q: np.ndarray, qids: np.ndarray, k: int, wanted: np.ndarray | None = None) -> DataFrame:
    """At most ``k`` hits per query and Arrow batch: a matrix product for as many queries as give ``SCORES`` scores.
    ``wanted[cell, query]`` masks cells."""
    unit = _unit_rows(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                rows, ids = _unit_rows(_matrix(table.column("embedding"), unit.shape[1])), np.asarray(table.column("vec_id"))
                cells = None if wanted is None else np.asarray(table.column("cell"))
                width = max(1, SCORES // len(ids))
                for at in range(0, len(qids), width):
                    some = slice(at, at + width)
                    scores = _score(rows, unit[some])
                    if wanted is not None:
                        scores[~wanted[cells, some]] = -np.inf
                    yield pa.RecordBatch.from_pydict(_best(qids[some], ids, scores, k), schema=_HITS_ARROW)

    return corpus.mapInArrow(run, HITS)


def _all_hits(spark: SparkSession, parts: list[DataFrame], k: int) -> DataFrame:
    return _top_per_query(reduce(DataFrame.unionByName, parts or [spark.createDataFrame([], HITS)]), k)


def search_exact(corpus: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, vec_id, score, rank)``: the ``k`` rows of highest cosine per query; zero vectors have none.

    ``corpus`` is ``(vec_id, embedding)``, ``queries`` is ``(query_id, embedding)``; null and empty vectors take no part.
    Reads the queries in a job. For every ``QUERY_BLOCK`` of them the corpus is read once, unshuffled.
    """
    rows = corpus.select("vec_id", "embedding").filter(F.size("embedding") > 0)
    return _all_hits(corpus.sparkSession, [_hits_of(rows, q, qids, k) for qids, q in _query_blocks(queries)], k)


_HITS_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def fit_cells(corpus: DataFrame, cells: int, seed: int = 42, iterations: int = 20):
    """K-Means model over every vector of ``corpus`` (vectors column ``embedding``)."""
    data = corpus.select(array_to_vector("embedding").alias("features"))
    return KMeans(k=cells, seed=seed, maxIter=iterations, distanceMeasure="euclidean").fit(data)


def assign_cells(corpus: DataFrame, model, out_col: str = "cell") -> DataFrame:
    """Nearest centroid per row: a scan without a shuffle. Write it partitioned by ``cell`` to serve searches."""
    featured = corpus.withColumn("features", array_to_vector("embedding"))
    return model.transform(featured).withColumnRenamed("prediction", out_col).drop("features")


def _by_distance(q: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Numbers of the cells per query, nearest first."""
    distance = (q**2).sum(axis=1)[:, None] - 2 * q @ centers.T + (centers**2).sum(axis=1)[None, :]
    return np.argsort(distance, axis=1, kind="stable")


def probes_for(celled: DataFrame, queries: DataFrame, model, k: int, recall: float = 0.9, sample: int = 64) -> tuple[int, float]:
    """The fewest probes with which ``search_cells`` finds ``recall`` of the exact hits of ``sample`` queries, drawn by a
    hash of their ids, and the recall measured with them. Costs an exact search of these queries, which says in which cell
    each true neighbour lies; with no more queries than ``sample`` the recall holds for all of them."""
    drawn = queries.filter(F.size("embedding") > 0).orderBy(F.xxhash64("query_id"), "query_id").limit(sample)
    drawn = materialize(drawn.select("query_id", "embedding"), "drawn")
    hits = search_exact(celled, drawn, k).select("query_id", "vec_id")
    found = hits.join(celled.select("vec_id", "cell"), "vec_id").groupBy("query_id", "cell").count().collect()
    near = {}
    for qids, q in _query_blocks(drawn):
        near |= dict(zip(qids.tolist(), _by_distance(q, np.array(model.clusterCenters()))))
    at = np.zeros(len(model.clusterCenters()))
    for r in found:
        at[int(np.flatnonzero(near[r["query_id"]] == r["cell"])[0])] += r["count"]
    if not at.any():
        return len(at), 1.0
    reached = np.cumsum(at) / at.sum()
    probes = int(np.argmax(reached >= recall)) + 1
    return probes, float(reached[probes - 1])


def search_cells(celled: DataFrame, queries: DataFrame, model, k: int, probes: int) -> DataFrame:
    """Approximate search: each query looks at its ``probes`` nearest cells only, however many queries there are.

    The probed cells are a filter on ``cell``, which prunes directories of a table partitioned by it. ``probes`` equal
    to the number of cells gives the exact result. Null and empty vectors take no part.
    """
    centers = np.array(model.clusterCenters())
    rows = celled.select("vec_id", "embedding", "cell").filter(F.size("embedding") > 0)
    parts = []
    for qids, q in _query_blocks(queries):
        probed = _by_distance(q, centers)[:, :probes]
        wanted = np.zeros((len(centers), len(qids)), dtype=bool)
        wanted[probed.T, np.arange(len(qids))] = True
        near = rows.filter(F.col("cell").isin(sorted({int(c) for c in probed.ravel()})))
        parts.append(_hits_of(near, q, qids, k, wanted))
    return _all_hits(celled.sparkSession, parts, k)


def _bands(distinct: int, cut: float, recall: float) -> tuple[int, int]:
    """Sign bits per band and number of bands: about one vector in two has its bits by chance, and a pair whose cosine is
    just ``cut`` agrees on a whole band somewhere with probability ``recall``, a closer one more often."""
    bits = min(60, max(8, int(distinct).bit_length() + 1))
    alike = (1 - np.arccos(cut) / np.pi) ** bits
    return bits, 1 if alike >= recall else int(np.ceil(np.log1p(-recall) / np.log1p(-alike)))


def _signs(batches: Iterator[pa.RecordBatch], bits: int, bands: int, seed: int) -> Iterator[pa.RecordBatch]:
    """A row per vector and band with the signs of its projections on ``bits`` random directions as a number."""
    weights = (1 << np.arange(bits, dtype="int64")).astype("int64")
    planes: dict[int, np.ndarray] = {}
    for batch in batches:
        lists = batch.column("embedding")
        sizes = np.asarray(pc.list_value_length(lists))
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            m = _matrix(pa.chunked_array([lists.take(pa.array(at))]), int(dim))
            if dim not in planes:
                planes[dim] = np.random.default_rng([seed, int(dim)]).normal(size=(int(dim), bands * bits))
            live = np.isfinite(m).all(axis=1) & m.any(axis=1)
            ids = np.asarray(batch.column("id"))[at][live]
            if len(ids):
                codes = ((m[live] @ planes[dim] > 0).reshape(len(ids), bands, bits) * weights).sum(axis=2)
                yield pa.RecordBatch.from_pydict({
                    "id": np.repeat(ids, bands),
                    "dim": np.full(len(ids) * bands, dim, dtype="int32"),
                    "band": np.tile(np.arange(bands, dtype="int32"), len(ids)),
                    "bits": codes.ravel(),
                })


def _forest(ids: np.ndarray, unit: np.ndarray, cut: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect the rows as all pairs with a cosine of at least ``cut`` do. Every row is compared with those that
    are not yet reached only, so rows that are all alike take one step."""
    rest = np.arange(len(ids))
    while len(rest) > 1:
        found, rest = rest[:1], rest[1:]
        while len(found) and len(rest):
            some, found = found[:256], found[256:]
            near = np.round(unit[rest] @ unit[some].T, 9) >= cut
            hit = near.any(axis=1)
            new = rest[hit]
            if len(new):
                yield ids[some[near[hit].argmax(axis=1)]], ids[new]
                found, rest = np.concatenate([found, new]), rest[~hit]


def _links(batches: Iterator[pa.RecordBatch], cut: float) -> Iterator[pa.RecordBatch]:
    """Edges inside every tile; the rows of a tile follow each other."""

    def edges(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = np.asarray(rows.column("id"))
        unit = _unit_rows(_matrix(rows.column("embedding"), rows.column("dim")[0].as_py()))
        for a, b in _forest(ids, unit, cut):
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        keys = [np.asarray(table.column(c)) for c in _TILE]
        starts = [0, *(np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1).tolist()]
        for start, stop in zip(starts, starts[1:]):
            yield from edges(table.slice(start, stop - start))
        held = table.slice(starts[-1]) if table.num_rows else None
    if held is not None:
        yield from edges(held)


_TILE = ("dim", "band", "bits", "low", "high")
_BAND = ["dim", "band", "bits"]

#: Pivots that a crowded band value is thinned out by, one after another.
PIVOTS = 6


def _thinned(hot: DataFrame, cut: float, pivot: int) -> tuple[DataFrame, DataFrame]:
    """One pivot's links to the rows ``(dim, band, bits, id, embedding)`` of crowded band values, and the rows that still
    have to be compared.

    Two rows that both reach ``cut`` with the pivot are linked through it. A row that does not lies at an angle of at least
    m from the pivot, m being the smallest such angle of its band value, and can only reach rows at m less the angle of the
    cut or more. All others are done: a dense group leaves one link per row.
    """
    order = F.struct(F.xxhash64("id", F.lit(pivot)), "id", "embedding")
    pivots = hot.groupBy(*_BAND).agg(F.min(order).alias("p")).select(*_BAND, F.col("p.id").alias("pivot"), F.col("p.embedding").alias("at"))
    pivots = materialize(pivots, "pivots")
    dot = lambda a, b: F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )
    cosine = F.round(dot("embedding", "at") / F.sqrt(dot("embedding", "embedding") * dot("at", "at")), 9)
    met = materialize(hot.join(pivots, _BAND).select(*_BAND, "id", "embedding", "pivot", cosine.alias("cosine")), "met_pivot")
    edges = met.filter((F.col("cosine") >= cut) & (F.col("id") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    outer = materialize(met.filter(F.col("cosine") < cut).groupBy(*_BAND).agg(F.max("cosine").alias("most")), "outer")
    angle = lambda c: F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c)))
    near = angle(F.col("cosine")) >= angle(F.col("most")) - float(np.arccos(cut)) - 1e-6
    return edges, met.join(outer, _BAND).filter(near).select(*_BAND, "id", "embedding")


def _uncrowded(codes: DataFrame, whole: DataFrame, cut: float) -> tuple[list[DataFrame], DataFrame]:
    """Links found by pivots inside the band values of more than ``TILE`` rows, and the rows ``(dim, band, bits, id)`` of all
    band values that still have to be compared."""
    edges, done, rest = [], [], codes
    for pivot in range(PIVOTS):
        sizes = materialize(rest.groupBy(*_BAND).agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
        crowded = sizes.filter(F.col("n") > TILE).select(*_BAND)
        if crowded.isEmpty():
            return edges, reduce(DataFrame.unionByName, [*done, rest.select(*_BAND, "id")])
        done.append(rest.join(sizes.filter(F.col("n") <= TILE).select(*_BAND), _BAND).select(*_BAND, "id"))
        hot = rest.join(crowded, _BAND)
        hot = hot if "embedding" in hot.columns else hot.join(whole, "id")
        found, rest = _thinned(hot, cut, pivot)
        edges.append(found)
        rest = materialize(rest, "thinned")
    return edges, reduce(DataFrame.unionByName, [*done, rest.select(*_BAND, "id")])


def near_duplicates(corpus: DataFrame, cut: float = 0.95, recall: float = 0.95, seed: int = 42) -> DataFrame:
    """``(vec_id, group_id)``: group_id is the smallest vec_id that is reached over pairs with a cosine of at least ``cut``.

    Equal vectors are one from the start. The others are looked up by bands of random hyperplanes: a pair just at the cut
    shares one with probability ``recall``, a closer pair more often, and bits and bands follow the number of vectors, so
    that chance meetings stay linear. Vectors of one band value are compared exactly, no other cosine counts. A band value
    that more than ``TILE`` vectors share is thinned out by pivots first, without losing a link (``_thinned``): a dense group
    costs a multiple of its size. What is still crowded after ``PIVOTS`` of them is spread over all pairs of its parts. What
    leaves a task are edges of a forest, never pairs. Null vectors stand for themselves; zero vectors and those with a null, an infinite or a NaN
    component are alike only where they are equal.
    """
    text = F.array_join(F.transform("embedding", lambda x: (x + F.lit(0).cast("float")).cast("string")), ",", "null")
    rows = corpus.select("vec_id", "embedding", F.sha2(text, 256).alias("_key"))
    known = rows.filter("embedding is not null").groupBy("_key")
    known = materialize(known.agg(F.min("vec_id").alias("id"), F.first("embedding").alias("embedding")), "distinct")
    whole = known.filter(F.size("embedding") > 0).filter(~F.exists("embedding", lambda x: x.isNull()))
    whole = whole.filter("id is not null").select("id", "embedding")
    bits, bands = _bands(whole.count(), cut, recall)

    codes = whole.mapInArrow(lambda it: _signs(it, bits, bands, seed), "id long, dim int, band int, bits long")
    linked, codes = _uncrowded(materialize(codes, "bands"), whole, cut)
    codes = materialize(codes, "to_compare")
    met = materialize(codes.groupBy("dim", "band", "bits").agg(F.count("*").alias("n")).filter("n > 1"), "met")
    parts = codes.join(met, ["dim", "band", "bits"]).withColumn("parts", F.ceil(F.col("n") / TILE).cast("int"))
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: (x != F.col("own")) | (F.col("parts") == 1))
    tiles = parts.withColumn("own", own).withColumn("other", F.explode(others))
    tiles = tiles.select("id", "dim", "band", "bits", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    tiles = tiles.join(whole, "id").repartition(*_TILE).sortWithinPartitions(*_TILE)
    edges = reduce(DataFrame.unionByName, [*linked, tiles.mapInArrow(lambda it: _links(it, cut), "a long, b long")])
    roots = components(edges).withColumnRenamed("node", "id")

    named = materialize(known.select("_key", "id").join(roots, "id", "left").select("_key", F.coalesce("root", "id").alias("low")), "groups")
    out = rows.select("vec_id", F.when(F.col("embedding").isNotNull(), F.col("_key")).alias("_key")).join(named, "_key", "left")
    return out.select("vec_id", F.coalesce("low", "vec_id").alias("group_id"))


def describe_clusters(assigned: DataFrame, text_col: str, score: Column, top: int = 10) -> DataFrame:
    """Per cluster: size, mean score and its ``top`` most frequent words (counted once per row)."""
    base = assigned.groupBy("cell").agg(F.count("*").alias("size"), F.avg(score).alias("mean_score"))
    terms = assigned.select("cell", F.explode(F.array_distinct(words(F.col(text_col)))).alias("term"))
    order = Window.partitionBy("cell").orderBy(F.desc("count"), "term")
    ranked = (
        terms.groupBy("cell", "term").count().withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
    )
    best = ranked.groupBy("cell").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), " ")
        .alias("top_terms")
    )
    return base.join(best, "cell", "left")
