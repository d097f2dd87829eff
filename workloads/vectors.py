"""Vectors: encoding, search, clusters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from postloom.operators import star, vector_index, vectors
from postloom.session import materialize
from workloads.base import ORACLES, costly, query, table


@query("embed_default")
def embed_default(spark, sf_dir):
    """Unit vectors of every document (hash functions differ between engines, so no SQL)."""
    docs = costly(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("text", "full_text")
    return vectors.embed(docs).drop("full_text")


@query(
    "embed_length",
    r"""
    SELECT doc_id, 384 AS dimensions, CASE WHEN regexp_matches(text, '[\p{L}\p{N}]') THEN 1.0 ELSE 0.0 END::DOUBLE AS norm,
           min(doc_id) OVER (PARTITION BY list_sort(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))) AS first_alike
    FROM documents
    """,
)
def embed_length(spark, sf_dir):
    """What SQL can say of the vectors: their size and length, and that texts with the same words have the same one (the
    first document with an equal vector; 384 components tell these texts apart)."""
    vecs = vectors.embed(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("full_text"))).drop("full_text")
    vecs = materialize(vecs, "vectors")
    first = vecs.groupBy("embedding").agg(F.min("doc_id").alias("first_alike"))
    norm = F.round(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)), 4)
    return vecs.join(first, "embedding").select("doc_id", F.size("embedding").alias("dimensions"), norm.alias("norm"), "first_alike")


@query(
    "vectors_reused",
    "SELECT doc_id, CAST(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 384 END AS INTEGER) AS dimensions, doc_id % 3 = 0 AS kept FROM documents",
)
def vectors_reused(spark, sf_dir):
    """Documents of which one in three has a stored vector, which stays, and one in three a stored null, which is encoded
    like those that have none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("full_text"))
    short = F.array(F.col("doc_id").cast("float"), F.lit(2.0).cast("float"))
    stored = docs.filter("doc_id % 3 < 2").select("doc_id", F.when(F.col("doc_id") % 3 == 0, short).alias("embedding"))
    done = vectors.embed(vectors.reuse_vectors(docs, stored, "doc_id"))
    return done.select(
        "doc_id", F.size("embedding").alias("dimensions"), (F.col("embedding") == short).alias("kept")
    )


@query(
    "vector_text",
    "SELECT vec_id, CASE WHEN vec_id % 5 <> 0 THEN CAST(len(embedding) AS INTEGER) END AS dimensions, vec_id % 5 <> 0 AS same FROM embeddings",
)
def vector_text(spark, sf_dir):
    """Vectors as JSON text and back; one in five is empty and has no text."""
    vecs = corpus(spark, sf_dir).withColumn("embedding", F.col("embedding").cast("array<float>"))
    vecs = vecs.withColumn("embedding", F.when(F.col("vec_id") % 5 != 0, F.col("embedding")).otherwise(F.array().cast("array<float>")))
    text = star.vector_json(F.col("embedding"))
    back = F.from_json(text, "array<float>")
    return vecs.select(
        "vec_id", F.when(text.isNotNull(), F.size(back)).alias("dimensions"), F.coalesce(back == F.col("embedding"), F.lit(False)).alias("same")
    )


def corpus(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


def label_means(spark, sf_dir):
    """One query vector per label: the mean of its vectors, made of one partial aggregate per dimension."""
    cells = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = cells.groupBy("label", "pos").agg(F.avg("x").alias("x"))
    # As many items as the vectors have dimensions.
    per = means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("ps")
    )
    return per.select("query_id", F.transform("ps", lambda p: p["x"]).alias("embedding"))


@query(
    "search_topk",
    """
    WITH x AS (SELECT label, pos, avg(CAST(embedding[pos] AS DOUBLE)) AS m
               FROM embeddings, unnest(range(1, len(embedding) + 1)) AS u(pos) GROUP BY label, pos),
    q AS (SELECT label AS query_id, list(m ORDER BY pos) AS qv FROM x GROUP BY label),
    s AS (SELECT query_id, vec_id, round(list_cosine_similarity(qv, CAST(embedding AS DOUBLE[])), 9) AS score
          FROM q, embeddings),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
    FROM r WHERE rank <= 10
    """,
)
def search_topk(spark, sf_dir):
    """The ten nearest vectors to every label's mean; ten is the search's k."""
    hits = vectors.search_exact(corpus(spark, sf_dir), label_means(spark, sf_dir), 10)
    return hits.withColumn("score", F.round("score", 6))


_TOPK_SQL = ORACLES["search_topk"]


@query("search_cells_all", _TOPK_SQL)
def search_cells_all(spark, sf_dir):
    """Every cell probed: the approximate search must then be the exact one."""
    vecs = corpus(spark, sf_dir)
    model = vectors.fit_cells(vecs, cells=10)
    hits = vectors.search_cells(vectors.assign_cells(vecs, model), label_means(spark, sf_dir), model, k=10, probes=10)
    return hits.withColumn("score", F.round("score", 6))


def ann(spark, sf_dir):
    """The vectors, the queries (every row whose id is divisible by 20) and the approximate hits. The index is fitted on a
    bounded sample, its settings on other rows as queries."""
    vecs = corpus(spark, sf_dir)
    of = lambda rest: vecs.filter(F.col("vec_id") % 20 == rest).select(F.col("vec_id").alias("query_id"), "embedding")
    index = vector_index.fit_index(vecs)
    coded = materialize(vector_index.encode(vecs, index), "coded")
    share, short = vector_index.settings_for(vecs, coded, of(10), index, k=10)
    return vecs, of(0), vector_index.search_index(vecs, coded, of(0), index, 10, share, short), short


@query(
    "search_recall",
    "SELECT true AS reached, true AS few_scored, count(*) AS queries FROM embeddings WHERE vec_id % 20 = 0",
)
def search_recall(spark, sf_dir):
    """Whether the setting of ``search_ann`` finds nine tenths of what the exact search finds, for queries that it was not
    chosen by, and scores at most a tenth of the vectors."""
    vecs, queries, some, short = ann(spark, sf_dir)
    exact = vectors.search_exact(vecs, queries, 10)
    found = exact.join(some.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return found.agg(
        (F.count("hit") >= 0.9 * F.count("*")).alias("reached"),
        F.lit(10 * short <= vecs.count()).alias("few_scored"),
        F.count_distinct("query_id").alias("queries"),
    )


@query(
    "cluster_terms",
    r"""
    WITH w AS (SELECT DISTINCT lang AS cell, doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents),
    n AS (SELECT cell, term, count(*) AS c FROM w GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY c DESC, term) AS rank FROM n),
    t AS (SELECT cell, string_agg(term, ' ' ORDER BY rank) AS top_terms FROM r WHERE rank <= 10 GROUP BY cell)
    SELECT d.lang AS cell, count(*) AS size, round(avg(quality), 6) AS mean_score, any_value(top_terms) AS top_terms
    FROM documents d LEFT JOIN labels USING (doc_id) LEFT JOIN t ON t.cell = d.lang GROUP BY d.lang
    """,
)
def cluster_terms(spark, sf_dir):
    """The description of clusters, over cells that are given: the languages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("cell"), "text")
    graded = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    out = vectors.describe_clusters(graded, "text", F.col("quality"))
    return out.withColumn("mean_score", F.round("mean_score", 6))


@query(
    "near_dup_vectors",
    """
    WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
               UNION ALL SELECT vec_id + 1000000, list_transform(embedding, lambda x: CAST(x AS DOUBLE) + 0.00001) FROM embeddings
               UNION ALL SELECT vec_id + 2000000, CAST(embedding AS DOUBLE[]) FROM embeddings WHERE label < 5),
    near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
             WHERE round(list_cosine_similarity(a.e, b.e), 9) >= 0.95),
    reached AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reached r JOIN near n ON r.b = n.a)
    SELECT v.vec_id, least(v.vec_id, coalesce(min(b), v.vec_id)) AS group_id FROM v LEFT JOIN reached ON a = v.vec_id GROUP BY v.vec_id
    """,
)
def near_dup_vectors(spark, sf_dir):
    """Groups by a cosine of 0.95 among the vectors, a slightly moved copy of each, and an equal copy of half of them."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    moved = rows.select(F.col("vec_id") + 1_000_000, "label", F.transform("embedding", lambda x: x + F.lit(0.00001)))
    equal = rows.filter("label < 5").select(F.col("vec_id") + 2_000_000, "label", "embedding")
    return vectors.near_duplicates(rows.union(moved).union(equal))


@query("search_ann")
def search_ann(spark, sf_dir):
    """The ten nearest vectors to every twentieth, by a quantised index; ``search_recall`` measures this very setting."""
    return ann(spark, sf_dir)[2]


@query(
    "cluster_cells",
    """
    WITH x AS (SELECT label, pos, avg(CAST(embedding[pos] AS DOUBLE)) AS m
               FROM embeddings, unnest(range(1, len(embedding) + 1)) AS u(pos) GROUP BY label, pos),
    c AS (SELECT row_number() OVER (ORDER BY label) - 1 AS cell, list(m ORDER BY pos) AS cv FROM x GROUP BY label),
    e AS (SELECT vec_id, list_transform(embedding, lambda y: CAST(y AS DOUBLE)
                 / sqrt(list_sum(list_transform(embedding, lambda z: CAST(z AS DOUBLE) * z)))) AS ev FROM embeddings),
    d AS (SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_distance(ev, cv), 9), cell) AS n FROM e, c)
    SELECT vec_id, CAST(cell AS INTEGER) AS cell FROM d WHERE n = 1
    """,
)
def cluster_cells(spark, sf_dir):
    """The assignment to centres that are given: the means of the labels, in their order."""
    means = label_means(spark, sf_dir).orderBy("query_id").collect()
    return vector_index.nearest_cell(corpus(spark, sf_dir), np.array([r["embedding"] for r in means])).select("vec_id", "cell")


@query("clusters")
def clusters(spark, sf_dir):
    """Documents grouped by their vectors, in as many groups as a measure on a bounded sample finds best: size, mean quality
    label and frequent words per group. A document without a word is in none."""
    docs = costly(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("text", "full_text")
    # Texts are read again where their words are counted; only ids, vectors and cells are written.
    vecs = materialize(vectors.embed(docs).select(F.col("doc_id").alias("vec_id"), "embedding"), "vectors")
    centres, _ = vector_index.fit_clusters(vecs)
    assigned = vector_index.nearest_cell(vecs, centres).select(F.col("vec_id").alias("doc_id"), "cell").filter("cell is not null")
    graded = docs.join(materialize(assigned, "assigned"), "doc_id")
    graded = graded.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return vectors.describe_clusters(graded, "full_text", F.col("quality"))
