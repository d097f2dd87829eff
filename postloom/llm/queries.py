"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm import (
    fingerprints,
    lexical,
    mixing,
    negatives,
    packing,
    pii,
    quality,
    rollups,
    sharding,
    simhash,
    substring,
    topk,
    warc,
)
from postloom.session import materialize, scratch_path, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    """Register ``fn`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and component of every document."""
    found = simhash.near_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


ORACLES["op1_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS win
  FROM w, unnest(generate_series(1, len(words) - 12)) AS t(i)
), low AS (
  SELECT win, min(doc_id) AS low FROM win GROUP BY win HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, i + k AS pos FROM win JOIN low USING (win), unnest(generate_series(0, 12)) AS u(k) WHERE low < doc_id
), lost AS (
  SELECT doc_id, list(pos) AS pos FROM gone GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(pos), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN pos IS NULL THEN words
         ELSE list_filter(words, lambda x, n: NOT list_contains(pos, n)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id)
"""


@query
def op1_substring_dedup(spark, sf_dir):
    """What is left of every document once runs of 13 words that an earlier one holds are removed."""
    cleaned = substring.remove_copied(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op9_quality_classifier(spark, sf_dir):
    """Quality score of every document."""
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op6_source_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1/' || doc_id) AS shuffle
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS number
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][number % 3 + 1] AS weight, 3 * source_size AS most, sum(source_size) OVER () AS total FROM sources
), tried AS (  -- with the sources capped that have the least room for their weight, what the others share
  SELECT *, coalesce(sum(most) OVER w, 0) AS gone, coalesce(sum(weight) OVER w, 0) AS used, sum(weight) OVER () AS weights,
         row_number() OVER (ORDER BY most / weight, number) AS k
  FROM weighed WINDOW w AS (ORDER BY most / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), cut AS (
  SELECT coalesce(min(k), (SELECT count(*) + 1 FROM tried)) AS k
  FROM tried WHERE most * (weights - used) >= weight * (total - gone)
), targets AS (
  SELECT number, source, source_size, CASE WHEN tried.k < cut.k THEN CAST(most AS DOUBLE)
    ELSE CAST(weight * (SELECT total - gone FROM tried t, cut c WHERE t.k = c.k) AS DOUBLE)
       / (SELECT weights - used FROM tried t, cut c WHERE t.k = c.k) END AS target
  FROM tried, cut
), ends AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS words, sum(CAST(floor(target) AS BIGINT)) OVER (ORDER BY number) AS upto,
         sum(CAST(floor(target) AS BIGINT)) OVER () AS total
  FROM targets
), owned AS (
  SELECT number, CAST(floor(CAST(upto - words AS DOUBLE) / total * 2147483648) AS BIGINT) AS low,
         CAST(floor(CAST(upto AS DOUBLE) / total * 2147483648) AS BIGINT) AS high, total
  FROM ends
), points AS (
  SELECT (i + 1) * 1327217885 % 2147483648 AS point
  FROM range(CAST(ceil((SELECT max(total) FROM ends) / 64) AS BIGINT)) AS t(i)
), slots AS (
  SELECT number, count(*) AS slots FROM points JOIN owned ON low <= point AND point < high GROUP BY number
), laid AS (
  SELECT doc_id, size, source_size, target, coalesce(slots, 0) * 64 AS words,
         sum(size) OVER (PARTITION BY targets.number ORDER BY shuffle, doc_id) - size AS place
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source LEFT JOIN slots ON slots.number = targets.number
)
SELECT doc_id, size, source_size, target,
       CAST(least(size, greatest(0, words - place)) + least(size, greatest(0, words - place - source_size))
          + least(size, greatest(0, words - place - 2 * source_size)) AS BIGINT) AS taken
FROM laid
"""


@query
def op6_source_mixing(spark, sf_dir):
    """How many words of every document the mixture takes."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_sharding(spark, sf_dir):
    """Shard and place of every document."""
    return sharding.shard(table(spark, sf_dir, "documents"))


@query
def op2_best_fit_packing(spark, sf_dir):
    """Piece, sequence and place of every document's tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


ORACLES["op4_exact_topk"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""


@query
def op4_exact_topk(spark, sf_dir):
    """The ten nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"))


ORACLES["op8_warc"] = r"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query
def op8_warc(spark, sf_dir):
    """Every page, as it is read back from the archives it was written to."""
    records = warc.roundtrip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_document_fingerprints(spark, sf_dir):
    """Fingerprint of every document and of its edited text."""
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


@query
def op10_token_rollups(spark, sf_dir):
    """Totals after three batches over the documents, one of them sent twice: all are inserted; German ones are revised
    to lower case; later copies of a text are deleted."""
    docs = table(spark, sf_dir, "documents")
    rollup = rollups.TokenRollup(spark, scratch_path(spark, "rollup"))
    change = lambda rows, op: rows.select(F.lit(op).alias("op"), F.lit(0).alias("seq"), "doc_id", "source", "lang", "text")
    rollup.apply("insert", change(docs, "insert"))
    revised = change(docs.filter("lang = 'de'").withColumn("text", F.lower("text")), "revise")
    rollup.apply("revise", revised)
    rollup.apply("revise", revised)
    digest = docs.select("doc_id", "source", "lang", F.sha2("text", 256).alias("digest"))
    first = materialize(digest.groupBy("digest").agg(F.min("doc_id").alias("first")), "first")
    copies = digest.join(first, "digest").filter("doc_id > first").withColumn("text", F.lit(None).cast("string"))
    rollup.apply("delete", change(copies, "delete"))
    return rollup.totals()


ORACLES["op11_ranked_lexical_search"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
  ) AS terms
  FROM documents
), size AS (
  SELECT doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0
), total AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM size
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
  )) AS term
  FROM benchmark
), counts AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, total GROUP BY term
), gain AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words))) AS gain
  FROM counts JOIN weight USING (term) JOIN size USING (doc_id), total
), score AS (
  SELECT item_id, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM asked JOIN gain USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY rank <= 10
"""


@query
def op11_ranked_lexical_search(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query
def op13_hard_negatives(spark, sf_dir):
    """Negatives between half and 95 hundredths of each positive's score, for every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    )
    return negatives.mine(vectors, vectors.filter("vec_id % 50 = 0"))


@query
def op12_pii(spark, sf_dir):
    """Personal data of every document."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [kind.name for kind in pii.BASE]
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    of = lambda *names: F.filter("spans", lambda s: s["kind"].isin(*names))
    return found.select(
        "doc_id",
        *[F.size(of(name)).cast("long").alias(f"n_{name}") for name in base],
        F.sha2(written(of(*base)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
