"""Label normalisation, the gate, the cache, the labeller, and the child tables."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from postloom.functions import text as tx
from postloom.functions.evaluation import once
from postloom.operators import annotate as ann
from postloom.operators import cache, clean, labels, star
from postloom.plans import reports
from postloom.schemas import CACHE
from postloom.session import materialize
from postloom.vocabulary import VocabularyTable, default_vocabulary
from workloads.base import K, URL, costly, query, table
from workloads.text import CLEAN_SQL, POST

VOCAB = default_vocabulary()


def pick(on: str, *options: str) -> str:
    """CASE over ``on`` modulo the number of options, each an SQL expression."""
    arms = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options))
    return f"(CASE {on} % {len(options)} {arms} END)"


# What a label model may write, and what each must become.
RAW = {
    "intent": pick("k", "' Venting '", "'COMPLAINING'", "'recommendation'", "'asking question'", "tag", "'discovery'",
                   "'sharing_success'"),
    "sentiment": pick("k", "'Negative'", "' positive'", "'meh'", "'neutral'"),
    "cause1": pick("k", "'Stress'", "'water quality'", "'weather'", "'age'", "tag"),
    "cause2": pick("k", "'stress'", "'seasonal'", "'AGE '"),
    "product1": pick("k", "'Hair Lotion'", "'dry shampoo'", "'hair_mask'", "'shampoo'"),
    "product2": pick("k", "'shampoo'", "'hair color'"),
    "barrier": pick("k", "'Price'", "'side effects'", "'sensory'"),
    "aspect": pick("k", "'hair quality'", "'ingredients'"),
    "brand": pick("k", "tag", "upper(tag)"),
    "type": pick("k", "'null'", "'\"Hair Mask\"'", "'\"x\"'"),
}
NORMAL = {
    "intent": pick("k", "'venting'", "'complaining'", "'seeking_recommendation'", "'other'", "'other'", "'discovery'",
                   "'sharing_success'"),
    "sentiment": pick("k", "'negative'", "'positive'", "'neutral'", "'neutral'"),
    "cause1": pick("k", "'stress'", "'water_quality'", "'seasonal'", "'age'", "'other'"),
    "cause2": pick("k", "'stress'", "'seasonal'", "'age'"),
    "product1": pick("k", "'hair_tonic'", "'shampoo'", "'treatment_mask'", "'shampoo'"),
    "product2": pick("k", "'shampoo'", "'other'"),
    "barrier": pick("k", "'price'", "'side_effects'", "'other'"),
    "aspect": pick("k", "'hair_quality'", "'other'"),
    "brand": RAW["brand"],
    "type": pick("k", "'-'", "'treatment_mask'", "'other'"),
}
RESPONSE = (
    f"'{{\"intent\": \"' || {RAW['intent']} || '\", \"sentiment\": \"' || {RAW['sentiment']} || '\", \"causes\": "
    f"[{{\"cause_category\": \"' || {RAW['cause1']} || '\", \"matched_sentence\": \"m' || k || '\"}}, {{\"cause_category\": "
    f"\"' || {RAW['cause2']} || '\"}}, 5], \"products\": [\"' || {RAW['product1']} || '\", \"' || {RAW['product2']} || "
    f"'\", null], \"barriers\": [{{\"barrier_code\": \"' || {RAW['barrier']} || '\"}}, \"x\"], \"aspects\": [{{\"aspect\": "
    f"\"' || {RAW['aspect']} || '\", \"sentiment\": \"positive\", \"span_text\": \"s' || k || '\"}}], \"brands_raw\": "
    f"[{{\"brand_raw\": \"' || {RAW['brand']} || '\", \"product_type\": ' || {RAW['type']} || '}}]}}'"
)
EVENTS_SQL = f"(SELECT event_id, event_type AS tag, {K} AS k FROM events)"


def responses(spark, sf_dir):
    events = costly(spark, sf_dir, "events", "event_id", "event_type", "props").selectExpr("event_id", "event_type AS tag", f"{K} AS k")
    return events.selectExpr("event_id", "CAST(event_id AS STRING) AS tweet_id", "tag", f"{RESPONSE} AS response")


def labelled(spark, sf_dir):
    return labels.normalize_labels(responses(spark, sf_dir), VOCAB).withColumn("coded_by", F.lit("m"))


@query(
    "normalize_labels",
    f"""
    SELECT event_id, {NORMAL['intent']} AS intent, {NORMAL['sentiment']} AS sentiment,
           {NORMAL['cause1']} || ':m' || k || ',' || {NORMAL['cause2']} || ':' AS causes,
           {NORMAL['product1']} || ',' || {NORMAL['product2']} || ',other' AS products,
           {NORMAL['barrier']} AS barriers, {NORMAL['aspect']} || ':positive:s' || k AS aspects,
           {NORMAL['brand']} || ':' || {NORMAL['type']} AS brands
    FROM {EVENTS_SQL}
    """,
)
def normalize_labels(spark, sf_dir):
    def joined(items, *fields):
        return F.array_join(
            F.transform(items, lambda x: F.concat_ws(":", *[F.coalesce(x[f], F.lit("-")) for f in fields])), ","
        )

    return labelled(spark, sf_dir).select(
        "event_id", "intent", "sentiment",
        joined("causes", "cause_category", "matched_sentence").alias("causes"),
        F.array_join("products", ",").alias("products"),
        joined("barriers", "barrier_code").alias("barriers"),
        joined("aspects", "aspect", "sentiment", "span_text").alias("aspects"),
        joined("brands_raw", "brand_raw", "product_type").alias("brands"),
    )


@query(
    "normalize_table",
    """
    SELECT l_orderkey, l_linenumber, 'sold' AS intent, CASE WHEN l_linenumber = 2 THEN 'other' ELSE coalesce(p_brand, 'other') END AS product,
           CASE WHEN l_linenumber = 3 THEN 'aspects.sentiment:not_allowed' ELSE '' END AS errors
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    """,
)
def normalize_table(spark, sf_dir):
    """Labels against a vocabulary that is a table: every part is a spelling of its brand, in each response one part, written
    in another case, or an unknown one."""
    parts = table(spark, sf_dir, "part").selectExpr(
        "'product' AS field", "'no_' || p_partkey AS raw_value", "p_brand AS canonical_value")
    fixed = spark.range(1).selectExpr(
        "stack(2, 'intent', 'sale', 'sold', 'sentiment', 'good', 'positive') AS (field, raw_value, canonical_value)")
    said = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        """concat('{"intent": "Sale ", "products": ["', CASE WHEN l_linenumber = 2 THEN 'none' ELSE 'NO ' || l_partkey END,
           '"], "aspects": [{"aspect": "x", "sentiment": "', CASE WHEN l_linenumber = 3 THEN 'good' ELSE 'positive' END,
           '", "span_text": "s"}]}') AS response""",
    )
    done = labels.normalize_labels(said, VocabularyTable(parts.unionByName(fixed)))
    return done.select("l_orderkey", "l_linenumber", "intent", F.element_at("products", 1).alias("product"), F.array_join("errors", ",").alias("errors"))


DEFECTS = (
    ("'{}'", ""),
    ("'[1]'", "response:not_an_object"),
    ("'{\"causes\": null, \"products\": null}'", "causes:not_a_list"),
    ("'{\"barriers\": \"' || event_type || '\"}'", "barriers:not_a_list"),
    ("'{\"causes\": [{\"matched_sentence\": null}]}'", "causes.matched_sentence:not_a_string"),
    ("'{\"aspects\": [{\"sentiment\": \"Positive\", \"span_text\": \" \"}]}'", "aspects.sentiment:not_allowed"),
    ("'{\"aspects\": [{\"sentiment\": \"neutral\", \"span_text\": \"\"}, 3]}'", "aspects.span_text:missing"),
    ("'{\"brands_raw\": [{\"product_type\": \"hair_oil\"}]}'", "brands_raw.brand_raw:missing"),
    ("event_type", "response:not_an_object"),
    ("'{\"intent\": 5, \"aspects\": [{\"sentiment\": \"neutral\", \"span_text\": \" \"}], \"x\": {}}'", ""),
    (
        "'{\"aspects\": [{}], \"brands_raw\": [{\"brand_raw\": 5}]}'",
        "aspects.sentiment:not_allowed; aspects.span_text:missing; brands_raw.brand_raw:missing",
    ),
)
_ERRORS = pick("event_id", *[f"'{e}'" for _, e in DEFECTS])


def judged(spark, sf_dir):
    events = costly(spark, sf_dir, "events", "event_id", "event_type", "props").selectExpr(
        "event_id", "CAST(event_id AS STRING) AS tweet_id", "props || repeat(event_type, 40) AS full_text",
        f"{pick('event_id', *[r for r, _ in DEFECTS])} AS response",
    )
    return labels.normalize_labels(events, VOCAB)


@query("validate_split", f"SELECT event_id, {_ERRORS} AS errors, {_ERRORS} = '' AS is_valid FROM events")
def validate_split(spark, sf_dir):
    return judged(spark, sf_dir).select(
        "event_id", F.array_join("errors", "; ").alias("errors"), (F.size("errors") == 0).alias("is_valid")
    )


@query(
    "dead_letters",
    f"""
    SELECT CAST(event_id AS VARCHAR) AS tweet_id, substr(props || repeat(event_type, 40), 1, 200) AS tweet_text,
           {_ERRORS} AS error
    FROM events WHERE {_ERRORS} <> ''
    """,
)
def dead_letters(spark, sf_dir):
    return labels.dead_letters(judged(spark, sf_dir)).select("tweet_id", "tweet_text", "error")


@query(
    "failure_rate",
    f"SELECT count(*) AS n, count(*) FILTER (WHERE {_ERRORS} <> '') AS failed, "
    f"round(avg(CASE WHEN {_ERRORS} <> '' THEN 1 ELSE 0 END), 6) AS failure_rate FROM events",
)
def failure_rate(spark, sf_dir):
    return reports.failure_rate(judged(spark, sf_dir)).withColumn("failure_rate", F.round("failure_rate", 6))


def posts_and_cache(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("tweet_id"), "lang")
    stored = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("tweet_id"),
        F.when(F.col("toxic") == 0, F.concat(F.lit("q"), "quality")).alias("response"),
        F.lit("m").alias("model"),
        F.lit("2024-01-01").cast("timestamp").alias("cached_at"),
    )
    assert stored.columns == [f.strip().split(" ")[0] for f in CACHE.split(",")]
    return docs, stored


_HITS = "JOIN labels l ON l.doc_id = d.doc_id AND l.toxic = 0"


@query(
    "cache_hit",
    f"SELECT CAST(d.doc_id AS VARCHAR) AS tweet_id, lang, 'q' || quality AS response FROM documents d LEFT {_HITS}",
)
def cache_hit(spark, sf_dir):
    return cache.cache_lookup(*posts_and_cache(spark, sf_dir)).select("tweet_id", "lang", "response")


@query(
    "cache_miss",
    "SELECT CAST(doc_id AS VARCHAR) AS tweet_id, lang FROM documents "
    "WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)",
)
def cache_miss(spark, sf_dir):
    return cache.cache_misses(*posts_and_cache(spark, sf_dir))


@query(
    "cache_only",
    f"SELECT CAST(d.doc_id AS VARCHAR) AS tweet_id, lang, 'q' || quality AS response FROM documents d {_HITS}",
)
def cache_only(spark, sf_dir):
    return cache.cache_hits(*posts_and_cache(spark, sf_dir)).select("tweet_id", "lang", "response")


def rule_labeller():
    """A stand-in for a model: judges by length and refuses very short texts."""

    def label(texts: list[str]) -> list[str]:
        if any(len(t) < 20 for t in texts):
            raise ValueError("too short to judge")
        names = ["positive", "negative", "unsure"]
        return [json.dumps({"intent": "Venting", "sentiment": names[len(t) % 3]}) for t in texts]

    return label


@query(
    "annotate",
    """
    SELECT doc_id, CASE WHEN length(text) < 20 THEN 'too short to judge' ELSE '' END AS error,
           CASE WHEN length(text) < 20 THEN NULL WHEN length(text) % 3 = 0 THEN 'positive'
                WHEN length(text) % 3 = 1 THEN 'negative' ELSE 'neutral' END AS sentiment
    FROM documents
    """,
)
def annotate(spark, sf_dir):
    docs = costly(spark, sf_dir, "documents", "doc_id", "text")
    answers = ann.annotate(docs, rule_labeller, text_col="text", batch_size=64, call_pause=0, retry_wait=0)
    out = labels.normalize_labels(answers.drop("text"), VOCAB)
    failed = F.col("call_error").isNotNull()
    return out.select(
        "doc_id", F.coalesce("call_error", F.lit("")).alias("error"), F.when(~failed, F.col("sentiment")).alias("sentiment")
    )


@query(
    "explode_causes",
    f"""
    WITH c AS (SELECT event_id, 1 AS pos, {NORMAL['cause1']} AS cause_category, 'm' || k AS matched_sentence FROM {EVENTS_SQL}
               UNION ALL SELECT event_id, 2, {NORMAL['cause2']}, '' FROM {EVENTS_SQL})
    SELECT CAST(event_id AS VARCHAR) AS tweet_id, cause_category, arg_max(matched_sentence, pos) AS matched_sentence
    FROM c GROUP BY event_id, cause_category
    """,
)
def explode_causes(spark, sf_dir):
    return star.explode_causes(labelled(spark, sf_dir))


@query(
    "explode_products",
    f"""
    SELECT CAST(event_id AS VARCHAR) AS tweet_id, {NORMAL['product1']} AS product_type FROM {EVENTS_SQL}
    UNION SELECT CAST(event_id AS VARCHAR), {NORMAL['product2']} FROM {EVENTS_SQL}
    UNION SELECT CAST(event_id AS VARCHAR), 'other' FROM {EVENTS_SQL}
    """,
)
def explode_products(spark, sf_dir):
    return star.explode_products(labelled(spark, sf_dir))


@query(
    "explode_brands",
    f"SELECT CAST(event_id AS VARCHAR) AS tweet_id, {NORMAL['brand']} AS brand_raw, 'C-' || tag AS brand_canonical "
    f"FROM {EVENTS_SQL} WHERE {NORMAL['brand']} = tag "
    f"UNION ALL SELECT CAST(event_id AS VARCHAR), {NORMAL['brand']}, {NORMAL['brand']} FROM {EVENTS_SQL} "
    f"WHERE {NORMAL['brand']} <> tag",
)
def explode_brands(spark, sf_dir):
    posts = labelled(spark, sf_dir)
    canonical = F.create_map(F.col("tag"), F.concat(F.lit("C-"), "tag"))
    return star.explode_brands(posts.withColumn("brands_canonical", canonical))


@query(
    "explode_barriers",
    f"SELECT CAST(event_id AS VARCHAR) AS tweet_id, {NORMAL['barrier']} AS barrier_code, 'm' AS coded_by FROM {EVENTS_SQL}",
)
def explode_barriers(spark, sf_dir):
    return star.explode_barriers(labelled(spark, sf_dir))


@query(
    "explode_aspects",
    f"SELECT CAST(event_id AS VARCHAR) AS tweet_id, {NORMAL['aspect']} AS aspect, 'positive' AS sentiment, "
    f"'s' || k AS span_text FROM {EVENTS_SQL}",
)
def explode_aspects(spark, sf_dir):
    return star.explode_aspects(labelled(spark, sf_dir))


FLAGSHIP_SQL = f"""
    WITH p AS (SELECT doc_id, {POST} AS post FROM documents),
    t AS (SELECT doc_id, source AS tag, CAST(length({CLEAN_SQL}) AS BIGINT) AS k FROM p JOIN documents USING (doc_id)
          WHERE length({CLEAN_SQL}) >= 10
            AND coalesce(list_sum(list_transform(regexp_extract_all(post, '{URL}'), lambda u: length(u))), 0) * 2
                <= length(post)),
    c AS (SELECT doc_id, {NORMAL['cause1']} AS cause_category FROM t UNION SELECT doc_id, {NORMAL['cause2']} FROM t)
    SELECT cause_category, count(DISTINCT doc_id) AS tweet_count FROM c GROUP BY cause_category
    ORDER BY tweet_count DESC, cause_category
"""


@query("posts_per_cause", FLAGSHIP_SQL)
def posts_per_cause(spark, sf_dir):
    """Documents to cleaned posts, spam dropped, labelled, gated, exploded and counted: most frequent cause first."""
    docs = costly(spark, sf_dir, "documents", "doc_id", "text", "source")
    docs = docs.selectExpr("CAST(doc_id AS STRING) AS tweet_id", "source AS tag", f"{POST} AS post")
    posts = once(docs, full_text=tx.clean_text(F.col("post")))
    posts = once(posts, is_spam=tx.is_spam(F.col("full_text"), F.col("post")), k=F.length("full_text").cast("bigint"))
    posts = clean.without_spam(posts)
    gated = labels.normalize_labels(posts.selectExpr("tweet_id", f"{RESPONSE} AS response"), VOCAB)
    # Parent and child both come from it, so it is written once instead of being computed twice.
    valid = materialize(labels.valid_rows(gated).select("tweet_id", "causes"), "valid")
    return reports.posts_per_cause(valid.select("tweet_id"), star.explode_causes(valid))
