"""Whole stages and jobs over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.operators import clean, ingest
from postloom.plans.enrich_job import EnrichConfig, enrich
from postloom.schemas import MERGED_COLUMNS
from postloom.session import scratch_path
from postloom.sources.lookup import lookup_table
from postloom.sources.star_store import StarStore
from workloads.base import URL, costly, query, table
from workloads.labels import rule_labeller
from workloads.text import CLEAN_SQL, POST


def merged_documents(spark, sf_dir):
    """Documents as merged rows: some without an id, some with the text in the fallback column."""
    docs = costly(spark, sf_dir, "documents", "doc_id", "text", "n_chars").selectExpr(
        "doc_id AS row_ord", f"{POST} AS post", "doc_id",
        "CASE WHEN doc_id % 50 = 7 THEN ' ' ELSE CAST(doc_id AS STRING) END AS tweet_id", "CAST(n_chars AS STRING) AS likes",
    )
    docs = docs.selectExpr(
        "row_ord", "tweet_id", "likes", "CASE WHEN doc_id % 3 = 0 THEN '' ELSE post END AS text",
        "CASE WHEN doc_id % 3 = 0 THEN post END AS embedded_text",
    )
    return ingest.project_merged(docs, "row_ord", columns=MERGED_COLUMNS)


_STAGE = f"""
    WITH p AS (SELECT doc_id, n_chars, {POST} AS post FROM documents),
    c AS (SELECT doc_id, n_chars, doc_id % 50 <> 7 AND {CLEAN_SQL} <> '' AS accepted, length({CLEAN_SQL}) AS n_clean,
                 length({CLEAN_SQL}) < 10 OR 2 * coalesce(list_sum(list_transform(regexp_extract_all(post, '{URL}'),
                     lambda u: length(u))), 0) > length(post) AS is_spam FROM p)
"""


@query(
    "clean_stage",
    _STAGE + """
    SELECT CAST(doc_id AS VARCHAR) AS tweet_id, CAST(n_clean AS INTEGER) AS n_clean, n_chars AS like_count, is_spam
    FROM c WHERE accepted
    """,
)
def clean_stage(spark, sf_dir):
    posts = clean.accepted_posts(clean.clean_posts(merged_documents(spark, sf_dir)))
    return posts.select("tweet_id", F.length("full_text").alias("n_clean"), "like_count", "is_spam")


@query(
    "clean_counters",
    _STAGE + """
    SELECT count(*) FILTER (WHERE accepted) AS extracted, count(*) FILTER (WHERE NOT accepted) AS skipped,
           count(*) FILTER (WHERE accepted AND is_spam) AS spam FROM c
    """,
)
def clean_counters(spark, sf_dir):
    rows = clean.clean_posts(merged_documents(spark, sf_dir))
    return rows.agg(
        F.count_if("accepted").alias("extracted"),
        F.count_if(~F.col("accepted")).alias("skipped"),
        F.count_if(F.col("accepted") & F.col("is_spam")).alias("spam"),
    )


@query(
    "screen_names",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS tweet_id, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN c_mktsegment ELSE '' END AS screen_name
    FROM customer
    """,
)
def screen_names(spark, sf_dir):
    """Handles of cleaned posts: the screen name unless it is exactly empty, else the user name, both stripped; a blank
    screen name is none, but does not give way."""
    rows = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS tweet_id", "'a post of ' || c_name AS text", "c_name || ' ' AS user_username",
        "CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN chr(9) || c_mktsegment ELSE ' ' END AS user_screen_name",
    )
    return clean.accepted_posts(clean.clean_posts(ingest.project_merged(rows, columns=MERGED_COLUMNS))).select("tweet_id", "screen_name")


@query(
    "enrich_job",
    _STAGE + """
    SELECT CAST(doc_id AS VARCHAR) AS tweet_id, 'venting' AS intent_label, 'rules' AS coded_by,
           CASE n_clean % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'neutral' END AS sentiment
    FROM c WHERE accepted AND NOT is_spam AND n_clean >= 20
    """,
)
def enrich_job(spark, sf_dir):
    """Clean, label, embed, resolve and load every document; the parent table as stored."""
    root = scratch_path(spark, "job")
    merged_documents(spark, sf_dir).write.parquet(f"{root}/merged")
    cfg = EnrichConfig(
        input=f"{root}/merged", store=f"{root}/star", cache=f"{root}/cache", dead_letters=f"{root}/dead",
        labeller=rule_labeller, model_name="rules", chunks=2, call_pause=0, retry_wait=0,
    )
    enrich(spark, cfg, lookup_table(spark, {"dove": "Dove"}))
    return StarStore(spark, f"{root}/star").read("tweets").select("tweet_id", "intent_label", "coded_by", "sentiment")


@query(
    "flatten_author",
    """
    SELECT c_custkey, c_name AS text, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS user_username,
           '' AS user_displayname, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE c_nationkey END AS user_followers,
           false AS user_verified
    FROM customer
    """,
)
def flatten_author(spark, sf_dir):
    """Customers as crawler records with a nested author, missing for one in four."""
    author = F.struct(F.col("c_mktsegment").alias("username"), F.col("c_nationkey").alias("followers_count"))
    records = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("text"), F.when(F.col("c_custkey") % 4 != 0, author).alias("user")
    )
    return ingest.flatten_author(records)
