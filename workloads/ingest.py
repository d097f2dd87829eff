"""Batches, payloads, deduplication, upserts, streams and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.functions.evaluation import once
from postloom.functions.payload import post_fields, with_payload
from postloom.functions.numbers import safe_int
from postloom.operators import ingest, star
from postloom.session import materialize, scratch_path
from postloom.sources.csv_tables import READ, read_landing, write_csv
from postloom.sources.files import list_files, move
from postloom.sources.star_store import StarStore
from postloom.streaming import landing
from workloads.base import K, costly, query, table

# One payload in three is plain JSON, one is wrapped, one is a Python literal without an author record.
PAYLOAD = (
    "CASE event_id % 3 "
    "WHEN 0 THEN '{\"views\": {\"count\": \"' || user_id || '\"}, \"source\": \"<a href=x>' || event_type || '</a>\", "
    "\"legacy\": {\"lang\": \"en\"}, \"core\": {\"user_results\": {\"result\": {\"legacy\": {\"location\": \"L' || user_id "
    "|| '\", \"followers_count\": ' || k || '}}}}}' "
    "WHEN 1 THEN '{\"__typename\": \"TweetWithVisibilityResults\", \"tweet\": {\"views\": {\"count\": ' || k || '}, "
    "\"source\": \"' || event_type || '\", \"legacy\": {}, \"core\": {\"user_results\": {\"result\": {\"legacy\": "
    "{\"location\": \"\"}}}}}}' "
    "ELSE '{''views'': {''count'': None}, ''ok'': True, ''source'': ''<b>' || event_type || '</b>'', "
    "''legacy'': {''lang'': ''id''}}' END"
)


@query(
    "payload_fields",
    f"""
    SELECT event_id,
           CASE event_id % 3 WHEN 0 THEN user_id WHEN 1 THEN {K} ELSE 0 END AS view_count,
           event_type AS source,
           CASE event_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN '' ELSE 'id' END AS lang,
           CASE event_id % 3 WHEN 0 THEN 'L' || user_id ELSE '' END AS user_location,
           CASE event_id % 3 WHEN 0 THEN {K} WHEN 1 THEN 0 ELSE CAST(trunc(value) AS BIGINT) END AS followers_count
    FROM events
    """,
)
def payload_fields(spark, sf_dir):
    events = costly(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value", "props")
    events = events.selectExpr("*", f"{K} AS k").selectExpr("*", f"{PAYLOAD} AS raw")
    rows = once(with_payload(events.select("event_id", "value", "raw"), "raw", "_v"), _p=post_fields(F.col("_v")))
    return rows.select(
        "event_id", "_p.view_count", "_p.source", "_p.lang", "_p.user_location",
        F.coalesce("_p.followers_count", safe_int(F.col("value").cast("string"))).alias("followers_count"),
    )


NAMES = {
    "user_screen_name": "CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'sn' || c_custkey END",
    "user_username": "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'un' || c_custkey END",
    "user_name": "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END",
    "user_displayname": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END",
    "raw": (
        "CASE WHEN c_custkey % 4 = 0 THEN '{\"core\": {\"user_results\": {\"result\": {\"core\": {\"screen_name\": \"x' || "
        "c_custkey || '\"}, \"legacy\": {\"name\": \"X' || c_custkey || '\"}}}}}' ELSE '' END"
    ),
    "media": "CASE WHEN c_custkey % 6 = 0 THEN '{\"image_links\": [\"a\", \"b' || c_custkey || '\"]}' ELSE '' END",
    "image_links": "CASE WHEN c_custkey % 9 = 0 THEN 'kept' ELSE '[]' END",
}
_X = {
    "sn": "CASE WHEN c_custkey % 4 = 0 THEN 'x' || c_custkey END",
    "n": "CASE WHEN c_custkey % 4 = 0 THEN 'X' || c_custkey END",
}


@query(
    "author_backfill",
    f"""
    WITH r AS (SELECT c_custkey, {", ".join(f"{e} AS {c}" for c, e in NAMES.items())}, {_X['sn']} AS xs, {_X['n']} AS xn
               FROM customer),
    s AS (SELECT *, coalesce(nullif(user_screen_name, ''), xs, nullif(user_username, ''), '') AS sn,
                 coalesce(nullif(user_name, ''), xn, nullif(user_displayname, ''), '') AS nm FROM r)
    SELECT c_custkey, sn AS user_screen_name, coalesce(nullif(user_username, ''), nullif(sn, ''), xs, '') AS user_username,
           nm AS user_name, coalesce(nullif(user_displayname, ''), nullif(nm, ''), xn, '') AS user_displayname,
           CASE WHEN image_links = 'kept' THEN 'kept' WHEN c_custkey % 6 = 0 THEN '["a", "b' || c_custkey || '"]'
                ELSE '[]' END AS image_links
    FROM s
    """,
)
def author_backfill(spark, sf_dir):
    rows = costly(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment").selectExpr(
        "c_custkey", *[f"{e} AS {c}" for c, e in NAMES.items()]
    )
    return ingest.backfill_authors(rows).select(
        "c_custkey", "user_screen_name", "user_username", "user_name", "user_displayname", "image_links"
    )


@query(
    "dedup_best",
    """
    SELECT user_id, event_id, event_type, value, first_ord FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn,
             min(event_id) OVER (PARTITION BY user_id) AS first_ord FROM events)
    WHERE rn = 1
    """,
)
def dedup_best(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return ingest.dedup_best(events, "user_id", F.col("value"), "event_id")


@query(
    "union_batches",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS tweet_id, o_orderpriority AS text,
           CASE WHEN o_orderstatus = 'F' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS likes, '' AS media
    FROM orders
    """,
)
def union_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tweet_id"), F.col("o_orderpriority").alias("text"),
        F.col("o_custkey").alias("likes"), "o_orderstatus",
    )
    narrow = orders.filter("o_orderstatus = 'F'").select("text", "tweet_id")
    wide = orders.filter("o_orderstatus <> 'F'").select("tweet_id", "likes", "text")
    both = ingest.union_batches(narrow, wide)
    return ingest.project_merged(both, columns=("tweet_id", "text", "likes", "media"))


@query(
    "missing_id",
    """
    SELECT event_id, CASE WHEN event_id % 5 < 2 THEN 'unknown_' || event_id ELSE 'u' || user_id END AS tweet_id
    FROM events
    """,
)
def missing_id(spark, sf_dir):
    ids = "CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'u' || user_id END AS tweet_id"
    events = table(spark, sf_dir, "events").selectExpr("event_id", ids)
    return ingest.fill_missing_ids(events, "tweet_id", "event_id")


@query(
    "landing_merge",
    """
    WITH r AS (SELECT 'u' || user_id AS tweet_id, 'say "' || event_type || '", ' || event_id AS text, event_id,
                      CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END AS src, CAST(trunc(value) AS BIGINT) AS likes
               FROM events),
    w AS (SELECT *, row_number() OVER (PARTITION BY tweet_id ORDER BY likes DESC, src, event_id) AS rn FROM r)
    SELECT tweet_id, text, CAST(likes AS VARCHAR) AS likes FROM w WHERE rn = 1
    """,
)
def landing_merge(spark, sf_dir):
    """Events written as a base folder and a landing folder of CSV with different headers, then merged."""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type", "'u' || user_id AS tweet_id",
        "'say \"' || event_type || '\", ' || event_id AS text", "CAST(CAST(value AS BIGINT) AS STRING) AS likes",
    )
    base, folder = scratch_path(spark, "base"), scratch_path(spark, "landing")
    first = events.filter("event_type = 'purchase'").orderBy("event_id")
    write_csv(first.select("tweet_id", "text", "likes"), base)
    write_csv(events.filter("event_type <> 'purchase'").orderBy("event_id").select("likes", "tweet_id", "text"), folder)
    return ingest.merge_batches(read_landing(spark, folder, base)).select("tweet_id", "text", "likes")


@query(
    "upsert_star",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, 'new', o_totalprice * 2 FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def upsert_star(spark, sf_dir):
    """Old snapshot: orders that are not pending. Batch: orders that are not finished, at twice the price."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    old = orders.filter("o_orderstatus <> 'P'")
    new = orders.filter("o_orderstatus <> 'F'").select(
        "o_orderkey", F.lit("new").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice")
    )
    return star.upsert(old, new, new, "o_orderkey")


@query(
    "last_per_id",
    "SELECT o_custkey, max(o_orderkey) AS last_order, arg_max(o_orderpriority, o_orderkey) AS priority "
    "FROM orders GROUP BY o_custkey",
)
def last_per_id(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    last = star.last_per_id(orders.withColumn("last_order", F.col("o_orderkey")), "o_orderkey", "o_custkey")
    return last.select("o_custkey", "last_order", F.col("o_orderpriority").alias("priority"))


@query(
    "export_roundtrip",
    """
    SELECT doc_id, ' "' || text || '", \\' || chr(10) || ' ' AS text, CASE WHEN lang = 'en' THEN NULL ELSE lang END AS lang
    FROM documents
    """,
)
def export_roundtrip(spark, sf_dir):
    """Texts with quotes, commas, backslashes, newlines and blank ends, to CSV and back."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit(' "'), "text", F.lit('", \\'), F.lit("\n ")).alias("text"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("lang"),
    )
    path = scratch_path(spark, "export")
    write_csv(docs, path)
    return spark.read.schema("doc_id bigint, text string, lang string").options(**READ).csv(path)


@query(
    "store_reload",
    """
    SELECT CAST(event_id AS VARCHAR) AS tweet_id, CASE WHEN event_type = 'click' THEN 'second' ELSE 'first' END AS coded_by,
           CASE WHEN event_type = 'click' THEN 1 ELSE 2 END AS n_products
    FROM events
    """,
)
def store_reload(spark, sf_dir):
    """Two loads into the star store: the second replaces the clicks, and one of their two children."""
    events = table(spark, sf_dir, "events")

    def batch(rows, coded_by, products):
        posts = rows.select(
            F.col("event_id").cast("string").alias("tweet_id"),
            F.lit("").alias("screen_name"), F.lit(0).cast("bigint").alias("followers_count"),
            F.col("event_type").alias("full_text"), F.col("ts").cast("string").alias("created_at"),
            F.lit("").alias("lang"), F.lit("").alias("source"), F.lit("other").alias("intent"),
            F.lit("neutral").alias("sentiment"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("retweet_count", "like_count", "reply_count", "view_count")],
            F.lit("").alias("user_location"), F.lit(coded_by).alias("coded_by"), F.lit(False).alias("is_spam"),
            F.lit(None).cast("array<struct<cause_category:string,matched_sentence:string>>").alias("causes"),
            F.array(*[F.lit(p) for p in products]).alias("products"),
            F.lit(None).cast("array<struct<barrier_code:string>>").alias("barriers"),
            F.lit(None).cast("array<struct<aspect:string,sentiment:string,span_text:string>>").alias("aspects"),
            F.lit(None).cast("array<struct<brand_raw:string,product_type:string>>").alias("brands_raw"),
        )
        return star.star_tables(posts)

    store = StarStore(spark, scratch_path(spark, "star"))
    store.load(batch(events, "first", ["hair_oil", "shampoo", "hair_oil"]))
    store.load(batch(events.filter("event_type = 'click'"), "second", ["shampoo"]))
    products = store.read("tweet_products").groupBy("tweet_id").agg(F.count("*").cast("int").alias("n_products"))
    return store.read("tweets").select("tweet_id", "coded_by").join(products, "tweet_id")


@query(
    "ingest_stream",
    """
    WITH r AS (SELECT CASE WHEN event_id % 11 = 0 THEN '' ELSE 'u' || user_id END AS tweet_id, event_type AS text,
                      CAST(trunc(value) AS BIGINT) % 20 AS likes,
                      CASE WHEN event_type < 'e' THEN 'a.csv' WHEN event_type < 'p' THEN 'b.csv'
                           WHEN event_type < 's' THEN 'c.csv' ELSE 'd.csv' END AS file, event_id FROM events),
    p AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY event_id) - 1 AS place FROM r),
    n AS (SELECT * EXCLUDE (tweet_id), CASE WHEN tweet_id = '' THEN 'unknown_' || file || '_' || place ELSE tweet_id END AS tweet_id FROM p),
    w AS (SELECT *, row_number() OVER (PARTITION BY tweet_id ORDER BY likes DESC, file, place) AS rn,
                 first_value(file) OVER f AS source_file, first_value(place) OVER f AS file_row
          FROM n WINDOW f AS (PARTITION BY tweet_id ORDER BY file, place))
    SELECT tweet_id, text, CAST(likes AS VARCHAR) AS likes, source_file, CAST(file_row AS BIGINT) AS file_row FROM w WHERE rn = 1
    """,
)
def ingest_stream(spark, sf_dir):
    """Events as four CSV files that a stream picks up two at a time, with ties and missing ids. The rows must be those
    that the merge job makes of the folder."""
    events = table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_type < 'e' THEN 'a' WHEN event_type < 'p' THEN 'b' WHEN event_type < 's' THEN 'c' ELSE 'd' END AS file",
        "event_id", "CASE WHEN event_id % 11 = 0 THEN '' ELSE 'u' || user_id END AS tweet_id", "event_type AS text",
        "CAST(CAST(value AS BIGINT) % 20 AS STRING) AS likes",
    )
    events = materialize(events, "events")
    root, names = scratch_path(spark, "stream"), ["tweet_id", "text", "likes"]
    for file in "abcd":
        part = f"{root}/parts-{file}"
        write_csv(events.filter(F.col("file") == file).orderBy("event_id").coalesce(1).select(*names), part)
        # Spark names its files itself; the landing folder wants one name per batch.
        move(spark, list_files(spark, f"{part}/*.csv")[0], f"{root}/landing/{file}.csv")
    store = landing.ingest_new_files(spark, f"{root}/landing", names, f"{root}/store", f"{root}/checkpoint", max_files=2)
    return store.read("merged").select(*names, "source_file", "file_row")
