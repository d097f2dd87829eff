"""Text cleaning, spam, lenient numbers, ordering and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.functions import text as tx
from postloom.functions.evaluation import once
from postloom.functions.numbers import safe_int
from postloom.operators import clean, ordering
from workloads.base import URL, WORD, WS, costly, query, table

POST = (
    "CASE doc_id % 4 WHEN 0 THEN 'see https://ex.org/' || doc_id || ' ' || text "
    "WHEN 1 THEN '@user_' || doc_id || chr(9) || text "
    "WHEN 2 THEN text || ' https://t.co/a  http://b.c/d' ELSE text END"
)
CLEAN_SQL = (
    f"trim(regexp_replace(regexp_replace(regexp_replace(post, '{URL}', '', 'g'), '@[{WORD}]+', '', 'g'), "
    f"'[{WS}]+', ' ', 'g'))"
)


@query("clean_text", f"SELECT doc_id, {CLEAN_SQL} AS clean_text FROM (SELECT doc_id, {POST} AS post FROM documents)")
def clean_text(spark, sf_dir):
    posts = costly(spark, sf_dir, "documents", "doc_id", "text").selectExpr("doc_id", f"{POST} AS post")
    return posts.select("doc_id", tx.clean_text(F.col("post")).alias("clean_text"))


LINKED = (
    "CASE doc_id % 4 WHEN 0 THEN 'https://ex.org/' || replace(text, ' ', '_') "
    "WHEN 1 THEN 'http://a.b ' || text WHEN 2 THEN text || ' https://t.co/' || doc_id ELSE text END"
)


@query(
    "spam_flag",
    f"""
    WITH p AS (SELECT doc_id, {LINKED} AS post FROM documents),
    c AS (SELECT doc_id, length({CLEAN_SQL}) AS n_clean, length(post) AS n_raw,
                 coalesce(list_sum(list_transform(regexp_extract_all(post, '{URL}'), lambda u: length(u))), 0) AS n_url
          FROM p)
    SELECT doc_id, CAST(n_url AS BIGINT) AS url_chars, (n_clean < 10 OR n_url / n_raw > 0.5) AS is_spam FROM c
    """,
)
def spam_flag(spark, sf_dir):
    posts = costly(spark, sf_dir, "documents", "doc_id", "text").selectExpr("doc_id", f"{LINKED} AS post")
    post = F.col("post")
    return once(posts, clean=tx.clean_text(post)).select(
        "doc_id",
        tx.url_chars(post).cast("bigint").alias("url_chars"),
        tx.is_spam(F.col("clean"), post).alias("is_spam"),
    )


NUMERIC = (
    "CASE event_id % 9 WHEN 0 THEN CAST(value AS STRING) WHEN 1 THEN ' ' || CAST(value AS STRING) || ' ' "
    "WHEN 2 THEN '-' || CAST(value AS STRING) WHEN 3 THEN event_type WHEN 4 THEN '' WHEN 5 THEN NULL "
    "WHEN 6 THEN CAST(event_id AS STRING) || 'e1' WHEN 7 THEN 'nan' ELSE CAST(event_id AS STRING) || 'd' END"
)


@query(
    "safe_int",
    f"""
    SELECT event_id, CASE WHEN regexp_full_match(s, ' *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)? *')
                          THEN CAST(trunc(CAST(trim(s) AS DOUBLE)) AS BIGINT) ELSE 0 END AS n
    FROM (SELECT event_id, {NUMERIC} AS s FROM events)
    """,
)
def lenient_numbers(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{NUMERIC} AS s").select(
        "event_id", safe_int(F.col("s")).alias("n")
    )


@query(
    "anchor_text",
    r"""
    SELECT page_id, CASE WHEN regexp_matches(html, '>([^\n]+?)<') THEN regexp_extract(html, '>([^\n]+?)<', 1)
                         ELSE html END AS anchor_text
    FROM pages
    """,
)
def anchor_text(spark, sf_dir):
    return costly(spark, sf_dir, "pages", "page_id", "html").select("page_id", tx.anchor_text(F.col("html")).alias("anchor_text"))


TAGGED = "text || ' #' || lang || ' #Source_' || source || '#x'"


@query(
    "hashtags",
    f"""
    SELECT doc_id, array_to_string(regexp_extract_all({TAGGED}, '#([{WORD}]+)', 1), ',') AS tags FROM documents
    """,
)
def hashtags(spark, sf_dir):
    docs = costly(spark, sf_dir, "documents", "doc_id", "text", "lang", "source").selectExpr(
        "doc_id", f"{TAGGED} AS post"
    )
    return docs.select("doc_id", F.array_join(tx.hashtags(F.col("post")), ",").alias("tags"))


@query(
    "slang",
    """
    SELECT doc_id, array_to_string(list_transform(string_split(text, ' '), lambda w:
        CASE lower(w) WHEN 'the' THEN 'this' WHEN 'of' THEN 'from' WHEN 'is' THEN 'was' WHEN 'la' THEN 'une'
                      ELSE w END), ' ') AS plain
    FROM documents
    """,
)
def slang(spark, sf_dir):
    words = {"the": "this", "of": "from", "is": "was", "la": "une"}
    docs = costly(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", tx.replace_slang(F.col("text"), words).alias("plain"))


@query("dup_text_flag", "SELECT doc_id, count(*) OVER (PARTITION BY text) > 1 AS is_repeated FROM documents")
def dup_text_flag(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean.flag_repeated_text(docs, "text", 1).select("doc_id", "is_repeated")


@query(
    "repeat_posters",
    """
    WITH a AS (SELECT DISTINCT source FROM (SELECT source, text FROM documents GROUP BY source, text
                                            HAVING count(*) > 1))
    SELECT doc_id, source, source IN (SELECT source FROM a) AS is_repeat_poster FROM documents
    """,
)
def repeat_posters(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    flagged = clean.flag_repeat_posters(docs, "source", "text", 1, "is_repeat_poster")
    return flagged.select("doc_id", "source", "is_repeat_poster")


@query(
    "offset_limit",
    "SELECT doc_id, n_chars FROM documents WHERE doc_id >= 100 AND length(text) >= 50 ORDER BY doc_id LIMIT 500",
)
def offset_limit(spark, sf_dir):
    """Skip the first 100 rows, then take the first 500 accepted ones; both numbers are the feature."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    rest = ordering.skip_rows(docs, "doc_id", 100).filter(F.length("text") >= 50)
    return ordering.take_rows(rest, "doc_id", 500).select("doc_id", "n_chars")


@query(
    "keyword_filter",
    """
    SELECT doc_id, source FROM documents
    WHERE lang = 'en' AND contains(lower(text), 'the') AND contains(lower(text), 'and')
      AND (contains(lower(text), 'whi') OR contains(lower(text), 'rest')) AND NOT contains(lower(text), 'copyright')
    """,
)
def keyword_filter(spark, sf_dir):
    spec = clean.KeywordSpec("The And", ("whi", "rest"), ("copyright",), lang="en")
    docs = table(spark, sf_dir, "documents")
    return clean.keyword_filter(docs, spec, "text", "lang").select("doc_id", "source")


@query(
    "keyword_dates",
    """
    SELECT event_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'
      AND (contains(event_type, 'click') OR contains(event_type, 'view'))
    """,
)
def keyword_dates(spark, sf_dir):
    spec = clean.KeywordSpec(any_words=("click", "view"), since="2024-01-05", until="2024-01-20")
    out = clean.keyword_filter(table(spark, sf_dir, "events"), spec, "event_type", ts_col="ts")
    return out.select("event_id", "event_type")


