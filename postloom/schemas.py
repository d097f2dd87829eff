"""Schemas of the tables that pass between the stages."""

from __future__ import annotations

from pyspark.sql import types as T

# The merged file has exactly these columns in this order.
MERGED_COLUMNS = (
    "comments", "embedded_text", "emojis", "likes", "media", "raw", "retweets", "text", "timestamp", "tweet_id",
    "tweet_url", "user_username", "user_displayname", "user_followers", "user_verified", "user_screen_name",
    "user_name", "image_links",
)

MERGED = T.StructType([T.StructField(c, T.StringType()) for c in MERGED_COLUMNS])

CLEANED_COLUMNS = (
    "tweet_id", "full_text", "screen_name", "followers_count", "created_at", "lang", "source", "retweet_count",
    "like_count", "reply_count", "view_count", "user_location", "is_spam",
)

CACHE = "tweet_id string, response string, model string, cached_at timestamp"
DEAD_LETTER = "tweet_id string, tweet_text string, error string, raw_response string, failed_at timestamp"
LOOKUP = "alias string, canonical string"

CAUSES = "array<struct<cause_category:string,matched_sentence:string>>"
BARRIERS = "array<struct<barrier_code:string>>"
ASPECTS = "array<struct<aspect:string,sentiment:string,span_text:string>>"
BRANDS = "array<struct<brand_raw:string,product_type:string>>"

# The star schema's tables, columns and order; keys are documented in operators/star.py.
STAR = {
    "tweets": (
        "tweet_id string, screen_name string, followers_count bigint, full_text string, created_at string, "
        "lang string, source string, intent_label string, sentiment string, embedding array<float>, "
        "retweet_count bigint, like_count bigint, reply_count bigint, view_count bigint, user_location string, "
        "coded_by string, is_spam boolean"
    ),
    "tweet_causes": "tweet_id string, cause_category string, matched_sentence string",
    "tweet_products": "tweet_id string, product_type string",
    "tweet_brands": "tweet_id string, brand_raw string, brand_canonical string",
    "tweet_barriers": "tweet_id string, barrier_code string, coded_by string",
    "tweet_aspects": "tweet_id string, aspect string, sentiment string, span_text string",
}
