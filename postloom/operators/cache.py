"""Joins between posts and the response cache."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_answers(cache: DataFrame) -> DataFrame:
    """One stored answer per id, the newest, of equally new ones the greatest; a null response is no answer."""
    rows = cache.filter(F.col("response").isNotNull())
    age = F.struct(F.coalesce("cached_at", F.lit(0).cast("timestamp")), "response", "model")
    newest = rows.groupBy("tweet_id").agg(F.max_by(F.struct("response", "model", "cached_at"), age).alias("_a"))
    return newest.select("tweet_id", "_a.*")


def usable_answers(cache: DataFrame, posts: DataFrame) -> DataFrame:
    """The answers that the ids of ``posts`` have. Others leave before anything is grouped: a cache holds all answers
    ever given, a batch asks for a few."""
    asked = cache.join(posts.select("tweet_id").distinct(), "tweet_id", "left_semi")
    return newest_answers(asked).drop("cached_at")


def cache_lookup(posts: DataFrame, cache: DataFrame) -> DataFrame:
    """All posts with ``response`` and ``model``, null where the cache has no answer."""
    return posts.join(usable_answers(cache, posts), "tweet_id", "left")


def cache_hits(posts: DataFrame, cache: DataFrame) -> DataFrame:
    """Posts with a stored answer; the others are dropped (cache-only mode)."""
    return posts.join(usable_answers(cache, posts), "tweet_id")


def cache_misses(posts: DataFrame, cache: DataFrame) -> DataFrame:
    """Posts still to be labelled."""
    return posts.join(cache.filter(F.col("response").isNotNull()), "tweet_id", "left_anti")
