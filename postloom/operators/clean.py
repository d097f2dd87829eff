"""From merged rows to cleaned posts, and filters over posts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import text
from postloom.functions.evaluation import once
from postloom.functions.numbers import safe_int
from postloom.functions.payload import post_fields, with_payload
from postloom.schemas import CLEANED_COLUMNS
from postloom.session import materialize


def text_source(primary: Column, fallback: Column) -> Column:
    """``primary`` unless it is exactly empty; white space alone does not fall back."""
    primary = F.coalesce(primary, F.lit(""))
    return F.when(primary != "", primary).otherwise(F.coalesce(fallback, F.lit("")))


def clean_posts(merged: DataFrame, *keep: str) -> DataFrame:
    """Every merged row with its cleaned fields and ``accepted``: false where id or text is missing or malformed.

    Keeps the rejected rows so that a caller can count them; ``accepted_posts`` drops them.
    """
    raw_text = text_source(F.col("text"), F.col("embedded_text"))
    df = merged.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in
          ("raw", "user_screen_name", "user_username", "user_followers", "retweets", "likes", "comments")],
        text.strip(F.coalesce(F.col("tweet_id"), F.lit(""))).alias("tweet_id"),
        text.strip(F.coalesce(F.col("timestamp"), F.lit(""))).alias("created_at"),
        raw_text.alias("_text"),
        *keep,
    )
    df = once(df, full_text=text.clean_text(F.col("_text")))
    df = once(df, is_spam=text.is_spam(F.col("full_text"), F.col("_text"))).drop("_text")
    usable = (F.col("tweet_id") != "") & (F.col("full_text") != "")
    # A rejected row's payload is not worth parsing.
    df = with_payload(df.withColumn("raw", F.when(usable, F.col("raw"))), "raw", "_payload")
    df = once(df, _post=post_fields(F.col("_payload"))).drop("raw", "_payload")
    return df.select(
        "tweet_id",
        "full_text",
        text.strip(text.first_nonempty(F.col("user_screen_name"), F.col("user_username"))).alias("screen_name"),
        F.coalesce(F.col("_post.followers_count"), safe_int(F.col("user_followers"))).alias("followers_count"),
        "created_at",
        F.col("_post.lang").alias("lang"),
        F.col("_post.source").alias("source"),
        safe_int(F.col("retweets")).alias("retweet_count"),
        safe_int(F.col("likes")).alias("like_count"),
        safe_int(F.col("comments")).alias("reply_count"),
        F.col("_post.view_count").alias("view_count"),
        F.col("_post.user_location").alias("user_location"),
        "is_spam",
        (usable & F.col("_post.ok")).alias("accepted"),
        *keep,
    )


def accepted_posts(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter("accepted").drop("accepted")


def without_spam(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_spam"))


def text_digest(text: Column) -> Column:
    """What identifies a text among any number of them."""
    return F.sha2(text, 256)


def flag_repeated_text(df: DataFrame, text_col: str, max_copies: int, flag: str = "is_repeated") -> DataFrame:
    """Flag rows whose text occurs more than ``max_copies`` times.

    Copies are counted with a partial aggregate over a SHA-256 digest, so a text that makes up a third of the table
    reaches the shuffle as one row per task. The repeated keys are written down (one job): their size is then known
    to the planner, which broadcasts them if they are few and otherwise joins by key, splitting skewed partitions.
    """
    keyed = df.withColumn("_h", text_digest(F.col(text_col)))
    repeated = keyed.groupBy("_h").agg(F.count("*").alias("_copies")).filter(F.col("_copies") > max_copies)
    out = keyed.join(materialize(repeated, "repeated"), "_h", "left")
    return out.withColumn(flag, F.col("_copies").isNotNull()).drop("_h", "_copies")


def flag_repeat_posters(df: DataFrame, author_col: str, text_col: str, max_copies: int, flag: str) -> DataFrame:
    """Flag rows of an author who posted the same text more than ``max_copies`` times. Writes the authors down first."""
    keyed = df.withColumn("_h", text_digest(F.col(text_col)))
    per_text = keyed.groupBy(author_col, "_h").agg(F.count("*").alias("_copies"))
    authors = per_text.filter(F.col("_copies") > max_copies).select(author_col).distinct()
    hits = materialize(authors, "posters").withColumn("_hit", F.lit(True))
    out = keyed.drop("_h").join(hits, author_col, "left")
    return out.withColumn(flag, F.col("_hit").isNotNull()).drop("_hit")


@dataclass(frozen=True)
class KeywordSpec:
    """All base words, any of ``any_words``, none of ``exclude``, one language, and dates in [since, until)."""

    base: str = ""
    any_words: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    lang: str | None = None
    since: str | None = None
    until: str | None = None

    def query(self) -> str:
        """The same request in the search syntax of the site the batches come from."""
        parts = [self.base] if self.base else []
        if self.any_words:
            parts.append(f"({' OR '.join(self.any_words)})")
        parts += [f"-{w}" for w in self.exclude]
        if self.lang:
            parts.append(f"lang:{self.lang}")
        return " ".join(parts)


def keyword_filter(
    df: DataFrame, spec: KeywordSpec, text_col: str, lang_col: str | None = None, ts_col: str | None = None
) -> DataFrame:
    """Cheap column predicates first: language and dates reach the scan, text tests run on what is left."""
    conds = []
    if spec.lang and lang_col:
        conds.append(F.col(lang_col) == spec.lang)
    if spec.since and ts_col:
        conds.append(F.col(ts_col) >= F.lit(spec.since).cast("timestamp_ntz"))
    if spec.until and ts_col:
        conds.append(F.col(ts_col) < F.lit(spec.until).cast("timestamp_ntz"))
    low = F.lower(F.col(text_col))
    conds += [low.contains(w.lower()) for w in spec.base.split()]
    if spec.any_words:
        any_of = F.lit(False)
        for w in spec.any_words:
            any_of = any_of | low.contains(w.lower())
        conds.append(any_of)
    conds += [~low.contains(w.lower()) for w in spec.exclude]
    for cond in conds:
        df = df.filter(cond)
    return df


def cleaned_only(df: DataFrame) -> DataFrame:
    return df.select(*CLEANED_COLUMNS)
