"""Merging raw batches: target columns, back-filled author fields, ids for rows without one, one row per id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.functions.evaluation import once
from postloom.functions.numbers import safe_int
from postloom.functions.payload import author_fields, image_links_json, with_payload
from postloom.functions.text import first_nonempty
from postloom.schemas import MERGED_COLUMNS
from postloom.session import materialize


def union_batches(*batches: DataFrame) -> DataFrame:
    """UNION ALL by name; a column a batch lacks is null there."""
    out = batches[0]
    for batch in batches[1:]:
        out = out.unionByName(batch, allowMissingColumns=True)
    return out


def project_merged(df: DataFrame, *keep: str, columns: tuple[str, ...] = MERGED_COLUMNS) -> DataFrame:
    """Exactly the target columns, absent or null values as empty strings, plus the columns named in ``keep``."""
    have = set(df.columns)
    cols = [
        (F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")).alias(c) for c in columns
    ]
    return df.select(*cols, *keep)


def fill_pair(first: Column, second: Column, extracted: Column) -> tuple[Column, Column]:
    """Two names of one thing fill each other: first <- extracted <- second, then second <- first <- extracted."""
    a = first_nonempty(first, extracted, second)
    return a, first_nonempty(second, a, extracted)


def backfill_authors(df: DataFrame) -> DataFrame:
    """Fill handle and display name from each other and the payload, and the image list from the media payload."""
    out = with_payload(with_payload(df, "raw", "_raw"), "media", "_media")
    out = once(out, _author=author_fields(F.col("_raw")))
    handle, username = fill_pair(F.col("user_screen_name"), F.col("user_username"), F.col("_author.screen_name"))
    name, display = fill_pair(F.col("user_name"), F.col("user_displayname"), F.col("_author.name"))
    links = F.col("image_links")
    return out.withColumns(
        {
            "user_screen_name": handle,
            "user_username": username,
            "user_name": name,
            "user_displayname": display,
            "image_links": F.when(
                links.isin("", "[]"), F.coalesce(image_links_json(F.col("_media")), F.lit("[]"))
            ).otherwise(links),
        }
    ).drop("_raw", "_media", "_author")


def number_rows(df: DataFrame) -> DataFrame:
    """Turn ``(_source_rank, _file, _pos)`` of a landing read into a 0-based ``row_ord`` over all rows.

    Positions within a file are consecutive, so per-file bounds are enough: one extra, column-pruned scan (a job) and a
    running sum with one row per input file. No row is sorted. The per-file offsets are written down, so the planner
    knows their size. A source whose positions have gaps, as a merged table has, leaves gaps in ``row_ord``.
    """
    key = ["_source_rank", "_file"]
    before = Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    files = df.groupBy(*key).agg((F.max("_pos") - F.min("_pos") + 1).alias("_rows"), F.min("_pos").alias("_first"))
    files = files.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    files = materialize(files, "files")
    out = df.join(files, key).withColumn("row_ord", F.col("_offset") + F.col("_pos") - F.col("_first"))
    return out.drop(*key, "_pos", "_first", "_offset")


def place_in_file(df: DataFrame) -> DataFrame:
    """Turn ``(_file, _pos)`` of a read into ``source_file`` and ``file_row``, a row's 0-based place in its file.

    Unlike an ordinal over all files, it does not depend on which other files are read.
    """
    firsts = materialize(df.groupBy("_file").agg(F.min("_pos").alias("_first")), "files")
    out = df.join(firsts, "_file").withColumn("file_row", F.col("_pos") - F.col("_first"))
    return out.withColumnRenamed("_file", "source_file").drop("_pos", "_first", "_source_rank")


def fill_missing_ids(df: DataFrame, id_col: str = "tweet_id", *ord_cols: str) -> DataFrame:
    """Rows without an id become ``unknown_<input ordinal>``, or what the named columns hold, joined by ``_``."""
    made = F.concat_ws("_", F.lit("unknown"), *[F.col(c).cast("string") for c in ord_cols or ("row_ord",)])
    return df.withColumn(id_col, F.coalesce(F.nullif(F.col(id_col), F.lit("")), made))


def dedup_best(df: DataFrame, id_col: str, score: Column, ord_col: str, seen_col: str | None = None) -> DataFrame:
    """One row per id: highest score, first by ``ord_col`` on ties; ``first_ord`` is where the id was first seen, by
    ``seen_col`` where rows are winners of earlier rounds. Both may be of any ordered type.

    An aggregate rather than a window, so each task first reduces its own rows to one per id: an id that holds a third
    of the table reaches the shuffle as one row per task.
    """
    row = F.struct(*[F.col(c) for c in df.columns if c != id_col])
    best = df.groupBy(id_col).agg(
        F.min_by(row, F.struct(-score, F.col(ord_col))).alias("_row"), F.min(seen_col or ord_col).alias("first_ord")
    )
    return best.select(id_col, "_row.*", "first_ord")


def winners(df: DataFrame, id_col: str, score: Column, place: tuple[str, ...], seen_col: str) -> DataFrame:
    """As ``dedup_best``, for rows that id and ``place`` tell apart, which orders equal scores. The winners are found by
    these columns alone and written down; whole rows travel once to meet them and are never sorted, as an aggregate that
    holds them would do on both sides of its shuffle. Reads ``df`` twice."""
    ranked = F.struct((-score).alias("_score"), *place)
    best = df.select(id_col, ranked.alias("_rank"), seen_col).groupBy(id_col).agg(
        F.min("_rank").alias("_rank"), F.min(seen_col).alias("first_ord"))
    best = materialize(best.select(id_col, *[f"_rank.{c}" for c in place], "first_ord"), "winners")
    return df.drop(seen_col).join(best.hint("shuffle_hash"), [id_col, *place])


def engagement() -> Column:
    """Likes, retweets and comments; three counts of 64 bits need more than 64 for their sum."""
    return sum(safe_int(F.col(c)).cast("decimal(38,0)") for c in ("likes", "retweets", "comments"))


def merge_rows(rows: DataFrame, ord_col: str = "row_ord", *keep: str) -> DataFrame:
    """One row per id of rows that have one, author fields filled: the target columns, ``ord_col``, where the id was
    first seen, and the winner's columns named in ``keep``."""
    best = dedup_best(rows, "tweet_id", engagement(), ord_col)
    # Back-filling touches single rows and no deduplication key, so only the winners pay for payload parsing.
    merged = backfill_authors(best.drop(ord_col).withColumnRenamed("first_ord", ord_col))
    return merged.select(*MERGED_COLUMNS, ord_col, *keep)


def numbered_rows(df: DataFrame, missing_ids: str = "ordinal") -> DataFrame:
    """Rows of a landing read with ``row_ord``, an id in each: ``unknown_<row_ord>`` where there was none, or with
    ``missing_ids="file"`` ``unknown_<file>_<row in it>``, which stays the same whatever else is in the folder."""
    rows = project_merged(df, "_source_rank", "_file", "_pos")
    if missing_ids == "ordinal":
        return fill_missing_ids(number_rows(rows))
    keyed = place_in_file(rows.withColumns({"_from": F.struct("_source_rank", "_file", "_pos")}))
    named = fill_missing_ids(keyed, "tweet_id", "source_file", "file_row").drop("source_file", "file_row")
    return number_rows(named.select("*", "_from.*").drop("_from"))


def merge_batches(df: DataFrame, missing_ids: str = "ordinal") -> DataFrame:
    """From a landing read to the merged table."""
    return merge_rows(numbered_rows(df, missing_ids))


def flatten_author(df: DataFrame) -> DataFrame:
    """Crawler records to batch rows: sorted flat fields, then the nested author's fields with defaults."""
    flat = sorted(c for c in df.columns if c != "user")
    have = set(df.schema["user"].dataType.fieldNames()) if "user" in df.columns else set()

    def author(field: str, default: Column) -> Column:
        return F.coalesce(F.col(f"user.{field}"), default) if field in have else default

    return df.select(
        *flat,
        author("username", F.lit("")).alias("user_username"),
        author("displayname", F.lit("")).alias("user_displayname"),
        author("followers_count", F.lit(0)).alias("user_followers"),
        author("verified", F.lit(False)).alias("user_verified"),
    )
