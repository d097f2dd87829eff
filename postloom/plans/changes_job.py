"""From a growing merged store to the star tables, reading only what has changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions import text
from postloom.plans.enrich_job import EnrichConfig, EnrichResult, enrich_rows, star_batch
from postloom.schemas import MERGED_COLUMNS, STAR
from postloom.session import TEXTS, empty, materialize, tune
from postloom.sources.cache_store import read_dead_letters
from postloom.sources.csv_tables import merged_store, ordered_rows
from postloom.sources.star_store import StarStore, TableStore

# What the later stages see of a merged row: its values, and its place, which orders ids that are equal once stripped.
_SEEN = (*MERGED_COLUMNS, "source_file", "file_row")
_TEXT = ("text", "embedded_text")


def _struct(columns, of: str | None = None):
    return F.struct(*[F.col(f"{of}.{c}" if of else c) for c in columns])


def changed_rows(source: TableStore, since: int, upto: int, owed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows to clean again, and the ids ``(tweet_id)``, stripped, whose stored answers were given for another text.

    These are the rows that are new or differ between the two versions of the merged store, the rows whose id is the same
    as one of theirs once stripped, because the last of such rows makes the post, and the rows of the stripped ids in
    ``owed``. Besides the changed rows, only the id column of the store is read, and rows of such other ids.
    """
    if not since:
        # Every row is new, and there is no answer to another text.
        return source.read("merged", version=upto).select(*_SEEN), empty(source.spark, "tweet_id string")
    own = text.strip(F.col("tweet_id")).alias("_own")
    moved = source.changes(since, upto).filter(~_struct(_SEEN).eqNullSafe(_struct(_SEEN, "_before")))
    moved = materialize(moved.select(
        *_SEEN, own, F.col("_before").isNull().alias("_new"),
        (F.col("_before").isNotNull() & ~_struct(_TEXT).eqNullSafe(_struct(_TEXT, "_before"))).alias("_reworded"),
    ), "moved", **TEXTS)
    wanted = moved.select("_own")
    if owed is not None:
        wanted = wanted.unionByName(owed.select(F.col("tweet_id").alias("_own")))
    ids = source.read("merged", version=upto).select("tweet_id", own)
    others = ids.join(wanted.filter("_own <> ''"), "_own", "left_semi").join(moved, "tweet_id", "left_anti")
    others = materialize(others, "others")
    rest = source.read("merged", others, upto).select(*_SEEN)
    groups = moved.select("_own", "_new", "_reworded").unionByName(
        others.select("_own", F.lit(False).alias("_new"), F.lit(False).alias("_reworded")))
    # Of rows that share a stripped id the first one's text is asked; which one that was may have changed.
    stale = groups.groupBy("_own").agg(
        F.max("_reworded").alias("_reworded"), F.min("_new").alias("_all_new"), F.count("*").alias("_n"))
    stale = stale.join(moved.select("_own"), "_own", "left_semi")
    stale = stale.filter(F.col("_reworded") | (~F.col("_all_new") & (F.col("_n") > 1)))
    return moved.select(*_SEEN).unionByName(rest), materialize(stale.select(F.col("_own").alias("tweet_id")), "stale")


def enrich_changes(
    spark: SparkSession, cfg: EnrichConfig, lookup: DataFrame, noise_terms: DataFrame | None = None, retry_failed: bool = True
) -> EnrichResult:
    """Clean, label and load what has changed in the merged store ``cfg.input`` since the last call for ``cfg.store``.

    After any number of calls the star tables are those of one ``enrich`` over the whole store into an empty one with an
    empty cache: a post whose text has changed is asked again, and one that is no longer accepted, or whose answer no
    longer holds, is removed. The version of the input that was read is published together with the load, so that a run
    that dies is done again as a whole (answers it has stored are used, but for posts whose text had changed), and of two
    runs at once one ends with a Conflict. Where ``retry_failed`` is set, posts without a row whose call to the labeller
    failed are tried again on each call.
    """
    if cfg.limit or cfg.offset:
        raise ValueError("limit and offset number the rows of a whole table")
    tune(spark)
    source, target = merged_store(spark, cfg.input), StarStore(spark, cfg.store)
    held, upto = target.state(), source.state()["version"]
    owed = None
    if retry_failed:
        failed = read_dead_letters(spark, cfg.dead_letters).filter(F.col("raw_response").isNull()).select("tweet_id").distinct()
        owed = failed.join(target.read("tweets", failed, held["version"]), "tweet_id", "left_anti")
    rows, stale = changed_rows(source, held["mark"] or 0, upto, owed)
    result = enrich_rows(spark, cfg, ordered_rows(rows), lookup, noise_terms, stale)
    if cfg.dry_run:
        return result
    if result.enriched is None:
        batch = {name: empty(spark, ddl) for name, ddl in STAR.items()}
    else:
        batch = star_batch(result)
    ids = rows.select(text.strip(F.col("tweet_id")).alias("tweet_id")).distinct()
    shown = target.read("tweets", ids, held["version"]).select("tweet_id")
    gone = materialize(shown.join(batch["tweets"].select("tweet_id"), "tweet_id", "left_anti"), "gone")
    result.version = target.load(batch, removed=gone, mark=upto, base=held["version"], folder=result.folder)
    return result
