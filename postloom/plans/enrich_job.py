"""Enrichment job: clean, label (cache first), embed, resolve names, load."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.metrics import count_where, counted
from postloom.operators import annotate as ann
from postloom.operators import cache as cache_ops
from postloom.operators import clean, entities, labels, ordering, star, vectors
from postloom.session import TEXTS, materialize, open_folders, small_batches, tune
from postloom.sources import cache_store
from postloom.sources.csv_tables import read_merged
from postloom.sources.star_store import StarStore
from postloom.vocabulary import Vocabulary, VocabularyTable, default_vocabulary


@dataclass(frozen=True)
class EnrichConfig:
    input: str
    store: str
    cache: str
    dead_letters: str
    limit: int | None = None
    offset: int = 0
    skip_annotate: bool = False
    skip_embeddings: bool = False
    dry_run: bool = False
    labeller: ann.LabellerFactory | None = None
    model_name: str = "custom"
    chunks: int = 16
    concurrency: int | None = None
    call_pause: float = 0.1
    retry_wait: float = 2.0
    vocabulary: Vocabulary | VocabularyTable = field(default_factory=default_vocabulary)
    encoder: object = vectors.hash_encoder
    # Take the vector of a post whose text the store already has; worth its join where the encoder is a model.
    reuse_vectors: bool = False


@dataclass
class EnrichResult:
    """Counters by stage, and the enriched table (None when a stage yielded no rows); what a load is made of: the folder
    its parent has been written to, if any, and the labels of its posts."""

    counts: dict[str, int] = field(default_factory=dict)
    enriched: DataFrame | None = None
    posts: DataFrame | None = None
    labels: DataFrame | None = None
    folder: str | None = None
    stopped_after: str | None = None
    version: int | None = None


def run_clean(spark: SparkSession, cfg: EnrichConfig, merged: DataFrame, counts: dict[str, int]) -> DataFrame:
    """Cleaned, accepted posts with ``row_ord``, written once, where they are to be labelled by ``chunk``.

    ``_row`` tells rows apart. Labels are looked up, asked for and judged under it and the id; the posts themselves are
    only joined to them at the end, so that no other stage writes or shuffles a text.
    """
    rows = ordering.skip_rows(merged, "row_ord", cfg.offset)
    cleaned, seen = counted(
        clean.clean_posts(rows, "row_ord"), skipped=count_where(~F.col("accepted"))
    )
    posts = clean.accepted_posts(cleaned)
    if cfg.limit:
        # Finding the last row to keep reads the rows more than once, so they are cleaned once and written first.
        posts = ordering.take_rows(materialize(posts, "accepted", **TEXTS), "row_ord", cfg.limit)
    posts, kept = counted(posts, extracted=F.count(F.lit(1)), spam=count_where(F.col("is_spam")))
    posts = posts.withColumn("_row", F.monotonically_increasing_id())
    if cfg.skip_annotate:
        posts = materialize(posts, "clean", **TEXTS)
    else:
        posts = posts.withColumn("chunk", ann.chunk_of("tweet_id", cfg.chunks))
        # Row groups so small that a task can hold one for each chunk.
        block = {"parquet.block.size": str(max(1, 64 // cfg.chunks) << 20)}
        with open_folders(spark, cfg.chunks):
            posts = materialize(posts, "clean", by="chunk", **TEXTS, **block)
    counts.update(seen.get)
    counts.update(kept.get)
    return posts


# Rows of posts while they are labelled; under ``full_text`` no more than the dead-letter log shows.
KEYS = ("tweet_id", "row_ord", "_row")


def start_of_text():
    return F.substring("full_text", 1, 200).alias("full_text")


def asked_posts(wanted: DataFrame, looked_up: DataFrame) -> DataFrame:
    """The rows of ``wanted`` whose text is asked: of each id without an answer the first. Either these or all others are
    few, as a rule; the fewer are what the texts meet."""
    misses = looked_up.filter(F.col("response").isNull())
    first = misses.groupBy("tweet_id").agg(F.min(F.struct("row_ord", "_row")).alias("_first"))
    first, seen = counted(first.select("_first._row"), rows=F.count(F.lit(1)))
    first = materialize(first, "first")
    n_first, n_all = seen.get["rows"], looked_up.count()
    if 2 * n_first <= n_all:
        return wanted.join(first, "_row", "left_semi")
    if n_first == n_all:
        return wanted
    others = materialize(looked_up.select("_row").join(first, "_row", "left_anti"), "others")
    return wanted.join(others, "_row", "left_anti")


def run_annotate(
    spark: SparkSession, cfg: EnrichConfig, wanted: DataFrame, looked_up: DataFrame, counts: dict[str, int]
) -> DataFrame | None:
    """Label the misses chunk by chunk, and join the valid answers of all chunks to them; None where there is no chunk.

    An id is asked once, with the text of its first row, and the answer holds for all its rows. Each chunk's judged
    answers are written before anything reads them, so a retried task cannot leave two answers in use, and its valid
    answers join the cache at once, so a killed run resumes after its last finished chunk.
    """
    if cfg.labeller is None:
        raise ValueError("a labeller is needed unless skip_annotate is set")
    asked = asked_posts(wanted, looked_up).select("tweet_id", "full_text", "chunk")
    answers = None
    for chunk in range(cfg.chunks):
        answered, seen = counted(
            ann.annotate(
                asked.filter(F.col("chunk") == chunk).drop("chunk"),
                cfg.labeller,
                concurrency=cfg.concurrency,
                call_pause=cfg.call_pause,
                retry_wait=cfg.retry_wait,
            ),
            calls=count_where(F.col("call_error").isNull()),
        )
        answered = answered.select("tweet_id", start_of_text(), "response", "call_error", F.lit(cfg.model_name).alias("model"))
        judged = labels.normalize_labels(answered, cfg.vocabulary)
        # A failed call has no response to judge; its own error is the one to report.
        errors = F.when(F.col("call_error").isNotNull(), F.array("call_error")).otherwise(F.col("errors"))
        judged = materialize(judged.withColumn("errors", errors).drop("call_error"), "answers")
        counts["calls"] = counts.get("calls", 0) + seen.get["calls"]
        valid = labels.valid_rows(judged)
        cache_store.append_cache(cache_store.cache_entries(valid, cfg.model_name), cfg.cache)
        counts["dead"] = counts.get("dead", 0) + _write_dead(judged, cfg)
        valid = valid.drop("full_text", "response")
        answers = valid if answers is None else answers.unionByName(valid)
    # As many rows as the ids have in the input.
    misses = looked_up.filter(F.col("response").isNull()).select(*KEYS)
    return None if answers is None else misses.join(answers, "tweet_id")


def _write_dead(judged: DataFrame, cfg: EnrichConfig) -> int:
    dead, seen = counted(labels.dead_letters(judged), dead=F.count(F.lit(1)))
    cache_store.append_dead_letters(dead, cfg.dead_letters)
    return seen.get["dead"]


def run_label(
    spark: SparkSession, cfg: EnrichConfig, posts: DataFrame, counts: dict[str, int], stale: DataFrame | None = None
) -> DataFrame:
    """Labels of posts, with ``KEYS``, from cache and labeller; rejects go to the dead-letter log. Spam never reaches the
    labeller. Stored answers of ``stale`` ids are not used."""
    wanted = clean.without_spam(posts)
    ids = wanted.select("tweet_id") if stale is None else wanted.select("tweet_id").join(stale, "tweet_id", "left_anti")
    cache = cache_store.read_cache(spark, cfg.cache, ids)
    looked_up = materialize(cache_ops.cache_lookup(wanted.select(*KEYS, start_of_text()), cache), "lookup")
    hits, seen = counted(looked_up.filter(F.col("response").isNotNull()), hits=F.count(F.lit(1)))
    judged = materialize(labels.require_model(labels.normalize_labels(hits, cfg.vocabulary)), "hits")
    counts.update(hits=seen.get["hits"], dead=_write_dead(judged, cfg), calls=0)
    out = labels.valid_rows(judged).drop("full_text", "response")
    if not cfg.skip_annotate:
        fresh = run_annotate(spark, cfg, wanted, looked_up, counts)
        out = out if fresh is None else out.unionByName(fresh)
    return out.withColumnRenamed("model", "coded_by")


def enrich(
    spark: SparkSession,
    cfg: EnrichConfig,
    lookup: DataFrame,
    noise_terms: DataFrame | None = None,
) -> EnrichResult:
    """Run all stages; stops early when one yields no rows. ``dry_run`` does everything except the load."""
    tune(spark)
    result = enrich_rows(spark, cfg, read_merged(spark, cfg.input), lookup, noise_terms)
    if result.enriched is not None and not cfg.dry_run:
        result.version = StarStore(spark, cfg.store).load(star_batch(result), folder=result.folder)
    return result


def star_batch(result: EnrichResult) -> dict[str, DataFrame]:
    """The star tables of a result: posts as they were written, and what their labels hold."""
    return {"tweets": result.posts if result.folder else star.parent_table(result.posts), **star.child_tables(result.labels)}


def enrich_rows(
    spark: SparkSession,
    cfg: EnrichConfig,
    merged: DataFrame,
    lookup: DataFrame,
    noise_terms: DataFrame | None = None,
    stale: DataFrame | None = None,
) -> EnrichResult:
    """All stages but the load over merged rows with ``row_ord``; stored answers of ``stale`` ids are asked again. Unless it
    is a dry run, the posts are written where the load will have them, so that no text is written again for it."""
    with small_batches(spark):
        return _enrich_rows(spark, cfg, merged, lookup, noise_terms, stale)


def _enrich_rows(
    spark: SparkSession, cfg: EnrichConfig, merged: DataFrame, lookup: DataFrame, noise_terms: DataFrame | None, stale: DataFrame | None
) -> EnrichResult:
    result = EnrichResult()
    posts = run_clean(spark, cfg, merged, result.counts)
    if not result.counts["extracted"]:
        result.stopped_after = "clean"
        return result

    labelled = run_label(spark, cfg, posts, result.counts, stale)
    # Ids that collide once stripped: the later row replaces the earlier, as successive loads would.
    unique, seen = counted(labelled, enriched=F.count(F.lit(1)))
    enriched = materialize(star.last_per_id(unique, "row_ord"), "labelled")
    result.counts.update(seen.get)
    if not result.counts["enriched"]:
        result.stopped_after = "label"
        return result

    mentions = enriched.select(F.explode("brands_raw.brand_raw").alias("brand_raw"))
    resolved = materialize(entities.resolve_names(mentions, lookup, noise_terms), "names")
    loaded, found = counted(
        entities.resolve_mentions(enriched, resolved), mentions=F.coalesce(F.sum(F.size("brands_raw")), F.lit(0))
    )
    result.labels = materialize(loaded, "resolved")
    # A row per post on both sides: never one to broadcast, whatever the planner guesses. Hashing the narrow side spares a
    # sort of the texts.
    own = result.labels.select("_row", "intent", "sentiment", "coded_by")
    final = clean.without_spam(posts).drop("chunk", "row_ord").join(own.hint("shuffle_hash"), "_row").drop("_row")
    if not cfg.skip_embeddings:
        # Last, so that no join above carries a vector.
        final = vectors.embed(with_stored_vectors(spark, cfg, final), cfg.encoder)
    final, seen = counted(
        final,
        posts=F.count(F.lit(1)),
        **({} if cfg.skip_embeddings else {"embedded": count_where(F.col("embedding").isNotNull())}),
    )
    columns, at = final.columns, None
    if not cfg.dry_run:
        store = StarStore(spark, cfg.store)
        result.folder = store.new_load()
        final, at = star.parent_table(final), store.parent_path(result.folder)
    result.posts = materialize(final, "final", at=at, **TEXTS)
    result.counts.update({k: n for k, n in seen.get.items() if k != "posts"})
    result.counts.update(found.get)
    result.counts.update(name_counts(mentions, resolved))
    kept = result.posts if cfg.dry_run else result.posts.withColumnRenamed("intent_label", "intent").select(*columns)
    others = result.labels.drop("_row", "intent", "sentiment", "coded_by")
    result.enriched = kept.join(others.hint("shuffle_hash"), "tweet_id")
    return result


def with_stored_vectors(spark: SparkSession, cfg: EnrichConfig, posts: DataFrame) -> DataFrame:
    """``posts`` with the stored vector of each post whose text is still the same, on request."""
    if not cfg.reuse_vectors:
        return posts
    stored = StarStore(spark, cfg.store).read("tweets").filter(F.size("embedding") > 0)
    same = stored.join(posts.select("tweet_id", "full_text"), ["tweet_id", "full_text"], "left_semi")
    return vectors.reuse_vectors(posts, same)


def name_counts(mentions: DataFrame, resolved: DataFrame) -> dict[str, int]:
    """Mentions normalised by exact lookup, mentions that were noise, and distinct unknown names."""
    per_name = mentions.groupBy("brand_raw").count().join(resolved, "brand_raw")
    row = per_name.agg(
        F.coalesce(F.sum(F.when(F.col("matched_by") == "exact", F.col("count"))), F.lit(0)).alias("normalized"),
        F.coalesce(F.sum(F.when(F.col("noise").isNotNull(), F.col("count"))), F.lit(0)).alias("noise"),
        F.count_if(F.col("matched_by").isin("fuzzy", "raw")).alias("unknown"),
    ).first()
    return row.asDict()
