"""Incremental ingest of a growing landing folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postloom.operators.ingest import (
    backfill_authors, dedup_best, engagement, fill_missing_ids, place_in_file, project_merged, winners,
)
from postloom.schemas import MERGED_COLUMNS
from postloom.session import materialize, tune
from postloom.sources.csv_tables import READ, merged_store
from postloom.sources.star_store import TableStore


def stream_folder(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "csv", max_files: int = 1000, **options: str
) -> DataFrame:
    """Files as they arrive, at most ``max_files`` per micro-batch. For CSV all files must share the header."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.options(**{**READ, "enforceSchema": "false"})
    return reader.options(**options).format(fmt).load(folder)


def run_available(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what has arrived and stop; the checkpoint remembers which files are done."""
    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def keep_best(
    old: DataFrame | None, batch: DataFrame, id_col: str, score, ord_col: str
) -> DataFrame:
    """Stored winners against a new batch: the highest score per id, the first seen on ties.

    Applying a batch twice changes nothing, and the result does not depend on how files fall into batches, because the
    winner is a maximum over (score, -ord).
    """
    rows = batch if old is None else old.select(*batch.columns).unionByName(batch)
    return dedup_best(rows, id_col, score, ord_col).select(*batch.columns)


def merge_batch(store: TableStore, batch: DataFrame, batch_id: int) -> None:
    """Fold a micro-batch of raw rows, with ``_file``, into the store: the most engaged copy of each id, the first seen
    on ties. First is by file name and row in the file, as in the batch job, so the result does not depend on how files
    fall into micro-batches or tasks. Only stored rows of the batch's own ids are read back.
    """
    # Directly above the scan: a multi-line CSV is never split, so within one file the number follows the file's rows.
    rows = place_in_file(project_merged(batch.withColumn("_pos", F.monotonically_increasing_id()), "_file", "_pos"))
    rows = fill_missing_ids(rows, "tweet_id", "source_file", "file_row")
    at = F.struct("source_file", "file_row")
    fresh = rows.select(*MERGED_COLUMNS, at.alias("seen"), at.alias("won"))
    stored = store.read("merged", materialize(fresh.select("tweet_id").distinct(), "ids"))
    won = F.struct(F.col("won_file").alias("source_file"), F.col("won_row").alias("file_row"))
    stored = stored.select(*MERGED_COLUMNS, at.alias("seen"), won.alias("won"))
    # A replayed row meets its own copy, so a row is told by where it comes from, too.
    both = stored.withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True)))
    best = winners(both, "tweet_id", engagement(), ("won", "_new"), "seen")
    # Back-filling stored rows again changes nothing: it has left no field empty that it can fill.
    merged = backfill_authors(best).select(
        *MERGED_COLUMNS, "first_ord.*", F.col("won.source_file").alias("won_file"), F.col("won.file_row").alias("won_row")
    )
    store.load({"merged": merged})


def ingest_new_files(
    spark: SparkSession, folder: str, columns: list[str], root: str, checkpoint: str, max_files: int = 1000
) -> TableStore:
    """Merge the CSV files that arrived since the last call; ``columns`` is their header, in order. ``root`` can be the
    input of the enrichment job.

    A batch that is replayed after a failure changes nothing: its rows meet their own copies and the maximum stays.
    """
    tune(spark)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    store = merged_store(spark, root)
    stream = stream_folder(spark, folder, schema, "csv", max_files).select("*", F.col("_metadata.file_name").alias("_file"))
    run_available(stream, checkpoint, lambda batch, batch_id: merge_batch(store, batch, batch_id))
    return store
