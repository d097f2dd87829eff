"""The response cache, a table store in which an id's newest load holds, and the dead-letter log, a Parquet folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.operators.cache import newest_answers
from postloom.operators.labels import response_json
from postloom.schemas import CACHE, DEAD_LETTER
from postloom.session import empty
from postloom.sources.files import exists
from postloom.sources.star_store import TableStore


def read_cache(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    """The stored answers, with ``ids`` those of these ids only; an empty table when there is no cache yet. A plain Parquet
    folder can be read, too."""
    if exists(spark, f"{path}/_manifest"):
        return cache_table(spark, path).read("cache", ids)
    if not exists(spark, path):
        return empty(spark, CACHE)
    stored = spark.read.schema(CACHE).parquet(path)
    return stored if ids is None else stored.join(ids.select("tweet_id"), "tweet_id", "left_semi")


def cache_table(spark: SparkSession, path: str) -> TableStore:
    return TableStore(spark, path, {"cache": CACHE}, "cache")


def cache_entries(valid: DataFrame, model: str) -> DataFrame:
    """Rows to store for newly labelled, valid posts: the normalised answer, not the raw one."""
    return valid.select(
        "tweet_id",
        response_json().alias("response"),
        F.lit(model).alias("model"),
        F.current_timestamp().alias("cached_at"),
    )


def append_cache(entries: DataFrame, path: str) -> None:
    """Add answers, one per id: readers see all of them or none. Small loads are merged as they gather.

    The first append to a plain Parquet folder takes its answers over.
    """
    store = cache_table(entries.sparkSession, path)
    if not store.current()[0] and exists(entries.sparkSession, path):
        store.load({"cache": newest_answers(read_cache(entries.sparkSession, path))})
    store.load({"cache": entries})


def read_json_cache(spark: SparkSession, path: str) -> DataFrame:
    """Import a JSON object ``{id: {response, model, cached_at}}``.

    An absent model becomes ``cached``; a null one stays null and is rejected by the gate. JSON null as response stays a
    miss.
    """
    # One JSON document is one record for Spark, so the import of a file runs in one task; stored caches are Parquet.
    rows = spark.read.text(path, wholetext=True).select(
        F.explode(F.from_json("value", "map<string,string>")).alias("tweet_id", "entry")
    )
    v = F.try_parse_json("entry")
    model = F.try_variant_get(v, "$.model", "string")
    return rows.select(
        "tweet_id",
        F.when(
            F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.response", "variant")), F.lit("VOID")) != "VOID",
            F.to_json(F.try_variant_get(v, "$.response", "variant")),
        ).alias("response"),
        F.when(F.try_variant_get(v, "$.model", "variant").isNull(), F.lit("cached")).otherwise(model).alias("model"),
        F.try_to_timestamp(F.try_variant_get(v, "$.cached_at", "string")).alias("cached_at"),
    )


def append_dead_letters(dead: DataFrame, path: str) -> None:
    dead.write.mode("append").parquet(path)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return empty(spark, DEAD_LETTER)
    return spark.read.schema(DEAD_LETTER).parquet(path)
