"""Entity lookup and noise terms from files or plain Python values."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.schemas import LOOKUP
from postloom.session import empty
from postloom.sources.files import exists


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """``(alias, canonical)`` from one JSON object; a missing file gives a warning and an empty table.

    No broadcast hint: the planner sees the file's size and broadcasts it only below its own threshold.
    """
    if not exists(spark, path):
        warnings.warn(f"lookup {path} does not exist", stacklevel=2)
        return empty(spark, LOOKUP)
    pairs = F.from_json("value", "map<string,string>")
    return spark.read.text(path, wholetext=True).select(F.explode(pairs).alias("alias", "canonical"))


def lookup_table(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    """``(alias, canonical)`` from a small dict, as a literal so that the planner knows how small it is."""
    if not mapping:
        return empty(spark, LOOKUP)
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return spark.range(1).select(F.explode(F.create_map(*pairs)).alias("alias", "canonical"))


def noise_table(spark: SparkSession, terms: list[str] | tuple[str, ...]) -> DataFrame:
    """One column ``term`` from a small list."""
    if not terms:
        return empty(spark, "term string")
    return spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in terms])).alias("term"))


def read_noise(spark: SparkSession, path: str) -> DataFrame:
    """One term per line."""
    return spark.read.text(path).select(F.trim("value").alias("term")).filter("term != ''").distinct()
