"""Merge job: landing folder to merged table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from postloom.metrics import counted
from postloom.operators import ingest
from postloom.session import tune
from postloom.sources.csv_tables import read_landing, write_merged


@dataclass(frozen=True)
class IngestCounts:
    before: int
    duplicates: int
    after: int


def ingest_landing(
    spark: SparkSession, landing: str, out: str, base: str | None = None, fmt: str = "parquet",
    missing_ids: str = "ordinal",
) -> IngestCounts:
    """Read, deduplicate, back-fill, write. One shuffle of the data, by id. ``base`` may be an earlier output."""
    tune(spark)
    rows = ingest.numbered_rows(read_landing(spark, landing, base), missing_ids)
    numbered, before = counted(rows, rows=F.count(F.lit(1)))
    watched, after = counted(ingest.merge_rows(numbered), rows=F.count(F.lit(1)))
    write_merged(watched, out, fmt)
    n_before, n_after = before.get["rows"], after.get["rows"]
    return IngestCounts(n_before, n_before - n_after, n_after)
