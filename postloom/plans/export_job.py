"""Export job: star tables to CSV, and CSV to a warehouse."""

from __future__ import annotations

from pyspark.sql import SparkSession

from postloom.schemas import STAR
from postloom.sources.export import export_csv, load_warehouse
from postloom.sources.star_store import StarStore


# As the export writes them: vectors are JSON text, flags are 0 or 1. Ids stay text, whatever they look like.
EXPORTED = {t: ddl.replace("array<float>", "string").replace("boolean", "int") for t, ddl in STAR.items()}


def export_star(spark: SparkSession, store: str, out: str) -> dict[str, int | str]:
    return export_csv(StarStore(spark, store).tables(), out)


def load_exports(
    spark: SparkSession, folder: str, target: str, fmt: str = "parquet", options: dict[str, str] | None = None
) -> dict[str, int | None]:
    return load_warehouse(spark, folder, list(STAR), target, fmt, options, EXPORTED)
