"""CSV in the dialect spreadsheets and crawlers write: doubled quotes, quoted newlines, header names."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.operators.ingest import number_rows, project_merged, union_batches
from postloom.schemas import MERGED, MERGED_COLUMNS
from postloom.session import materialize
from postloom.sources.files import exists, list_files
from postloom.sources.split_csv import read_rows
from postloom.sources.star_store import TableStore

READ = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}
WRITE = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


MERGED_STORE = {"merged": ", ".join(f"`{c}` string" for c in MERGED_COLUMNS) + (
    ", source_file string, file_row bigint, won_file string, won_row bigint"
)}


def merged_store(spark: SparkSession, root: str) -> TableStore:
    """The merged table as a store, one row per id, with the file and row in it where the id was first seen, and those
    of the copy that was kept."""
    return TableStore(spark, root, MERGED_STORE, "merged", texts=True)


def read_csv_files(spark: SparkSession, paths: list[str], rank: int = 1) -> DataFrame:
    """All files by header name, each divided over tasks (``split_csv``). Every column is a string.

    Adds ``_source_rank``, ``_file`` and ``_pos`` for ``ingest.number_rows``.
    """
    rows = read_rows(spark, paths, {k: v for k, v in READ.items() if k != "header"})
    if rows is None:
        raise FileNotFoundError("no CSV file with a header")
    return rows.withColumn("_source_rank", F.lit(rank))


def read_landing(spark: SparkSession, landing: str, base: str | None = None) -> DataFrame:
    """The optional base first (CSV, or Parquet as the merge job writes it; a warning if it is missing), then every
    ``*.csv`` of the landing folder by name."""
    parts = []
    if base is not None:
        if exists(spark, base):
            files = list_files(spark, base.rstrip("/") + "/*.csv") or list_files(spark, base)
            if files:
                parts.append(read_csv_files(spark, files, rank=0))
            else:  # an earlier merged table, which has its own order
                rows = spark.read.parquet(base)
                parts.append(rows.select(*MERGED_COLUMNS, F.lit(0).alias("_source_rank"), F.lit("").alias("_file"), F.col("row_ord").alias("_pos")))
        else:
            warnings.warn(f"base file {base} does not exist", stacklevel=2)
    batches = list_files(spark, landing.rstrip("/") + "/*.csv")
    if batches:
        parts.append(read_csv_files(spark, batches, rank=1))
    if not parts:
        raise FileNotFoundError(f"nothing to read in {landing}")
    return union_batches(*parts)


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Rows of a merged store with ``row_ord``, which follows the place where an id was first seen."""
    placed = rows.select("*", F.lit(0).alias("_source_rank"), F.col("source_file").alias("_file"), F.col("file_row").alias("_pos"))
    return number_rows(placed).select(*MERGED_COLUMNS, "row_ord")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The merged table with ``row_ord``, from Parquet, CSV or the store a stream keeps; a missing path is an
    AnalysisException."""
    if exists(spark, path.rstrip("/") + "/_manifest"):
        return ordered_rows(merged_store(spark, path).read("merged"))
    if exists(spark, path) and not list_files(spark, path.rstrip("/") + "/*.csv") and not path.endswith(".csv"):
        return spark.read.parquet(path)
    if not exists(spark, path):
        return spark.read.schema(MERGED).options(**READ).csv(path)  # raises PATH_NOT_FOUND
    files = list_files(spark, path.rstrip("/") + "/*.csv") or [path]
    return number_rows(project_merged(read_csv_files(spark, files), "_source_rank", "_file", "_pos"))


def write_merged(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Fixed column order. CSV has no place for the row number, so its files are written in row order instead."""
    if fmt == "csv":
        # The sort samples its input before it reads it, so the input is written down instead of being computed twice.
        materialize(df, "merged").orderBy("row_ord").select(*MERGED_COLUMNS).write.mode("overwrite").options(**WRITE).csv(path)
    else:
        df.select(*MERGED_COLUMNS, "row_ord").write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**WRITE).csv(path)
