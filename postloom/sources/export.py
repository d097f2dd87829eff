"""Exporting the star tables to CSV and loading the CSVs into a warehouse."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.metrics import counted
from postloom.operators.star import vector_json
from postloom.sources.csv_tables import READ, write_csv
from postloom.sources.files import exists, remove_folder, replace_folder


def export_table(df: DataFrame) -> DataFrame:
    """Columns as CSV can hold them: vectors as JSON text, flags as 0 or 1."""
    cols = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f.name)
        cols.append((vector_json(c) if kind == "array" else c.cast("int") if kind == "boolean" else c).alias(f.name))
    return df.select(*cols)


def export_csv(tables: dict[str, DataFrame], out: str) -> dict[str, int | str]:
    """Write each table to ``out/<table>``; returns rows written, or the error text of a table that failed."""
    report: dict[str, int | str] = {}
    for name, df in tables.items():
        try:
            watched, seen = counted(export_table(df), rows=F.count(F.lit(1)))
            write_csv(watched, f"{out}/{name}")
            report[name] = seen.get["rows"]
        except Exception as exc:  # one bad table must not stop the others
            report[name] = f"{type(exc).__name__}: {exc}"
    return report


def load_warehouse(
    spark: SparkSession,
    folder: str,
    tables: list[str],
    target: str,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    schemas: dict[str, str] | None = None,
) -> dict[str, int | None]:
    """Replace ``target/<table>`` by each CSV; returns rows loaded, None for a missing CSV, whose table stays. Types are
    those of ``schemas`` and are detected, by a further pass over the file, only for tables that it lacks.

    All tables are first written to a folder beside the others and read back: the rows, and in formats that keep them the
    columns and types, must be those of the CSV. Only then does each take its place, so that a load that fails before, by
    whatever cause, leaves every old table whole.
    """
    report: dict[str, int | None] = {}
    staged = f"{target}/.staged-{uuid.uuid4().hex}"
    try:
        for name in tables:
            path = f"{folder}/{name}"
            if not exists(spark, path):
                report[name] = None
                continue
            reader = spark.read.options(**READ)
            known = (schemas or {}).get(name)
            df = (reader.schema(known) if known else reader.option("inferSchema", "true")).csv(path)
            watched, seen = counted(df, rows=F.count(F.lit(1)))
            watched.write.format(fmt).options(**(options or {})).save(f"{staged}/{name}")
            report[name] = seen.get["rows"]
            _verify(spark, f"{staged}/{name}", fmt, options or {}, df.schema, report[name])
        for name, rows in report.items():
            if rows is not None:
                replace_folder(spark, f"{staged}/{name}", f"{target}/{name}")
    finally:
        remove_folder(spark, staged)
    return report


def _verify(spark: SparkSession, path: str, fmt: str, options: dict[str, str], schema: T.StructType, rows: int) -> None:
    typed = fmt in ("parquet", "orc")
    reader = spark.read.format(fmt).options(**options)
    stored = reader.load(path) if typed else reader.schema(schema).load(path)
    if typed and [(f.name, f.dataType) for f in stored.schema] != [(f.name, f.dataType) for f in schema]:
        raise ValueError(f"{path}: columns {stored.schema.simpleString()} instead of {schema.simpleString()}")
    found = stored.count()
    if found != rows:
        raise ValueError(f"{path}: {found} rows instead of {rows}")
