"""What the operators share: word rules, column hygiene, Arrow plumbing."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of characters other than blank, tab, line feed, vertical tab, form feed and carriage return.
# ``bytes.split()`` splits at exactly these, so Python code splits the UTF-8 bytes; this is the same rule for the JVM.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def utf8(text: Column) -> Column:
    """UTF-8 bytes of a text; null stays null. Arrow then hands Python bytes and no string is decoded."""
    return text.cast("binary")


def packed(docs: DataFrame) -> Column:
    """All columns as one, ``row``, so that the names of working columns cannot clash with theirs."""
    return F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(docs.columns)]).alias("row")


def unpacked(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` out of ``row``, those named replaced."""
    return [changed.get(c, F.col(f"row.f{i}")).alias(c) for i, c in enumerate(docs.columns)]


def arrow_map(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function that yields column dictionaries instead of record batches."""
    target = df.sparkSession.createDataFrame([], schema).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(target)
        for columns in rows(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for f in out for c in (columns[f.name],)], schema=out
            )

    return df.mapInArrow(run, target)
