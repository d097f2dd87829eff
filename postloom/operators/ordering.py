"""Offset and limit by a unique row number, without sorting the table or sending it through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65_536


def nth_row(df: DataFrame, ord_col: str, n: int) -> int | None:
    """The ``n``-th smallest (0-based) value of a unique bigint column, or None when there are fewer rows.

    Runs two small jobs. Rows are counted per block of ``BLOCK`` numbers with a partial aggregate, a running sum over
    the block counts (one row per 65,536 possible numbers) finds the block, and only that block is ordered.
    """
    block = F.floor(F.col(ord_col) / BLOCK).alias("block")
    running = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = (
        df.groupBy(block)
        .count()
        .withColumn("upto", F.sum("count").over(running))
        .filter(F.col("upto") > n)
        .orderBy("block")
        .limit(1)
        .collect()
    )
    if not hit:
        return None
    start, rank = hit[0]["block"] * BLOCK, n - (hit[0]["upto"] - hit[0]["count"])
    inside = df.filter((F.col(ord_col) >= start) & (F.col(ord_col) < start + BLOCK)).select(ord_col)
    return inside.orderBy(ord_col).limit(rank + 1).agg(F.max(ord_col)).first()[0]


def skip_rows(df: DataFrame, ord_col: str, n: int) -> DataFrame:
    """Drop the first ``n`` rows by ``ord_col``. Runs ``nth_row`` when ``n`` is positive."""
    if n <= 0:
        return df
    cut = nth_row(df, ord_col, n)
    return df.filter(F.lit(False)) if cut is None else df.filter(F.col(ord_col) >= cut)


def take_rows(df: DataFrame, ord_col: str, n: int | None) -> DataFrame:
    """Keep the first ``n`` rows by ``ord_col``; None and 0 mean all. Runs ``nth_row`` otherwise."""
    if not n:
        return df
    cut = nth_row(df, ord_col, n)
    return df if cut is None else df.filter(F.col(ord_col) < cut)
