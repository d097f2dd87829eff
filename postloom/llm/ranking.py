"""Global positions and running totals without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.session import materialize


def positions(df: DataFrame, order: list[Column], total: str | None = None) -> DataFrame:
    """``df`` with ``position`` (from 0, in ``order``) and, where a column ``total`` of whole numbers is named,
    ``before``: its sum over all earlier rows. Runs the sort as a job.

    A range sort spreads the rows evenly whatever single value is frequent, as long as the whole order is not one value.
    Each partition's size and sum, a row per partition, are summed in a window of that many rows; rows then add their
    place inside their partition.
    """
    at = F.monotonically_increasing_id()
    placed = materialize(df.sort(*order).withColumn("_at", at), "sorted")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    size = F.col(total) if total else F.lit(0)
    parts = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.sum(size).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum_before"),
    )
    offsets = materialize(offsets, "offsets")
    out = placed.join(offsets, "_part").withColumn(
        "position", F.col("_rows_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    )
    if total:
        inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn("before", F.col("_sum_before") + F.sum(total).over(inside) - F.col(total))
    return out.drop("_at", "_part", "_rows_before", "_sum_before")
