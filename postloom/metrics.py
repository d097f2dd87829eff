"""Stage counters, taken while the data flows (no extra pass)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def counted(df: DataFrame, **counters: Column) -> tuple[DataFrame, Observation]:
    """``df`` with an observation; read ``observation.get`` after the first action on the result."""
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in counters.items()]), seen
