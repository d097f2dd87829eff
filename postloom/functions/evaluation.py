"""Computing a costly column once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that later filters and projections reuse instead of recomputing.

    The optimizer moves filters below projections by copying the projected expressions into them, so a filter on a
    parsed document parses it again for every mention. The output of a generator is never copied; a one-row ``inline``
    is the cheapest generator, stays inside code generation and moves no data.
    """
    made = F.inline_outer(F.array(F.struct(*[c.alias(name) for name, c in cols.items()])))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in cols], made)
