"""The star schema: one parent table and five child tables.

Keys and which duplicate survives: ``tweets`` by tweet_id, the last wins; ``tweet_causes`` by (tweet_id,
cause_category), the last item of the list wins; ``tweet_products``, ``tweet_brands`` and ``tweet_barriers`` by
tweet_id and their second column, the first wins; ``tweet_aspects`` keeps every item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.schemas import ASPECTS, BARRIERS, CAUSES, STAR

CHILDREN = ("tweet_causes", "tweet_products", "tweet_brands", "tweet_barriers", "tweet_aspects")


def first_per_key(items: Column, key) -> Column:
    """Array without items whose key occurred earlier in it. Lists belong to one row, so no shuffle is needed."""
    return F.filter(items, lambda x, i: F.array_position(F.transform(items, key), key(x)) == i + 1)


def last_per_key(items: Column, key) -> Column:
    """Array without items whose key occurs again later in it."""
    return F.reverse(first_per_key(F.reverse(items), key))


def last_per_id(df: DataFrame, ord_col: str, id_col: str = "tweet_id") -> DataFrame:
    """Last row of each id by ``ord_col``, reduced inside each task before the shuffle."""
    rest = [c for c in df.columns if c != id_col]
    last = df.groupBy(id_col).agg(F.max_by(F.struct(*rest), ord_col).alias("_row"))
    return last.select(id_col, "_row.*")


def first_per_id(df: DataFrame, ord_col: str, id_col: str = "tweet_id") -> DataFrame:
    """First row of each id by ``ord_col``, likewise."""
    rest = [c for c in df.columns if c != id_col]
    first = df.groupBy(id_col).agg(F.min_by(F.struct(*rest), ord_col).alias("_row"))
    return first.select(id_col, "_row.*")


def _children(df: DataFrame, keep: list[str], generator: Column) -> DataFrame:
    """Rows of a generator, without the empty row an outer one gives.

    A plain ``explode`` makes the optimizer add a ``size > 0`` test below it, which computes the whole list twice.
    """
    out = df.select(*keep, generator)
    first = out.columns[len(keep)]
    return out.filter(F.col(first).isNotNull())


def explode_causes(df: DataFrame, id_col: str = "tweet_id", causes: str = "causes") -> DataFrame:
    kept = last_per_key(F.col(causes), lambda x: x["cause_category"])
    return _children(df, [id_col], F.inline_outer(kept)).select(id_col, "cause_category", "matched_sentence")


def explode_products(df: DataFrame, id_col: str = "tweet_id", products: str = "products") -> DataFrame:
    return _children(df, [id_col], F.explode_outer(F.array_distinct(products)).alias("product_type"))


def explode_brands(
    df: DataFrame, id_col: str = "tweet_id", brands: str = "brands_raw", canonical: str | None = "brands_canonical"
) -> DataFrame:
    """Names compare case-sensitively; a name the map lacks is its own canonical name."""
    kept = F.array_distinct(F.transform(brands, lambda x: x["brand_raw"]))
    out = _children(df, [id_col, *([canonical] if canonical else [])], F.explode_outer(kept).alias("brand_raw"))
    mapped = F.try_element_at(F.col(canonical), F.col("brand_raw")) if canonical else F.lit(None).cast("string")
    return out.select(id_col, "brand_raw", F.coalesce(mapped, F.col("brand_raw")).alias("brand_canonical"))


def explode_barriers(
    df: DataFrame, id_col: str = "tweet_id", barriers: str = "barriers", coded_by: str = "coded_by"
) -> DataFrame:
    kept = F.array_distinct(F.transform(barriers, lambda x: x["barrier_code"]))
    out = _children(df, [id_col, coded_by], F.explode_outer(kept).alias("barrier_code"))
    return out.select(id_col, "barrier_code", coded_by)


def explode_aspects(df: DataFrame, id_col: str = "tweet_id", aspects: str = "aspects") -> DataFrame:
    return _children(df, [id_col], F.inline_outer(aspects)).select(id_col, "aspect", "sentiment", "span_text")


def star_columns(table: str) -> list[str]:
    return [f.strip().split(" ")[0] for f in STAR[table].split(", ")]


def parent_table(enriched: DataFrame) -> DataFrame:
    """The parent's columns of enriched posts."""
    have = set(enriched.columns)
    parent = enriched.withColumnRenamed("intent", "intent_label") if "intent" in have else enriched
    if "embedding" not in have:
        parent = parent.withColumn("embedding", F.lit(None).cast("array<float>"))
    vector = F.when(F.size("embedding") > 0, F.col("embedding")).alias("embedding")
    return parent.select(*[vector if c == "embedding" else F.col(c) for c in star_columns("tweets")])


def child_tables(enriched: DataFrame) -> dict[str, DataFrame]:
    """The five child tables of enriched posts, or of their labels alone."""
    have = set(enriched.columns)
    return {
        "tweet_causes": explode_causes(enriched),
        "tweet_products": explode_products(enriched),
        "tweet_brands": explode_brands(enriched, canonical="brands_canonical" if "brands_canonical" in have else None),
        "tweet_barriers": explode_barriers(enriched),
        "tweet_aspects": explode_aspects(enriched),
    }


def star_tables(enriched: DataFrame) -> dict[str, DataFrame]:
    """The six tables of a batch whose ids are unique (see ``last_per_id``). Five scans of one table, no shuffle."""
    return {"tweets": parent_table(enriched), **child_tables(enriched)}


def upsert(old: DataFrame, new: DataFrame, batch_ids: DataFrame, id_col: str = "tweet_id") -> DataFrame:
    """Replace all rows of the ids in the batch. ``batch_ids`` are the parents' ids, so vanished children go too."""
    return old.join(batch_ids.select(id_col), id_col, "left_anti").unionByName(new.select(*old.columns))


def vector_json(c: Column) -> Column:
    """Vector as JSON text for exports; empty or null gives null."""
    return F.when(F.size(c) > 0, F.to_json(c))


__all__ = [
    "ASPECTS", "BARRIERS", "CAUSES", "CHILDREN", "child_tables", "explode_aspects", "explode_barriers", "explode_brands",
    "explode_causes", "explode_products", "first_per_id", "first_per_key", "last_per_id", "last_per_key", "parent_table",
    "star_columns", "star_tables", "upsert", "vector_json",
]
