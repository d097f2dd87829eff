"""Proportional stratified interleaving into shards.

Inside each source the rows are shuffled by a seeded hash and ranked. Row r of n gets the fractional rank (2r - 1)/2n.
Sorting all rows by it interleaves the sources so that every stretch holds them in proportion, and cutting the order
into equal runs gives shards that match the mixture. DataFrame functions only; the texts stay in the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import utf8
from postloom.llm.ranking import positions
from postloom.session import materialize

SHARDS = 40
SEED = 17


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs(doc_id, text, source)``.

    The law is ``rows``: shard sizes differ by one row at most, and each shard holds each source in proportion. ``slot``
    counts from 0 in every shard, in the interleaved order. ``size`` is the text's UTF-8 bytes plus 16. Null text counts
    as empty. Rows without a source are a source of their own. Null doc_ids and repeated rows are rows like any other;
    rows equal in doc_id, source and text are interchangeable. With fewer rows than shards some shards stay empty; no
    rows give no rows. Further columns are not read.
    """
    body = F.coalesce(utf8(F.col("text")), F.lit(b""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    rows = rows.withColumn("shuffle", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
    ranked = positions(rows, [F.col(c) for c in ("source", "shuffle", "doc_id", "text_crc32", "size")])
    ranked = materialize(ranked, "ranked")
    sources = ranked.groupBy(F.col("source").alias("_source")).agg(F.min("position").alias("first"), F.count("*").alias("n"))
    sources = materialize(sources, "sources")
    placed = ranked.join(sources, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "fraction", ((F.col("position") - F.col("first")) * 2 + 1).cast("double") / (F.col("n") * 2)
    )
    columns = ("doc_id", "source", "size", "text_crc32", "fraction")
    # Equal fractions: the source decides, and within a source no two rows have the same.
    order = positions(placed.select(*columns), [F.col("fraction"), F.col("source")])
    total = ranked.count()
    # Shard s holds positions from ceil(s * total / shards) on.
    number = F.expr(f"position * {shards}L div {max(1, total)}L")
    start = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return order.withColumn("shard", number).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("position") - start).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
