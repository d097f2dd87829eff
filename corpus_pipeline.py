"""From raw documents to packed training sequences: quality, near-duplicates, copied passages, mixture, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm import mixing, packing, quality, simhash, substring
from postloom.session import scratch_path, tune

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of ``documents``, the number of characters that of the text as it is now."""
    size = F.coalesce(F.char_length("text"), F.lit(0)).cast("long")
    return rows.withColumn("n_chars", size).select(*COLUMNS)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _documents(quality.keep_good(docs, labels))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return _documents(simhash.keep_one(docs))


def without_copied_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds; those of which nothing is left go."""
    cleaned = substring.remove_copied(docs).filter("n_words > n_removed or n_removed = 0")
    return _documents(cleaned.withColumnRenamed("kept", "text"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target mixture of sources, repeats as rows."""
    return _documents(mixing.apply_mix(docs))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("simhash near-dedup", one_of_each_group),
    ("substring dedup", without_copied_passages),
    ("source mixing", mixed_sources),
    ("best-fit packing", packed_sequences),
]

# A fitted classifier and a tokenizer are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each one's rows written to the shared folder in between."""
    tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
