"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # JSON in the wild repeats keys; the last one wins, as in most parsers.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators rely on; leaves cluster sizing to the cluster."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


# Writer options of tables that hold whole texts.
TEXTS = {"compression": "zstd"}


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """Inside, rows cross to Python in batches of about ``size`` bytes, however long their texts are: what a worker holds
    does not follow its input, as it does up to the default of 10,000 rows."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def open_folders(spark: SparkSession, folders: int) -> Iterator[None]:
    """Inside, a task that writes to up to so many folders keeps a file open in each, instead of sorting its rows by folder."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(folders))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one in ``spark.checkpoint.dir``, or a private one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="postloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a cut point; a written table survives lost executors and drops the lineage."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A table without rows which the optimizer knows to be empty, so that joins and unions with it vanish."""
    fields = T.StructType.fromDDL(schema).fields
    return spark.range(1).filter("false").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    )


def materialize(df: DataFrame, name: str, by: str | None = None, at: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` once and read it back: the cut point between stages that several outputs share. ``by`` is a column
    whose values get folders of their own, which a filter on it prunes; ``at`` is a path to write to instead of scratch;
    ``options`` are those of the writer."""
    spark = df.sparkSession
    path = at or scratch_path(spark, name)
    (df.write.partitionBy(by) if by else df.write).options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
