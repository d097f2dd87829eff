"""Registry, and input expressions that read the same in Spark SQL and DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB equivalent."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def costly(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table."""
    return table(spark, sf_dir, name).select(*columns)


# Unicode white space, word characters and links, as DuckDB spells them.
WS = r"\t-\r\x1c-\x1f\x{85}\p{Z}"
URL = rf"https?://[^{WS}]+"
WORD = r"\p{L}\p{N}_"

# The number inside events.props, {"k": 69}.
K = "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT)"
