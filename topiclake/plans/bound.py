"""Registry of the named queries that run over the given tables.

Each query has a DataFrame side and, where SQL can say the same, a SQL side
that serves as its check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def plain_times(df: DataFrame) -> DataFrame:
    """Result timestamps without a zone, as the given tables have them."""
    cols = [F.col(f"`{n}`").cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(f"`{n}`") for n, t in df.dtypes]
    return df.select(*cols)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and its SQL check."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_times(fn(use_utc(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register
