"""Latest-row-per-key logic shared by upsert and change-data tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The row with the largest ``order`` tuple per key.

    An aggregate, not a ranking window: each task first keeps one row per key,
    so a key that holds most rows never travels whole to a single task.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def apply_changes(df: DataFrame, keys: list[str], order: list[str | Column], op_col: str = "_cdc.op") -> DataFrame:
    """Final rows of a change feed: newest change per key, without deleted keys."""
    return latest_by_key(df, keys, order).where(F.col(op_col) != "d")


def union_versions(*dfs: DataFrame) -> DataFrame:
    """Rows written under several schema versions; missing columns read null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
