"""Counts, filters and top-k reports over event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def of_type(df: DataFrame, value: str, col: str = "type") -> DataFrame:
    return df.where(F.col(col) == value)


def since_days(df: DataFrame, ts: str, n: int, as_of=None) -> DataFrame:
    """Rows from midnight ``n`` days before ``as_of`` on (inclusive).

    ``as_of`` is a date, a date text, a column, or a one-row one-column
    DataFrame, which becomes a scalar subquery and still reaches the scan.
    """
    if as_of is None:
        day = F.current_date()
    elif isinstance(as_of, DataFrame):
        day = F.to_date(as_of.scalar())
    else:
        day = F.to_date(as_of if isinstance(as_of, Column) else F.lit(as_of))
    bound = F.date_sub(day, n).cast(df.schema[ts].dataType)
    return df.where(F.col(ts) >= bound)


def count_all(df: DataFrame, name: str = "total_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_where(df: DataFrame, pred: Column, name: str = "n") -> DataFrame:
    """The predicate stays a filter so that it can be pushed into the scan."""
    return df.where(pred).agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, cols: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def recent(df: DataFrame, ts: str, n: int = 20, tie: list[str] | None = None) -> DataFrame:
    """The ``n`` newest rows; ``tie`` columns order rows of equal time, newest first."""
    return df.orderBy(F.desc(ts), *[F.desc(t) for t in tie or []]).limit(n)


def top_k(df: DataFrame, group: str, k: int = 10, name: str = "n") -> DataFrame:
    """Largest groups by row count; equal counts order by the group."""
    return count_by(df, [group], name).orderBy(F.desc(name), F.asc(group)).limit(k)


def page(df: DataFrame, key: str | list[str], n: int = 50) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return df.orderBy(*keys).limit(n)


def head_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def random_row(df: DataFrame, seed: int = 0, key: list[str] | None = None) -> DataFrame:
    """One row that looks random: the smallest hash of seed and key (all columns without one).

    The same row for the same data and seed, however the rows are dealt to tasks.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key or df.columns])
    return df.orderBy(F.md5(text.cast("binary"))).limit(1)


def select_available(df: DataFrame, cols: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])
