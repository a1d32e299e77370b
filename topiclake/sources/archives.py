"""Hourly archives of JSON lines and the plan of a resumable backfill."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.session import child_names

# fixed value: how the hourly archives are named
HOURLY_NAME = "{day}-{hour}.json.gz"
EVENT_LINES_SCHEMA = "value string, file string"


def hour_names(start: datetime, end: datetime, name: str = HOURLY_NAME) -> list[str]:
    """Archive names of the hours in ``[start, end)``; the hour is not padded."""
    hour = start.replace(minute=0, second=0, microsecond=0)
    out = []
    while hour < end:
        out.append(name.format(day=hour.strftime("%Y-%m-%d"), hour=hour.hour))
        hour += timedelta(hours=1)
    return out


def read_hourly_json(spark: SparkSession, root: str, start: datetime, end: datetime, name: str = HOURLY_NAME) -> DataFrame:
    """Lines of the archives in ``[start, end)`` as ``value``; absent hours give no rows.

    A name may also be a folder. The root is listed once, only the named hours are read.
    """
    there = set(child_names(spark, root))
    names = [n for n in hour_names(start, end, name) if n in there]
    if not names:
        return spark.createDataFrame([], "value string")
    return spark.read.text(f"{root}/{{{','.join(names)}}}")


def hour_label(ts: Column, name: str = HOURLY_NAME) -> Column:
    """Archive name of a time as a column."""
    day, hour = F.date_format(ts, "yyyy-MM-dd"), F.hour(ts).cast("string")
    before, rest = name.split("{day}")
    middle, after = rest.split("{hour}")
    return F.concat(F.lit(before), day, F.lit(middle), hour, F.lit(after))


def plan_hours(spark: SparkSession, now, last_done, available: DataFrame) -> DataFrame:
    """Hours the next cycle should load, in order.

    The span is three days ago to three hours ago, both floored to the hour and
    half open, and starts after ``last_done`` when that is given. An hour that
    ``available`` (``hour timestamp``, ``events bigint``) lacks or has empty
    stops the cycle, so the following cycle retries it. ``now`` may be a one-row
    one-column DataFrame.
    """
    at = now.scalar() if isinstance(now, DataFrame) else F.lit(now)
    at = at.cast("timestamp")
    first = F.date_trunc("hour", at - F.expr("interval 3 days"))
    stop = F.date_trunc("hour", at - F.expr("interval 3 hours"))
    if last_done is not None:
        first = F.greatest(first, F.date_trunc("hour", F.lit(last_done).cast("timestamp")) + F.expr("interval 1 hour"))
    last = stop - F.expr("interval 1 hour")
    span = F.sequence(first, last, F.expr("interval 1 hour"))
    wanted = spark.range(1).select(F.explode(F.when(first <= last, span)).alias("hour"))
    have = (
        available.where(F.col("events") > 0)
        .select(F.date_trunc("hour", F.col("hour").cast("timestamp")).alias("hour"))
        .distinct()
    )
    gap = wanted.join(have, "hour", "left_anti").agg(F.min("hour"))
    return wanted.where(F.coalesce(F.col("hour") < gap.scalar(), F.lit(True))).orderBy("hour")
