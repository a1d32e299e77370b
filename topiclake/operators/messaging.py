"""Delivery checks and latency statistics over message logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclake.functions.scalars import epoch_us


def _ms(col) -> Column:
    return epoch_us(col) / F.lit(1000.0)


def reconcile(sent: DataFrame, received: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only: ``status`` is ``missing`` (never received) or ``extra``.

    Both sides are counted per key before the join, so repeated keys shrink on
    the map side and the join sees each key once.
    """
    a = sent.groupBy(*keys).agg(F.count(F.lit(1)).alias("sent_count"))
    b = received.groupBy(*keys).agg(F.count(F.lit(1)).alias("received_count"))
    return (
        a.join(b, keys, "full_outer")
        .where(F.col("sent_count").isNull() | F.col("received_count").isNull())
        .select(
            *keys,
            F.when(F.col("received_count").isNull(), "missing").otherwise("extra").alias("status"),
            F.coalesce("sent_count", "received_count").alias("messages"),
        )
    )


def delivery_metrics(
    log: DataFrame,
    sent: str = "sent_at",
    acked: str = "acked_at",
    received: str = "received_at",
) -> DataFrame:
    """Counts, total and consume time, mean produce and end-to-end latency (ms), in one aggregate.

    Means divide by the messages really sent or received.
    """
    s, a, r = _ms(sent), _ms(acked), _ms(received)
    return log.agg(
        F.count(s).alias("messages_sent"),
        F.count(r).alias("messages_received"),
        (F.greatest(F.max(r), F.max(s)) - F.min(s)).alias("total_ms"),
        (F.max(r) - F.min(r)).alias("consume_ms"),
        F.avg(a - s).alias("avg_produce_ms"),
        F.avg(r - s).alias("avg_end_to_end_ms"),
    )


def consume_rate(log: DataFrame, received: str = "received_at") -> DataFrame:
    """Messages per second over the receive span; null when the span is empty."""
    r = _ms(received)
    return log.agg(F.try_divide(F.count(r) * F.lit(1000.0), F.max(r) - F.min(r)).alias("messages_per_second"))


def batch_stats(log: DataFrame, by: list[str], ok: str = "ok", ts: str = "sent_at") -> DataFrame:
    """Delivered and failed messages and throughput per batch."""
    t = epoch_us(ts)
    seconds = (F.max(t) - F.min(t)) / F.lit(1e6)
    return log.groupBy(*by).agg(
        F.count_if(F.col(ok)).alias("delivered"),
        F.count_if(~F.col(ok)).alias("failed"),
        F.coalesce(F.try_divide(F.count(F.lit(1)).cast("double"), seconds), F.lit(0.0)).alias("messages_per_second"),
    )


def with_latency(df: DataFrame, ts: str = "timestamp", received: str | None = None) -> DataFrame:
    """Adds ``latency_ms`` from the message time to ``received`` (now, when not stored)."""
    until = F.unix_millis(F.current_timestamp() if received is None else F.col(received).cast("timestamp"))
    return df.withColumn("latency_ms", until - F.unix_millis(F.col(ts).cast("timestamp")))


def topic_overview(messages: DataFrame) -> DataFrame:
    """Partitions, messages, bytes and end offset per topic.

    Reduces to one row per partition first; no distinct aggregate is needed.
    """
    size = F.coalesce(F.octet_length("value"), F.lit(0)) + F.coalesce(F.octet_length("key"), F.lit(0))
    per_partition = messages.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"), F.sum(size.cast("bigint")).alias("b"), F.max("offset").alias("o")
    )
    return per_partition.groupBy("topic").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("n").alias("messages"),
        F.sum("b").alias("bytes"),
        F.max("o").alias("max_offset"),
    )
