"""Metric samples derived from the ``events`` table, and the same as SQL.

Label and value expressions are text that both engines read alike.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.operators.metrics import as_counter, label_key
from topiclake.plans.bound import load

REGION = "'region-' || cast(user_id % 3 as string)"
CHANNEL = "'channel-' || cast(user_id % 2 as string)"
INSTANCE = "'node-' || cast(user_id % 3 as string)"
PARTITION = "cast(user_id % 4 as string)"
CONSUMER = "'group-' || cast(user_id % 2 as string)"
DIRECTION = "case when event_type in ('view', 'click') then 'in' else 'out' end"
REQUEST = "case event_type when 'view' then 'Fetch' when 'click' then 'Produce' else 'OffsetCommit' end"
TOPIC_REQUEST = "case when event_type in ('view', 'click') then 'fetch' else 'produce' end"
ERROR = "case event_type when 'error' then 'TIMEOUT' when 'signup' then 'FULL' else 'NONE' end"
MEMORY = "case when event_type = 'error' then 'nonheap' else 'heap' end"
TYPE = "event_type"
JOB = "'cluster-1'"

# fixed values: histogram bounds in seconds
BOUNDS = ["0.05", "0.1", "0.2", "0.4", "0.8", "1.6", "3.2"]


@dataclass
class Source:
    """``counter``: running total of ``value`` (or of rows); ``raw``: the value itself; ``histogram``: running bucket counts."""

    kind: str
    labels: dict[str, str]
    value: str = "value"
    where: str = "true"
    sorted_labels: list[str] = field(init=False)

    def __post_init__(self):
        names = [*self.labels, "le"] if self.kind == "histogram" else list(self.labels)
        self.sorted_labels = sorted(names)


def _raw(value: str = "value", where: str = "true", **labels: str) -> Source:
    return Source("raw", labels, value, where)


def _counter(value: str = "1", where: str = "true", **labels: str) -> Source:
    return Source("counter", labels, value, where)


def _histogram(value: str, **labels: str) -> Source:
    return Source("histogram", labels, value)


_BY_TOPIC = {"job": JOB, "topic": TYPE, "partition": PARTITION, "instance": INSTANCE}

# fixed values: names of metrics and labels that the panels ask for. Where a source has a condition, the rest of the rows
# makes the side without a partner, which joins and ratios have to show.
SOURCES: dict[str, Source] = {
    "demo_orders_total": _counter(region=REGION, channel=CHANNEL, status=TYPE),
    "demo_payment_failures_total": _counter(where="event_type = 'error'", region=REGION),
    "demo_revenue_total": _counter("value", region=REGION, currency="'USD'"),
    "demo_cart_events_total": _counter(region=REGION, event=TYPE),
    "demo_product_views_total": _counter(where="event_type = 'view'", region=REGION, shop_id="'shop-' || cast(user_id as string)"),
    "demo_active_users": _raw(region=REGION),
    "demo_queue_depth": _raw("value + 1", region=REGION, channel=CHANNEL),
    "demo_workload_scenario": _raw("user_id % 2", scenario=TYPE),
    "demo_workload_target_series": _raw("user_id * 1.0"),
    "demo_checkout_latency_seconds_bucket": _histogram("value / 100.0", region=REGION),
    "prometheus_remote_storage_samples_total": _counter(url=INSTANCE),
    "cortex_distributor_received_samples_total": _counter("value", instance=INSTANCE),
    "cortex_ingest_storage_writer_input_bytes_total": _raw("value * 10", instance=INSTANCE),
    "cortex_ingest_storage_writer_latency_seconds_bucket": _histogram("value / 200.0", instance=INSTANCE),
    "cortex_ingest_storage_reader_receive_delay_seconds_bucket": _histogram("value / 50.0"),
    "cortex_distributor_ingest_storage_enabled": _raw("1.0", instance=INSTANCE),
    "cortex_ingest_storage_reader_records_total": _raw(where="user_id % 3 < 2", zone="'zone-' || cast(user_id % 3 as string)"),
    "cortex_ingest_storage_reader_requests_total": _raw("value + 5", zone="'zone-' || cast(user_id % 3 as string)"),
    "jvm_cpu_recent_utilization_ratio": _raw("value / 500.0", job=JOB, instance=INSTANCE),
    "jvm_memory_used_bytes": _raw("value", job=JOB, instance=INSTANCE, jvm_memory_type=MEMORY),
    "jvm_memory_limit_bytes": _raw("value + user_id % 5 * 50", job=JOB, instance=INSTANCE, jvm_memory_type=MEMORY),
    "kafka_broker_active_count": _raw("user_id % 7", job=JOB, instance=INSTANCE),
    "kafka_topic_count": _raw("user_id % 11", job=JOB, instance=INSTANCE),
    "kafka_partition_count": _raw("user_id % 13", job=JOB, instance=INSTANCE),
    "kafka_tableworker_eventloop_busy_ratio_percent": _raw("value / 5", job=JOB, instance=INSTANCE),
    "kafka_request_count_total": _counter(job=JOB, instance=INSTANCE, type=REQUEST),
    "kafka_message_count_total": _raw(direction=DIRECTION, **_BY_TOPIC),
    "kafka_stream_network_inbound_usage_bytes_total": _raw("value * 3", instance=INSTANCE),
    "kafka_stream_network_outbound_usage_bytes_total": _raw("value * 2", instance=INSTANCE),
    "kafka_tabletopic_delay_milliseconds": _raw(job=JOB, topic=TYPE),
    "kafka_tabletopic_fields_per_second": _raw("value * 6", job=JOB, topic=TYPE),
    "kafka_tabletopic_fps": _raw("value * 7", job=JOB, topic=TYPE),
    "kafka_log_end_offset": _raw("event_id + 1", **_BY_TOPIC),
    "kafka_group_commit_offset": _raw("event_id", "user_id % 4 < 3", job=JOB, topic=TYPE, partition=PARTITION, consumer_group=CONSUMER),
    "kafka_log_size": _raw("value * 100", **_BY_TOPIC),
    "kafka_request_error_count_total": _raw(job=JOB, instance=INSTANCE, error=ERROR),
    "kafka_server_connection_count": _raw("user_id % 50", instance=INSTANCE, listener=CHANNEL, job=JOB),
    "kafka_stream_partition_status_statistics": _raw("user_id % 3", instance=INSTANCE, status=TYPE),
    "kafka_broker_network_io_bytes_total": _raw(job=JOB, instance=INSTANCE, direction=DIRECTION),
    "kafka_network_io_bytes_total": _raw("value * 8", direction=DIRECTION, **_BY_TOPIC),
    "kafka_topic_request_count_total": _raw("value * 4", job=JOB, instance=INSTANCE, topic=TYPE, type=TOPIC_REQUEST),
    "kafka_stream_topic_partition_count": _raw("user_id % 9", topic=TYPE, node_id=INSTANCE, rack=CHANNEL),
    **{
        f"kafka_request_time_{s}_milliseconds": _raw(f"value * {k}", instance=INSTANCE, type=REQUEST)
        for s, k in (("99p", 9), ("mean", 2), ("50p", 1), ("max", 12))
    },
}


def _labels(src: Source) -> dict[str, Column]:
    return {n: F.expr(e) for n, e in src.labels.items()}


def _one(events: DataFrame, metric: str) -> DataFrame:
    src = SOURCES[metric]
    df = events.where(src.where)
    labels, value = _labels(src), F.expr(src.value)
    if src.kind == "raw":
        return df.select(
            F.lit(metric).alias("metric"),
            label_key(labels).alias("series_key"),
            F.create_map(*[x for n, c in labels.items() for x in (F.lit(n), c)]).cast("map<string,string>").alias("labels"),
            F.col("ts").cast("timestamp").alias("ts"),
            value.cast("double").alias("value"),
        )
    if src.kind == "counter":
        increment = None if src.value == "1" else value
        return as_counter(df, metric, labels, increment=increment, tie="event_id")
    bounds = F.array(*[F.struct(F.lit(b).alias("le"), F.lit(float(b)).alias("upper")) for b in [*BOUNDS, "inf"]])
    df = df.select("*", F.explode(bounds).alias("_b"))
    labels["le"] = F.when(F.col("_b.le") == "inf", F.lit("+Inf")).otherwise(F.col("_b.le"))
    increment = (value <= F.col("_b.upper")).cast("int")
    return as_counter(df, metric, labels, increment=increment, tie="event_id")


def samples(spark: SparkSession, sf_dir: str, metrics: list[str]) -> DataFrame:
    """Samples of the named metrics."""
    events = load(spark, sf_dir, "events")
    return reduce(DataFrame.unionByName, [_one(events, m) for m in metrics])


def _key_sql(labels: list[str]) -> str:
    """The series key text: labels in name order."""
    parts = " || ',' || ".join(f"'\"{n}\":\"' || \"{n}\" || '\"'" for n in labels)
    return f"'{{' || {parts} || '}}'" if labels else "'{}'"


def samples_sql(metric: str, where: str = "true") -> str:
    """``sk``, the label columns, ``t`` (epoch microseconds) and ``v``."""
    src = SOURCES[metric]
    names = ", ".join(f'"{n}"' for n in src.sorted_labels)
    names = f"{names}, " if names else ""
    cols = "".join(f'{e} AS "{n}", ' for n, e in src.labels.items())
    if src.kind == "raw":
        body = f"SELECT {cols} ts, event_id, cast({src.value} AS double) AS v FROM events WHERE {src.where}"
    elif src.kind == "counter":
        by = "".join(f"{e}, " for e in src.labels.values())
        part = f"PARTITION BY {by.rstrip(', ')}" if by else ""
        body = (
            f"SELECT {cols} ts, event_id, cast(sum(cast({src.value} AS decimal(28,6))) OVER ({part} ORDER BY ts, event_id "
            f"ROWS UNBOUNDED PRECEDING) AS double) AS v FROM events WHERE {src.where}"
        )
    else:
        les = ", ".join(f"('{b}', {b})" for b in BOUNDS) + ", ('+Inf', cast('inf' AS double))"
        by = "".join(f"{e}, " for e in src.labels.values())
        body = (
            f"SELECT {cols} le, ts, event_id, cast(sum(CASE WHEN {src.value} <= upper THEN 1 ELSE 0 END) OVER "
            f"(PARTITION BY {by}le ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS double) AS v "
            f"FROM events, (VALUES {les}) b(le, upper) WHERE {src.where}"
        )
    return (
        f"SELECT {_key_sql(src.sorted_labels)} AS sk, {names}epoch_us(ts) AS t, max(v) AS v "
        f"FROM ({body}) WHERE {where} GROUP BY ALL"
    )
