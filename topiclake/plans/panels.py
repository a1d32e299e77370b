"""Dashboard panels as named queries over a samples table.

A panel takes ``(samples, window, step)`` plus optional matchers that apply to
each of its metrics, and returns a range result: ``step``, label columns, ``value``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from topiclake.functions.scalars import classify
from topiclake.operators import metrics as M

Matchers = list[tuple[str, str, str]]
GROUP = M.GROUP
# fixed values: the names of metrics, labels and panels below are those of the dashboards that are asked for
FIELDS_NAMES = "kafka_tabletopic_fps_fields/s|kafka_tabletopic_fps_fields_per_second|kafka_tabletopic_fields_per_second"
DEFAULT_LOOKBACK = "5m"


def rates(samples: DataFrame, window: str, step: str, metric: str | None = None, where: Matchers | None = None, extra: Matchers | None = None, name_regex: str | None = None) -> DataFrame:
    return M.rate(M.select_series(samples, metric, [*(where or []), *(extra or [])], name_regex), window, step)


def gauges(samples: DataFrame, window: str, step: str, metric: str | None = None, where: Matchers | None = None, extra: Matchers | None = None, name_regex: str | None = None, lookback: str | None = None) -> DataFrame:
    picked = M.select_series(samples, metric, [*(where or []), *(extra or [])], name_regex)
    return M.gauge_range(picked, step, lookback or DEFAULT_LOOKBACK)


def _rate(metric: str, where: Matchers | None = None) -> Callable:
    """Rate of each series."""

    def panel(samples, window, step, extra=None, lookback=None):
        return rates(samples, window, step, metric, where, extra)

    return panel


def _rate_sum(metric: str, by: list[str] | None = None, where: Matchers | None = None) -> Callable:
    """``sum by (labels) (rate(metric))``."""

    def panel(samples, window, step, extra=None, lookback=None):
        return M.agg_by(rates(samples, window, step, metric, where, extra), "sum", by)

    return panel


def _rate_sum_of_max(metric: str, inner: list[str], outer: list[str], where: Matchers | None = None) -> Callable:
    def panel(samples, window, step, extra=None, lookback=None):
        return M.sum_of_max(rates(samples, window, step, metric, where, extra), inner, outer)

    return panel


def _gauge(metric: str | None, where: Matchers | None = None, name_regex: str | None = None) -> Callable:
    def panel(samples, window, step, extra=None, lookback=None):
        return gauges(samples, window, step, metric, where, extra, name_regex, lookback)

    return panel


def _gauge_agg(fn: str, metric: str, by: list[str] | None = None, where: Matchers | None = None) -> Callable:
    def panel(samples, window, step, extra=None, lookback=None):
        return M.agg_by(gauges(samples, window, step, metric, where, extra, lookback=lookback), fn, by)

    return panel


def _gauge_sum_of_max(metric: str, inner: list[str], outer: list[str]) -> Callable:
    def panel(samples, window, step, extra=None, lookback=None):
        return M.sum_of_max(gauges(samples, window, step, metric, None, extra, lookback=lookback), inner, outer)

    return panel


def _quantiles(metric: str, phis: list[float]) -> Callable:
    """``histogram_quantile(phi, sum(rate(metric)) by (le))``."""

    def panel(samples, window, step, extra=None, lookback=None):
        buckets = M.agg_by(rates(samples, window, step, metric, None, extra), "sum", ["le"])
        return M.histogram_quantile(buckets, phis, ["step"])

    return panel


def _failure_rate(samples, window, step, extra=None, lookback=None):
    return M.ratio(
        _rate_sum("demo_payment_failures_total")(samples, window, step, extra),
        _rate_sum("demo_orders_total")(samples, window, step, extra),
    )


def _consumption_by_zone(samples, window, step, extra=None, lookback=None):
    records = _rate_sum("cortex_ingest_storage_reader_records_total", ["zone"])(samples, window, step, extra)
    requests = _rate_sum("cortex_ingest_storage_reader_requests_total", ["zone"])(samples, window, step, extra)
    return M.vector_or(records, requests)


CPU_STEPS = [(None, "green"), (70, "yellow"), (90, "red")]
HEAP_STEPS = [(None, "green"), (70, "yellow"), (85, "red")]


def _cpu_percent(samples, window, step, extra=None, lookback=None):
    cpu = M.scale(gauges(samples, window, step, "jvm_cpu_recent_utilization_ratio", None, extra, lookback=lookback), 100)
    return cpu.withColumn("status", classify("value", CPU_STEPS))


def _heap_percent(samples, window, step, extra=None, lookback=None):
    heap = [("jvm_memory_type", "=", "heap")]
    used = gauges(samples, window, step, "jvm_memory_used_bytes", heap, extra, lookback=lookback)
    limit = gauges(samples, window, step, "jvm_memory_limit_bytes", heap, extra, lookback=lookback)
    return M.scale(M.binary_op(used, limit, "/"), 100).withColumn("status", classify("value", HEAP_STEPS))


def _partition_total(samples, window, step, extra=None, lookback=None):
    sizes = M.agg_by(gauges(samples, window, step, "kafka_log_size", None, extra, lookback=lookback), "max", ["topic", "partition"])
    return M.agg_by(M.agg_by(sizes, "count", ["topic"]), "sum")


def _latest(metric: str) -> Callable:
    """Stat panel: newest value of every series over the range."""

    def panel(samples, window, step, extra=None, lookback=None):
        return M.reduce_series(gauges(samples, window, step, metric, None, extra, lookback=lookback), ["lastNotNull"], M.SERIES)

    return panel


def _lag(fn: Callable, **kw) -> Callable:
    def panel(samples, window, step, extra=None, lookback=None):
        commits = gauges(samples, window, step, "kafka_group_commit_offset", None, extra, lookback=lookback)
        ends = gauges(samples, window, step, "kafka_log_end_offset", None, [m for m in extra or [] if m[0] != GROUP], lookback=lookback)
        return fn(commits, ends, **kw)

    return panel


def _throughput(by_partition: bool) -> Callable:
    def panel(samples, window, step, extra=None, lookback=None):
        commits = M.select_series(samples, "kafka_group_commit_offset", extra)
        return M.consumer_throughput(commits, window, step, by_partition)

    return panel


def _request_time(stat: str, kind: str) -> Callable:
    return _gauge_agg("sum", f"kafka_request_time_{stat}_milliseconds", ["instance"], [("type", "=", kind)])


_IN, _OUT = [("direction", "=", "in")], [("direction", "=", "out")]

BUSINESS = {
    "orders_per_second_by_status": _rate_sum("demo_orders_total", ["status"]),
    "checkout_latency": _quantiles("demo_checkout_latency_seconds_bucket", [0.50, 0.95, 0.99]),
    "payment_failure_rate": _failure_rate,
    "active_users": _gauge_agg("sum", "demo_active_users", ["region"]),
    "revenue_per_second": _rate_sum("demo_revenue_total", ["region"]),
    "cart_events_per_second": _rate_sum("demo_cart_events_total", ["event"]),
    "queue_depth": _gauge_agg("sum", "demo_queue_depth", ["region"]),
    "active_scenario": _gauge_agg("sum", "demo_workload_scenario", ["scenario"]),
    "product_view_series": _gauge_agg("count", "demo_product_views_total"),
    "target_series": _gauge("demo_workload_target_series"),
    "product_views_per_second": _rate_sum("demo_product_views_total"),
    "remote_write_samples_per_second": _rate_sum("prometheus_remote_storage_samples_total"),
    "received_samples_per_second": _rate_sum("cortex_distributor_received_samples_total"),
    "ingest_bytes_per_second": _rate_sum("cortex_ingest_storage_writer_input_bytes_total"),
}

INGEST_LAB = {
    "samples_per_second": _rate_sum("prometheus_remote_storage_samples_total"),
    "write_latency_p99": _quantiles("cortex_ingest_storage_writer_latency_seconds_bucket", [0.99]),
    "receive_delay_p99": _quantiles("cortex_ingest_storage_reader_receive_delay_seconds_bucket", [0.99]),
    "ingest_storage_enabled": _latest("cortex_distributor_ingest_storage_enabled"),
    "bytes_per_second": _rate_sum("cortex_ingest_storage_writer_input_bytes_total"),
    "consumption_by_zone": _consumption_by_zone,
}

TABLE_TOPIC = {
    "cpu_percent": _cpu_percent,
    "heap_percent": _heap_percent,
    "brokers": _latest("kafka_broker_active_count"),
    "topics": _latest("kafka_topic_count"),
    "partitions": _latest("kafka_partition_count"),
    "worker_busy_percent": _gauge("kafka_tableworker_eventloop_busy_ratio_percent"),
    "produce_request_rate": _rate_sum("kafka_request_count_total", None, [("type", "=", "Produce")]),
    "fetch_request_rate": _rate_sum("kafka_request_count_total", None, [("type", "=", "Fetch")]),
    "message_rate_by_topic": _rate_sum("kafka_message_count_total", ["topic"], _IN),
    "network_in": _rate("kafka_stream_network_inbound_usage_bytes_total"),
    "network_out": _rate("kafka_stream_network_outbound_usage_bytes_total"),
    "table_delay": _gauge("kafka_tabletopic_delay_milliseconds"),
    "fields_per_second": _gauge(None, None, FIELDS_NAMES),
    "partition_message_rate": _rate("kafka_message_count_total", _IN),
    "partition_offset": _gauge("kafka_log_end_offset"),
}

BROKER = {
    "error_rate": _rate_sum("kafka_request_error_count_total", ["instance", "error"], [("error", "!=", "NONE")]),
    "connection_count": _gauge_agg("sum", "kafka_server_connection_count", ["instance", "listener"]),
    "partition_count": _gauge("kafka_partition_count"),
    "partition_status": _gauge("kafka_stream_partition_status_statistics"),
    "bytes_in": _rate_sum("kafka_broker_network_io_bytes_total", ["instance"], _IN),
    "bytes_out": _rate_sum("kafka_broker_network_io_bytes_total", ["instance"], _OUT),
    "messages_in": _rate_sum("kafka_message_count_total", ["instance"]),
    "bytes_in_per_topic": _rate_sum("kafka_network_io_bytes_total", ["topic", "instance"], _IN),
    "bytes_out_per_topic": _rate_sum("kafka_network_io_bytes_total", ["topic", "instance"], _OUT),
    "messages_in_per_topic": _rate_sum("kafka_message_count_total", ["topic", "instance"]),
    "produce_qps_per_topic": _rate_sum("kafka_topic_request_count_total", ["instance", "topic"], [("type", "=", "produce")]),
    "fetch_qps_per_topic": _rate_sum("kafka_topic_request_count_total", ["instance", "topic"], [("type", "=", "fetch")]),
    "total_throughput": _rate_sum("kafka_request_count_total", ["instance"], [("type", "=~", "OffsetCommit|Produce|Fetch")]),
    "produce_throughput": _rate_sum("kafka_request_count_total", ["instance"], [("type", "=", "Produce")]),
    "fetch_throughput": _rate_sum("kafka_request_count_total", ["instance"], [("type", "=", "Fetch")]),
    "produce_throughput_by_topic": _rate_sum("kafka_topic_request_count_total", ["instance"], [("type", "=", "produce")]),
    "fetch_throughput_by_topic": _rate_sum("kafka_topic_request_count_total", ["instance"], [("type", "=", "fetch")]),
    **{
        f"{kind.lower()}_latency_{stat}": _request_time(stat, kind)
        for kind in ("Produce", "Fetch")
        for stat in ("99p", "mean", "50p", "max")
    },
}

GROUPS = {
    "consumer_throughput": _throughput(False),
    "consumer_throughput_by_partition": _throughput(True),
    "consumer_lag": _lag(M.consumer_lag),
    "consumer_lag_by_partition": _lag(M.consumer_lag, by_partition=True),
    "commit_offsets": _gauge_agg("max", "kafka_group_commit_offset", [GROUP, "topic", "partition"]),
    "log_end_offset": _gauge_agg("max", "kafka_log_end_offset", ["topic", "partition"]),
}

TOPICS = {
    "traffic_by_direction": _rate_sum("kafka_network_io_bytes_total", ["direction", "job"]),
    "total_size": _gauge_agg("sum", "kafka_log_size"),
    "partition_total": _partition_total,
    "partitions_per_broker": _gauge_agg("sum", "kafka_stream_topic_partition_count", ["node_id", "topic"]),
    "partitions_per_rack": _gauge_agg("sum", "kafka_stream_topic_partition_count", ["rack", "topic"]),
    "topic_size": _gauge_sum_of_max("kafka_log_size", ["topic", "partition"], ["topic"]),
    "partition_size": _gauge("kafka_log_size"),
    "partition_end_offset": _gauge("kafka_log_end_offset"),
    "messages_in": _rate_sum("kafka_message_count_total", ["topic"], _IN),
    "bytes_in": _rate_sum_of_max("kafka_network_io_bytes_total", ["topic", "partition"], ["topic"], _IN),
    "bytes_out": _rate_sum_of_max("kafka_network_io_bytes_total", ["topic", "partition"], ["topic"], _OUT),
    "partition_messages_in": _rate_sum("kafka_log_end_offset", ["topic", "partition"], [("topic", "!~", "__cluster_metadata")]),
    "partition_bytes_in": _rate_sum("kafka_network_io_bytes_total", ["topic", "partition"], _IN),
    "partition_bytes_out": _rate_sum("kafka_network_io_bytes_total", ["topic", "partition"], _OUT),
    "produce_qps": _rate_sum("kafka_topic_request_count_total", ["topic"], [("type", "=", "produce")]),
    "fetch_qps": _rate_sum("kafka_topic_request_count_total", ["topic"], [("type", "=", "fetch")]),
    "fields_per_second": _gauge("kafka_tabletopic_fps"),
    "table_watermark": _gauge("kafka_tabletopic_delay_milliseconds"),
    "consume_statistics": _lag(M.consume_statistics),
}

PANELS: dict[str, Callable] = {
    f"{board}.{name}": fn
    for board, panels in {
        "business": BUSINESS,
        "ingest": INGEST_LAB,
        "table": TABLE_TOPIC,
        "broker": BROKER,
        "group": GROUPS,
        "topic": TOPICS,
    }.items()
    for name, fn in panels.items()
}


def panel(name: str, samples: DataFrame, window: str = "1m", step: str = "1m", matchers: Matchers | None = None, lookback: str | None = None) -> DataFrame:
    """Evaluate a panel; ``matchers`` are the dashboard variables, such as job or topic."""
    return PANELS[name](samples, window, step, extra=matchers, lookback=lookback)


def dashboard_variables(samples: DataFrame, metric: str, label: str, matchers: Matchers | None = None) -> DataFrame:
    return M.label_values(samples, metric, label, matchers)
