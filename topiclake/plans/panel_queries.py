"""Every dashboard panel over samples derived from ``events``, with its SQL check."""

from __future__ import annotations


from pyspark.sql import functions as F

from topiclake.operators.metrics import duration_us
from topiclake.plans.bound import query
from topiclake.plans.panels import PANELS, panel
from topiclake.plans.samples import SOURCES, samples, samples_sql

WINDOW, STEP, LOOKBACK = "1d", "12h", "1d"
DIGITS = 6


# ---- SQL building blocks: each gives (label columns, step, value)


# Ends are multiples of the step. A rate's window is open at its end, so a sample counts from the first end after it; a
# gauge sees the sample at the end itself.


def _rate_ends(w: str, s: str) -> str:
    return f"unnest(range(t // {duration_us(s)} + 1, (t + {duration_us(w)}) // {duration_us(s)} + 1)) AS k"


def _gauge_ends(w: str, s: str, origin: str = "0") -> str:
    low, high = f"cast(ceil((t - {origin}) / {duration_us(s)}.0) AS bigint)", f"cast(ceil((t - {origin} + {duration_us(w)}) / {duration_us(s)}.0) AS bigint)"
    return f"unnest(range({low}, {high})) AS k"


def _end(s: str, origin: str = "0") -> str:
    return f"make_timestamp({origin} + k * {duration_us(s)})"


def _names(metric: str) -> str:
    return "".join(f'"{n}", ' for n in SOURCES[metric].sorted_labels)


def rate_sql(metric: str, where: str = "true", w: str = WINDOW, s: str = STEP) -> str:
    names = _names(metric)
    return f"""(
        WITH s AS ({samples_sql(metric, where)}),
        d AS (SELECT *, lag(v) OVER (PARTITION BY sk ORDER BY t) AS pv FROM s),
        g AS (SELECT sk, {names} t, CASE WHEN pv IS NULL THEN 0 WHEN v >= pv THEN v - pv ELSE v END AS delta, {_rate_ends(w, s)} FROM d)
        SELECT sk, {names} {_end(s)} AS step, (sum(delta) - arg_min(delta, t)) / ((max(t) - min(t)) / 1e6) AS value
        FROM g GROUP BY sk, {names} k HAVING count(*) >= 2)"""


def gauge_sql(metric: str, where: str = "true", w: str = LOOKBACK, s: str = STEP, origin: str = "0") -> str:
    names = _names(metric)
    return f"""(
        WITH g AS (SELECT *, {_gauge_ends(w, s, origin)} FROM ({samples_sql(metric, where)}))
        SELECT sk, {names} {_end(s, origin)} AS step, arg_max(v, t) AS value FROM g GROUP BY sk, {names} k)"""


def agg_sql(source: str, fn: str, by: list[str] | None = None) -> str:
    cols = "".join(f'"{b}", ' for b in by or [])
    value = "cast(count(*) AS bigint)" if fn == "count" else f"{fn}(value)"
    return f"(SELECT {cols} step, {value} AS value FROM {source} GROUP BY {cols} step)"


def quantile_sql(source: str, phis: list[float]) -> str:
    """``source`` gives ``le, step, value`` already summed over series."""
    values = ", ".join(f"(cast({p} AS double))" for p in phis)
    return f"""(
        WITH b AS (SELECT step, CASE le WHEN '+Inf' THEN cast('inf' AS double) ELSE cast(le AS double) END AS le, value AS c FROM {source}),
        r AS (SELECT step, le, c, phi, phi * total AS rank, total,
                     lag(le) OVER w AS lo, lag(c) OVER w AS prev
              FROM (SELECT *, max(c) FILTER (le = cast('inf' AS double)) OVER (PARTITION BY step) AS total FROM b), (VALUES {values}) p(phi)
              WINDOW w AS (PARTITION BY step, phi ORDER BY le)),
        f AS (SELECT step, phi, min(le) FILTER (c >= rank) AS hit, max(le) FILTER (le < cast('inf' AS double)) AS top, max(total) AS total FROM r GROUP BY step, phi)
        SELECT f.step, f.phi, CASE WHEN f.total > 0 THEN CASE WHEN isinf(f.hit) THEN f.top
            ELSE coalesce(r.lo, 0) + (r.le - coalesce(r.lo, 0)) * (r.rank - coalesce(r.prev, 0)) / nullif(r.c - coalesce(r.prev, 0), 0) END END AS value
        FROM f JOIN r ON f.step = r.step AND f.phi = r.phi AND f.hit = r.le)"""


def finish_sql(source: str, cols: list[str], extra: str = "", metric: str | None = None) -> str:
    head = f"'{metric}' AS metric, sk AS series_key, " if metric else "".join(f'"{c}", ' for c in cols)
    return f"SELECT {head}step, round(cast(value AS double), {DIGITS}) AS value{extra} FROM {source}"


def _rate(metric, where="true"):
    return [metric], finish_sql(rate_sql(metric, where), [], metric=metric)


def _gauge(metric, where="true"):
    return [metric], finish_sql(gauge_sql(metric, where), [], metric=metric)


def _rate_sum(metric, by=None, where="true"):
    return [metric], finish_sql(agg_sql(rate_sql(metric, where), "sum", by), by or [])


def _gauge_agg(fn, metric, by=None, where="true"):
    return [metric], finish_sql(agg_sql(gauge_sql(metric, where), fn, by), by or [])


def _sum_of_max(source, metric, inner, outer):
    return [metric], finish_sql(agg_sql(agg_sql(source, "max", inner), "sum", outer), outer)


def _quantiles(metric, phis):
    buckets = agg_sql(rate_sql(metric), "sum", ["le"])
    return [metric], finish_sql(quantile_sql(buckets, phis), ["phi"])


def _latest(metric):
    return [metric], (
        f"SELECT '{metric}' AS metric, sk AS series_key, round(arg_max(value, step), {DIGITS}) AS last_not_null "
        f"FROM {gauge_sql(metric)} GROUP BY sk"
    )


def _thresholds(yellow: int, red: int) -> str:
    v = "cast(value AS double)"
    return f", CASE WHEN {v} >= {red} THEN 'red' WHEN {v} >= {yellow} THEN 'yellow' WHEN {v} IS NOT NULL THEN 'green' END AS status"


def _scaled(source: str, k: float, cols: str) -> str:
    return f"(SELECT {cols}, step, value * {k} AS value FROM {source})"


_TP = ["topic", "partition"]
_GTP = ["consumer_group", *_TP]
_COMMITS, _ENDS = "kafka_group_commit_offset", "kafka_log_end_offset"


def _lag_sql(by_partition: bool) -> str:
    a, b = agg_sql(gauge_sql(_COMMITS), "max", _GTP), agg_sql(gauge_sql(_ENDS), "max", _TP)
    keys = _TP if by_partition else ["topic"]
    if not by_partition:
        a, b = agg_sql(a, "sum", ["consumer_group", "topic"]), agg_sql(b, "sum", ["topic"])
    cols = ", ".join(f"a.{k}" for k in keys)
    return f"(SELECT a.step, a.consumer_group, {cols}, b.value - a.value AS value FROM {a} a JOIN {b} b USING (step, {', '.join(keys)}))"


def _statistics_sql() -> str:
    a = agg_sql(agg_sql(gauge_sql(_COMMITS), "max", _GTP), "sum", ["consumer_group", "topic"])
    b = agg_sql(agg_sql(gauge_sql(_ENDS), "max", _TP), "sum", ["topic"])
    return (
        f"SELECT step, topic, consumer_group, a.value AS committed, b.value AS end_offset, b.value - a.value AS lag "
        f"FROM {a} a FULL JOIN {b} b USING (step, topic) WHERE consumer_group IS NOT NULL"
    )


def _failure_sql() -> str:
    a, b = (agg_sql(rate_sql(m), "sum") for m in ("demo_payment_failures_total", "demo_orders_total"))
    return finish_sql(f"(SELECT step, a.value / nullif(b.value, 0) AS value FROM {a} a JOIN {b} b USING (step))", [])


def _zone_sql() -> str:
    a, b = (agg_sql(rate_sql(f"cortex_ingest_storage_reader_{m}_total"), "sum", ["zone"]) for m in ("records", "requests"))
    return finish_sql(
        f"(SELECT zone, step, value FROM {a} UNION ALL SELECT zone, step, value FROM {b} b WHERE NOT EXISTS "
        f"(SELECT 1 FROM {a} a WHERE a.zone = b.zone AND a.step = b.step))",
        ["zone"],
    )


def _heap_sql() -> str:
    used, limit = (gauge_sql(f"jvm_memory_{m}_bytes", "jvm_memory_type = 'heap'") for m in ("used", "limit"))
    joined = f"(SELECT sk, step, a.value / nullif(b.value, 0) * 100 AS value FROM {used} a JOIN {limit} b USING (sk, step))"
    return f"SELECT sk AS series_key, step, round(value, {DIGITS}) AS value{_thresholds(70, 85)} FROM {joined}"


def _cpu_sql() -> str:
    m = "jvm_cpu_recent_utilization_ratio"
    return finish_sql(_scaled(gauge_sql(m), 100.0, "sk"), [], _thresholds(70, 90), metric=m)


_IN, _OUT = "direction = 'in'", "direction = 'out'"
_NET = "kafka_network_io_bytes_total"

PANEL_SQL: dict[str, tuple[list[str], str]] = {
    "business.orders_per_second_by_status": _rate_sum("demo_orders_total", ["status"]),
    "business.checkout_latency": _quantiles("demo_checkout_latency_seconds_bucket", [0.5, 0.95, 0.99]),
    "business.payment_failure_rate": (["demo_payment_failures_total", "demo_orders_total"], _failure_sql()),
    "business.active_users": _gauge_agg("sum", "demo_active_users", ["region"]),
    "business.revenue_per_second": _rate_sum("demo_revenue_total", ["region"]),
    "business.cart_events_per_second": _rate_sum("demo_cart_events_total", ["event"]),
    "business.queue_depth": _gauge_agg("sum", "demo_queue_depth", ["region"]),
    "business.active_scenario": _gauge_agg("sum", "demo_workload_scenario", ["scenario"]),
    "business.product_view_series": _gauge_agg("count", "demo_product_views_total"),
    "business.target_series": _gauge("demo_workload_target_series"),
    "business.product_views_per_second": _rate_sum("demo_product_views_total"),
    "business.remote_write_samples_per_second": _rate_sum("prometheus_remote_storage_samples_total"),
    "business.received_samples_per_second": _rate_sum("cortex_distributor_received_samples_total"),
    "business.ingest_bytes_per_second": _rate_sum("cortex_ingest_storage_writer_input_bytes_total"),
    "ingest.samples_per_second": _rate_sum("prometheus_remote_storage_samples_total"),
    "ingest.write_latency_p99": _quantiles("cortex_ingest_storage_writer_latency_seconds_bucket", [0.99]),
    "ingest.receive_delay_p99": _quantiles("cortex_ingest_storage_reader_receive_delay_seconds_bucket", [0.99]),
    "ingest.ingest_storage_enabled": _latest("cortex_distributor_ingest_storage_enabled"),
    "ingest.bytes_per_second": _rate_sum("cortex_ingest_storage_writer_input_bytes_total"),
    "ingest.consumption_by_zone": (["cortex_ingest_storage_reader_records_total", "cortex_ingest_storage_reader_requests_total"], _zone_sql()),
    "table.cpu_percent": (["jvm_cpu_recent_utilization_ratio"], _cpu_sql()),
    "table.heap_percent": (["jvm_memory_used_bytes", "jvm_memory_limit_bytes"], _heap_sql()),
    "table.brokers": _latest("kafka_broker_active_count"),
    "table.topics": _latest("kafka_topic_count"),
    "table.partitions": _latest("kafka_partition_count"),
    "table.worker_busy_percent": _gauge("kafka_tableworker_eventloop_busy_ratio_percent"),
    "table.produce_request_rate": _rate_sum("kafka_request_count_total", None, "type = 'Produce'"),
    "table.fetch_request_rate": _rate_sum("kafka_request_count_total", None, "type = 'Fetch'"),
    "table.message_rate_by_topic": _rate_sum("kafka_message_count_total", ["topic"], _IN),
    "table.network_in": _rate("kafka_stream_network_inbound_usage_bytes_total"),
    "table.network_out": _rate("kafka_stream_network_outbound_usage_bytes_total"),
    "table.table_delay": _gauge("kafka_tabletopic_delay_milliseconds"),
    "table.fields_per_second": _gauge("kafka_tabletopic_fields_per_second"),
    "table.partition_message_rate": _rate("kafka_message_count_total", _IN),
    "table.partition_offset": _gauge(_ENDS),
    "broker.error_rate": _rate_sum("kafka_request_error_count_total", ["instance", "error"], "error <> 'NONE'"),
    "broker.connection_count": _gauge_agg("sum", "kafka_server_connection_count", ["instance", "listener"]),
    "broker.partition_count": _gauge("kafka_partition_count"),
    "broker.partition_status": _gauge("kafka_stream_partition_status_statistics"),
    "broker.bytes_in": _rate_sum("kafka_broker_network_io_bytes_total", ["instance"], _IN),
    "broker.bytes_out": _rate_sum("kafka_broker_network_io_bytes_total", ["instance"], _OUT),
    "broker.messages_in": _rate_sum("kafka_message_count_total", ["instance"]),
    "broker.bytes_in_per_topic": _rate_sum(_NET, ["topic", "instance"], _IN),
    "broker.bytes_out_per_topic": _rate_sum(_NET, ["topic", "instance"], _OUT),
    "broker.messages_in_per_topic": _rate_sum("kafka_message_count_total", ["topic", "instance"]),
    "broker.produce_qps_per_topic": _rate_sum("kafka_topic_request_count_total", ["instance", "topic"], "type = 'produce'"),
    "broker.fetch_qps_per_topic": _rate_sum("kafka_topic_request_count_total", ["instance", "topic"], "type = 'fetch'"),
    "broker.total_throughput": _rate_sum("kafka_request_count_total", ["instance"]),
    "broker.produce_throughput": _rate_sum("kafka_request_count_total", ["instance"], "type = 'Produce'"),
    "broker.fetch_throughput": _rate_sum("kafka_request_count_total", ["instance"], "type = 'Fetch'"),
    "broker.produce_throughput_by_topic": _rate_sum("kafka_topic_request_count_total", ["instance"], "type = 'produce'"),
    "broker.fetch_throughput_by_topic": _rate_sum("kafka_topic_request_count_total", ["instance"], "type = 'fetch'"),
    **{
        f"broker.{kind.lower()}_latency_{stat}": _gauge_agg("sum", f"kafka_request_time_{stat}_milliseconds", ["instance"], f"type = '{kind}'")
        for kind in ("Produce", "Fetch")
        for stat in ("99p", "mean", "50p", "max")
    },
    "group.consumer_throughput": _sum_of_max(rate_sql(_COMMITS), _COMMITS, _GTP, ["consumer_group", "topic"]),
    "group.consumer_throughput_by_partition": _rate_sum(_COMMITS, _GTP),
    "group.consumer_lag": ([_COMMITS, _ENDS], finish_sql(_lag_sql(False), ["consumer_group", "topic"])),
    "group.consumer_lag_by_partition": ([_COMMITS, _ENDS], finish_sql(_lag_sql(True), _GTP)),
    "group.commit_offsets": _gauge_agg("max", _COMMITS, _GTP),
    "group.log_end_offset": _gauge_agg("max", _ENDS, _TP),
    "topic.traffic_by_direction": _rate_sum(_NET, ["direction", "job"]),
    "topic.total_size": _gauge_agg("sum", "kafka_log_size"),
    "topic.partition_total": (
        ["kafka_log_size"],
        finish_sql(agg_sql(agg_sql(agg_sql(gauge_sql("kafka_log_size"), "max", _TP), "count", ["topic"]), "sum"), []),
    ),
    "topic.partitions_per_broker": _gauge_agg("sum", "kafka_stream_topic_partition_count", ["node_id", "topic"]),
    "topic.partitions_per_rack": _gauge_agg("sum", "kafka_stream_topic_partition_count", ["rack", "topic"]),
    "topic.topic_size": _sum_of_max(gauge_sql("kafka_log_size"), "kafka_log_size", _TP, ["topic"]),
    "topic.partition_size": _gauge("kafka_log_size"),
    "topic.partition_end_offset": _gauge(_ENDS),
    "topic.messages_in": _rate_sum("kafka_message_count_total", ["topic"], _IN),
    "topic.bytes_in": _sum_of_max(rate_sql(_NET, _IN), _NET, _TP, ["topic"]),
    "topic.bytes_out": _sum_of_max(rate_sql(_NET, _OUT), _NET, _TP, ["topic"]),
    "topic.partition_messages_in": _rate_sum(_ENDS, _TP),
    "topic.partition_bytes_in": _rate_sum(_NET, _TP, _IN),
    "topic.partition_bytes_out": _rate_sum(_NET, _TP, _OUT),
    "topic.produce_qps": _rate_sum("kafka_topic_request_count_total", ["topic"], "type = 'produce'"),
    "topic.fetch_qps": _rate_sum("kafka_topic_request_count_total", ["topic"], "type = 'fetch'"),
    "topic.fields_per_second": _gauge("kafka_tabletopic_fps"),
    "topic.table_watermark": _gauge("kafka_tabletopic_delay_milliseconds"),
    "topic.consume_statistics": ([_COMMITS, _ENDS], _statistics_sql()),
}


def _register(name: str) -> None:
    metrics, sql = PANEL_SQL[name]

    @query(f"panel_{name.replace('.', '_')}", sql)
    def run(spark, sf_dir):
        out = panel(name, samples(spark, sf_dir, metrics), WINDOW, STEP, lookback=LOOKBACK)
        for c in ("value", "last_not_null"):
            if c in out.columns:
                out = out.withColumn(c, F.round(F.col(c).cast("double"), DIGITS))
        return out


for _name in PANELS:
    _register(_name)
