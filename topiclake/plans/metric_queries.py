"""Metric operators over samples derived from ``events`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiclake.operators import metrics as M
from topiclake.plans.bound import load, query
from topiclake.plans.panel_queries import finish_sql, gauge_sql, rate_sql
from topiclake.plans.samples import BOUNDS, samples, samples_sql
from topiclake.sources import exposition

DIGITS = 6


def _round(df, *cols):
    return df.withColumns({c: F.round(F.col(c).cast("double"), DIGITS) for c in cols or ("value",)})


@query("counter_reset_rate", finish_sql(rate_sql("kafka_tabletopic_fps", w="2d", s="1d"), [], metric="kafka_tabletopic_fps"))
def counter_reset_rate(spark, sf_dir):
    return _round(M.rate(samples(spark, sf_dir, ["kafka_tabletopic_fps"]), "2d", "1d"))


@query("event_rate", finish_sql(rate_sql("demo_cart_events_total", w="1d", s="1d"), [], metric="demo_cart_events_total"))
def event_rate(spark, sf_dir):
    return _round(M.rate(samples(spark, sf_dir, ["demo_cart_events_total"]), "1d", "1d"))


@query("fine_grid_rate", finish_sql(rate_sql("kafka_tabletopic_fps", w="90m", s="20m"), [], metric="kafka_tabletopic_fps"))
def fine_grid_rate(spark, sf_dir):
    return _round(M.rate(samples(spark, sf_dir, ["kafka_tabletopic_fps"]), "90m", "20m"))


_BOUNDED = gauge_sql("demo_active_users", w="6h", s="4h", origin="epoch_us(TIMESTAMP '2024-01-05 01:30:00')")


@query(
    "bounded_gauge_range",
    f"""SELECT 'demo_active_users' AS metric, sk AS series_key, step, round(value, {DIGITS}) AS value FROM {_BOUNDED}
        WHERE step >= TIMESTAMP '2024-01-05 01:30:00' AND step <= TIMESTAMP '2024-01-12 12:00:00'""",
)
def bounded_gauge_range(spark, sf_dir):
    return _round(M.gauge_range(samples(spark, sf_dir, ["demo_active_users"]), "4h", "6h", "2024-01-05 01:30:00", "2024-01-12 12:00:00"))


_PER_USER = f"""WITH r AS {rate_sql("kafka_tabletopic_fps", w="90m", s="20m")}, g AS {gauge_sql("demo_active_users", w="5m", s="20m")},
                 rs AS (SELECT step, sum(value) AS value FROM r GROUP BY step), gs AS (SELECT step, sum(value) AS value FROM g GROUP BY step)"""


@query("rate_per_gauge", f"{_PER_USER} SELECT step, round(rs.value / gs.value, {DIGITS}) AS value FROM rs JOIN gs USING (step) WHERE gs.value <> 0")
def rate_per_gauge(spark, sf_dir):
    """Vectors of different windows meet: all ends lie on one grid."""
    rates = M.agg_by(M.rate(samples(spark, sf_dir, ["kafka_tabletopic_fps"]), "90m", "20m"), "sum", [])
    users = M.agg_by(M.gauge_range(samples(spark, sf_dir, ["demo_active_users"]), "20m", "5m"), "sum", [])
    return _round(M.binary_op(rates, users.where("value <> 0"), "/"))


@query(
    "instant_vector",
    f"""WITH s AS ({samples_sql("kafka_log_size")}), newest AS (SELECT epoch_us(max(ts)) AS e FROM events)
        SELECT 'kafka_log_size' AS metric, sk AS series_key, make_timestamp(e) AS step, round(arg_max(v, t), {DIGITS}) AS value
        FROM s, newest WHERE t > e - 21600000000 AND t <= e GROUP BY sk, e""",
)
def instant_vector(spark, sf_dir):
    newest = load(spark, sf_dir, "events").agg(F.max("ts"))
    return _round(M.instant(samples(spark, sf_dir, ["kafka_log_size"]), newest, "6h"))


@query(
    "series_selection",
    f"""SELECT metric, cast(count(*) AS bigint) AS n FROM (
          SELECT 'kafka_network_io_bytes_total' AS metric FROM ({samples_sql("kafka_network_io_bytes_total", "topic <> 'error' AND instance IN ('node-0', 'node-1') AND partition NOT IN ('2', '3')")})
          UNION ALL SELECT 'kafka_log_size' FROM ({samples_sql("kafka_log_size", "topic <> 'error' AND instance IN ('node-0', 'node-1') AND partition NOT IN ('2', '3')")}))
        GROUP BY metric""",
)
def series_selection(spark, sf_dir):
    all_samples = samples(spark, sf_dir, ["kafka_network_io_bytes_total", "kafka_log_size", "kafka_topic_count"])
    matchers = [("topic", "!=", "error"), ("instance", "=~", "node-[01]"), ("partition", "!~", "2|3"), ("rack", "=", "")]
    picked = M.select_series(all_samples, None, matchers, "kafka_(network_io_bytes_total|log_size)")
    return picked.groupBy("metric").agg(F.count(F.lit(1)).alias("n"))


@query(
    "checkout_quantiles",
    f"""WITH b AS (SELECT l_returnflag, le, upper, count(*) FILTER (l_extendedprice / 20000.0 <= upper) AS c
                   FROM lineitem, (VALUES {", ".join(f"({b})" for b in BOUNDS)}, (cast('inf' AS double))) u(upper), (SELECT 1 AS le) GROUP BY ALL),
             r AS (SELECT l_returnflag, phi, upper, c, phi * max(c) OVER (PARTITION BY l_returnflag, phi) AS rank,
                          lag(upper) OVER w AS lo, lag(c) OVER w AS prev
                   FROM b, (VALUES (0.5), (0.95), (0.99)) p(phi) WINDOW w AS (PARTITION BY l_returnflag, phi ORDER BY upper)),
             f AS (SELECT l_returnflag, phi, min(upper) FILTER (c >= rank) AS hit, max(upper) FILTER (NOT isinf(upper)) AS top FROM r GROUP BY ALL)
        SELECT f.l_returnflag, cast(f.phi AS double) AS phi, round(CASE WHEN isinf(hit) THEN top
                 ELSE coalesce(lo, 0) + (upper - coalesce(lo, 0)) * (rank - coalesce(prev, 0)) / (c - coalesce(prev, 0)) END, {DIGITS}) AS value
        FROM f JOIN r ON f.l_returnflag = r.l_returnflag AND f.phi = r.phi AND f.hit = r.upper""",
)
def checkout_quantiles(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_extendedprice") / F.lit(20000.0)).alias("v"))
    buckets = M.to_histogram(rows, "v", [float(b) for b in BOUNDS], ["l_returnflag"])
    return _round(M.histogram_quantile(buckets, [0.5, 0.95, 0.99], ["l_returnflag"], value="bucket"))


@query(
    "histogram",
    f"""SELECT event_type, upper AS le, count(*) FILTER (value <= upper) AS bucket, round(cast(sum(cast(value AS decimal(18,2))) AS double), 4) AS sum,
               count(*) AS count
        FROM events, (VALUES (1.0), (10.0), (50.0), (100.0), (cast('inf' AS double))) u(upper) GROUP BY event_type, upper""",
)
def histogram(spark, sf_dir):
    exact = load(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    return _round(M.to_histogram(exact, "value", [1, 10, 50, 100], ["event_type"]), "sum")


@query("slo_violations", "SELECT event_type, count(*) FILTER (value > 100) AS violations FROM events GROUP BY event_type")
def slo_violations(spark, sf_dir):
    return M.slo_violations(load(spark, sf_dir, "events"), "value", 100, ["event_type"])


@query(
    "label_values",
    "SELECT DISTINCT 'node-' || (user_id % 3) AS label_value FROM events WHERE event_type <> 'error'",
)
def label_values(spark, sf_dir):
    return M.label_values(samples(spark, sf_dir, ["kafka_log_size"]), "kafka_log_size", "instance", [("topic", "!=", "error")])


@query(
    "series_count",
    f"SELECT count(DISTINCT sk) AS series FROM ({samples_sql('kafka_network_io_bytes_total')})",
)
def series_count(spark, sf_dir):
    keyed = M.with_series_key(samples(spark, sf_dir, ["kafka_network_io_bytes_total"]))
    return keyed.agg(F.count_distinct("series_key").alias("series"))


@query(
    "metric_names",
    "SELECT DISTINCT 'kafka_' || event_type || '_total' AS metric FROM events WHERE event_type <> 'error' ORDER BY 1",
)
def metric_names(spark, sf_dir):
    name = F.when(F.col("event_type") == "error", F.lit("jvm_errors")).otherwise(F.concat(F.lit("kafka_"), "event_type", F.lit("_total")))
    return M.list_metrics(load(spark, sf_dir, "events").select(name.alias("metric")))


@query(
    "series_reducers",
    f"""SELECT 'demo_queue_depth' AS metric, sk AS series_key, round(arg_max(value, step), {DIGITS}) AS last_not_null,
               round(avg(value), {DIGITS}) AS mean, round(max(value), {DIGITS}) AS max
        FROM {gauge_sql("demo_queue_depth")} GROUP BY sk""",
)
def series_reducers(spark, sf_dir):
    g = M.gauge_range(samples(spark, sf_dir, ["demo_queue_depth"]), "12h", "1d")
    return _round(M.reduce_series(g, ["lastNotNull", "mean", "max"], M.SERIES), "last_not_null", "mean", "max")


@query(
    "failure_ratio",
    """SELECT day AS step, round(errors / nullif(purchases, 0), 6) AS value FROM (
         SELECT date_trunc('day', ts) AS day, cast(count(*) FILTER (event_type = 'error') AS double) AS errors,
                cast(count(*) FILTER (event_type = 'purchase') AS double) AS purchases FROM events GROUP BY 1)
       WHERE errors > 0 AND purchases > 0""",
)
def failure_ratio(spark, sf_dir):
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).alias("step")
    events = load(spark, sf_dir, "events")

    def per_day(kind):
        return events.where(F.col("event_type") == kind).groupBy(day).agg(F.count(F.lit(1)).cast("double").alias("value"))

    return _round(M.ratio(per_day("error"), per_day("purchase")))


@query(
    "vector_or",
    """WITH a AS (SELECT date_trunc('hour', ts) AS step, user_id % 3 AS zone, cast(sum(cast(value AS decimal(18,2))) AS double) AS value FROM events WHERE event_type = 'view' GROUP BY ALL),
            b AS (SELECT date_trunc('hour', ts) AS step, user_id % 3 AS zone, cast(sum(cast(value AS decimal(18,2))) AS double) AS value FROM events WHERE event_type = 'click' GROUP BY ALL)
       SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.step = b.step AND a.zone = b.zone)""",
)
def vector_or(spark, sf_dir):
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("step")
    events = load(spark, sf_dir, "events")

    def per_hour(kind):
        total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value")
        return events.where(F.col("event_type") == kind).groupBy(hour, (F.col("user_id") % 3).alias("zone")).agg(total)

    return M.vector_or(per_hour("view"), per_hour("click"))


@query(
    "catch_up",
    """WITH l AS (SELECT date_trunc('day', ts) AS step, max(event_id) + 1 - max(event_id) FILTER (event_type = 'purchase') AS lag, max(event_id) + 1 AS ends
                  FROM events GROUP BY 1)
       SELECT max(lag) AS peak_lag, min(step) FILTER (lag <= 2) AS recovered_at, arg_max(ends, step) - arg_min(ends, step) AS log_growth
       FROM l WHERE step >= TIMESTAMP '2024-01-10'""",
)
def catch_up(spark, sf_dir):
    step = F.date_trunc("day", F.col("ts").cast("timestamp")).alias("step")
    per_day = load(spark, sf_dir, "events").groupBy(step).agg(
        (F.max("event_id") + 1).alias("ends"), F.max(F.when(F.col("event_type") == "purchase", F.col("event_id"))).alias("committed")
    )
    # a lag of two messages counts as caught up
    lag = per_day.select("step", (F.col("ends") - F.col("committed") - 2).alias("value"))
    ends = per_day.select("step", F.col("ends").alias("value"))
    return M.catch_up(lag, "2024-01-10", ends).withColumn("peak_lag", F.col("peak_lag") + 2)


@query(
    "exposition_samples",
    """SELECT event_id, 'app_value_total' AS metric, event_type AS type, 'a\\b"c' || user_id AS path, round(value, 6) AS value FROM events WHERE event_type <> 'error'""",
)
def exposition_samples(spark, sf_dir):
    lines = exposition.format_exposition(
        load(spark, sf_dir, "events"),
        F.lit("app_value_total"),
        [("type", F.col("event_type")), ("path", F.concat(F.lit('a\\b"c'), "user_id"))],
        F.col("value"),
        keep=["event_id"],
    )
    # comment lines stand where errors were
    is_error = F.contains("value", F.lit('type="error"'))
    lines = lines.withColumn("value", F.when(is_error, F.concat(F.lit("# "), "value")).otherwise(F.col("value")))
    return exposition.parse_exposition(lines, keep=["event_id"]).select(
        "event_id", "metric", F.col("labels")["type"].alias("type"), F.col("labels")["path"].alias("path"), F.round("value", 6).alias("value")
    )
