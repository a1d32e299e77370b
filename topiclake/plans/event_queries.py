"""Analytics, projection and messaging queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclake.functions import scalars as S
from topiclake.operators import analytics as A
from topiclake.operators import messaging as G
from topiclake.operators import projection as P
from topiclake.plans.bound import load, query
from topiclake.session import shared_dir
from topiclake.sources import archives, topics

# ---- notebook queries

_LAST_DAYS = "ts >= cast(cast((SELECT max(ts) FROM events) AS date) - 3 AS timestamp)"


def _recent_events(spark, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    return A.since_days(events, "ts", 3, as_of=events.agg(F.max("ts")))


@query(
    "top_repos",
    f"""SELECT user_id AS repo, count(*) AS star_count FROM events WHERE event_type = 'click' AND {_LAST_DAYS}
        GROUP BY user_id ORDER BY star_count DESC, repo LIMIT 10""",
)
def top_repos(spark, sf_dir):
    stars = A.of_type(_recent_events(spark, sf_dir), "click", "event_type").withColumnRenamed("user_id", "repo")
    return A.top_k(stars, "repo", 10, "star_count")


@query("star_count", f"SELECT count(*) AS star_count FROM events WHERE event_type = 'click' AND {_LAST_DAYS}")
def star_count(spark, sf_dir):
    return A.count_where(_recent_events(spark, sf_dir), F.col("event_type") == "click", "star_count")


@query("total_count", f"SELECT count(*) AS total_count FROM events WHERE {_LAST_DAYS}")
def total_count(spark, sf_dir):
    return A.count_all(_recent_events(spark, sf_dir))


@query("since_fixed_day", "SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-17'")
def since_fixed_day(spark, sf_dir):
    return A.count_all(A.since_days(load(spark, sf_dir, "events"), "ts", 3, as_of="2024-01-20"), "n")


@query("count_by_type", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def count_by_type(spark, sf_dir):
    return A.count_by(load(spark, sf_dir, "events"), ["event_type"])


@query("recent_events", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")
def recent_events(spark, sf_dir):
    return A.recent(load(spark, sf_dir, "events"), "ts", 20, ["event_id"])


@query("page_customers", "SELECT * FROM customer ORDER BY c_custkey LIMIT 50")
def page_customers(spark, sf_dir):
    return A.page(load(spark, sf_dir, "customer"), "c_custkey", 50)


@query("head_rows", "SELECT count(*) AS n, count(*) AS n_in_table FROM (SELECT * FROM lineitem LIMIT 20)")
def head_rows(spark, sf_dir):
    """Which rows come first is open, so the check asks how many there are and how many of them the table has."""
    lines = load(spark, sf_dir, "lineitem")
    head = A.head_rows(lines, 20)
    found = head.join(lines.select("l_orderkey", "l_linenumber").distinct(), ["l_orderkey", "l_linenumber"], "left_semi")
    return A.count_all(head, "n").crossJoin(A.count_all(found, "n_in_table"))


@query("random_row", "SELECT * FROM customer ORDER BY md5('7|' || c_custkey) LIMIT 1")
def random_row(spark, sf_dir):
    return A.random_row(load(spark, sf_dir, "customer"), seed=7, key=["c_custkey"])


@query("available_columns", "SELECT event_id, event_type, ts FROM events")
def available_columns(spark, sf_dir):
    return A.select_available(load(spark, sf_dir, "events"), ["event_id", "event_type", "actor_login", "ts"])


# ---- decoding and projection


@query("typed_props", "SELECT event_id, cast(json_extract_string(props, '$.k') AS integer) AS k FROM events")
def typed_props(spark, sf_dir):
    decoded = P.decode_json(load(spark, sf_dir, "events"), "k int", "props")
    return P.select_fields(decoded, {"event_id": "event_id", "k": "props.k"})


@query("schemaless_messages", "SELECT cast(event_id AS varchar) AS key, props AS value, ts AS timestamp FROM events")
def schemaless_messages(spark, sf_dir):
    return P.convert_schemaless(topics.to_messages(load(spark, sf_dir, "events"), "events", "event_id", "props", "ts"))


@query("json_round_trip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def json_round_trip(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    ddl = ", ".join(f"{c} {t}" for c, t in orders.select(*cols).dtypes)
    return P.flatten(P.decode_json(P.encode_json(orders, "o_orderkey", cols), ddl))


def event_lines(spark, sf_dir: str) -> DataFrame:
    """Archive lines from ``events``: broken for errors, blank for one user in five, without actor for purchases."""
    actor = F.when(
        F.col("event_type") != "purchase", F.struct(F.concat(F.lit("user-"), F.col("user_id")).alias("login"))
    )
    line = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.col("event_type").alias("type"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
            actor.alias("actor"),
            F.struct(F.concat(F.lit("repo/"), F.col("user_id") % 7).alias("name")).alias("repo"),
        )
    )
    null_actor = F.replace(line, F.lit('"repo"'), F.lit('"actor":null,"repo"'))
    value = (
        F.when(F.col("user_id") % 5 == 4, F.lit("  "))
        .when(F.col("event_type") == "error", F.substring(line, 1, 20))
        .when((F.col("event_type") == "purchase") & (F.col("user_id") % 2 == 0), null_actor)
        .otherwise(line)
    )
    return load(spark, sf_dir, "events").select("event_id", "ts", value.alias("value"))


_MAPPED = """
    SELECT cast(event_id AS varchar) AS id, event_type AS type,
           CASE WHEN event_type <> 'purchase' THEN 'user-' || user_id END AS actor_login,
           'repo/' || (user_id % 7) AS repo_name, cast(NULL AS varchar) AS org_login,
           date_trunc('second', ts) AS created_at
    FROM events WHERE user_id % 5 <> 4 AND event_type <> 'error' AND NOT (event_type = 'purchase' AND user_id % 2 = 0)"""


@query("map_events", _MAPPED)
def map_events(spark, sf_dir):
    return P.map_event(event_lines(spark, sf_dir))


@query(
    "line_quality",
    """SELECT count(*) FILTER (user_id % 5 <> 4 AND event_type <> 'error') AS good,
              count(*) FILTER (user_id % 5 <> 4 AND event_type = 'error') AS bad,
              count(*) FILTER (user_id % 5 = 4) AS blank FROM events""",
)
def line_quality(spark, sf_dir):
    return P.count_lines(event_lines(spark, sf_dir))


@query("malformed_lines", "SELECT event_id FROM events WHERE user_id % 5 <> 4 AND event_type = 'error'")
def malformed_lines(spark, sf_dir):
    return P.drop_malformed(event_lines(spark, sf_dir))[1].select("event_id")


@query("epoch_millis", "SELECT o_orderkey, epoch_ms(o_orderdate) AS ms FROM orders")
def epoch_millis(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return load(spark, sf_dir, "orders").select("o_orderkey", S.to_epoch_ms(text).alias("ms"))


@query(
    "nested_access",
    """SELECT l_orderkey, l_linenumber, l_shipdate AS shipped, l_quantity AS quantity, l_returnflag AS first_tag,
              l_linestatus AS second_tag, cast(NULL AS varchar) AS third_tag, l_tax AS tax, cast(NULL AS double) AS unknown
       FROM lineitem""",
)
def nested_access(spark, sf_dir):
    nested = load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.struct(F.struct("l_shipdate", "l_quantity").alias("inner")).alias("s"),
        F.array("l_returnflag", "l_linestatus").alias("tags"),
        F.create_map(F.lit("tax"), F.struct(F.col("l_tax").alias("v"))).alias("m"),
    )
    return nested.select(
        "l_orderkey",
        "l_linenumber",
        S.struct_field("s", "inner", "l_shipdate").alias("shipped"),
        S.struct_field("s", "inner", "l_quantity").alias("quantity"),
        S.array_item("tags", 1).alias("first_tag"),
        S.array_item("tags", 2).alias("second_tag"),
        S.array_item("tags", 3).alias("third_tag"),
        S.map_value("m", "tax", "v").alias("tax"),
        S.map_value("m", "none", "v").alias("unknown"),
    )


def event_messages(spark, sf_dir: str) -> DataFrame:
    """``events`` as messages of one topic; the event number is the offset."""
    return load(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 16).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "event_type",
    )


@query(
    "browse_messages",
    """SELECT cast(user_id AS varchar) AS key, props AS value, cast(user_id % 16 AS integer) AS "partition", event_id AS "offset", ts AS timestamp
       FROM events WHERE user_id % 16 = 3 AND event_id >= 100 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25'
         AND event_type = 'view' ORDER BY event_id LIMIT 50""",
)
def browse_messages(spark, sf_dir):
    found = P.browse(
        event_messages(spark, sf_dir), "events", 3, (100, None), ("2024-01-05", "2024-01-25"), "event_type = 'view'", 50
    )
    return found.select("key", "value", "partition", "offset", "timestamp")


@query(
    "masked_customers",
    """SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name,
              sha256(c_mktsegment) AS c_mktsegment, regexp_replace(cast(c_nationkey AS varchar), '[0-9]', '#', 'g') AS c_nationkey
       FROM customer""",
)
def masked_customers(spark, sf_dir):
    rules = {"c_name": ("mask",), "c_mktsegment": ("hash",), "c_nationkey": ("replace", "[0-9]", "#"), "c_acctbal": ("drop",)}
    return P.mask_fields(load(spark, sf_dir, "customer"), rules)


@query(
    "masked_conversations",
    "SELECT conv_id, turn, role, regexp_replace(text, '[0-9]+', '#', 'g') AS text FROM conversations",
)
def masked_conversations(spark, sf_dir):
    return P.mask_fields(load(spark, sf_dir, "conversations"), {"text": ("replace", "[0-9]+", "#")})


def _commit_lines(spark, sf_dir: str) -> DataFrame:
    """Log lines from ``orders``: a commit response each, other text for priority 5."""
    line = F.format_string(
        "INFO COMMIT_RESPONSE id=%d code=%d, topic='%s', dataFiles=%d",
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1),
        "o_orderstatus",
        F.col("o_custkey") % 3,
    )
    noise = F.concat(F.lit("INFO heartbeat "), F.col("o_orderkey"))
    return load(spark, sf_dir, "orders").select(F.when(F.col("o_orderpriority") == "5-LOW", noise).otherwise(line).alias("value"))


@query(
    "commit_log_scan",
    """SELECT cast(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS integer) AS code, o_orderstatus AS topic,
              cast(o_custkey % 3 AS integer) AS data_files, count(*) AS n
       FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL""",
)
def commit_log_scan(spark, sf_dir):
    return A.count_by(P.scan_commit_log(_commit_lines(spark, sf_dir)), ["code", "topic", "data_files"])


@query(
    "commit_seen",
    """SELECT count(*) > 0 AS seen FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'F' AND o_custkey % 3 > 0""",
)
def commit_seen(spark, sf_dir):
    return P.commit_seen(_commit_lines(spark, sf_dir), "F")


@query(
    "clamped_prices",
    """SELECT l_orderkey, l_linenumber, greatest(1000.0, least(50000.0, l_extendedprice)) AS price,
              CASE WHEN l_quantity >= 40 THEN 'red' WHEN l_quantity >= 25 THEN 'yellow' ELSE 'green' END AS class
       FROM lineitem""",
)
def clamped_prices(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        S.clamp("l_extendedprice", 1000.0, 50000.0).alias("price"),
        S.classify("l_quantity", [(None, "green"), (25, "yellow"), (40, "red")]).alias("class"),
    )


@query(
    "unsigned_numbers",
    """SELECT event_id, (user_id * 7919 + 4294967296 - 1000000) % 4294967296 AS u32,
              cast(18446744073709551616 - 1 - event_id AS double) AS u64 FROM events""",
)
def unsigned_numbers(spark, sf_dir):
    return load(spark, sf_dir, "events").select(
        "event_id",
        S.as_unsigned((F.col("user_id") * 7919 - 1000000).cast("int"), 32).alias("u32"),
        S.as_unsigned(-1 - F.col("event_id"), 64).cast("double").alias("u64"),
    )


@query(
    "oneof_choice",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 'by_props' WHEN event_type = 'view' THEN 'by_user' END AS source_choice
       FROM events""",
)
def oneof_choice(spark, sf_dir):
    branches = load(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "click", F.col("props")).alias("by_props"),
        F.when(F.col("event_type") == "view", F.col("user_id")).alias("by_user"),
    )
    return P.with_choice(branches, "source", ["by_props", "by_user"]).select("event_id", "source_choice")


# ---- archives


@query(
    "hourly_archive",
    f"""WITH m AS ({_MAPPED}) SELECT type, count(*) AS n, min(created_at) AS first_at, max(created_at) AS last_at FROM m
        WHERE created_at >= TIMESTAMP '2024-01-03 05:00:00' AND created_at < TIMESTAMP '2024-01-20 13:00:00' GROUP BY type""",
)
def hourly_archive(spark, sf_dir):
    from datetime import datetime

    root, name = shared_dir(spark, "archive"), "file={day}-{hour}"
    lines = event_lines(spark, sf_dir)
    label = archives.hour_label(F.col("ts"), "{day}-{hour}")
    (
        lines.select(label.alias("file"), "value")
        .hint("rebalance", "file")
        .write.partitionBy("file")
        .option("compression", "gzip")
        .text(root)
    )
    read = archives.read_hourly_json(spark, root, datetime(2024, 1, 3, 5), datetime(2024, 1, 20, 13), name)
    return P.map_event(read).groupBy("type").agg(
        F.count(F.lit(1)).alias("n"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at")
    )


@query(
    "backfill_hours",
    """WITH b AS (SELECT date_trunc('hour', max(ts) - INTERVAL 3 DAY) AS lo, date_trunc('hour', max(ts) - INTERVAL 3 HOUR) AS hi FROM events),
            w AS (SELECT unnest(generate_series(lo, hi - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour FROM b),
            h AS (SELECT DISTINCT date_trunc('hour', ts) AS hour FROM events),
            g AS (SELECT min(hour) AS gap FROM w WHERE hour NOT IN (SELECT hour FROM h))
       SELECT hour FROM w, g WHERE gap IS NULL OR hour < gap""",
)
def backfill_hours(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    available = events.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour")).agg(F.count(F.lit(1)).alias("events"))
    return archives.plan_hours(spark, events.agg(F.max("ts")), None, available)


# ---- messaging


@query(
    "topic_round_trip",
    """SELECT cast(o_custkey AS varchar) AS key, count(*) AS n, max(o_orderdate) AS last_at, cast(sum(length(o_orderstatus)) AS bigint) AS bytes
       FROM orders GROUP BY o_custkey""",
)
def topic_round_trip(spark, sf_dir):
    log = shared_dir(spark, "topic")
    topics.write_topic(load(spark, sf_dir, "orders"), log, "orders", "o_custkey", "o_orderstatus", "o_orderdate")
    return topics.read_topic(spark, log, "orders").groupBy(F.col("key").cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.max("timestamp").alias("last_at"), F.sum(F.octet_length("value").cast("bigint")).alias("bytes")
    )


@query(
    "read_committed",
    """SELECT l_orderkey, l_linenumber FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
       WHERE l_returnflag = 'N' OR o_orderstatus = 'F'""",
)
def read_committed(spark, sf_dir):
    messages = load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "N", F.col("l_orderkey").cast("string")).alias("txn_id"),
    )
    status = F.when(F.col("o_orderstatus") == "F", "committed").when(F.col("o_orderstatus") == "P", "aborted").otherwise("open")
    txns = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("txn_id"), status.alias("status"), F.col("o_orderdate").alias("ts")
    )
    return topics.read_committed(messages, txns).drop("txn_id")


@query(
    "transaction_write",
    "SELECT cast(o_orderkey AS varchar) AS key FROM orders WHERE o_orderstatus <> 'P'",
)
def transaction_write(spark, sf_dir):
    log, orders = shared_dir(spark, "txn"), load(spark, sf_dir, "orders")
    for status in ("F", "O"):
        part = orders.where(F.col("o_orderstatus") == status)
        topics.write_transaction(part, log, "orders", f"txn-{status}", "o_orderkey", "o_orderpriority")
    # a batch whose transaction never ends
    topics.write_topic(orders.where(F.col("o_orderstatus") == "P"), log, "orders", "o_orderkey", "o_orderpriority", txn_id="txn-P")
    seen = topics.read_committed(topics.read_topic(spark, log, "orders"), topics.read_transactions(spark, log))
    return seen.select(F.col("key").cast("string").alias("key"))


@query(
    "reconcile",
    """SELECT o_orderkey AS order_key, 'missing' AS status, count(*) AS messages FROM orders
         WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1
       UNION ALL
       SELECT l_orderkey, 'extra', count(*) FROM lineitem
         WHERE l_returnflag = 'R' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1""",
)
def reconcile(spark, sf_dir):
    sent = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    received = load(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("order_key"))
    return G.reconcile(sent, received, ["order_key"])


def delivery_log(spark, sf_dir: str) -> DataFrame:
    """Send time from ``events``; acknowledged after ``value`` ms, received after twice that; errors never arrive."""
    us = S.epoch_us("ts")
    value_us = F.round(F.col("value") * 1000).cast("bigint")
    arrived = F.col("event_type") != "error"
    return load(spark, sf_dir, "events").select(
        "event_type",
        F.timestamp_micros(us).alias("sent_at"),
        F.timestamp_micros(us + value_us).alias("acked_at"),
        F.when(arrived, F.timestamp_micros(us + value_us * 2)).alias("received_at"),
        arrived.alias("ok"),
    )


_LOG = """(SELECT event_type, event_type <> 'error' AS ok, epoch_us(ts) / 1000.0 AS s, (epoch_us(ts) + cast(round(value * 1000) AS bigint)) / 1000.0 AS a,
           CASE WHEN event_type <> 'error' THEN (epoch_us(ts) + 2 * cast(round(value * 1000) AS bigint)) / 1000.0 END AS r FROM events)"""


def _rounded(df: DataFrame, digits: int = 3) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(
    "delivery_metrics",
    f"""SELECT count(s) AS messages_sent, count(r) AS messages_received, round(greatest(max(r), max(s)) - min(s), 3) AS total_ms,
               round(max(r) - min(r), 3) AS consume_ms, round(avg(a - s), 3) AS avg_produce_ms, round(avg(r - s), 3) AS avg_end_to_end_ms FROM {_LOG}""",
)
def delivery_metrics(spark, sf_dir):
    return _rounded(G.delivery_metrics(delivery_log(spark, sf_dir)))


@query("consume_rate", f"SELECT round(count(r) * 1000.0 / (max(r) - min(r)), 6) AS messages_per_second FROM {_LOG}")
def consume_rate(spark, sf_dir):
    return _rounded(G.consume_rate(delivery_log(spark, sf_dir)), 6)


@query(
    "batch_stats",
    f"""SELECT h AS hour, count(*) FILTER (ok) AS delivered, count(*) FILTER (NOT ok) AS failed,
               round(coalesce(count(*) / nullif((max(s) - min(s)) / 1000.0, 0), 0), 6) AS messages_per_second
        FROM (SELECT *, date_trunc('hour', make_timestamp(cast(s * 1000 AS bigint))) AS h FROM {_LOG}) GROUP BY h""",
)
def batch_stats(spark, sf_dir):
    log = delivery_log(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "sent_at"))
    return _rounded(G.batch_stats(log, ["hour"]), 6)


@query(
    "message_latency",
    "SELECT event_id, (epoch_us(ts) + cast(round(value * 1000) AS bigint)) // 1000 - epoch_us(ts) // 1000 AS latency_ms FROM events",
)
def message_latency(spark, sf_dir):
    log = load(spark, sf_dir, "events").withColumn(
        "got", F.timestamp_micros(S.epoch_us("ts") + F.round(F.col("value") * 1000).cast("bigint"))
    )
    return G.with_latency(log, "ts", "got").select("event_id", "latency_ms")


@query(
    "topic_overview",
    """SELECT event_type AS topic, count(DISTINCT user_id % 16) AS partitions, count(*) AS messages,
              cast(sum(strlen(props) + strlen(cast(user_id AS varchar))) AS bigint) AS bytes, max(event_id) AS max_offset
       FROM events GROUP BY event_type""",
)
def topic_overview(spark, sf_dir):
    return G.topic_overview(event_messages(spark, sf_dir).withColumn("topic", F.col("event_type")))
