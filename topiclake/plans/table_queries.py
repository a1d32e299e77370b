"""Table and streaming queries: the given tables are written as tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclake.operators import keyed as K
from topiclake.operators import projection as P
from topiclake.plans.bound import load, query
from topiclake.plans.format_queries import order_registry, order_topic
from topiclake.session import shared_dir
from topiclake.sources import topics
from topiclake.streaming import jobs
from topiclake.table import LakeTable
from topiclake.table.lake import ensure_table, list_tables

# ---- keyed rows

_LATEST = """SELECT user_id, event_id, ts, event_type, value, props FROM events
             QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
_FINAL = f"SELECT user_id, event_id, event_type, value FROM ({_LATEST}) WHERE event_type <> 'error'"
HALF = "2024-01-15"


@query("latest_by_key", _LATEST)
def latest_by_key(spark, sf_dir):
    return K.latest_by_key(load(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


def change_feed(spark, sf_dir: str) -> DataFrame:
    """``events`` as change envelopes keyed by user: errors delete, signups create, the rest updates."""
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    row = F.struct("user_id", "event_id", "event_type", "value")
    return load(spark, sf_dir, "events").select(
        F.struct(
            F.when(op == "d", row).alias("before"), F.when(op != "d", row).alias("after"), op.alias("op"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms")
        ).alias("value"),
        F.col("ts").alias("at"),
        F.col("event_id").alias("offset"),
    )


@query("cdc_apply", _FINAL)
def cdc_apply(spark, sf_dir):
    flat = P.flatten_debezium(change_feed(spark, sf_dir), "value", keep=["at", "offset"])
    return K.apply_changes(flat, ["user_id"], ["at", "offset"]).select("user_id", "event_id", "event_type", "value")


def _halves(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = load(spark, sf_dir, "events")
    cut = F.lit(HALF).cast("timestamp_ntz")
    return events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)


@query("upsert_table", _LATEST)
def upsert_table(spark, sf_dir):
    """Two upserts, the newer one first, with a compaction between them."""
    first, second = _halves(spark, sf_dir)
    table = LakeTable(spark, shared_dir(spark, "upsert")).create(id_columns=["user_id"])
    table.upsert(second, order=["ts", "event_id"])
    table.compact()
    table.upsert(first, order=["ts", "event_id"])
    return table.read(["user_id", "event_id", "ts", "event_type", "value", "props"])


@query("cdc_table", _FINAL)
def cdc_table(spark, sf_dir):
    flat = P.flatten_debezium(change_feed(spark, sf_dir), "value", keep=["at", "offset"])
    table, cut = LakeTable(spark, shared_dir(spark, "cdc")), F.lit(HALF).cast("timestamp_ntz")
    for part in (flat.where(F.col("at") < cut), flat.where(F.col("at") >= cut)):
        table.apply_changes(part, ["user_id"], ["at", F.lit(0), "offset"])
    table.compact()
    return table.read(["user_id", "event_id", "event_type", "value"])


@query(
    "key_change",
    f"""WITH a AS (SELECT user_id, event_type, event_id FROM events WHERE ts < TIMESTAMP '{HALF}'
                   QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
             b AS (SELECT user_id, event_type, event_id FROM events WHERE ts >= TIMESTAMP '{HALF}'
                   QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
        SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = a.user_id AND b.event_type = a.event_type)""",
)
def key_change(spark, sf_dir):
    first, second = _halves(spark, sf_dir)
    table = LakeTable(spark, shared_dir(spark, "keys")).create(id_columns=["user_id"])
    table.upsert(first, order=["ts", "event_id"])
    table.set_id_columns(["user_id", "event_type"])
    table.upsert(second, order=["ts", "event_id"])
    return table.read(["user_id", "event_type", "event_id"])


# ---- schema and partitions


@query(
    "schema_union",
    """SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def schema_union(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    old = orders.where(F.col("o_orderstatus") != "O").select("o_orderkey", "o_custkey", "o_totalprice")
    new = orders.where(F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    return K.union_versions(old, new)


@query(
    "schema_evolution",
    """SELECT c_custkey, c_nationkey AS nation, c_acctbal AS balance, CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS segment,
              CASE WHEN c_custkey % 2 = 0 THEN c_name END AS c_name
       FROM (SELECT c_custkey, cast(c_nationkey AS bigint) AS c_nationkey, cast(CASE WHEN c_custkey % 2 = 0 THEN cast(c_acctbal AS float) ELSE c_acctbal END AS double) AS c_acctbal, c_mktsegment, c_name FROM customer)""",
)
def schema_evolution(spark, sf_dir):
    """The second batch widens two columns, adds one and leaves one out."""
    customer = load(spark, sf_dir, "customer")
    table = LakeTable(spark, shared_dir(spark, "evolve"))
    old = customer.where(F.col("c_custkey") % 2 == 0)
    new = customer.where(F.col("c_custkey") % 2 == 1)
    table.append(old.select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_acctbal").cast("float").alias("balance"), "c_name"))
    table.append(
        new.select("c_custkey", F.col("c_nationkey").cast("bigint").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    )
    return table.read(["c_custkey", "nation", "balance", "segment", "c_name"])


def _month_table(spark, sf_dir: str, spec: str = "[month(o_orderdate)]") -> LakeTable:
    table = LakeTable(spark, shared_dir(spark, "months")).create(partition_by=spec)
    table.append(load(spark, sf_dir, "orders"))
    return table


@query(
    "partition_counts",
    """SELECT cast((year(o_orderdate) - 1970) * 12 + month(o_orderdate) - 1 AS integer) AS month, cast(count(*) AS bigint) AS record_count
       FROM orders GROUP BY 1""",
)
def partition_counts(spark, sf_dir):
    parts = _month_table(spark, sf_dir).partitions()
    month = F.get_json_object("partition", "$.o_orderdate_month").cast("int").alias("month")
    return parts.groupBy(month).agg(F.sum("record_count").alias("record_count"))


@query("compacted_partition_counts", "SELECT o_orderstatus AS status, cast(count(*) AS bigint) AS record_count FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def compacted_partition_counts(spark, sf_dir):
    """Live rows of a keyed, partitioned table: written twice, the pending orders removed again, folded after each step."""
    orders = load(spark, sf_dir, "orders")
    table = LakeTable(spark, shared_dir(spark, "live")).create(id_columns=["o_orderkey"], partition_by="[o_orderstatus]")
    table.upsert(orders)
    table.compact()
    gone = F.when(F.col("o_orderstatus") == "P", F.lit("d")).otherwise(F.lit("u"))
    table.upsert(orders.withColumn("op", gone), op="op")
    table.compact()
    status = F.get_json_object("partition", "$.o_orderstatus_key").alias("status")
    return table.partitions().groupBy(status).agg(F.sum("record_count").alias("record_count"))


@query(
    "partition_evolution",
    """SELECT cast(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS integer) AS spec_id, cast(sum(1) AS bigint) AS record_count,
              cast((year(o_orderdate) - 1970) * 12 + month(o_orderdate) - 1 AS integer) AS month FROM orders GROUP BY 1, 3""",
)
def partition_evolution(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    table = LakeTable(spark, shared_dir(spark, "specs")).create(partition_by="[month(o_orderdate)]")
    table.append(orders.where(F.col("o_orderstatus") == "F"))
    table.set_partition_by("[month(o_orderdate), bucket(o_custkey, 4)]")
    table.append(orders.where(F.col("o_orderstatus") != "F"))
    month = F.get_json_object("partition", "$.o_orderdate_month").cast("int").alias("month")
    return table.partitions().groupBy("spec_id", month).agg(F.sum("record_count").alias("record_count"))


@query(
    "hour_partitions",
    "SELECT epoch_us(ts) // 3600000000 AS hour, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10 03:30:00' AND ts < TIMESTAMP '2024-01-11' GROUP BY 1",
)
def hour_partitions(spark, sf_dir):
    table = LakeTable(spark, shared_dir(spark, "hours")).create(partition_by="[hour(ts)]")
    table.append(load(spark, sf_dir, "events"))
    rows = table.read(["ts"], ("ts", "2024-01-10 03:30:00", "2024-01-11"))
    hour = F.call_function("div", F.unix_micros(F.col("ts").cast("timestamp")), F.lit(3_600_000_000))
    return rows.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "pruned_range",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1995-03-10' AND o_orderdate < TIMESTAMP '1995-06-01'",
)
def pruned_range(spark, sf_dir):
    return _month_table(spark, sf_dir).read(["o_orderkey", "o_totalprice"], ("o_orderdate", "1995-03-10", "1995-06-01"))


# ---- metadata


def _two_batches(spark, sf_dir: str) -> LakeTable:
    first, second = _halves(spark, sf_dir)
    table = LakeTable(spark, shared_dir(spark, "meta"))
    table.append(first)
    table.append(second)
    return table


@query(
    "snapshots",
    f"""SELECT cast(1 AS bigint) AS commit_id, 'append' AS operation, count(*) AS record_count FROM events WHERE ts >= TIMESTAMP '{HALF}'
        UNION ALL SELECT 0, 'append', count(*) FROM events WHERE ts < TIMESTAMP '{HALF}'""",
)
def snapshots(spark, sf_dir):
    return _two_batches(spark, sf_dir).snapshots().select("commit_id", "operation", "record_count")


@query(
    "table_files",
    "SELECT 'DATA' AS content, 'PARQUET' AS file_format, cast(count(*) AS bigint) AS record_count, true AS sized FROM events",
)
def table_files(spark, sf_dir):
    return _two_batches(spark, sf_dir).files().groupBy("content", "file_format").agg(
        F.sum("record_count").alias("record_count"), F.every(F.col("file_size_in_bytes") > 0).alias("sized")
    )


@query(
    "manifests",
    f"""SELECT cast(0 AS bigint) AS commit, 'append' AS operation, cast(count(*) AS bigint) AS added_rows FROM events WHERE ts < TIMESTAMP '{HALF}'
        UNION ALL SELECT 1, 'append', cast(count(*) AS bigint) FROM events WHERE ts >= TIMESTAMP '{HALF}'""",
)
def manifests(spark, sf_dir):
    return _two_batches(spark, sf_dir).manifests().select("commit", "operation", "added_rows")


@query(
    "history",
    """SELECT * FROM (VALUES (cast(0 AS bigint), cast(NULL AS bigint), true), (1, 0, true)) h(snapshot_id, parent_id, is_current_ancestor)
       WHERE (SELECT count(*) FROM events) > 0""",
)
def history(spark, sf_dir):
    return _two_batches(spark, sf_dir).history().drop("made_current_at")


@query(
    "table_options",
    """SELECT * FROM (VALUES (cast(0 AS bigint), 'month(o_orderdate)', ''), (2, 'month(o_orderdate), bucket(o_custkey, 16)', ''))
         o(commit_id, partition_by, id_columns) WHERE (SELECT count(*) FROM orders) > 0""",
)
def table_options(spark, sf_dir):
    table = _month_table(spark, sf_dir)
    table.set_partition_by("[month(o_orderdate), bucket(o_custkey, 16)]")
    return table.table_options().drop("options", "committed_at")


@query(
    "describe_table",
    """SELECT name, CASE type WHEN 'BIGINT' THEN 'bigint' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' END AS value
       FROM (SELECT column_name AS name, column_type AS type FROM (DESCRIBE SELECT * FROM events))""",
)
def describe_table(spark, sf_dir):
    return _two_batches(spark, sf_dir).describe().where(F.col("kind") == "column").drop("kind")


@query("truncated_table", f"SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '{HALF}'")
def truncated_table(spark, sf_dir):
    first, second = _halves(spark, sf_dir)
    table = LakeTable(spark, shared_dir(spark, "truncate"))
    table.append(first)
    table.truncate()
    table.append(second)
    return table.read(["event_id"]).agg(F.count(F.lit(1)).alias("n"))


# ---- streaming


def _run(stream_query) -> None:
    stream_query.awaitTermination()
    if stream_query.exception() is not None:
        raise stream_query.exception()


@query(
    "stream_avro_to_table",
    """SELECT o_orderkey, status, o_totalprice, placed, priority FROM (
         SELECT o_orderkey, o_orderstatus AS status, o_totalprice, o_orderdate AS placed, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS priority FROM orders)""",
)
def stream_avro_to_table(spark, sf_dir):
    """Avro topic to a month-partitioned table; a restart on the same checkpoint adds nothing."""
    log, checkpoint = shared_dir(spark, "topic"), shared_dir(spark, "checkpoint")
    topics.write_topic(order_topic(spark, sf_dir), log, "orders", "o_orderkey", "value")
    table = LakeTable(spark, shared_dir(spark, "orders"))
    options = {"convert.value.type": "by_schema_id", "transform.value.type": "flatten", "partition.by": "[month(placed)]"}
    for _ in range(2):
        source = topics.read_topic_stream(spark, log, "orders")
        _run(jobs.ingest_topic(spark, source, table, options, checkpoint, order_registry(spark), "orders", once=True))
    return table.refresh().read(["o_orderkey", "status", "o_totalprice", "placed", "priority"])


@query(
    "stream_mixed_to_table",
    """SELECT count(*) FILTER (o_orderkey % 10 > 1) AS decoded, count(*) FILTER (o_orderkey % 10 <= 1) AS undecoded,
         count(*) FILTER (o_orderkey % 10 > 1) AS kept, count(*) FILTER (o_orderkey % 10 <= 1) AS aside FROM orders""",
)
def stream_mixed_to_table(spark, sf_dir):
    """A topic with broken bytes and unknown schema ids: what the commits count, and what table and side table hold."""
    log = shared_dir(spark, "topic")
    broken = F.when(F.col("o_orderkey") % 10 == 0, F.lit(b"??")).when(F.col("o_orderkey") % 10 == 1, F.concat(F.lit(b"\x00\x00\x00\xff\xff"), F.substring("value", 6, 1 << 30)))
    topics.write_topic(order_topic(spark, sf_dir).withColumn("value", broken.otherwise(F.col("value"))), log, "orders", "o_orderkey", "value")
    table = LakeTable(spark, shared_dir(spark, "orders"))
    options = {"convert.value.type": "by_schema_id", "transform.value.type": "flatten"}
    source = topics.read_topic_stream(spark, log, "orders", max_per_batch=2)
    _run(jobs.ingest_topic(spark, source, table, options, shared_dir(spark, "checkpoint"), order_registry(spark), "orders", once=True))
    kept = table.refresh().read().agg(F.count("*").alias("kept"))
    aside = table.undecoded().read().agg(F.count_distinct("partition", "offset").alias("aside"))
    return table.commits().agg(F.sum("decoded_count").alias("decoded"), F.sum("undecoded_count").alias("undecoded")).crossJoin(kept).crossJoin(aside)


@query("stream_cdc_to_table", _FINAL)
def stream_cdc_to_table(spark, sf_dir):
    """JSON change envelopes through a topic into a keyed table, in several micro-batches."""
    log = shared_dir(spark, "topic")
    feed = change_feed(spark, sf_dir).select(F.col("value.after"), F.col("value.before"), F.to_json("value").alias("value"), "at")
    key = F.coalesce(F.col("after.user_id"), F.col("before.user_id")).cast("string")
    topics.write_topic(feed.select(key.alias("key"), "value", "at").repartition(4), log, "cdc", "key", "value", timestamp="at")
    row = "struct<user_id:bigint,event_id:bigint,event_type:string,value:double>"
    options = {
        "convert.value.type": "json",
        "json.schema": f"before {row}, after {row}, op string, ts_ms bigint",
        "transform.value.type": "flatten_debezium",
        "id.columns": "[user_id]",
        "cdc.field": "_cdc.op",
    }
    table = LakeTable(spark, shared_dir(spark, "users"))
    source = topics.read_topic_stream(spark, log, "cdc", max_per_batch=2)
    _run(jobs.ingest_topic(spark, source, table, options, shared_dir(spark, "checkpoint"), topic="cdc", once=True))
    return table.refresh().read(["user_id", "event_id", "event_type", "value"])


@query(
    "stream_telemetry",
    """SELECT cast(l_orderkey AS varchar) AS vin, CASE WHEN l_returnflag <> 'R' THEN l_linestatus END AS iccid,
              CASE WHEN l_returnflag <> 'R' THEN cast(l_quantity AS float) END AS speed,
              CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS request, cast(NULL AS integer) AS response, l_shipdate AS event_timestamp
       FROM lineitem""",
)
def stream_telemetry(spark, sf_dir):
    """Schemaless table to typed table; returned items carry broken JSON."""
    good = F.to_json(F.struct(F.col("l_linestatus").alias("iccid"), F.col("l_quantity").alias("speed"), F.col("l_linenumber").alias("request")))
    rows = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("key"),
        F.when(F.col("l_returnflag") == "R", F.substring(good, 1, 12)).otherwise(good).alias("value"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
    )
    source, target = LakeTable(spark, shared_dir(spark, "telemetry")), LakeTable(spark, shared_dir(spark, "vehicle"))
    source.append(rows)
    _run(jobs.telemetry_job(spark, source, target, shared_dir(spark, "checkpoint"), trigger=None))
    return target.read()


@query("stream_live_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_live_counts(spark, sf_dir):
    """Running counts in complete mode; each trigger replaces the result folder's newest version."""
    schema = load(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    target = shared_dir(spark, "counts")

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/version={batch_id}")

    counts = jobs.live_counts(stream, ["event_type"])
    writer = counts.writeStream.outputMode("complete").foreachBatch(publish)
    _run(writer.option("checkpointLocation", shared_dir(spark, "checkpoint")).trigger(availableNow=True).start())
    results = spark.read.schema("event_type string, n bigint, version bigint").parquet(target)
    newest = results.agg(F.max("version"))
    return results.where(F.col("version") == newest.scalar()).drop("version")


@query(
    "ingest_delay",
    "SELECT 'events' AS topic, count(*) * 3.0::double AS fields, true AS positive FROM events",
)
def ingest_delay(spark, sf_dir):
    """Commit delay and written fields per second of an ingestion in several micro-batches."""
    log = shared_dir(spark, "topic")
    events = load(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), "props", "ts")
    topics.write_topic(events.repartition(4), log, "events", "key", "props", timestamp="ts")
    table = LakeTable(spark, shared_dir(spark, "raw"))
    source = topics.read_topic_stream(spark, log, "events", max_per_batch=2)
    _run(jobs.ingest_topic(spark, source, table, {}, shared_dir(spark, "checkpoint"), topic="events", once=True))
    speed = table.refresh().fields_per_second(1000).select("commit_id", "fields_per_second")
    return table.ingest_delay().join(speed, "commit_id").groupBy("topic").agg(
        F.sum("fields_per_second").alias("fields"), F.every(F.col("delay_ms") > 0).alias("positive")
    )


@query("ensured_table", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def ensured_table(spark, sf_dir):
    """A table that is created once and found the second time."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    path = shared_dir(spark, "ensured")
    for part in (F.col("l_orderkey") % 2 == 0, F.col("l_orderkey") % 2 == 1):
        ensure_table(spark, path, lines.schema, "[l_returnflag]").append(lines.where(part))
    return LakeTable(spark, path).read().groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("listed_tables", "SELECT DISTINCT 'status_' || lower(o_orderstatus) AS name, 'MANAGED' AS table_type FROM orders")
def listed_tables(spark, sf_dir):
    """One catalog table for each order status, which there are a few of."""
    space = f"listed_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {space}")
    try:
        for row in load(spark, sf_dir, "orders").select(F.lower("o_orderstatus").alias("s")).distinct().collect():
            for _ in range(2):
                ensure_table(spark, f"{space}.status_{row.s}", "o_orderkey bigint")
        return list_tables(spark).where(F.col("namespace") == space).select("name", "table_type")
    finally:
        spark.sql(f"DROP DATABASE {space} CASCADE")


@query("stream_latency", "SELECT event_type, count(*) AS n, true AS late FROM events GROUP BY event_type")
def stream_latency(spark, sf_dir):
    """Latency of every message of a stream; all of the given ones are old."""
    schema = load(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    stream = jobs.latency_stream(stream.withColumn("timestamp", F.col("ts").cast("timestamp")))
    target = shared_dir(spark, "latency")
    writer = stream.select("event_type", "latency_ms").writeStream.format("parquet").option("path", target)
    _run(writer.option("checkpointLocation", shared_dir(spark, "checkpoint")).trigger(availableNow=True).start())
    seen = spark.read.parquet(target)
    return seen.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.every(F.col("latency_ms") > 0).alias("late"))


@query(
    "follow_keyed_table",
    f"""SELECT (SELECT count(DISTINCT user_id) FROM events WHERE ts < TIMESTAMP '{HALF}') + (SELECT count(DISTINCT user_id) FROM events WHERE ts >= TIMESTAMP '{HALF}') AS changes,
               (SELECT count(DISTINCT user_id) FROM events WHERE ts >= TIMESTAMP '{HALF}') AS after_restart""",
)
def follow_keyed_table(spark, sf_dir):
    """Change rows of two upserts, a compaction between them; the follower restarts in between."""
    source, target = (LakeTable(spark, shared_dir(spark, n)) for n in ("keyed", "changes"))
    source.create(id_columns=["user_id"])
    ckpt = shared_dir(spark, "checkpoint")

    def sink(rows: DataFrame, batch_id: int) -> None:
        target.append(rows.select("user_id", F.col("_op").alias("op"), F.lit(batch_id).alias("batch")), stream=(ckpt, batch_id))

    for part in _halves(spark, sf_dir):
        source.upsert(part.select("user_id", "event_id", "ts"), order=["ts", "event_id"])
        _run(jobs.follow_table(spark, source, sink, ckpt))
        source.compact()
    counts = target.refresh().read().groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.sum("n").alias("changes"), F.max_by("n", "batch").alias("after_restart"))


@query("latest_restart", f"SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '{HALF}' GROUP BY event_type")
def latest_restart(spark, sf_dir):
    """A stream from ``latest`` sees what was written while it was stopped, but nothing from before its first start."""
    log, ckpt, target = (shared_dir(spark, n) for n in ("log", "checkpoint", "fresh"))
    old, new = _halves(spark, sf_dir)

    def start() -> None:
        stream = topics.read_topic_stream(spark, log, "events", starting="latest", checkpoint=ckpt)
        writer = stream.select(F.col("key").cast("string").alias("event_type")).writeStream.format("parquet").option("path", target)
        _run(writer.option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    topics.write_topic(old, log, "events", "event_type", "props", timestamp="ts")
    start()
    topics.write_topic(new, log, "events", "event_type", "props")
    start()
    return spark.read.schema("event_type string").parquet(target).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
