import datetime as dt

from pyspark.sql import functions as F

from tests.fixtures import LINE_V1, registry_df, supplier_registry
from tests.test_formats import line_df
from topiclake.formats.avro import encode_avro
from topiclake.formats.protobuf import encode_protobuf
from topiclake.session import shared_dir
from topiclake.sources import topics
from topiclake.streaming import jobs
from topiclake.table import LakeTable


def run(query):
    query.awaitTermination(300)
    assert query.exception() is None and not query.isActive


def test_transactions_are_seen_after_commit_only(spark):
    log = shared_dir(spark, "log")
    df = spark.createDataFrame([(f"msg-{i}", f"v{i}") for i in range(4)], "k string, v string")
    topics.write_topic(df, log, "t", "k", "v")
    topics.write_transaction(df, log, "t", "done", "k", "v")
    topics.write_topic(df, log, "t", "k", "v", txn_id="open")
    topics.write_topic(df, log, "other", "k", "v")
    spark.createDataFrame([("open", "open", dt.datetime(2024, 1, 1))], topics.TXN_SCHEMA).write.mode("append").parquet(f"{log}/txns")
    try:
        topics.write_transaction(df, log, "t", "failed", "k", F.raise_error(F.lit("stop")))
    except Exception:
        pass
    messages = topics.read_topic(spark, log, "t")
    assert messages.count() == 12
    seen = topics.read_committed(messages, topics.read_transactions(spark, log))
    assert seen.count() == 8
    assert messages.select("partition", "offset").distinct().count() == 12  # offsets never repeat
    status = {(r.txn_id, r.status) for r in topics.read_transactions(spark, log).collect()}
    assert ("failed", "aborted") in status and ("failed", "committed") not in status


def test_avro_topic_to_partitioned_table_and_restart(spark):
    log, ckpt = shared_dir(spark, "log"), shared_dir(spark, "ckpt")
    reg = registry_df(spark, [("lines-value", 1, 3, "AVRO", LINE_V1, [])])
    table = LakeTable(spark, shared_dir(spark, "lines"))
    options = {"convert.value.type": "by_schema_id", "transform.value.type": "flatten", "partition.by": "[month(l_shipdate)]"}

    def ingest():
        source = topics.read_topic_stream(spark, log, "lines", max_per_batch=2)
        run(jobs.ingest_topic(spark, source, table, options, ckpt, reg, "lines", once=True))

    messages = encode_avro(line_df(spark), 3, LINE_V1, keep=["l_orderkey"])
    topics.write_topic(messages, log, "lines", "l_orderkey", "value")
    broken = spark.createDataFrame([(5, bytearray(b"??"))], "l_orderkey bigint, value binary")
    topics.write_topic(broken, log, "lines", "l_orderkey", "value")
    ingest()
    assert table.read().count() == 10
    commits = table.refresh().commits().count()
    ingest()  # restart on the same checkpoint
    assert table.refresh().commits().count() == commits and table.read().count() == 10
    topics.write_topic(messages, log, "lines", "l_orderkey", "value")
    ingest()
    assert table.refresh().read().count() == 20
    assert table.read(["l_shipmode", "part"]).where("part.p_name = 's3'").count() == 2
    delay = table.ingest_delay().where("topic = 'lines'").collect()
    assert delay and all(d.delay_ms >= 0 for d in delay)
    rate = table.fields_per_second(1000).agg(F.sum("fields_per_second")).first()[0]
    assert rate == 20 * 12


def test_undecodable_messages_are_kept_aside(spark):
    row = "struct<id:int,v:string>"
    log = shared_dir(spark, "log")
    envelope = '{"after": {"id": %d, "v": "x"}, "op": "c", "ts_ms": 1}'
    df = spark.createDataFrame([("a", envelope % 1), ("b", "{broken"), ("c", envelope % 2), ("d", None)], "k string, v string")
    topics.write_topic(df, log, "c", "k", "v")
    table = LakeTable(spark, shared_dir(spark, "changes"))
    options = {"convert.value.type": "json", "json.schema": f"before {row}, after {row}, op string, ts_ms bigint", "transform.value.type": "flatten_debezium", "id.columns": "[id]", "cdc.field": "_cdc.op"}
    source, ckpt = topics.read_topic_stream(spark, log, "c"), shared_dir(spark, "ckpt")
    for _ in range(2):
        run(jobs.ingest_topic(spark, source, table, options, ckpt, topic="c", once=True))
    assert {r.id for r in table.refresh().read().collect()} == {1, 2}
    aside = table.undecoded().read().collect()
    assert [bytes(r.value) for r in aside] == [b"{broken"] and aside[0].offset is not None
    assert [(r.decoded_count, r.undecoded_count) for r in table.commits().where("operation = 'cdc'").collect()] == [(3, 1)]


def test_protobuf_topic_upsert(spark):
    log = shared_dir(spark, "log")
    reg = supplier_registry(spark)
    rows = spark.createDataFrame([("p1", 1.0), ("p2", 2.0)], "s_suppkey string, s_acctbal double")
    later = spark.createDataFrame([("p1", 9.0)], "s_suppkey string, s_acctbal double")
    for i, df in enumerate((rows, later)):
        m = encode_protobuf(df, reg, "tests.supply.Supplier", keep=["s_suppkey"])
        topics.write_topic(m, log, "p", "s_suppkey", "value", timestamp=F.timestamp_seconds(F.lit(100 + i)))
    table = LakeTable(spark, shared_dir(spark, "suppliers"))
    options = {
        "convert.value.type": "by_latest_schema", "message.full.name": "tests.supply.Supplier", "transform.value.type": "flatten",
        "upsert.enable": True, "id.columns": "[s_suppkey]",
    }
    source = topics.read_topic_stream(spark, log, "p")
    run(jobs.ingest_topic(spark, source, table, options, shared_dir(spark, "ckpt"), reg, "p", once=True))
    assert {r.s_suppkey: r.s_acctbal for r in table.read().collect()} == {"p1": 9.0, "p2": 2.0}


def telemetry(spark, n):
    """Vehicle messages over the rows of a range."""
    body = F.to_json(F.struct(F.concat(F.lit("card"), "id").alias("iccid"), (F.col("id") % 90 + 0.5).alias("speed"), (F.col("id") % 7).cast("int").alias("request"), (F.col("id") % 5).cast("int").alias("response")))
    return spark.range(n).select(F.concat(F.lit("vin"), "id").alias("key"), body.alias("value"), F.timestamp_seconds(F.col("id") + 1_600_000_000).alias("timestamp"))


def test_telemetry_pipeline(spark):
    source, target = LakeTable(spark, shared_dir(spark, "src")), LakeTable(spark, shared_dir(spark, "dst"))
    ckpt = shared_dir(spark, "ckpt")
    good = telemetry(spark, 50)
    bad = good.limit(2).withColumn("value", F.lit("{broken"))
    partial = good.limit(1).withColumn("value", F.lit('{"iccid":"x"}'))
    source.append(good)
    source.append(bad.unionByName(partial))
    run(jobs.telemetry_job(spark, source, target, ckpt, trigger=None))
    assert target.read().columns == ["vin", "iccid", "speed", "request", "response", "event_timestamp"]
    batch = sorted(map(str, jobs.parse_telemetry(source.read()).collect()))
    assert sorted(map(str, target.read().collect())) == batch  # streaming equals batch
    assert target.read().where("iccid is null").count() == 2 and target.read().where("iccid = 'x' and speed is null").count() == 1
    run(jobs.telemetry_job(spark, source, target, ckpt, trigger=None))
    assert target.refresh().read().count() == 53
    source.append(good)
    run(jobs.telemetry_job(spark, source, target, ckpt, trigger=None))
    assert target.refresh().read().count() == 103


def test_raw_and_json_topics(spark):
    log = shared_dir(spark, "log")
    df = spark.createDataFrame([("a", '{"x": 1}'), ("b", "nope")], "k string, v string")
    topics.write_topic(df, log, "j", "k", "v")
    raw, parsed = LakeTable(spark, shared_dir(spark, "raw")), LakeTable(spark, shared_dir(spark, "json"))
    source = topics.read_topic_stream(spark, log, "j")
    run(jobs.ingest_topic(spark, source, raw, {}, shared_dir(spark, "c"), once=True))
    assert raw.read().columns == ["key", "value", "timestamp"] and raw.read().count() == 2
    options = {"convert.value.type": "json", "json.schema": "x int", "transform.value.type": "flatten"}
    run(jobs.ingest_topic(spark, source, parsed, options, shared_dir(spark, "c"), once=True))
    assert sorted(r.x or 0 for r in parsed.read().collect()) == [0, 1]


def test_live_counts_and_latency(spark):
    path = shared_dir(spark, "events")
    spark.range(30).select(F.concat(F.lit("customer-"), F.col("id") % 3).alias("customer_id"), F.current_timestamp().alias("timestamp")).write.parquet(path)
    schema = spark.read.parquet(path).schema
    stream = jobs.read_table_stream(spark, path, schema)
    q = jobs.live_counts(stream, ["customer_id"]).writeStream.format("memory").queryName("live").outputMode("complete").trigger(availableNow=True).start()
    run(q)
    assert {r.customer_id: r.n for r in spark.table("live").collect()} == {f"customer-{i}": 10 for i in range(3)}
    q = jobs.latency_stream(stream).writeStream.format("memory").queryName("lat").trigger(availableNow=True).start()
    run(q)
    assert spark.table("lat").where("latency_ms >= 0").count() == 30


def test_latest_start_skips_old_messages(spark):
    log = shared_dir(spark, "log")
    df = spark.createDataFrame([("a", "old")], "k string, v string")
    topics.write_topic(df, log, "t", "k", "v", timestamp=F.lit("2020-01-01").cast("timestamp"))
    stream = topics.read_topic_stream(spark, log, "t", starting="latest")
    topics.write_topic(df.withColumn("v", F.lit("new")), log, "t", "k", "v")
    q = stream.writeStream.format("memory").queryName("fresh").trigger(availableNow=True).start()
    run(q)
    assert [bytes(r.value) for r in spark.table("fresh").collect()] == [b"new"]


def test_latest_start_survives_a_restart(spark):
    log, ckpt, out = (shared_dir(spark, n) for n in ("log", "ckpt", "out"))
    df = spark.createDataFrame([("a", "old")], "k string, v string")
    topics.write_topic(df, log, "t", "k", "v", timestamp=F.lit("2020-01-01").cast("timestamp"))

    def start():
        stream = topics.read_topic_stream(spark, log, "t", starting="latest", checkpoint=ckpt)
        run(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    start()
    for word in ("between", "later"):
        topics.write_topic(df.withColumn("v", F.lit(word)), log, "t", "k", "v")
        start()
    assert sorted(bytes(r.value) for r in spark.read.parquet(out).collect()) == [b"between", b"later"]
    assert topics.read_topic(spark, log, "t", starting="latest").count() == 0


def test_following_a_keyed_table(spark):
    source, seen = LakeTable(spark, shared_dir(spark, "keyed")).create(id_columns=["k"]), []
    ckpt = shared_dir(spark, "ckpt")

    def follow():
        run(jobs.follow_table(spark, source, lambda rows, _: seen.extend(tuple(r) for r in rows.select("k", "v", "_op").collect()), ckpt))

    rows = lambda *x: spark.createDataFrame(list(x), "k int, v string")
    source.upsert(rows((1, "a"), (2, "b")))
    source.upsert(rows((1, "c")))
    follow()
    source.compact()
    source.upsert(rows((2, "b")).withColumn("op", F.lit("d")), op="op")
    follow()
    assert sorted(seen) == [(1, "a", "u"), (1, "c", "u"), (2, "b", "d"), (2, "b", "u")]
    assert sum(r.record_count for r in source.partitions().collect()) >= 2
