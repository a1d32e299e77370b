"""Topics: Kafka when servers are named, else a topic log of Parquet files.

A topic log keeps Kafka's columns under ``<path>/messages/topic=<t>/append=<n>``
and the states of transactions under ``<path>/txns``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.session import child_names, path_exists, use_utc

MESSAGE_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]
LOG_SCHEMA = (
    "key binary, value binary, partition int, offset bigint, timestamp timestamp, txn_id string, "
    "topic string, append bigint"
)
TXN_SCHEMA = "txn_id string, status string, ts timestamp"
DEFAULT_PARTITIONS = 16

_SERVERS = re.compile(r"^[\w.-]+:\d+(,[\w.-]+:\d+)*$")


def is_servers(location: str) -> bool:
    return bool(_SERVERS.match(location))


def _kafka_options(location: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": location,
        "subscribe": topic,
        "kafka.isolation.level": "read_committed",
    }


def read_topic(spark: SparkSession, location: str, topic: str, starting: str = "earliest") -> DataFrame:
    """All messages of a topic as a batch; a log also has ``txn_id``. A batch from ``latest`` on is empty."""
    use_utc(spark)
    if starting == "latest":
        return read_topic(spark, location, topic).limit(0)
    if is_servers(location):
        reader = spark.read.format("kafka").options(**_kafka_options(location, topic)).option("startingOffsets", starting)
        return reader.load().select(*MESSAGE_COLUMNS)
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{location}/messages").where(F.col("topic") == topic)
    return log.select(*MESSAGE_COLUMNS, "txn_id")


def _first_start(spark: SparkSession, checkpoint: str | None) -> int:
    """Microseconds of the first start with a checkpoint; written once."""
    now = spark.range(1).select(F.unix_micros(F.current_timestamp()).alias("at"))
    if checkpoint is None:
        return now.first()[0]
    path = f"{checkpoint.rstrip('/')}-start"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        now.coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).agg(F.min("at")).first()[0]


def read_topic_stream(
    spark: SparkSession,
    location: str,
    topic: str,
    starting: str = "earliest",
    max_per_batch: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """A topic as a stream.

    ``max_per_batch`` limits messages per batch for Kafka and files per batch
    for a log. ``latest`` on a log skips messages from before the first start:
    its time is kept in the folder of the query's ``checkpoint``, so a restart
    delivers what came in between. Without a checkpoint it is the time of this call.
    """
    use_utc(spark)
    if is_servers(location):
        reader = spark.readStream.format("kafka").options(**_kafka_options(location, topic)).option("startingOffsets", starting)
        if max_per_batch:
            reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
        return reader.load().select(*MESSAGE_COLUMNS)
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_per_batch)
    log = reader.parquet(f"{location}/messages").where(F.col("topic") == topic)
    if starting == "latest":
        log = log.where(F.col("timestamp") >= F.timestamp_micros(F.lit(_first_start(spark, checkpoint))))
    return log.select(*MESSAGE_COLUMNS, "txn_id")


def read_transactions(spark: SparkSession, location: str) -> DataFrame:
    if not path_exists(spark, f"{location}/txns"):
        return spark.createDataFrame([], TXN_SCHEMA)
    return spark.read.schema(TXN_SCHEMA).parquet(f"{location}/txns")


def read_committed(messages: DataFrame, txns: DataFrame) -> DataFrame:
    """Messages outside transactions and those of committed ones.

    Messages without a transaction are split off, so their null ids meet in no
    shuffle. The status side has one row per id.
    """
    committed = txns.groupBy("txn_id").agg(F.max_by("status", "ts").alias("status"))
    committed = committed.where(F.col("status") == "committed").select("txn_id")
    plain = messages.where(F.col("txn_id").isNull())
    return plain.unionByName(messages.where(F.col("txn_id").isNotNull()).join(committed, "txn_id", "left_semi"))


def to_messages(
    df: DataFrame,
    topic: str,
    key: str | Column,
    value: str | Column,
    timestamp: str | Column | None = None,
    partitions: int = DEFAULT_PARTITIONS,
    first_offset: int | Column = 0,
) -> DataFrame:
    """Rows in the message layout.

    The partition is a hash of the key. Offsets rise within a partition in the
    order of the tasks and have gaps, as in a compacted topic; numbering without
    gaps would send each partition through a single task.
    """
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    t = F.current_timestamp() if timestamp is None else F.col(timestamp) if isinstance(timestamp, str) else timestamp
    base = F.lit(first_offset) if isinstance(first_offset, int) else first_offset
    return df.select(
        k.cast("string").cast("binary").alias("key") if isinstance(key, str) and dict(df.dtypes)[key] != "binary" else k.cast("binary").alias("key"),
        v.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.coalesce(F.xxhash64(k), F.lit(0)), F.lit(partitions)).cast("int").alias("partition"),
        (base + F.monotonically_increasing_id()).alias("offset"),
        t.cast("timestamp").alias("timestamp"),
    )


def _next_append(spark: SparkSession, root: str) -> tuple[int, int]:
    """Number of the next append and its first offset.

    Offsets rise from append to append, so only the newest one with rows is read.
    """
    numbers = sorted((int(n.partition("=")[2]) for n in child_names(spark, root) if n.startswith("append=")), reverse=True)
    for n in numbers:
        last = spark.read.schema("offset bigint").parquet(f"{root}/append={n}").agg(F.max("offset")).first()[0]
        if last is not None:
            return numbers[0] + 1, last + 1
    return (numbers[0] + 1 if numbers else 0), 0


def write_topic(
    df: DataFrame,
    location: str,
    topic: str,
    key: str | Column,
    value: str | Column,
    timestamp: str | Column | None = None,
    partitions: int = DEFAULT_PARTITIONS,
    txn_id: str | None = None,
) -> None:
    """Append rows to a topic."""
    spark = use_utc(df.sparkSession)
    if is_servers(location):
        out = to_messages(df, topic, key, value, timestamp, partitions)
        out.select("key", "value", "topic", "timestamp").write.format("kafka").option("kafka.bootstrap.servers", location).save()
        return
    root = f"{location}/messages/topic={topic}"
    append, first = _next_append(spark, root)
    out = to_messages(df, topic, key, value, timestamp, partitions, first).drop("topic")
    out.withColumn("txn_id", F.lit(txn_id).cast("string")).write.parquet(f"{root}/append={append}")


def _mark(spark: SparkSession, location: str, txn_id: str, status: str) -> None:
    row = spark.range(1, numPartitions=1).select(
        F.lit(txn_id).alias("txn_id"), F.lit(status).alias("status"), F.current_timestamp().alias("ts")
    )
    row.write.mode("append").parquet(f"{location}/txns")


def write_transaction(df: DataFrame, location: str, topic: str, txn_id: str, key: str | Column, value: str | Column, **kw) -> None:
    """Append a batch that readers see as a whole after its commit mark, or never."""
    if is_servers(location):
        raise ValueError("the Kafka sink has no transactions; write to a topic log")
    spark = df.sparkSession
    _mark(spark, location, txn_id, "open")
    try:
        write_topic(df, location, topic, key, value, txn_id=txn_id, **kw)
    except Exception:
        _mark(spark, location, txn_id, "aborted")
        raise
    _mark(spark, location, txn_id, "committed")
