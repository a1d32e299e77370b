"""Structured Streaming jobs: topic to table, table to table, live counts.

Every job writes through ``foreachBatch`` into a ``LakeTable``. A commit records
the stream and its batch number, so a batch that is replayed after a failure is
committed once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from topiclake.formats.avro import decode_avro
from topiclake.formats.protobuf import decode_protobuf
from topiclake.operators.messaging import with_latency
from topiclake.operators.projection import convert_schemaless, decode_json, flatten, flatten_debezium, select_fields
from topiclake.table.lake import COMMIT_SCHEMA, LakeTable

# fixed values: fields of the telemetry messages
TELEMETRY_JSON = "iccid string, speed float, request int, response int"
TELEMETRY_FIELDS = {
    "vin": "key",
    "iccid": "value.iccid",
    "speed": "value.speed",
    "request": "value.request",
    "response": "value.response",
    "event_timestamp": "timestamp",
}
_META = ["_timestamp", "_partition", "_offset"]
_SIDE = ["_raw", "_bad"]


def _start(writer: DataStreamWriter, checkpoint: str, trigger: str | None) -> StreamingQuery:
    """Start on a processing-time interval, or on everything available when ``trigger`` is None."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)).start()


# ---- tables as streams


def read_table_stream(spark: SparkSession, table: str | LakeTable, schema: str | None = None, max_files: int | None = None) -> DataFrame:
    """Rows appended to a table, as a stream.

    For plain folders. A ``LakeTable`` is refused: compaction writes its rows again and unfinished writes lie beside
    committed ones, so it is followed by its commits, with ``follow_table``.
    """
    if isinstance(table, LakeTable):
        raise ValueError("a table is followed by its commits: use follow_table")
    path = table
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def follow_table(
    spark: SparkSession,
    source: LakeTable,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = None,
    max_commits: int = 1000,
) -> StreamingQuery:
    """Hand the rows of newly committed batches to ``sink(rows, batch_id)``.

    The stream runs over the commits table, so rows of unfinished writes are
    never seen and each commit is read once. Of a keyed table the sink gets the
    changes of each batch, with ``_op``; compaction adds nothing new.
    """
    commits = (
        spark.readStream.schema(f"{COMMIT_SCHEMA}, block bigint, commit_id bigint")
        .option("maxFilesPerTrigger", max_commits)
        .parquet(f"{source.path}/commits")
        .where(F.col("operation").isin("append", "upsert", "cdc"))
        .select("commit_id")
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        ids = [r.commit_id for r in batch.collect()]  # at most max_commits numbers
        sink(source.refresh().read_commits(ids), batch_id)

    return _start(commits.writeStream.foreachBatch(on_batch), checkpoint, trigger)


def parse_telemetry(df: DataFrame) -> DataFrame:
    return select_fields(decode_json(df, TELEMETRY_JSON), TELEMETRY_FIELDS)


def telemetry_job(
    spark: SparkSession, source: LakeTable, target: LakeTable, checkpoint: str, trigger: str | None = "30 seconds"
) -> StreamingQuery:
    """Schemaless ``(key, value, timestamp)`` table to a typed vehicle table."""

    def sink(rows: DataFrame, batch_id: int) -> None:
        target.append(parse_telemetry(rows), stream=(checkpoint, batch_id), message_ts="event_timestamp")

    return follow_table(spark, source, sink, checkpoint, trigger)


# ---- topics to tables


def convert(df: DataFrame, options: dict, registry: DataFrame | None) -> DataFrame:
    """Decode ``value`` as the topic options say; message columns stay under ``_`` names."""
    kind = options.get("convert.value.type", "raw")
    named = df.withColumnsRenamed({"timestamp": "_timestamp", "partition": "_partition", "offset": "_offset"})
    keep = named.select("key", "value", *_META, *[c for c in _SIDE if c in named.columns])
    if kind == "raw":
        return convert_schemaless(keep.withColumn("timestamp", F.col("_timestamp")), keep=_META)
    if kind == "json":
        return decode_json(keep, options["json.schema"])
    if kind == "by_schema_id":
        return decode_avro(keep, registry, subject=options.get("subject"))
    if kind == "by_latest_schema":
        return decode_protobuf(keep, registry, options["message.full.name"])
    raise ValueError(f"unknown convert.value.type: {kind}")


def transform(df: DataFrame, options: dict) -> DataFrame:
    kind = options.get("transform.value.type", "none")
    if kind == "none":
        return df
    df = df.where(F.col("value").isNotNull())  # undecodable messages have no row here, but in the side table
    if kind == "flatten":
        return flatten(df, keep=_META)
    if kind == "flatten_debezium":
        return flatten_debezium(df, "value", keep=_META)
    raise ValueError(f"unknown transform.value.type: {kind}")


def _list(text: str | list[str] | None) -> list[str]:
    if not text:
        return []
    return text if isinstance(text, list) else [p.strip() for p in text.strip("[] ").split(",") if p.strip()]


def ingest_batch(
    batch: DataFrame,
    table: LakeTable,
    options: dict,
    registry: DataFrame | None = None,
    stream: tuple[str, int] | None = None,
    topic: str | None = None,
) -> int:
    """Decode, flatten and commit one batch of messages.

    Messages whose value cannot be decoded go to ``table.undecoded()`` first; the commit holds the number of either kind.
    """
    if options.get("convert.value.type", "raw") == "raw":
        return _commit_rows(transform(convert(batch, options, registry), options), table, options, stream, topic)
    flag = F.lit(False)
    if options["convert.value.type"] == "json":
        broken = F.from_json(F.col("value").cast("string"), f"{options['json.schema']}, _broken string", {"columnNameOfCorruptRecord": "_broken"})
        flag = F.coalesce(broken["_broken"].isNotNull(), F.lit(False))
    decoded = convert(batch.withColumns({"_raw": F.col("value"), "_bad": flag}), options, registry).persist()
    try:
        # a null value is a tombstone to a change feed; where rows are flattened it is a message without a row
        unread = F.col("value").isNull() & (F.col("_raw").isNotNull() | F.lit(options.get("transform.value.type") == "flatten"))
        bad = F.col("_bad") | unread
        n, lost = decoded.agg(F.count("*"), F.count_if(bad)).first()
        if lost:
            side = decoded.where(bad).select("key", F.col("_raw").alias("value"), *[F.col(c).alias(c[1:]) for c in _META])
            table.undecoded().append(side, stream=stream, topic=topic)
        rows = transform(decoded.drop(*_SIDE), options)
        return _commit_rows(rows, table, options, stream, topic, {"decoded_count": n - lost, "undecoded_count": lost})
    finally:
        decoded.unpersist()


def _commit_rows(rows: DataFrame, table: LakeTable, options: dict, stream: tuple[str, int] | None, topic: str | None, counts: dict | None = None) -> int:
    ids = _list(options.get("id.columns"))
    cdc = options.get("cdc.field")
    if cdc or options.get("upsert.enable"):
        rows = rows.withColumn("_message_ts", F.col("_timestamp"))
        kw = {"stream": stream, "topic": topic, "message_ts": "_message_ts", "counts": counts}
        if cdc:
            return table.apply_changes(rows, ids, _META, op_col=cdc, **kw)
        return table.upsert(rows, ids, _META, **kw)
    rows = rows.withColumn("_message_ts", F.col("_timestamp")).drop(*_META)
    return table.append(rows, stream=stream, topic=topic, message_ts="_message_ts", counts=counts)


def ingest_topic(
    spark: SparkSession,
    source: DataFrame,
    table: LakeTable,
    options: dict,
    checkpoint: str,
    registry: DataFrame | None = None,
    topic: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Ingest a topic stream into a table.

    Options: ``convert.value.type`` (raw, json, by_schema_id, by_latest_schema),
    ``transform.value.type`` (none, flatten, flatten_debezium), ``partition.by``,
    ``id.columns``, ``upsert.enable``, ``cdc.field``, ``commit.interval.ms``.
    The table is created by the first batch. ``once`` ingests what is there and stops.
    """
    table.create(
        partition_by=options.get("partition.by"),
        id_columns=_list(options.get("id.columns")) if options.get("upsert.enable") or options.get("cdc.field") else None,
        options={k: str(v) for k, v in options.items()},
    )
    if options.get("partition.by"):
        table.set_partition_by(options["partition.by"])

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, table, options, registry, (checkpoint, batch_id), topic)

    interval = None if once else f"{options.get('commit.interval.ms', 1000)} milliseconds"
    return _start(source.writeStream.foreachBatch(on_batch), checkpoint, interval)


# ---- running results


def live_counts(stream: DataFrame, by: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """Running counts of a stream; write them in complete mode."""
    stream = stream if where is None else stream.where(where)
    return stream.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"))


def latency_stream(stream: DataFrame, ts: str = "timestamp") -> DataFrame:
    return with_latency(stream, ts)
