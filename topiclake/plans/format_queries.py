"""Payload and schema queries: rows of the given tables are encoded and read back."""

from __future__ import annotations

from google.protobuf import descriptor_pb2
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.formats import avro, protobuf, registry, wire
from topiclake.operators import projection as P
from topiclake.plans.bound import load, query

ORDER_FIELDS = [
    {"name": "o_orderkey", "type": "long"},
    {"name": "o_custkey", "type": "long"},
    {"name": "status", "type": {"type": "enum", "name": "Status", "symbols": ["F", "O", "P"]}},
    {"name": "o_totalprice", "type": "double"},
    {"name": "placed", "type": {"type": "long", "logicalType": "timestamp-micros"}},
    {"name": "tags", "type": {"type": "array", "items": "string"}},
    {"name": "attributes", "type": {"type": "map", "values": "long"}},
]
ORDER_V1 = {"type": "record", "name": "Order", "namespace": "demo", "fields": ORDER_FIELDS}
ORDER_V2 = {**ORDER_V1, "fields": [*ORDER_FIELDS, {"name": "priority", "type": ["null", "string"], "default": None}]}


def order_registry(spark: SparkSession) -> DataFrame:
    import json

    rows = [("orders-value", i, 100 + i, "AVRO", json.dumps(s), []) for i, s in ((1, ORDER_V1), (2, ORDER_V2))]
    return spark.createDataFrame(rows, registry.REGISTRY_SCHEMA)


def order_records(spark, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderstatus").alias("status"),
        "o_totalprice",
        F.col("o_orderdate").cast("timestamp").alias("placed"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.create_map(F.lit("customer"), "o_custkey").alias("attributes"),
        F.col("o_orderpriority").alias("priority"),
    )


def order_topic(spark, sf_dir: str) -> DataFrame:
    """Avro messages of all orders: open ones in the newer schema version."""
    records = order_records(spark, sf_dir)
    old = avro.encode_avro(records.where(F.col("status") != "O"), 101, ORDER_V1, keep=["o_orderkey"])
    new = avro.encode_avro(records.where(F.col("status") == "O"), 102, ORDER_V2, keep=["o_orderkey"])
    return old.unionByName(new)


@query(
    "avro_round_trip",
    """SELECT o_orderkey, o_custkey, o_orderstatus AS status, o_totalprice, o_orderdate AS placed, o_orderpriority AS second_tag,
              o_custkey AS customer, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS priority FROM orders""",
)
def avro_round_trip(spark, sf_dir):
    decoded = P.flatten(avro.decode_avro(order_topic(spark, sf_dir), order_registry(spark)))
    return decoded.select(
        "o_orderkey", "o_custkey", "status", "o_totalprice", "placed",
        F.try_element_at("tags", F.lit(2)).alias("second_tag"), F.col("attributes")["customer"].alias("customer"), "priority",
    )


@query(
    "wire_format",
    "SELECT cast(CASE WHEN o_orderstatus = 'O' THEN 102 ELSE 101 END AS integer) AS schema_id, count(*) AS n FROM orders GROUP BY 1",
)
def wire_format(spark, sf_dir):
    return wire.split_wire_format(order_topic(spark, sf_dir)).groupBy("schema_id").agg(F.count("payload").alias("n"))


def event_file() -> descriptor_pb2.FileDescriptorProto:
    """Descriptor of an event message with unsigned numbers, an enum, a oneof, a map and a timestamp."""
    fd = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(name="event.proto", package="demo", syntax="proto3")
    file.dependency.append("google/protobuf/timestamp.proto")
    kinds = file.enum_type.add(name="Kind")
    for i, name in enumerate(["unknown", "click", "error", "purchase", "signup", "view"]):
        kinds.value.add(name=name, number=i)
    event = file.message_type.add(name="Event")
    event.oneof_decl.add(name="subject")

    def add(name, number, kind, **kw):
        event.field.add(name=name, number=number, type=getattr(fd, f"TYPE_{kind}"), label=kw.pop("label", fd.LABEL_OPTIONAL), **kw)

    add("event_id", 1, "UINT64")
    add("hash", 2, "FIXED32")
    add("kind", 3, "ENUM", type_name=".demo.Kind")
    add("at", 4, "MESSAGE", type_name=".google.protobuf.Timestamp")
    add("user_id", 5, "SINT64", oneof_index=0)
    add("props", 6, "STRING", oneof_index=0)
    add("tags", 7, "STRING", label=fd.LABEL_REPEATED)
    add("values", 8, "MESSAGE", label=fd.LABEL_REPEATED, type_name=".demo.Event.ValuesEntry")
    entry = event.nested_type.add(name="ValuesEntry")
    entry.options.map_entry = True
    entry.field.add(name="key", number=1, type=fd.TYPE_STRING, label=fd.LABEL_OPTIONAL)
    entry.field.add(name="value", number=2, type=fd.TYPE_DOUBLE, label=fd.LABEL_OPTIONAL)
    return file


@query(
    "protobuf_round_trip",
    """SELECT event_id, (user_id + 4294967296 - 500) % 4294967296 AS hash, event_type AS kind, ts AS at,
              CASE WHEN event_type <> 'view' THEN user_id END AS user_id, CASE WHEN event_type = 'view' THEN props END AS props,
              CASE WHEN event_type = 'view' THEN 'props' ELSE 'user_id' END AS subject_choice, event_type AS tag, value
       FROM events""",
)
def protobuf_round_trip(spark, sf_dir):
    is_view = F.col("event_type") == "view"
    rows = load(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") - 500).cast("int").alias("hash"),
        F.col("event_type").alias("kind"),
        F.col("ts").cast("timestamp").alias("at"),
        F.when(~is_view, F.col("user_id")).alias("user_id"),
        F.when(is_view, F.col("props")).alias("props"),
        F.array("event_type").alias("tags"),
        F.create_map(F.lit("value"), "value").alias("values"),
    )
    known = spark.createDataFrame([("event-value", 1, 1, "PROTOBUF", protobuf.file_text(event_file()), [])], registry.REGISTRY_SCHEMA)
    messages = protobuf.encode_protobuf(rows, known, "demo.Event")
    decoded = P.flatten(protobuf.decode_protobuf(messages, known, "demo.Event"))
    return decoded.select(
        "event_id",
        F.col("hash").cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)).alias("hash"),
        "kind", "at", "user_id", "props", "subject_choice",
        F.try_element_at("tags", F.lit(1)).alias("tag"),
        F.col("values")["value"].alias("value"),
    )


# ---- registry data, derived from parts: a subject per brand, a version per part


def part_registry(spark, sf_dir: str) -> DataFrame:
    """Each part is a version of its brand's schema and refers to the part with half its number."""
    half = F.call_function("div", F.col("p_partkey"), F.lit(2)).cast("int")
    ref = F.struct(F.lit("half").alias("name"), F.concat(F.lit("part-"), half).alias("subject"), F.lit(-1).alias("version"))
    return load(spark, sf_dir, "part").select(
        "p_brand",
        F.concat(F.lit("part-"), F.col("p_partkey").cast("int")).alias("subject"),
        F.lit(1).alias("version"),
        F.col("p_partkey").cast("int").alias("id"),
        F.lit("AVRO").alias("type"),
        F.col("p_name").alias("schema"),
        F.when(F.col("p_partkey") > 0, F.array(ref)).otherwise(F.array().cast("array<struct<name:string,subject:string,version:int>>")).alias("refs"),
    )


def brand_registry(spark, sf_dir: str) -> DataFrame:
    return part_registry(spark, sf_dir).withColumns({"subject": F.col("p_brand"), "version": F.col("id")}).drop("p_brand")


@query(
    "latest_schemas",
    """SELECT p_brand AS subject, cast(p_partkey AS integer) AS version, p_name AS schema FROM part
       QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) = 1""",
)
def latest_schemas(spark, sf_dir):
    return registry.latest_schemas(brand_registry(spark, sf_dir)).select("subject", "version", "schema")


@query(
    "register_schema",
    """SELECT cast((SELECT max(p_partkey) FROM part WHERE p_brand = 'Brand#1') + 1 AS integer) AS version,
              cast((SELECT max(p_partkey) FROM part) + 1 AS integer) AS id, 'Brand#1' AS subject, (SELECT count(*) + 1 FROM part) AS total""",
)
def register_schema(spark, sf_dir):
    known = brand_registry(spark, sf_dir)
    after = registry.register_schema(known, "Brand#1", '"a new schema"')
    again = registry.register_schema(after, "Brand#1", '"a new schema"')
    return again.groupBy().agg(
        F.max_by("version", F.col("schema") == '"a new schema"').alias("version"),
        F.max_by("id", F.col("schema") == '"a new schema"').alias("id"),
        F.max_by("subject", F.col("schema") == '"a new schema"').alias("subject"),
        F.count(F.lit(1)).alias("total"),
    )


@query(
    "schema_references",
    """WITH RECURSIVE r AS (
         SELECT p_partkey // 2 AS k, p_partkey AS p FROM part WHERE p_partkey = 96 AND p_partkey > 0
         UNION SELECT k // 2, k FROM r WHERE k > 0)
       SELECT 'part-' || k AS subject, cast(1 AS integer) AS version, p_name AS schema FROM r JOIN part ON p_partkey = k""",
)
def schema_references(spark, sf_dir):
    found = registry.resolve_references(part_registry(spark, sf_dir).drop("p_brand"), "part-96")
    return found.select("subject", "version", "schema")
