"""Schema registry data as a DataFrame.

Columns: ``subject, version, id, type, schema, refs``. Avro schemas are JSON
text, Protobuf schemas the base64 text of a serialized file descriptor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from topiclake.session import kept

REGISTRY_SCHEMA = (
    "subject string, version int, id int, type string, schema string, "
    "refs array<struct<name:string, subject:string, version:int>>"
)
MAX_SCHEMAS = 10_000


def latest_schemas(registry: DataFrame) -> DataFrame:
    rest = [c for c in registry.columns if c != "subject"]
    newest = F.max_by(F.struct(*rest), F.col("version")).alias("_s")
    return registry.groupBy("subject").agg(newest).select("subject", "_s.*")


def register_schema(registry: DataFrame, subject: str, schema: str, type: str = "AVRO", refs: list[tuple] | None = None) -> DataFrame:
    """The registry with ``schema`` under ``subject``.

    Nothing changes when the subject already has it. Equal content under another
    subject keeps its id; otherwise the next id is taken.
    """
    spark = registry.sparkSession
    ref_type = registry.schema["refs"].dataType
    made = F.array(*[F.struct(*[F.lit(x) for x in r]) for r in refs or []]).cast(ref_type)
    same = (F.col("schema") == schema) & (F.col("type") == type) & (F.coalesce("refs", F.array().cast(ref_type)) == made)
    known = registry.agg(
        F.max(F.when(F.col("subject") == subject, F.col("version"))).alias("last_version"),
        F.max("id").alias("last_id"),
        F.min(F.when(same, F.col("id"))).alias("same_id"),
        F.count_if(same & (F.col("subject") == subject)).alias("present"),
    )
    added = known.where(F.col("present") == 0).select(
        F.lit(subject).alias("subject"),
        (F.coalesce("last_version", F.lit(0)) + 1).cast("int").alias("version"),
        F.coalesce("same_id", F.coalesce("last_id", F.lit(0)) + 1).cast("int").alias("id"),
        F.lit(type).alias("type"),
        F.lit(schema).alias("schema"),
        made.alias("refs"),
    )
    return registry.unionByName(added)


def resolve_references(registry: DataFrame, subject: str, version: int = -1) -> DataFrame:
    """Every schema that ``subject`` refers to, directly or not; version -1 means the latest."""
    spark = registry.sparkSession
    newest = latest_schemas(registry).select("subject", F.col("version").alias("latest"))
    edges = (
        registry.select("subject", "version", F.explode("refs").alias("r"))
        .join(newest.withColumnsRenamed({"subject": "_s"}), F.col("r.subject") == F.col("_s"))
        .select(
            "subject",
            "version",
            F.col("r.name").alias("ref_name"),
            F.col("r.subject").alias("ref_subject"),
            F.when(F.col("r.version") == -1, F.col("latest")).otherwise(F.col("r.version")).alias("ref_version"),
        )
    )
    start = newest.where(F.col("subject") == subject).select(
        "subject", (F.col("latest") if version == -1 else F.lit(version)).cast("int").alias("version")
    )
    # level by level: what was reached before is not followed again, so cycles end and shared references are met once
    keys = ["subject", "version"]
    reached = start.join(edges, keys).select("ref_name", F.col("ref_subject").alias("subject"), F.col("ref_version").cast("int").alias("version")).distinct()
    front, seen = reached.select(*keys).distinct(), reached
    while not front.isEmpty():
        found = front.join(edges, keys).select("ref_name", F.col("ref_subject").alias("subject"), F.col("ref_version").cast("int").alias("version")).distinct()
        found = kept(spark, found.join(seen, ["ref_name", *keys], "left_anti"))
        front = found.select(*keys).distinct().join(seen.select(*keys).distinct(), keys, "left_anti")
        seen = kept(spark, seen.union(found))
    return seen.withColumnRenamed("ref_name", "name").join(registry.drop("refs"), keys)


def registry_rows(registry: DataFrame) -> list[Row]:
    """Registry rows for building decoders; refuses a registry that is no metadata any more."""
    rows = registry.limit(MAX_SCHEMAS + 1).collect()
    if len(rows) > MAX_SCHEMAS:
        raise ValueError(f"more than {MAX_SCHEMAS} schemas: select the subject's schemas first")
    return rows
