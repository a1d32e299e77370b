"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "topiclake", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Time functions assume UTC wall-clock values; times of day need their type switched on."""
    for key, value in (("spark.sql.session.timeZone", "UTC"), ("spark.sql.timeType.enabled", "true")):
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one inside the warehouse, in every mode."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (base or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared").rstrip("/")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder for ``label`` that every executor can reach."""
    return f"{shared_root(spark)}/topiclake/{label}-{uuid.uuid4().hex[:12]}"


def kept(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A result written to the shared folder and read again, which ends its lineage."""
    path = shared_dir(spark, "kept")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when the folder is missing."""
    p, fs = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
