"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: ASCII space and the controls 0x09 to 0x0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x09-\x0D\x20]+"


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where that is unset, one beside the warehouse."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir")
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(root)
    return root.rstrip("/")


#: Narrow rows that a file may have, and files that a table of narrow rows may have in any case.
FILE_ROWS, FEW_FILES = 50_000, 32
#: Rows that travel to Python at once.
BATCH_ROWS = 1024
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def modest_batches(spark: SparkSession) -> None:
    """Rows of whole texts go to Python in small batches: an executor holds several of them for each task, outside its heap.

    A session that asks for still smaller ones keeps them; no result depends on it.
    """
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write a result to the shared folder and read it again: lineage ends, and lost executors recompute nothing.

    ``rows`` is given for narrow rows whose number has a known bound: few rows then go to few files, however many
    partitions the last shuffle has.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(FEW_FILES, 2 * spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    path = f"{shared_root(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.cut_to = path
    for made in _made.get():
        made.append(table)
    return table


#: Tables that ``cut`` wrote, for each ``written`` that is open.
_made: ContextVar[tuple[list[DataFrame], ...]] = ContextVar("made", default=())


@contextmanager
def written() -> Iterator[list[DataFrame]]:
    """The tables that ``cut`` writes inside, so that those of steps that are over can be dropped."""
    made: list[DataFrame] = []
    before = _made.set((*_made.get(), made))
    try:
        yield made
    finally:
        _made.reset(before)


def drop(*tables: DataFrame) -> None:
    """Delete the files of tables that ``cut`` wrote: nothing that is still to run may read them."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.cut_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Files of a shuffle go when the job that made them ends; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP_SETTING, None)
    spark.conf.set(_CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP_SETTING) if before is None else spark.conf.set(_CLEANUP_SETTING, before)


#: Rows of a few numbers that may be sent to every task; more are joined by a shuffle.
SMALL_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """A narrow table, marked for broadcast where a count of its rows allows it, else as it is."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def held_out(doc_id: Column) -> Column:
    """True for the third of documents that no model may learn from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def hash_order(*columns: str) -> Column:
    """A fixed order that looks random, for bounded training samples."""
    return F.xxhash64(*[F.col(c) for c in columns])
