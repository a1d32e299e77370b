"""Raw documents to packed training sequences: five stages, each a whole-corpus job over what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.llm import ngram_join, packing, quality, secrets, suffix_dedup
from topiclake.llm.common import cut, drop, table, written
from topiclake.llm.queries import TOKENIZER



def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it now is."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others stay as they are."""
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles at 0.8 the one of the smallest id stays."""
    return ngram_join.keep_one(docs, size=5, percent=80)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a document of a smaller id has go from the texts; every document stays."""
    return _recounted(suffix_dedup.remove(docs, length=50))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return _recounted(secrets.redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of at most 1024 tokens."""
    return packing.pack(docs, TOKENIZER, capacity=1024)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("suffix_array_dedup", suffix_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the forest nor the differencing; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again before the next, and go after it."""
    docs = table(spark, sf_dir, "documents")
    over = []
    for _, stage in STAGES[:-1]:
        with written() as made:
            docs = cut(stage(spark, docs, sf_dir))
        drop(*over, *(t for t in made if t is not docs))
        over = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
