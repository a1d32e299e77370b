"""Flattening, JSON decoding, event mapping, browsing and masking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclake.functions.scalars import choice, once

# ---- messages <-> values


def convert_schemaless(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return df.select(F.col("key").cast("string"), F.col("value").cast("string"), F.col("timestamp"), *(keep or []))


def decode_json(df: DataFrame, schema: T.StructType | str, col: str = "value") -> DataFrame:
    """Parse ``col`` by a declared schema; text that is not JSON gives null fields."""
    return df.withColumn(col, F.from_json(F.col(col).cast("string"), schema))


def encode_json(df: DataFrame, key: str, cols: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """``key`` and a JSON ``value`` from ``cols``; ``keep`` columns pass through."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*(cols or df.columns))).alias("value"),
        *(keep or []),
    )


# ---- flattening


def flatten(df: DataFrame, col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Fields of the value struct become top-level columns."""
    return df.select(*(keep or []), f"{col}.*")


def flatten_debezium(df: DataFrame, col: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The row image of a change envelope plus ``_cdc`` (``op``, ``ts_ms``).

    ``c``, ``r`` and ``u`` carry ``after``; ``d`` carries ``before``. Tombstones
    and events without a row image are dropped.
    """
    p = f"{col}." if col else ""
    image = F.when(F.col(f"{p}op") == "d", F.col(f"{p}before")).otherwise(F.col(f"{p}after"))
    return (
        df.select(
            *(keep or []),
            image.alias("_row"),
            F.struct(F.col(f"{p}op").alias("op"), F.col(f"{p}ts_ms").alias("ts_ms")).alias("_cdc"),
        )
        .where(F.col("_row").isNotNull())
        .select(*(keep or []), "_row.*", "_cdc")
    )


def select_fields(df: DataFrame, fields: dict[str, str | Column]) -> DataFrame:
    """``{output name: path or column}``."""
    return df.select(*[(F.col(p) if isinstance(p, str) else p).alias(o) for o, p in fields.items()])


def with_choice(df: DataFrame, oneof: str, branches: list[str]) -> DataFrame:
    return df.withColumn(f"{oneof}_choice", choice(branches))


# ---- event lines


_EVENT_JSON = (
    "id string, type string, created_at string, actor struct<login:string>, repo struct<name:string>, _bad string"
)


#: White space as text tools strip it, tabs and carriage returns included.
_BLANK = r"^\s*$"


def _parsed_lines(df: DataFrame, col: str) -> DataFrame:
    return df.where(~F.col(col).rlike(_BLANK)).select("*", F.try_parse_json(F.col(col)).alias("_json"))


def drop_malformed(df: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` lines: blank lines are in neither, bad ones are not JSON."""
    lines = _parsed_lines(df, col)
    good = lines.where(F.col("_json").isNotNull()).drop("_json")
    return good, lines.where(F.col("_json").isNull()).drop("_json")


def count_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """Good, bad and blank line counts in one pass."""
    c = F.col(col)
    blank = c.rlike(_BLANK)
    parsed = F.try_parse_json(c).isNotNull()
    return df.agg(
        F.count_if(~blank & parsed).alias("good"),
        F.count_if(~blank & ~parsed).alias("bad"),
        F.count_if(blank).alias("blank"),
    )


def map_event(df: DataFrame, col: str = "value") -> DataFrame:
    """Nested event lines to flat rows.

    A missing ``actor`` or ``repo`` gives null; a present one that is not an
    object makes the line invalid, as does a missing or unreadable time.
    """
    c = F.col(col)
    # only the declared fields are read; a broken line or a field of another kind fills _bad
    options = {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"}
    parsed = df.where(F.ltrim(c).startswith("{")).select(once(F.from_json(c, _EVENT_JSON, options)).alias("_e"), c.alias("_line"))

    def missing(path: str) -> Column:
        """The key is absent, as opposed to an explicit null; looked up for null parents only."""
        return F.try_variant_get(F.try_parse_json(F.col("_line")), path, "variant").isNull()

    def usable(name: str) -> Column:
        return F.when(F.col(f"_e.{name}").isNotNull(), F.lit(True)).otherwise(missing(f"$.{name}"))

    return (
        parsed.where(F.col("_e._bad").isNull())
        .select(
            "_e.id",
            "_e.type",
            F.col("_e.actor.login").alias("actor_login"),
            F.col("_e.repo.name").alias("repo_name"),
            F.lit(None).cast("string").alias("org_login"),
            F.try_to_timestamp("_e.created_at").alias("created_at"),
            (usable("actor") & usable("repo")).alias("_usable"),
        )
        .where(F.col("created_at").isNotNull() & F.col("_usable"))
        .drop("_usable")
    )


# ---- message viewer


def browse(
    df: DataFrame,
    topic: str | None = None,
    partition: int | None = None,
    offsets: tuple[int | None, int | None] | None = None,
    times: tuple | None = None,
    predicate: str | Column | None = None,
    limit: int | None = 50,
) -> DataFrame:
    """Messages by topic, partition, offset range and time range (both half-open) and predicate."""
    if topic is not None:
        df = df.where(F.col("topic") == topic)
    if partition is not None:
        df = df.where(F.col("partition") == partition)
    for col, bounds in (("offset", offsets), ("timestamp", times)):
        lo, hi = bounds or (None, None)
        dtype = df.schema[col].dataType
        if lo is not None:
            df = df.where(F.col(col) >= F.lit(lo).cast(dtype))
        if hi is not None:
            df = df.where(F.col(col) < F.lit(hi).cast(dtype))
    if predicate is not None:
        df = df.where(predicate)
    df = df.orderBy("partition", "offset") if limit is not None else df
    return df.limit(limit) if limit is not None else df


def mask_fields(df: DataFrame, rules: dict[str, tuple]) -> DataFrame:
    """Obfuscate columns: ``("mask",)``, ``("hash",)``, ``("replace", regex, text)`` or ``("drop",)``."""
    out = []
    for name in df.columns:
        rule = rules.get(name)
        c = F.col(name)
        if rule is None:
            out.append(c)
        elif rule[0] == "mask":
            out.append(F.mask(c.cast("string")).alias(name))
        elif rule[0] == "hash":
            out.append(F.sha2(c.cast("string"), 256).alias(name))
        elif rule[0] == "replace":
            out.append(F.regexp_replace(c.cast("string"), rule[1], rule[2]).alias(name))
        elif rule[0] != "drop":
            raise ValueError(f"unknown masking rule: {rule[0]}")
    return df.select(*out)


# ---- commit log text


def scan_commit_log(df: DataFrame, topic: str | None = None, col: str = "value") -> DataFrame:
    """Commit responses in log lines: code, topic and number of data files."""
    c = F.col(col)

    def part(pattern: str) -> Column:
        return F.regexp_extract(c, pattern, 1)

    out = df.where(c.rlike("COMMIT_RESPONSE")).select(
        F.expr(f"try_cast(regexp_extract({col}, 'code=(-?[0-9]+)', 1) as int)").alias("code"),
        part("topic='([^']*)'").alias("topic"),
        F.expr(f"try_cast(regexp_extract({col}, 'dataFiles=([0-9]+)', 1) as int)").alias("data_files"),
    )
    return out if topic is None else out.where(F.col("topic") == topic)


def commit_seen(df: DataFrame, topic: str, col: str = "value") -> DataFrame:
    """One row: did a successful commit with at least one data file happen?"""
    hits = scan_commit_log(df, topic, col).where((F.col("code") == 0) & (F.col("data_files") > 0))
    return hits.agg((F.count(F.lit(1)) > 0).alias("seen"))
