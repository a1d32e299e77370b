"""Metric exposition text to sample rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.functions.scalars import once

_LABEL = r'([a-zA-Z_][a-zA-Z0-9_]*+)="([^"\\]*+(?:\\.[^"\\]*+)*+)"'
_PAIR = r'\s*+[a-zA-Z_][a-zA-Z0-9_]*+="[^"\\]*+(?:\\.[^"\\]*+)*+"\s*+'
# the whole label text has to be pairs; anything else makes the line a bad one
_LINE = rf"^([a-zA-Z_:][a-zA-Z0-9_:]*)(?:\{{((?:{_PAIR}(?:,{_PAIR})*+,?\s*+)?+)\}})?\s*+(?<=[\s}}])(\S+)(?:\s+(-?\d+))?\s*$"


def _number(text: Column) -> Column:
    inf = F.when(text.isin("+Inf", "Inf"), F.lit(float("inf"))).when(text == "-Inf", F.lit(float("-inf")))
    return F.coalesce(inf, text.try_cast("double"))


def _unescape(text: Column) -> Column:
    # \\ first becomes a mark, so that its second character starts no new escape
    mark = F.lit("\u0000")
    out = F.replace(text, F.lit("\\\\"), mark)
    out = F.replace(F.replace(out, F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n"))
    return F.replace(out, mark, F.lit("\\"))


def parse_exposition(lines: DataFrame, col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """``metric, labels, value`` of every sample line.

    Comments, blank and bad lines are skipped; a line is bad when its labels are not all pairs or name one label twice.
    """
    c = F.regexp_replace(F.col(col), r"^\s+|\s+$", "")
    # one match per line: name, label text and number, split at a mark
    parts = F.split(F.regexp_replace(c, _LINE, "$1\u0001$2\u0001$3"), "\u0001")
    pairs = F.regexp_extract_all("_body", F.lit(_LABEL), F.lit(0))

    def entry(pair: Column) -> Column:
        cut = F.instr(pair, "=")
        text = F.substring(pair, cut + 2, F.length(pair) - cut - 2)
        plain = F.when(F.contains(text, F.lit("\\")), _unescape(text)).otherwise(text)
        return F.struct(F.substring(pair, F.lit(1), cut - 1), plain)

    names = F.transform(pairs, lambda p: F.substring_index(p, "=", 1))
    return (
        lines.where(~c.startswith("#"))
        .select(*(keep or []), once(parts).alias("_p"))
        .where(F.size("_p") == 3)
        .select(*(keep or []), F.get("_p", 0).alias("metric"), F.get("_p", 1).alias("_body"), _number(F.get("_p", 2)).alias("value"))
        .where(F.col("value").isNotNull() & (F.size(names) == F.size(F.array_distinct(names))))
        .select(*(keep or []), "metric", F.map_from_entries(F.transform(pairs, entry)).alias("labels"), "value")
    )


def read_exposition(spark: SparkSession, path: str) -> DataFrame:
    return parse_exposition(spark.read.text(path))


def format_exposition(df: DataFrame, metric: Column, labels: list[tuple[str, Column]], value: Column, keep: list[str] | None = None) -> DataFrame:
    """Sample lines of a metric, labels in the given order."""

    def quoted(c: Column) -> Column:
        text = F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\"))
        return F.replace(F.replace(text, F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))

    pairs = [F.concat(F.lit(f'{n}="'), quoted(c), F.lit('"')) for n, c in labels]
    body = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}")) if pairs else F.lit("")
    return df.select(*(keep or []), F.concat(metric, body, F.lit(" "), F.format_string("%.6f", value.cast("double"))).alias("value"))
