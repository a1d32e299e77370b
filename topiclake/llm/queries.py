"""The operators bound to the given tables, with the SQL checks of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.llm import bpe, chunked_bpe, hard_negatives, language, neighbours, ngram_join, packing, quality, ranked, secrets, suffix_dedup, toxicity, wrappers
from topiclake.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@_query
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "path", "start", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), "score", "secret")


@_query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), TOKENIZER)


@_query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    network = language.train(docs.where(~held_out(F.col("doc_id"))))
    return language.predict(docs, network).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@_query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


@_query
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), size=4, percent=85)


@_query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"), 50)


@_query
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def _sql_count(text: str, characters: str) -> str:
    return f"(length({text}) - length(regexp_replace({text}, '[{characters}]', '', 'g')))"


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LETTERS, _UPPER = _sql_count("bare", r"\p{L}"), _sql_count("bare", r"\p{Lu}")
_LINE = rf"""bare = '' OR ((regexp_matches(bare, '[.!?:;…。！？]["''”’»)\]]*$') OR regexp_matches(bare, '[.!?…。！？]["''”’»)\]]* '))
    AND {_sql_count("bare", "|")} < {quality.MENU_SEPARATORS} AND {_sql_count("bare", "»›>")} < {quality.MENU_SEPARATORS}
    AND {_sql_count("bare", quality.SYMBOLS)} <= {quality.SYMBOL_SHARE} * length(bare)
    AND NOT ({_LETTERS} >= {quality.SHOUT_LETTERS} AND {_UPPER} > {quality.SHOUT_SHARE} * {_LETTERS})
    AND NOT (regexp_matches(bare, '{quality.BOILERPLATE}') AND {_sql_count("bare", " ")} < {quality.BOILERPLATE_WORDS}))"""
_FAILED = f"(n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words)"
CHECKS["op8_quality"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM g, (VALUES (0), (1), (2)) o(k) WHERE g.n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, line, trim(line, {_BLANKS}) AS bare FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
p AS (SELECT doc_id, count(*) FILTER (bare <> '') - count(DISTINCT line) FILTER (bare <> '') AS dup,
             sum(length(line) + 1) FILTER ({_LINE}) - 1 AS left_chars FROM l GROUP BY doc_id),
m AS (SELECT d.doc_id, t, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, {_sql_count("t", quality.SYMBOLS)} AS n_symbols,
             p.dup AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(left_chars, 0) AS left_chars FROM d JOIN p USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {_FAILED} AS base_failed,
       NOT {_FAILED} AND left_chars >= {quality.KEPT_SHARE} * length(t) AS kept FROM m"""


@_query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = quality.measure(table(spark, sf_dir, "documents"))
    return verdict.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query
def op9_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned = ~held_out(F.col("doc_id"))
    docs, labels = table(spark, sf_dir, "documents", ["doc_id", "text"]), table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    model = toxicity.train(docs.where(learned), labels.where(learned))
    return toxicity.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


CHECKS["op11_ranked"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
p AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM r WHERE score > 0) WHERE rank <= 50"""


@_query
def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op12_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_bpe.digests(table(spark, sf_dir, "documents"), RANKS)


CHECKS["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b)::INTEGER AS rank, n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score QUALIFY rank <= 3"""


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=moved)
